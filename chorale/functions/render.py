"""Text forms of small results: message bodies and graph statements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _no_quotes(text: Column) -> Column:
    return F.translate(text, '"', "")


def _row(label: Column, rest: Column) -> Column:
    return F.concat(
        F.lit('["'),
        _no_quotes(label),
        F.lit('"'),
        F.array_join(F.transform(rest, lambda v: F.concat(F.lit(","), v)), ""),
        F.lit("]"),
    )


def pairs_json(pairs: Column) -> Column:
    """``[["#a",3],["#b",2]]`` from an array of (tag, count); empty gives ``[]``."""
    rows = F.transform(pairs, lambda p: _row(p["tag"], F.array(p["count"].cast("string"))))
    return F.concat(F.lit("["), F.array_join(rows, ","), F.lit("]"))


def tone_table_json(rows: Column) -> Column:
    """``[["x",tone…],["#a",score…],…]``; the first row names the tones.

    Each element is (tag, count, scores map); scores are listed by tone name.
    """

    def names(r: Column) -> Column:
        return F.array_sort(F.map_keys(r["scores"]))

    header = F.when(
        F.size(rows) > 0,
        F.array(
            _row(
                F.lit("x"),
                F.transform(
                    names(F.try_element_at(rows, F.lit(1))),
                    lambda t: F.concat(F.lit('"'), _no_quotes(t), F.lit('"')),
                ),
            )
        ),
    ).otherwise(F.array().cast("array<string>"))
    body = F.transform(
        rows,
        lambda r: _row(
            r["tag"],
            F.transform(names(r), lambda t: F.element_at(r["scores"], t).cast("string")),
        ),
    )
    return F.concat(F.lit("["), F.array_join(F.concat(header, body), ","), F.lit("]"))


def script_text(text: Column) -> Column:
    """Quote-escaped text for a graph statement."""
    return F.replace(text, F.lit("'"), F.lit("\\'"))


def property_arguments(properties: Column) -> Column:
    """``,'key','value'`` for every property, by key."""
    return F.array_join(
        F.transform(
            F.array_sort(F.map_entries(properties)),
            lambda e: F.concat(
                F.lit(",'"),
                script_text(e["key"]),
                F.lit("','"),
                script_text(F.coalesce(e["value"], F.lit(""))),
                F.lit("'"),
            ),
        ),
        "",
    )


def property_text(properties: Column) -> Column:
    """``key=value`` pairs by key, for reports that want one text column."""
    return F.array_join(
        F.transform(
            F.array_sort(F.map_entries(properties)),
            lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))),
        ),
        ";",
    )
