"""Score expressions: rounding, payload flattening, fixed score columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chorale.schemas import FACTORS


def percent_score(score: Column) -> Column:
    """Round half up to two decimals, then to 0–100 (SCL-9)."""
    return F.round(score, 2) * 100.0


def payload_scores(payload: Column) -> Column:
    """Nested tone payload to ``map<tone_id, score>`` (PRJ-1).

    Null payload, categories or tones give an empty map; the last of repeated
    tone ids wins, whatever the session's map key policy is.
    """
    categories = payload["document_tone"]["tone_categories"]
    entries = F.coalesce(
        F.flatten(F.transform(categories, lambda c: F.coalesce(c["tones"], F.array()))),
        F.array(),
    )
    ids = F.array_distinct(F.transform(entries, lambda t: t["tone_id"]))
    return F.map_from_arrays(
        ids,
        F.transform(
            ids,
            lambda i: percent_score(
                F.element_at(F.filter(entries, lambda t: t["tone_id"] == i), -1)["score"]
            ),
        ),
    )


def score_columns(scores: Column) -> list[Column]:
    """The fixed score columns out of a score map, 0.0 where absent (PRJ-2)."""
    return [score_of(scores, tone).alias(name) for name, tone in FACTORS]


def score_of(scores: Column, tone: str) -> Column:
    return F.coalesce(F.try_element_at(scores, F.lit(tone)), F.lit(0.0))


def last_wins_map(pairs: Column) -> Column:
    """Array of (key, value) structs to a map in which later keys win (SCL-11)."""
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    return F.map_from_arrays(
        keys,
        F.transform(
            keys, lambda k: F.element_at(F.filter(pairs, lambda p: p["key"] == k), -1)["value"]
        ),
    )
