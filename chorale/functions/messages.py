"""Message record expressions: labels, polarity, places, times, shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def polarity_value(polarity: Column, neutral_as: int = -1) -> Column:
    """AMBIVALENT 0, POSITIVE 1, anything else -1, null included (PRJ-11)."""
    return (
        F.when(polarity == "AMBIVALENT", 0)
        .when(polarity == "POSITIVE", 1)
        .when(polarity == "NEUTRAL", neutral_as)
        .otherwise(-1)
    )


def polarity_label(mean: Column) -> Column:
    return (
        F.when(mean > 0, "POSITIVE").when(mean < 0, "NEGATIVE").otherwise("AMBIVALENT")
    )


def upper_or_none(name: Column) -> Column:
    """Upper case, with null shown as the string NONE."""
    return F.upper(F.coalesce(name, F.lit("None")))


def display_place(name: Column) -> Column:
    return F.when(name == "NONE", "UNKNOWN").otherwise(name)


def point_part(location: Column, index: int) -> Column:
    """Part of ``'pos (lon lat)'`` as float, null when it cannot be read (SCL-6).

    The text between the first ``(`` and the next ``)`` is cut at blanks.
    """
    inside = F.split_part(F.split_part(location, F.lit("("), F.lit(2)), F.lit(")"), F.lit(1))
    part = F.split_part(inside, F.lit(" "), F.lit(index))
    # A type suffix, as in "1.5f", is no part of a number here.
    return F.when(~part.rlike("[0-9.][dDfF]$"), part.try_cast("float"))


def midnight(ts: Column) -> Column:
    """Day of a timestamp as a time-zone-free timestamp."""
    return ts.cast("date").cast("timestamp_ntz")


def influence(followers: Column, friends: Column) -> Column:
    return (followers + friends) / F.lit(2.0)


def percentage(total: Column, part: Column) -> Column:
    """Part as per cent of the total, 0 for an empty total."""
    return F.when(total == 0, F.lit(0.0)).otherwise(part * 100 / total)
