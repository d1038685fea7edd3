"""Daily series of a stream as event-time windows (AGG-14, AGG-16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.operators.mentions import by_label


def daily_windows(
    messages: DataFrame, posted: str, by: Sequence[str], name: str, counted: str | None = None, late: str = "1 day"
) -> DataFrame:
    """Number of messages per day and group, each given out once when its day is closed.

    A day is closed when the watermark, ``late`` behind the latest message, has passed its
    end: state holds the days still open, and what comes for a closed day is dropped and
    counted in Spark's progress. ``counted`` names a column whose nulls do not count.
    Messages without a time are in no day.
    """
    n = F.count(F.col(counted) if counted else F.lit(1)).alias(name)
    day = F.window(posted, "1 day")
    return (
        messages.withWatermark(posted, late)
        .groupBy(day, *by)
        .agg(n)
        .select(F.col("window.start").alias(posted), *by, name)
    )


def daily_sentiment(messages: DataFrame, posted: str = "POSTING_TIME", late: str = "1 day") -> DataFrame:
    """Daily numbers per sentiment (AGG-14)."""
    return daily_windows(messages, posted, ["SENTIMENT"], "NUM_TWEETS", "MESSAGE_BODY", late)


def label_daily(flags: DataFrame, labels: Sequence[str], posted: str = "POSTING_TIME", late: str = "1 day") -> DataFrame:
    """Daily numbers per label that holds (AGG-16)."""
    rows = by_label(flags.select(posted, *labels), labels).select(posted, "LABEL")
    return daily_windows(rows, posted, ["LABEL"], "COUNT", late=late)
