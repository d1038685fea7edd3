"""Messages joined to their sentiment records while both arrive (JOIN-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.functions import messages as ms


def polarity_pairs(
    messages: DataFrame,
    sentiments: DataFrame,
    posted: str,
    scored: str,
    within: str = "7 days",
    late: str = "1 day",
    neutral_as: int = -1,
    key: str = "MESSAGE_ID",
) -> DataFrame:
    """Every message beside the polarity of each of its records, as a column ``POLARITY``.

    A record's time ``scored`` lies between its message's time ``posted`` and ``within``
    after it. Rows may come ``late`` behind the latest seen of both streams. These two
    bounds let Spark drop a row from its state as soon as nothing that can still come
    matches it, so state holds rows of the span of both and not of all time. Rows without
    key or time match nothing. :func:`mean_polarity` puts the pairs together.
    """
    left = messages.where(F.col(key).isNotNull() & F.col(posted).isNotNull()).withWatermark(posted, late)
    right = (
        sentiments.where(F.col(key).isNotNull() & F.col(scored).isNotNull())
        .select(
            F.col(key).alias("_key"), F.col(scored).alias("_scored"),
            ms.polarity_value(F.col("SENTIMENT_POLARITY"), neutral_as).alias("POLARITY"),
        )
        .withWatermark("_scored", late)
    )
    span = F.expr(f"_scored >= `{posted}` AND _scored <= `{posted}` + INTERVAL {within}")
    return left.join(right, (F.col(key) == F.col("_key")) & span).drop("_key", "_scored")


def mean_polarity(pairs: DataFrame, *columns: str) -> DataFrame:
    """Messages with mean polarity and its label, of all pairs so far (JOIN-2, AGG-10)."""
    return (
        pairs.groupBy(*columns)
        .agg(F.avg("POLARITY").alias("SENTIMENT_POLARITY"))
        .withColumn("SENTIMENT", ms.polarity_label(F.col("SENTIMENT_POLARITY")))
    )
