"""Daily series and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.operators.mentions import by_label

# Sentiment values a timeline is split by; None stands for missing ones.
SERIES = ("POSITIVE", "NEGATIVE", "NEUTRAL", "AMBIVALENT", None)


def daily_sentiment(df: DataFrame) -> DataFrame:
    return df.groupBy("POSTING_TIME", "SENTIMENT").agg(
        F.count("MESSAGE_BODY").alias("NUM_TWEETS")
    )


def daily_totals(daily: DataFrame) -> DataFrame:
    """Roll a daily breakdown up to one total per day (AGG-15)."""
    return daily.groupBy("POSTING_TIME").agg(F.sum("NUM_TWEETS").alias("NUM_TWEETS"))


def daily_rollup(df: DataFrame) -> DataFrame:
    """Daily breakdown and daily totals in one grouping (AGG-14 with AGG-15).

    Total rows have ``IS_TOTAL``; it tells them from rows of a missing sentiment.
    """
    return (
        df.rollup("POSTING_TIME", "SENTIMENT")
        .agg(F.count("MESSAGE_BODY").alias("NUM_TWEETS"), F.grouping_id().alias("_level"))
        .where(F.col("_level") < 3)
        .withColumn("IS_TOTAL", F.col("_level") == 1)
        .drop("_level")
    )


def daily_filled(df: DataFrame, series: Sequence[str | None] = SERIES) -> DataFrame:
    """Every sentiment on every day present, 0 where it did not occur (JOIN-4).

    The spine is the days seen overall, so grouping by day with one conditional
    count per sentiment fills the gaps in the same shuffle: no join is needed.
    """
    named = [(s if s is not None else "NONE", s) for s in series]
    counted = F.col("MESSAGE_BODY").isNotNull()
    wide = df.groupBy("POSTING_TIME").agg(
        *[
            F.count_if(
                counted & (F.col("SENTIMENT").isNull() if s is None else F.col("SENTIMENT") == s)
            ).alias(name)
            for name, s in named
        ]
    )
    return wide.unpivot("POSTING_TIME", [n for n, _ in named], "SENTIMENT", "NUM_TWEETS")


def fill_gaps(
    spine: DataFrame, series: DataFrame, day: str = "POSTING_TIME", value: str = "NUM_TWEETS"
) -> DataFrame:
    """Left-join any spine of days to a series, 0 where absent."""
    return spine.join(series, day, "left").withColumn(value, F.coalesce(value, F.lit(0)))


def calendar(series: DataFrame, day: str = "POSTING_TIME") -> DataFrame:
    """All days from the first to the last of a series, as an optional spine."""
    kind = series.schema[day].dataType.simpleString()
    span = series.agg(
        F.min(F.col(day).cast("date")).alias("a"), F.max(F.col(day).cast("date")).alias("b")
    )
    days = span.where(F.col("a").isNotNull()).select(F.explode(F.sequence("a", "b")).alias(day))
    return days.select(F.col(day).cast(kind).alias(day))


def calendar_filled(
    df: DataFrame, wanted: Column, day: str = "POSTING_TIME", value: str = "NUM_TWEETS"
) -> DataFrame:
    """Number of wanted rows on each day from the first to the last of any row, 0 where there is none.

    One grouping by day, with a conditional count, gives both the days' numbers and, from
    that small result, the first and last day.
    """
    counts = df.groupBy(day).agg(F.count_if(wanted).alias(value))
    return fill_gaps(calendar(counts, day), counts, day, value)


def month_starts(series: DataFrame, day: str = "POSTING_TIME") -> DataFrame:
    """Rows on the first of a month with the axis label (FIL-15, SCL-8)."""
    return series.where(F.dayofmonth(day) == 1).withColumn(
        "LABEL", F.date_format(day, "yyyy-MM-dd")
    )


def label_daily(flags: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Daily count per label in one pass (AGG-16)."""
    return (
        by_label(flags.select("POSTING_TIME", *labels), labels)
        .groupBy("LABEL", "POSTING_TIME")
        .agg(F.count("*").alias("COUNT"))
    )


def label_daily_sentiment(
    flags: DataFrame, labels: Sequence[str], sentiments: Sequence[str] = ("POSITIVE", "NEGATIVE")
) -> DataFrame:
    """Daily count per label and sentiment, 0 on days without any (AGG-17)."""
    cells = [(label, s) for label in labels for s in sentiments]
    wide = flags.groupBy("POSTING_TIME").agg(
        *[
            F.count_if(F.col(label) & (F.col("SENTIMENT") == s)).alias(f"{label}:{s}")
            for label, s in cells
        ]
    )
    return wide.select(
        "POSTING_TIME",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias("LABEL"),
                        F.lit(s).alias("SENTIMENT"),
                        F.col(f"`{label}:{s}`").alias("COUNT"),
                    )
                    for label, s in cells
                ]
            )
        ),
    )
