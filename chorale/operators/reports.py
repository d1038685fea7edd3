"""Breakdowns of cleaned and flagged messages.

Label reports with a fixed set of rows are conditional aggregates in one pass:
every task sends one row, and labels without messages keep their zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.functions import messages as ms
from chorale.operators.mentions import by_label
from chorale.operators.rows import first_per_group, unpivot_row


def count_by(df: DataFrame, key: str, counted: str = "MESSAGE_BODY") -> DataFrame:
    """Rows per key value with a non-null counted column (AGG-11/12/13)."""
    return df.groupBy(key).agg(F.count(counted).alias("NUM_TWEETS"))


def country_counts(df: DataFrame) -> DataFrame:
    return count_by(df, "USER_COUNTRY").orderBy(F.desc("NUM_TWEETS"), "USER_COUNTRY")


def sentiment_counts(df: DataFrame) -> DataFrame:
    return count_by(df, "SENTIMENT", "MESSAGE_ID")


def gender_counts(df: DataFrame) -> DataFrame:
    return count_by(df, "USER_GENDER")


def _per_label(
    flags: DataFrame, labels: Sequence[str], measures: dict[str, Column | None]
) -> DataFrame:
    """Count per label and measure; a measure of None counts the label itself."""
    counts, rows = [], []
    for label in labels:
        fields = [F.lit(label).alias("LABEL")]
        for name, condition in measures.items():
            hit = F.col(label) if condition is None else F.col(label) & condition
            key = f"{label}:{name}"
            counts.append(F.count_if(hit).alias(key))
            fields.append(F.col(f"`{key}`").alias(name))
        rows.append(F.struct(*fields))
    return unpivot_row(flags.agg(*counts), rows)


def label_totals(flags: DataFrame, labels: Sequence[str]) -> DataFrame:
    return _per_label(flags, labels, {"TOTAL": None})


def label_sentiment_split(flags: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Positive, negative and the rest per label (AGG-19)."""
    split = _per_label(
        flags,
        labels,
        {
            "TOTAL": None,
            "POSITIVE": F.col("SENTIMENT") == "POSITIVE",
            "NEGATIVE": F.col("SENTIMENT") == "NEGATIVE",
        },
    )
    return split.withColumn("OTHER", F.col("TOTAL") - F.col("POSITIVE") - F.col("NEGATIVE"))


def label_gender_split(flags: DataFrame, labels: Sequence[str]) -> DataFrame:
    split = _per_label(
        flags,
        labels,
        {
            "TOTAL": None,
            "MALE": F.col("USER_GENDER") == "male",
            "FEMALE": F.col("USER_GENDER") == "female",
        },
    )
    return split.withColumn("UNKNOWN", F.col("TOTAL") - F.col("MALE") - F.col("FEMALE"))


def label_influence(flags: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Mean influence per label, null for a label without messages (AGG-21)."""
    means = flags.agg(*[F.avg(F.when(F.col(n), F.col("INFLUENCE"))).alias(n) for n in labels])
    return unpivot_row(
        means, [F.struct(F.lit(n).alias("LABEL"), F.col(n).alias("AVE_INFLUENCE")) for n in labels]
    )


def label_countries(flags: DataFrame, labels: Sequence[str]) -> DataFrame:
    return (
        by_label(flags.select("USER_COUNTRY", *labels), labels)
        .groupBy("LABEL", "USER_COUNTRY")
        .agg(F.count("*").alias("COUNT"))
    )


def label_top_countries(flags: DataFrame, labels: Sequence[str], n: int = 5) -> DataFrame:
    return first_per_group(
        label_countries(flags, labels), ["LABEL"], [F.desc("COUNT"), F.asc("USER_COUNTRY")], n
    )


def label_country_matrix(
    flags: DataFrame, labels: Sequence[str], countries: Sequence[str]
) -> DataFrame:
    """Label by chosen countries, absent pairs 0 (AGG-23)."""
    return _per_label(flags, labels, {c: F.col("USER_COUNTRY") == c for c in countries})


SENTIMENTS = ("POSITIVE", "NEGATIVE", "NEUTRAL", "AMBIVALENT")


def feature_report(flags: DataFrame, feature: str, labels: Sequence[str]) -> DataFrame:
    """Counts and percentages per label among messages with a feature (AGG-24/25).

    Sentiment shares are of the four named sentiments, gender shares of all.
    """
    counts = _per_label(
        flags.where(F.col(feature)),
        labels,
        {
            "TOTAL": None,
            "MALE": F.col("USER_GENDER") == "male",
            "FEMALE": F.col("USER_GENDER") == "female",
            **{s: F.col("SENTIMENT") == s for s in SENTIMENTS},
        },
    )
    known = sum((F.col(s) for s in SENTIMENTS[1:]), F.col(SENTIMENTS[0]))
    total = F.col("TOTAL")
    rest = total - F.col("MALE") - F.col("FEMALE")
    return counts.select(
        "*",
        *[ms.percentage(known, F.col(s)).alias(f"{s}_PCT") for s in SENTIMENTS],
        ms.percentage(total, F.col("MALE")).alias("MALE_PCT"),
        ms.percentage(total, F.col("FEMALE")).alias("FEMALE_PCT"),
        ms.percentage(total, rest).alias("UNKNOWN_PCT"),
    )
