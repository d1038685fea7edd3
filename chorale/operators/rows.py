"""Row selection and shaping shared by the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.functions import text as tx


def admit(
    posts: DataFrame,
    keywords: Sequence[str] = ("",),
    ignore_case: bool = False,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """Admission filter of the stream (FIL-1); works on batch frames alike."""
    return posts.where(tx.admitted(F.col(lang), F.col(text), keywords, ignore_case))


def columns_first(df: DataFrame, front: Sequence[str]) -> DataFrame:
    """Named columns first, the rest in their order (FIL-5)."""
    return df.select(*front, *[c for c in df.columns if c not in front])


def above(df: DataFrame, column: str, limit: float) -> DataFrame:
    return df.where(F.col(column) > limit)


def within(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows of the half-open span ``[start, end)`` (FIL-8)."""
    kind = df.schema[ts].dataType.simpleString()
    return df.where(
        (F.col(ts) >= F.lit(start).cast(kind)) & (F.col(ts) < F.lit(end).cast(kind))
    )


def matching(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows with a category value, where None picks the missing ones (FIL-7, SET-2)."""
    return df.where(F.col(column).eqNullSafe(F.lit(value)))


def wordy(df: DataFrame, text: str = "text", more_than: int = 100) -> DataFrame:
    """Rows whose text has more than so many words (FIL-10)."""
    return df.where(tx.word_count(F.col(text)) > more_than)


def flagged(df: DataFrame, flag: str) -> DataFrame:
    return df.where(F.col(flag))


def ranked(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    """Top-n by a measure, the key settling ties (TOP-1)."""
    return df.orderBy(F.desc(measure), F.asc(key)).limit(n)


def first_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, strands: int = 256
) -> DataFrame:
    """The first n rows of every group, hot groups included (TOP-5, UDF-6).

    Done in two rounds. Spark already keeps only n rows per group and map task
    before a shuffle; the strand then spreads what many map tasks send for one
    hot group, so the last round sees at most ``strands * n`` rows of it.
    """
    strand = df.withColumn("_strand", F.spark_partition_id() % strands)
    narrow = Window.partitionBy(*group, "_strand").orderBy(*order)
    wide = Window.partitionBy(*group).orderBy(*order)
    return (
        strand.withColumn("_n", F.row_number().over(narrow))
        .where(F.col("_n") <= n)
        .withColumn("_n", F.row_number().over(wide))
        .where(F.col("_n") <= n)
        .drop("_strand", "_n")
    )


def with_share(counts: DataFrame, n: str, share: str = "share") -> DataFrame:
    """Per cent of the whole (AGG-26).

    The total is an uncorrelated scalar subquery over the grouped counts, so no
    single-partition window is needed and the grouping exchange is shared.
    """
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn(share, F.col(n) * 100.0 / total)


def unpivot_row(totals: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """One wide row of totals to one row per struct in ``rows``."""
    return totals.select(F.inline(F.array(*rows)))
