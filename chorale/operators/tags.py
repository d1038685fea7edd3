"""Hashtag and word rankings, and the tag-by-tone breakdown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.functions import text as tx
from chorale.operators.rows import ranked
from chorale.schemas import TONES


def hashtag_counts(posts: DataFrame, text: str = "text") -> DataFrame:
    """How often each tag token occurs (AGG-4)."""
    return (
        posts.select(F.explode(tx.hashtags(F.col(text))).alias("tag"))
        .groupBy("tag")
        .agg(F.count("*").alias("n"))
    )


def top_hashtags(posts: DataFrame, n: int = 10, text: str = "text") -> DataFrame:
    return ranked(hashtag_counts(posts, text), "n", "tag", n)


def word_counts(
    posts: DataFrame, stop_words: Sequence[str] = tx.STOP_WORDS, text: str = "text"
) -> DataFrame:
    """Counts of admitted words (FIL-9).

    The stop list is a literal set inside the filter, so no join is planned.
    """
    words = posts.select(F.explode(F.split(text, r"\s")).alias("word"))
    return (
        words.where(tx.worthy_word(F.col("word"), stop_words))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def top_words(
    posts: DataFrame,
    n: int = 10,
    stop_words: Sequence[str] = tx.STOP_WORDS,
    text: str = "text",
) -> DataFrame:
    return ranked(word_counts(posts, stop_words, text), "n", "word", n)


def without_words(words: DataFrame, stop_words: DataFrame, word: str = "word") -> DataFrame:
    """Stop-word exclusion against a table (JOIN-8); Spark picks the join by size."""
    return words.join(stop_words.select(F.col(stop_words.columns[0]).alias(word)), word, "left_anti")


def _counts_by_tag(top: DataFrame) -> Column:
    """The ranked tags (a handful of rows) as one map value, a scalar subquery."""
    return top.agg(F.map_from_entries(F.collect_list(F.struct("tag", "n")))).scalar()


def tag_matches(posts: DataFrame, top: DataFrame, text: str = "text") -> DataFrame:
    """Posts paired with every top tag they contain as a substring (JOIN-5).

    The ranked tags reach the scan as a constant, so each text is tested where
    it is read, without a join.
    """
    hits = F.filter(F.map_keys("_tags"), lambda t: F.col(text).contains(t))
    return (
        posts.withColumn("_tags", _counts_by_tag(top))
        .withColumn("_hits", hits)
        .where(F.size("_hits") > 0)
        .withColumn("tag", F.explode("_hits"))
        .drop("_tags", "_hits")
    )


def _tag_tone_means(
    posts: DataFrame, top: DataFrame, tones: Sequence[str], text: str
) -> DataFrame:
    # One narrow row per pair: the tones stay columns until after the grouping,
    # so the shuffle carries one row per tag and task instead of one per tone.
    pairs = tag_matches(posts.select(text, *tones), top, text)
    return (
        pairs.select(tx.tag_label(F.col("tag")).alias("tag"), *tones)
        .groupBy("tag")
        .agg(*[F.round(F.avg(t), 2).alias(t) for t in tones])
    )


def tag_tone_breakdown(
    posts: DataFrame,
    top: DataFrame,
    tones: Sequence[str] = tuple(TONES),
    text: str = "text",
) -> DataFrame:
    """Mean of every tone per top tag, rounded to two places (AGG-5)."""
    return _tag_tone_means(posts, top, tones, text).unpivot("tag", list(tones), "tone", "mean")


def tag_tone_arrays(
    posts: DataFrame,
    top: DataFrame,
    tones: Sequence[str] = tuple(TONES),
    n: int = 10,
    text: str = "text",
) -> DataFrame:
    """Per tag the tone names in order and their means, busiest tags first (AGG-6).

    A label that is not itself a counted tag ranks as 0, hence last.
    """
    by_name = sorted(tones)
    means = _tag_tone_means(posts, top, tones, text).select(
        "tag",
        F.array(*[F.lit(t) for t in by_name]).alias("tones"),
        F.array(*[F.col(t) for t in by_name]).alias("means"),
    )
    n_of_tag = F.coalesce(F.try_element_at("_rank", F.col("tag")), F.lit(0))
    return (
        means.withColumn("_rank", _counts_by_tag(top))
        .withColumn("n", n_of_tag.cast("bigint"))
        .drop("_rank")
        .orderBy(F.desc("n"), "tag")
        .limit(n)
    )
