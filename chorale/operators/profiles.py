"""Per-author corpora, trait summaries and profile distances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.functions import text as tx
from chorale.functions import vectors as vx
from chorale.operators.rows import first_per_group, unpivot_row
from chorale.operators.running import running_sums


def recent_per_user(
    posts: DataFrame, order: Sequence[Column], n: int = 200, user: str = "userid"
) -> DataFrame:
    """The latest n own posts of every user, reposts and replies left out (UDF-6)."""
    own = posts.where(~F.col("is_repost") & ~F.col("is_reply"))
    return first_per_group(own, [user], order, n)


def author_corpus(
    posts: DataFrame,
    order: str = "created_at",
    more_than: int = 100,
    user: str = "userid",
) -> DataFrame:
    """ASCII copy of all of a user's own posts in one text, by time (AGG-8, FIL-10).

    The text of a user is one value, so it has to fit in a task; :func:`corpus_parts` is
    for users of any size, and :func:`recent_per_user` in front takes the latest posts. Reposts and replies are left out,
    and users with too few words.
    """
    own = posts.where(~F.col("is_repost") & ~F.col("is_reply"))
    parts = own.select(user, order, tx.ascii_only(F.col("text")).alias("text"))
    return (
        parts.groupBy(user)
        .agg(F.array_sort(F.collect_list(F.struct(order, "text"))).alias("_posts"))
        .select(
            user,
            F.size("_posts").alias("n_posts"),
            F.array_join(F.transform("_posts", lambda p: p["text"]), "\n").alias("text"),
        )
        .withColumn("n_words", tx.word_count(F.col("text")))
        .where(F.col("n_words") > more_than)
    )


def corpus_parts(
    posts: DataFrame,
    order: str = "created_at",
    more_than: int = 100,
    user: str = "userid",
    part_chars: int = 1 << 20,
) -> DataFrame:
    """(user, part, n_posts, text): a user's corpus, by time, in parts of bounded size (AGG-8, FIL-10).

    The same texts, posts and users as :func:`author_corpus`, for users of any size. A post
    belongs to the part its first character lies in, when a user's corpus is cut every
    ``part_chars`` characters, so parts are told from the data alone; a part is longer than
    that by one post at most, and a long post can leave part numbers out. Null texts count
    as empty here.
    """
    own = posts.where(~F.col("is_repost") & ~F.col("is_reply"))
    texts = own.select(user, order, F.coalesce(tx.ascii_only(F.col("text")), F.lit("")).alias("text"))
    sized = texts.withColumn("_size", (F.length("text") + 1).cast("bigint"))
    placed = running_sums(sized, user, [F.col(order), F.col("text")], "_size")
    part = F.expr(f"size_before div {part_chars}").alias("part")
    parts = (
        placed.select(user, order, "text", part)
        .groupBy(user, "part")
        .agg(F.array_sort(F.collect_list(F.struct(order, "text"))).alias("_posts"))
        .select(
            user, "part", F.size("_posts").cast("bigint").alias("n_posts"),
            F.array_join(F.transform("_posts", lambda p: p["text"]), "\n").alias("text"),
        )
    )
    # Posts are parted by a line end, so their words add up.
    wordy = texts.groupBy(user).agg(F.sum(tx.word_count(F.col("text"))).alias("_words")).where(F.col("_words") > more_than)
    return parts.join(wordy.select(user), user, "left_semi")


def describe_traits(profiles: DataFrame, traits: Mapping[str, Column]) -> DataFrame:
    """count, mean, stddev, min and max of each trait, in one pass (AGG-9)."""
    measures = {
        "count": F.count,
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    wide = profiles.agg(
        *[f(c).alias(f"{t}:{m}") for t, c in traits.items() for m, f in measures.items()]
    )
    return unpivot_row(
        wide,
        [
            F.struct(F.lit(t).alias("trait"), *[F.col(f"`{t}:{m}`").alias(m) for m in measures])
            for t in traits
        ],
    )


def profile_distances(
    profiles: DataFrame,
    references: DataFrame,
    names: Mapping[str, object],
    key: str,
    vector: str,
) -> DataFrame:
    """Distance of every profile to the named reference profiles (JOIN-7).

    ``names`` maps an output name to a key of ``references``. Each reference is
    one scalar subquery, so its vector is a constant of the scan.
    """
    out = profiles
    for name, value in names.items():
        # The first of equal keys: a scalar subquery must give one row.
        picked = references.where(F.col(key) == F.lit(value)).agg(F.min(vector)).scalar()
        out = out.withColumn(f"_{name}", picked)
    return out.select(
        *profiles.columns,
        *[vx.euclidean(F.col(vector), F.col(f"_{name}")).alias(name) for name in names],
    )


def closer_of_two(distances: DataFrame, first: str, second: str, name: str) -> DataFrame:
    return distances.withColumn(name, vx.closer(F.col(first), F.col(second)))
