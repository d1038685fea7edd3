"""Per-tag metrics of a batch and their smoothed state over batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.functions import render as rd
from chorale.functions import text as tx
from chorale.operators.rows import ranked

# Topic names, the counter's name and the constant message key.
TOPIC_TAGS = "topHashTags"
TOPIC_SCORES = "topHashTags.toneScores"
TOPIC_TOTAL = "total_tweets"
TOTAL = "total_tweets"
MESSAGE_KEY = "tweet"


def tag_tone_rows(
    posts: DataFrame, keep: tuple[str, ...] = (), text: str = "text", scores: str = "scores"
) -> DataFrame:
    """One row per tag of a post and tone of its score map (STR-3).

    Posts without scores or tags give nothing; a bare ``#`` is no tag here.
    """
    tags = posts.select(
        *keep, scores, F.explode(tx.hashtags(F.col(text), bare=False)).alias("tag")
    )
    return tags.select(*keep, "tag", F.explode(scores).alias("tone", "score"))


def counted_rows(posts: DataFrame, text: str = "text", scores: str = "scores") -> DataFrame:
    """Tag and tone rows plus one counter row per post, in one pass over the posts.

    The counter goes by a name no tag can have and by a tone of its own, so a
    batch is read and grouped once for the running total and the tags together.
    """
    pairs = F.flatten(
        F.transform(
            tx.hashtags(F.col(text), bare=False),
            lambda tag: F.transform(
                F.map_entries(scores),
                lambda e: F.struct(tag.alias("tag"), e["key"].alias("tone"), e["value"].alias("score")),
            ),
        )
    )
    counter = F.array(
        F.struct(F.lit(TOTAL).alias("tag"), F.lit(TOTAL).alias("tone"), F.lit(0.0).alias("score"))
    )
    return posts.select(F.inline(F.concat(counter, F.coalesce(pairs, F.slice(counter, 1, 0)))))


def tags_only(state: DataFrame) -> DataFrame:
    return state.where(F.col("tag") != TOTAL)


def total_only(state: DataFrame) -> DataFrame:
    return state.where(F.col("tag") == TOTAL)


def batch_metrics(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(tag, count, scores) of each batch (AGG-27, AGG-28).

    The count is the tag's row total divided by its tones, whole numbers only.
    Both groupings combine on the map side, so a hot tag costs a task no more
    than one row per tone.
    """
    per_tone = rows.groupBy(*keep, "tag", "tone").agg(
        F.sum("score").alias("_sum"), F.count("*").alias("_count")
    )
    mean = F.round(F.col("_sum") / F.col("_count"), 2)
    return per_tone.groupBy(*keep, "tag").agg(
        F.expr("sum(_count) div count(*)").alias("count"),
        F.map_from_entries(F.collect_list(F.struct("tone", mean))).alias("scores"),
    )


def _smooth(old: Column, new: Column) -> Column:
    def half(_, a, b):
        return (F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0))) / 2

    return F.map_zip_with(old, new, half)


def _running_mean(old: Column, new: Column, old_n: Column, new_n: Column) -> Column:
    def mean(_, a, b):
        weighted = F.coalesce(a, F.lit(0.0)) * old_n + F.coalesce(b, F.lit(0.0)) * new_n
        return F.when(old_n + new_n == 0, F.lit(0.0)).otherwise(weighted / (old_n + new_n))

    return F.map_zip_with(old, new, mean)


def fold_state(state: DataFrame | None, metrics: DataFrame, running_mean: bool = False) -> DataFrame:
    """State (tag, count, scores) after one more batch (STR-4).

    Counts add up; a score becomes the mean of its old and new value, where a
    missing side is 0.0, so a first batch is halved. Tags without news stay as
    they are. ``running_mean`` weighs by counts instead.
    """
    # The inputs go by names of their own: a lambda body would otherwise take
    # the new count for the old one.
    new = metrics.select("tag", F.col("count").alias("new_n"), F.col("scores").alias("new_scores"))
    if state is None:
        both = new.select(
            "tag",
            F.lit(None).cast("bigint").alias("old_n"),
            F.lit(None).cast("map<string,double>").alias("old_scores"),
            "new_n",
            "new_scores",
        )
    else:
        old = state.select("tag", F.col("count").alias("old_n"), F.col("scores").alias("old_scores"))
        both = old.join(new, "tag", "full")
    empty = F.create_map().cast("map<string,double>")
    old_n, new_n = F.coalesce("old_n", F.lit(0)), F.coalesce("new_n", F.lit(0))
    old_scores, new_scores = F.coalesce("old_scores", empty), F.col("new_scores")
    merged = (
        _running_mean(old_scores, new_scores, old_n, new_n)
        if running_mean
        else _smooth(old_scores, new_scores)
    )
    return both.select(
        "tag",
        (old_n + new_n).alias("count"),
        F.when(new_scores.isNull(), F.col("old_scores")).otherwise(merged).alias("scores"),
    )


# After so many halvings less than 1e-299 is left of a mean. Spark takes a window's limit
# before the shuffle up to this number.
HALVINGS = 1000


def state_of_batches(metrics: DataFrame, batch: str) -> DataFrame:
    """The state a run over all batches in order ends with, in one plan.

    A mean taken in a tag's i-th of m batches is halved m-i+1 times, so the
    fold over batches is one weighted sum: (tag, tone, count, score). What batches
    further back than ``HALVINGS`` weigh is taken for zero, so the window holds that
    many rows of a tag and Spark drops the others before the shuffle; counts and
    tones are taken over all batches by a grouping.
    """
    later = Window.partitionBy("tag").orderBy(F.desc(batch))
    recent = (
        metrics.select("tag", batch, "scores")
        .withColumn("_back", F.row_number().over(later))
        .where(F.col("_back") <= HALVINGS)
        .select("tag", F.pow(F.lit(0.5), "_back").alias("_weight"), F.explode("scores").alias("tone", "mean"))
        .groupBy("tag", "tone")
        .agg(F.sum(F.col("mean") * F.col("_weight")).alias("score"))
    )
    # Sets of tone names: tones are few.
    every = metrics.groupBy("tag").agg(
        F.sum("count").alias("count"), F.array_distinct(F.flatten(F.collect_set(F.map_keys("scores")))).alias("tones")
    )
    listed = every.select("tag", "count", F.explode("tones").alias("tone"))
    return listed.join(recent, ["tag", "tone"], "left").select(
        "tag", "tone", "count", F.coalesce("score", F.lit(0.0)).alias("score")
    )


def top_tags(state: DataFrame, n: int = 5) -> DataFrame:
    return ranked(state, "count", "tag", n)


def metric_messages(state: DataFrame, n: int = 5) -> DataFrame:
    """The two top-tag messages of a state as (topic, key, value) (STR-5, SNK-6).

    Nothing is published for a state without tags.
    """
    ordered = F.transform(
        F.array_sort(
            F.collect_list(F.struct((-F.col("count")).alias("rank"), "tag", "count", "scores")),
            # Maps have no order of their own, so compare rank and tag only.
            lambda a, b: F.when(a["rank"] < b["rank"], -1)
            .when(a["rank"] > b["rank"], 1)
            .when(a["tag"] < b["tag"], -1)
            .when(a["tag"] > b["tag"], 1)
            .otherwise(0),
        ),
        lambda r: F.struct(r["tag"].alias("tag"), r["count"].alias("count"), r["scores"].alias("scores")),
    )
    listed = top_tags(state, n).agg(ordered.alias("rows")).where(F.size("rows") > 0)
    message = F.array(
        F.struct(F.lit(TOPIC_TAGS).alias("topic"), rd.pairs_json(F.col("rows")).alias("value")),
        F.struct(F.lit(TOPIC_SCORES).alias("topic"), rd.tone_table_json(F.col("rows")).alias("value")),
    )
    return listed.select(F.inline(message)).select(
        "topic", F.lit(MESSAGE_KEY).alias("key"), "value"
    )


def total_message(total: DataFrame) -> DataFrame:
    """The running total of a (count) frame as a message; ``[]`` before any data."""
    rows = F.collect_list(F.struct(F.lit(TOTAL).alias("tag"), "count"))
    return total.agg(rd.pairs_json(rows).alias("value")).select(
        F.lit(TOPIC_TOTAL).alias("topic"), F.lit(MESSAGE_KEY).alias("key"), "value"
    )
