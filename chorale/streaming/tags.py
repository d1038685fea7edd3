"""Smoothed per-tag state in Spark's state store (STR-4, STR-5).

Each micro-batch touches the tags it holds and no others, so its cost does not
grow with the number of tags ever seen. A post goes to a map task's worker as one row
with its tags and scores, which are paired and added up there, an Arrow batch at a time:
a hot tag sends one row per tone and Arrow batch to its shuffle, not one per post.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chorale.functions import text as tx
from chorale.operators import tagstate as tg
from chorale.streaming.state import Snapshot

PARTIAL = "tag string, tone string, total double, n bigint"
STATE = "count bigint, tones array<string>, scores array<double>"
TAG_STATE = "tag string, count bigint, scores map<string,double>"


def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and counts per tag and tone of the posts (tags, scores) of each batch, and the number of its posts.

    The number of posts goes by a name no tag can have and by a tone of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        tags, scores = batch.column("tags"), batch.column("scores")
        n_tags, n_scores = (pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False) for c in (tags, scores))
        tags, scores = tags.flatten(), scores.flatten()
        # Every tag of a post meets every score of the post.
        times = np.repeat(n_scores, n_tags)
        first = np.repeat(np.cumsum(n_scores) - n_scores, n_tags)
        of_tag = np.repeat(np.arange(len(times)), times)
        of_score = np.arange(len(of_tag)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)
        pairs = pa.table({
            "tag": tags.take(pa.array(of_tag)), "tone": scores.field(0).take(pa.array(of_score)),
            "score": scores.field(1).take(pa.array(of_score)),
        })
        sums = pairs.group_by(["tag", "tone"]).aggregate([("score", "sum"), ([], "count_all")])
        yield pa.RecordBatch.from_arrays(
            [pa.array([*sums.column("tag").to_pylist(), tg.TOTAL]), pa.array([*sums.column("tone").to_pylist(), tg.TOTAL]),
             pa.array([*sums.column("score_sum").to_pylist(), 0.0], pa.float64()),
             pa.array([*sums.column("count_all").to_pylist(), batch.num_rows], pa.int64())],
            names=["tag", "tone", "total", "n"],
        )


def _half_up(value: float) -> float:
    return float(Decimal(repr(float(value))).quantize(Decimal("0.01"), ROUND_HALF_UP))


def smooth(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One more batch of one tag: counts add up, scores move half-way."""
    tones: dict[str, list] = {}
    for part in parts:
        for tone, total, n in zip(part["tone"], part["total"], part["n"]):
            seen = tones.setdefault(tone, [0.0, 0])
            seen[0] += total
            seen[1] += n
    count, scores = 0, {}
    if state.exists:
        count, names, values = state.get
        scores = dict(zip(names, values))
    count += sum(n for _, n in tones.values()) // len(tones)
    means = {tone: _half_up(total / n) for tone, (total, n) in tones.items()}
    merged = {
        tone: (scores.get(tone, 0.0) + means.get(tone, 0.0)) / 2
        for tone in sorted(scores.keys() | means.keys())
    }
    state.update((int(count), list(merged), list(merged.values())))
    yield pd.DataFrame(
        {"tag": [key[0]], "count": [count], "tones": [list(merged)], "scores": [list(merged.values())]}
    )


def state_changes(posts: DataFrame, text: str = "text", scores: str = "scores") -> DataFrame:
    """Stream of posts to the new state of every tag it touches, and of the number of posts."""
    known = F.coalesce(F.map_entries(F.col(scores).cast("map<string,double>")), F.array().cast("array<struct<key:string,value:double>>"))
    partial = posts.select(tx.hashtags(F.col(text), bare=False).alias("tags"), known.alias("scores")).mapInArrow(
        partial_sums, PARTIAL
    )
    changed = partial.groupBy("tag").applyInPandasWithState(
        smooth, f"tag string, {STATE}", STATE, "update", GroupStateTimeout.NoTimeout
    )
    return changed.select("tag", "count", F.map_from_arrays("tones", "scores").alias("scores"))


def stored_metrics(
    posts: DataFrame,
    top_path: str,
    checkpoint: str,
    publish: Callable[[DataFrame, int], None],
    on_change: Callable[[DataFrame, int], None] | None = None,
    n: int = 5,
) -> DataStreamWriter:
    """Publish the running total and the top tags of admitted, scored posts.

    Counts never fall, so the top tags over all state are among the earlier top
    tags and those just changed: n + 1 rows are kept next to the state store.
    ``on_change`` is handed the changed tags of each batch.
    """
    best = Snapshot(top_path, TAG_STATE)

    def each(batch: DataFrame, batch_id: int) -> None:
        # The state operator must run once per batch, however often it is read.
        changed = batch.persist()
        try:

            def merge(before: DataFrame | None) -> DataFrame:
                both = changed
                if before is not None:
                    kept = before.join(changed.select("tag"), "tag", "left_anti")
                    both = changed.unionByName(kept)
                return tg.top_tags(tg.tags_only(both), n).unionByName(tg.total_only(both))

            top = best.fold(changed.sparkSession, batch_id, merge)
            total = tg.total_message(tg.total_only(top))
            publish(total.unionByName(tg.metric_messages(tg.tags_only(top), n)), batch_id)
            if on_change:
                on_change(changed, batch_id)
        finally:
            changed.unpersist()

    return (
        state_changes(posts)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(each)
    )
