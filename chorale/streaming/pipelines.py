"""The streaming jobs: capture, running metrics, throttle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from chorale.functions.scores import score_columns
from chorale.operators import tagstate as tg
from chorale.operators.rows import admit
from chorale.schemas import POST_BASE
from chorale.session import cached
from chorale.sources import streams
from chorale.streaming.state import Snapshot
from chorale.streaming.tags import TAG_STATE


def scored_posts(
    messages: DataFrame,
    scores: Column,
    keywords: Sequence[str] = ("",),
    ignore_case: bool = False,
) -> DataFrame:
    """Topic messages decoded, admitted and scored, for streams and batches (STR-10).

    ``scores`` is any expression over a post that gives ``map<tone, score>``; a
    Python scorer only sees the posts that were admitted.
    """
    posts = streams.flat_posts(streams.decode_status(messages))
    return admit(posts, keywords, ignore_case).withColumn("scores", scores)


def scored_table(posts: DataFrame) -> DataFrame:
    """Scored posts as the flat table with one column per tone (PRJ-2)."""
    return posts.select(*POST_BASE.names, *score_columns(F.col("scores")))


def capture(posts: DataFrame, path: str, checkpoint: str, by: Sequence[str] = ()) -> DataStreamWriter:
    """Append every micro-batch to a growing table (SNK-3).

    The file sink commits a batch once, so a retried batch does not repeat rows.
    """
    return (
        posts.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*by)
        .outputMode("append")
    )


def write_batches(
    posts: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]
) -> DataStreamWriter:
    """Hand each non-empty micro-batch to a batch writer (SNK-5, FIL-14).

    The batch is kept while it is looked at and written, so its plan runs once.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        with cached(batch):
            if not batch.isEmpty():
                write(batch, batch_id)

    return posts.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)


def print_batches(df: DataFrame, rows: int = 10) -> DataStreamWriter:
    """Show the first rows of every batch on the console (SNK-9)."""
    return df.writeStream.format("console").option("numRows", rows).option("truncate", "false")


def running_total(posts: DataFrame, key: str = tg.TOTAL) -> DataFrame:
    """Rows seen so far as one keyed row, for complete output mode (STR-2)."""
    return posts.groupBy(F.lit(key).alias("key")).agg(F.count("*").alias("count"))


def published_total(posts: DataFrame, checkpoint: str, publish: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """Publish the number of rows seen so far after every batch (AGG-29, STR-2).

    The total is one row of the state store, so a batch reads its own rows only.
    """

    def each(total: DataFrame, batch_id: int) -> None:
        publish(tg.total_message(total), batch_id)

    return (
        running_total(posts)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(each)
    )


def write_message_folder(path: str) -> Callable[[DataFrame, int], None]:
    """Message rows of a batch to their own folder, so a retry replaces them."""

    def write(messages: DataFrame, batch_id: int) -> None:
        messages.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def running_metrics(
    posts: DataFrame,
    state_path: str,
    checkpoint: str,
    publish: Callable[[DataFrame, int], None],
    keywords: Sequence[str] = ("",),
    ignore_case: bool = False,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    running_mean: bool = False,
    n: int = 5,
) -> DataStreamWriter:
    """Admit, score, expand, aggregate and fold a stream of posts (STR-10).

    Every batch adds to the running total and to the per-tag state, then
    publishes the total and the messages of the top tags over all state. Posts
    bring a ``scores`` map, or ``enrich`` gives it to each batch.

    A batch is grouped before it meets the state, so the rows of a hot tag are
    combined where they are read and the join carries one row per tag. The total
    is a row of the same state: one pass over the batch serves both.

    The state table is read and written whole in every batch, which lets a batch
    be enriched in any way. For many millions of tags and posts that already
    have their scores use :func:`chorale.streaming.tags.stored_metrics`.
    """
    states = Snapshot(state_path, TAG_STATE)

    def each(batch: DataFrame, batch_id: int) -> None:
        scored = enrich(batch) if enrich else batch
        metrics = tg.batch_metrics(tg.counted_rows(scored))
        state = states.fold(
            batch.sparkSession,
            batch_id,
            lambda before: tg.fold_state(before, metrics, running_mean),
        )
        total = tg.total_message(tg.total_only(state))
        publish(total.unionByName(tg.metric_messages(tg.tags_only(state), n)), batch_id)

    return (
        admit(posts, keywords, ignore_case)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(each)
    )
