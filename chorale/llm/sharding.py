"""Contiguous shards of near equal bytes, from global prefix sums.

Rows are put in one order over all partitions (a range exchange and a sort inside each).
Every partition reports its totals, a row per partition; their prefix sums, taken in the
driver, are where each partition starts. A second pass adds the running sum inside the
partition, so every row knows how many bytes and rows stand before it in the whole table.
Shards are the stretches between equal targets of the total.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import kept, prepared

SHARDS = 8


def _totals(size: str):
    def run(batches):
        rows = total = 0
        for batch in batches:
            rows += batch.num_rows
            total += int(np.sum(batch.column(size).to_numpy(zero_copy_only=False), dtype=np.int64))
        if rows:
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                 "rows": pa.array([rows], pa.int64()), "total": pa.array([total], pa.int64())}
            )

    return run


def _running(size: str, starts: dict[int, tuple[int, int]]):
    def run(batches):
        row, before = starts.get(TaskContext.get().partitionId(), (0, 0))
        for batch in batches:
            sizes = batch.column(size).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = before + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(row + np.arange(len(sizes), dtype=np.int64)), pa.array(sums - sizes)],
                names=[*batch.schema.names, "row_number", "size_before"],
            )
            row += len(sizes)
            before += int(sizes.sum())

    return run


def positions(df: DataFrame, order: list[str], size: str) -> tuple[DataFrame, int, int]:
    """``df`` with ``row_number`` (from 0) and ``size_before`` in the order given; number of rows; total size.

    Nulls come first. Rows equal in all order columns stand in any order among themselves.
    The rows are written once to the checkpoint folder, since both passes must see the same
    partitions. An empty table gives no rows and zero totals.
    """
    prepared(df.sparkSession)
    placed = kept(df.repartitionByRange(*order).sortWithinPartitions(*order))
    found = placed.select(size).mapInArrow(_totals(size), "part int, rows bigint, total bigint").collect()
    starts, rows, total = {}, 0, 0
    for part in sorted(found):
        starts[part["part"]] = (rows, total)
        rows += part["rows"]
        total += part["total"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields)
    return placed.mapInArrow(_running(size, starts), f"{fields}, row_number bigint, size_before bigint"), rows, total


def cut(df: DataFrame, order: list[str], size: str, shards: int = SHARDS) -> DataFrame:
    """``df`` with its ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    A row belongs to the stretch its middle byte lies in, so a shard is off its equal
    share by less than one row's size. Sizes must be positive. A row larger than a share
    leaves shards empty.
    """
    placed, _, total = positions(df, order, size)
    # Integers in decimal: twice the total times the shards may pass 63 bits.
    middle = (F.col("size_before").cast("decimal(38,0)") * 2 + F.col(size)) * shards
    sharded = placed.withColumn(
        "shard", F.least(F.lit(shards - 1), F.floor(middle / F.lit(max(1, 2 * total)).cast("decimal(38,0)")).cast("int"))
    )
    firsts = {r["shard"]: r["first"] for r in sharded.groupBy("shard").agg(F.min("row_number").alias("first")).collect()}
    first = F.coalesce(*(F.when(F.col("shard") == k, F.lit(v)) for k, v in firsts.items()), F.lit(0))
    return sharded.withColumn("slot", (F.col("row_number") - first).cast("long")).drop("row_number", "size_before")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    The law is ``bytes``: shards are stretches of contiguous doc_ids, so documents with equal
    texts may lie in different shards. The order is by doc_id (null first), then by size and
    checksum; repeated rows get a slot each. An empty table gives no rows. A null text counts as an empty one: size 1. Texts are read once and not
    moved. Other columns are not read.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    return cut(sized, ["doc_id", "size", "text_crc32"], "size", shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
