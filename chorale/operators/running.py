"""Running sums per group over an order of the whole table.

Rows are put in order by a range exchange, so a group of any size lies over as many
partitions as it needs and none is held whole. Each partition reports the sums of its first
and its last group, one row; carried from partition to partition they give what each
partition starts with, and a second pass adds the running sums inside it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.session import stored


def _segments(batch: pa.RecordBatch, group: str, size: str):
    """Where the groups of a batch in order start, their values there, sums before each row, and the sum of all."""
    keys = batch.column(group)
    codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    sizes = batch.column(size).to_numpy(zero_copy_only=False).astype(np.int64)
    before = np.cumsum(sizes) - sizes
    return starts, [keys[int(i)].as_py() for i in starts], before, int(sizes.sum())


def _ends(group: str, size: str):
    """One row per partition: its first and last group and the sums of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts, keys, before, total = _segments(batch, group, size)
            ends = np.append(before[starts[1:]], total)
            for key, amount in zip(keys, np.diff(ends, prepend=0).tolist()):
                if last is not None and last[0] == key:
                    last[1] += amount
                else:
                    first = first or last
                    last = [key, amount]
        if last is not None:
            first = first or last
            kind = batch.schema.field(group).type
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([first[0]], kind),
                 pa.array([last[0]], kind), pa.array([last[1]], pa.int64()), pa.array([first is last])],
                names=["part", "first", "last", "total", "whole"],
            )

    return run


def _running(group: str, size: str, carried: dict[int, tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = carried.get(TaskContext.get().partitionId())
        for batch in batches:
            if not batch.num_rows:
                continue
            starts, keys, before, total = _segments(batch, group, size)
            base = before[starts].copy()
            if held is not None and held[0] == keys[0]:
                base[0] -= held[1]
            sums = before - np.repeat(base, np.diff(np.append(starts, len(before))))
            held = (keys[-1], total - int(base[-1]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], names=[*batch.schema.names, "size_before"])

    return run


def running_sums(df: DataFrame, group: str, order: Sequence[str | Column], size: str) -> DataFrame:
    """``df`` with ``size_before``: the sum of ``size`` over the rows of the same group that come before.

    Null groups are one group. Sizes are whole numbers and not null. Rows equal in group and
    all of ``order`` come in any order. The rows are written once to the checkpoint folder,
    since both passes must see the same partitions.
    """
    keys = [F.col(group), *order]
    placed = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys))
    kind = placed.schema[group].dataType.simpleString()
    found = placed.select(group, size).mapInArrow(
        _ends(group, size), f"part int, first {kind}, last {kind}, total bigint, whole boolean"
    ).collect()
    carried, open_ = {}, None
    for row in sorted(found, key=lambda r: r["part"]):
        goes_on = open_ is not None and open_[0] == row["first"]
        if goes_on:
            carried[row["part"]] = open_
        open_ = (row["last"], row["total"] + (open_[1] if goes_on and row["whole"] else 0))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields)
    return placed.mapInArrow(_running(group, size, carried), f"{fields}, size_before bigint")
