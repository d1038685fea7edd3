"""Minimum-gap throttle of a stream, on keyed state with an event-time timer (STR-9).

The state holds the time of the last message forwarded for a key, until its gap is over: once
the watermark has passed that time, whatever still comes for the key is beyond the gap, so
state holds the keys of the last gap and not all ever seen. Keys are dealt to buckets, whose
messages are chained together by array operations: a batch calls Python once for a bucket it
touches and not once for a key and once more for its timer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chorale.operators.throttle import NEVER, millis

LEFT_OUT = "left_out"


def _one_per_ms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of the messages of a key's millisecond in one Arrow batch the one with the smallest id."""
    for batch in batches:
        yield batch.sort_values("message_id").drop_duplicates(["key", "ms"])


def _sent(codes: np.ndarray, times: np.ndarray, last: np.ndarray, gap: int) -> np.ndarray:
    """Places of the messages forwarded; rows stand by code, then time, and ``last`` is a code's time forwarded before."""
    span = int(times.max()) - int(times.min()) + gap + 2
    if codes[0] != codes[-1] and span * (int(codes[-1]) - int(codes[0]) + 1) >= 1 << 62:
        # One number for key and time would not hold them all.
        half = np.searchsorted(codes, codes[len(codes) // 2], side="left" if codes[len(codes) // 2] > codes[0] else "right")
        return np.r_[_sent(codes[:half], times[:half], last, gap), half + _sent(codes[half:], times[half:], last, gap)]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    ends = np.r_[first[1:], len(codes)]
    base = (codes - codes[0]).astype(np.int64) * (span if codes[0] != codes[-1] else 0)
    at = base + (times - times.min())
    after = np.searchsorted(at, at + gap, side="right")
    beyond = np.clip(last[codes[first]] + gap - times.min(), -1, span - 1)
    place, kept = np.searchsorted(at, base[first] + beyond, side="right"), []
    while True:
        going = place < ends
        place, ends = place[going], ends[going]
        if not len(place):
            return np.sort(np.concatenate(kept)) if kept else np.zeros(0, np.int64)
        kept.append(place)
        place = after[place]


def _chain(gap: int):
    def forward(bucket: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(parts))
        held, before = state.get if state.exists else ([], [])
        codes, keys = pd.factorize(pd.concat([pd.Series(list(held), dtype=rows["key"].dtype), rows["key"]]), use_na_sentinel=False)
        rows = rows.assign(code=codes[len(held):]).sort_values(["code", "ms", "message_id"]).drop_duplicates(["code", "ms"])
        last = np.full(len(keys), NEVER)
        last[: len(held)] = before
        codes, times = rows["code"].to_numpy(), rows["ms"].to_numpy()
        kept = _sent(codes, times, last, gap)
        # Rows of a code go up in time, so its last one stands.
        last[codes[kept]] = times[kept]
        # A key whose gap the watermark has passed is held no longer.
        open_ = last + gap >= state.getCurrentWatermarkMs()
        if open_.any():
            state.update((pd.Index(keys)[open_].tolist(), last[open_].tolist()))
            state.setTimeoutTimestamp(max(int(last[open_].max()) + gap + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if len(kept):
            yield rows.iloc[kept][["key", "ms", "message_id"]]

    return forward


def throttled(
    messages: DataFrame, key: str, ts: str, message_id: str, gap_ms: int = 200, late: str = "0 seconds", buckets: int = 1024
) -> DataFrame:
    """The forwarded messages of a stream as (key, ms, message_id).

    A message is forwarded when it comes more than ``gap_ms`` after the last one forwarded
    for its key; of one millisecond the smallest id stands. Messages that are older than the
    watermark, ``late`` behind the latest seen, are dropped, and Spark's progress counts
    them. Messages without key or time are counted by the observed metric ``left_out``. The
    messages a batch has for the keys of one of the ``buckets`` are ordered in one task, so their
    number is bounded by the size of a batch, which the source's rate limit sets.
    """
    kinds = {n: messages.schema[c].dataType.simpleString() for n, c in (("key", key), ("message_id", message_id))}
    fields = f"key {kinds['key']}, ms bigint, message_id {kinds['message_id']}"
    timed = messages.select(F.col(key).alias("key"), millis(messages, ts).alias("ms"), F.col(message_id).alias("message_id"))
    counted = timed.observe(
        LEFT_OUT,
        F.count_if(F.col("key").isNull()).alias("null_keys"),
        F.count_if(F.col("key").isNotNull() & F.col("ms").isNull()).alias("null_times"),
    )
    return (
        counted.where(F.col("key").isNotNull() & F.col("ms").isNotNull())
        .mapInPandas(_one_per_ms, fields)
        .withColumn("_at", F.timestamp_millis("ms"))
        .withWatermark("_at", late)
        .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandasWithState(
            _chain(gap_ms), fields, f"keys array<{kinds['key']}>, sent array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)
    )
