"""Minimum-gap throttle per key (STR-9).

A message is forwarded when it comes more than ``gap`` after the last one
forwarded for its key. That is a chain through time, yet no key has to sit in
one task: time is cut into blocks, each block works out in parallel where it
would leave off for every way of entering it, the starts of these summaries are
linked to those that follow by pointer doubling in joins, and the blocks then
replay in parallel from their known entry.

Blocks are as long as they can be while no block of a key has more than ``BLOCK_ROWS``
messages, which is counted first: keys with few messages then are one block and need no
linking. Blocks of the shortest length hold a row per millisecond at most, and no row
holds more than a block.
Starts are rows, within the first gap of a block; only the look-up of the next
block that has messages goes through a key's blocks in order, one row for each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chorale.session import stored

BLOCK_MS = 600_000  # shortest length of a block
STEP, STEPS = 8, 7  # blocks may be so many times longer, so many times over: 40 years at most
BLOCK_ROWS = 100_000  # messages of one key in a block longer than the shortest
NEVER = np.iinfo("int64").min // 2


def millis(df: DataFrame, ts: str) -> Column:
    """Milliseconds since 1970; wall-clock reading for time-zone-free columns."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        seconds = F.expr(f"extract(SECOND FROM `{ts}`)")
        days = F.datediff(F.col(ts).cast("date"), F.lit("1970-01-01").cast("date"))
        minutes = (days.cast("bigint") * 24 + F.hour(ts)) * 60 + F.minute(ts)
        return minutes * 60_000 + F.floor(seconds * 1000).cast("bigint")
    return F.unix_millis(ts)


def _summaries(gap: int, block_ms: int):
    """Per block: (latest first-forwarded time, time of the block's last forward).

    A chain that comes from an earlier block starts within the first gap of this
    one, or at the first message beyond it.
    """

    @F.pandas_udf("firsts array<bigint>, lasts array<bigint>")
    def summarise(blocks: pd.Series, times_of: pd.Series) -> pd.DataFrame:
        out = []
        for block, times in zip(blocks, times_of):
            n = len(times)
            if n == 1:
                out.append((times, times))
                continue
            after = np.searchsorted(times, times + gap, side="right")
            # Pointers double until each start knows the last forward of its chain.
            to = np.where(after < n, after, np.arange(n))
            while not np.array_equal(further := to[to], to):
                to = further
            last = times[to]
            reach = min(n, np.searchsorted(times, block * block_ms + gap, side="right") + 1)
            firsts, lasts = times[:reach], last[:reach]
            ends_run = np.append(lasts[1:] != lasts[:-1], True)
            out.append((firsts[ends_run], lasts[ends_run]))
        return pd.DataFrame(out, columns=["firsts", "lasts"])

    return summarise


def _next_start(starts: DataFrame, gap: int, block_ms: int) -> DataFrame:
    """(key, at, to): the start that follows the chain from each; the last ones are left out.

    The smallest start beyond the gap is looked up in the block where the gap ends. If that
    has none, it is the first of the key's next block, of which a key has one row each.
    """
    due = F.col("last") + gap + 1
    block = lambda ms: F.floor(ms / block_ms).cast("bigint")
    wanted = starts.select("key", block(due).alias("block"), due.alias("ms"), F.col("first").alias("at"))
    offered = starts.select("key", "block", F.col("first").alias("ms"), F.lit(None).cast("bigint").alias("at"))
    offer = F.when(F.col("at").isNull(), F.col("ms"))
    # From the latest on, so that a row has seen what comes after it; of equal times offers go first.
    here = Window.partitionBy("key", "block").orderBy(F.desc("ms"), F.asc_nulls_first("at"))
    seen = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    looked = (
        wanted.unionByName(offered).withColumn("to", F.last(offer, ignorenulls=True).over(seen)).where("at is not null")
    )
    heads = starts.groupBy("key", "block").agg(F.min("first").alias("head"))
    asked = looked.where("to is null").select("key", "block", F.lit(None).cast("bigint").alias("head")).distinct()
    later = Window.partitionBy("key").orderBy(F.desc("block"), F.desc_nulls_last("head"))
    before = later.rowsBetween(Window.unboundedPreceding, -1)
    # A block that is asked past may have a head of its own, which is no later start.
    rows = heads.unionByName(asked).groupBy("key", "block").agg(F.max("head").alias("head"))
    beyond = rows.select("key", "block", F.last("head", ignorenulls=True).over(before).alias("beyond"))
    return (
        looked.join(beyond, ["key", "block"], "left")
        .select("key", "at", F.coalesce("to", "beyond").alias("to"))
        .where("to is not null")
    )


def _entries(starts: DataFrame, gap: int, block_ms: int) -> DataFrame:
    """(key, block, sent): blocks a key's chain enters and the last forward before each.

    Chains are put together by pointer doubling: table k leads 2**k blocks on, and from the
    largest down each adds what it reaches, so no row or task holds a key's history.
    """
    one = stored(_next_start(starts, gap, block_ms))
    jumps = [one]
    while not jumps[-1].isEmpty():
        half = jumps[-1]
        rest = half.select("key", F.col("at").alias("to"), F.col("to").alias("_to"))
        jumps.append(stored(half.join(rest, ["key", "to"]).select("key", "at", F.col("_to").alias("to"))))
    reached = starts.groupBy("key").agg(F.min("first").alias("at"))
    for jump in reversed(jumps[:-1]):
        reached = stored(reached.unionByName(reached.join(jump, ["key", "at"]).select("key", F.col("to").alias("at"))))
    block = F.floor(F.col("to") / block_ms).cast("bigint")
    came = (
        reached.join(one, ["key", "at"])
        .join(starts.select("key", F.col("first").alias("at"), "last"), ["key", "at"])
        .select("key", block.alias("block"), F.col("last").alias("sent"))
    )
    return starts.groupBy("key").agg(F.min("block").alias("block")).withColumn("sent", F.lit(int(NEVER))).unionByName(came)


def _replay(gap: int):
    """Per block: the places of the forwarded rows, given the last one before it."""

    @F.pandas_udf("array<int>")
    def replay(times_of: pd.Series, sent_of: pd.Series) -> pd.Series:
        out = []
        for times, sent in zip(times_of, sent_of):
            if len(times) == 1:
                out.append([0] if times[0] > sent + gap else [])
                continue
            kept, after = [], np.searchsorted(times, times + gap, side="right").tolist()
            at = int(np.searchsorted(times, sent + gap, side="right"))
            while at < len(times):
                kept.append(at)
                at = after[at]
            out.append(kept)
        return pd.Series(out)

    return replay


def block_length(timed: DataFrame) -> int:
    """Milliseconds of a block for messages (key, ms): the longest that keeps the blocks of every key small, or the shortest."""
    block = F.floor(F.col("ms") / BLOCK_MS).cast("bigint").alias("block")
    short = timed.groupBy("key", block).agg(F.count("*").alias("n"))
    stepped = short.select("key", "block", "n", F.explode(F.sequence(F.lit(1), F.lit(STEPS))).alias("step"))
    longer = stepped.groupBy("step", "key", F.floor(F.col("block") / F.pow(F.lit(STEP), "step")).alias("block")).agg(
        F.sum("n").alias("n")
    )
    # One row per length.
    fullest = {r["step"]: r["n"] for r in longer.groupBy("step").agg(F.max("n").alias("n")).collect()}
    return BLOCK_MS * STEP ** max([0, *(k for k, n in fullest.items() if n <= BLOCK_ROWS)])


def throttle(
    messages: DataFrame,
    key: str,
    ts: str,
    message_id: str,
    gap_ms: int = 200,
    carry: DataFrame | None = None,
    block_ms: int | None = None,
) -> DataFrame:
    """The forwarded messages as (key, ms, message_id).

    Among messages of one millisecond the smallest id stands for all, since no
    two of them can both be forwarded. ``carry`` gives (key, sent_ms) of earlier
    runs. Join the result back on the message id for whole rows.
    """
    timed = messages.select(
        F.col(key).alias("key"), millis(messages, ts).alias("ms"), F.col(message_id).alias("_id")
    ).where(F.col("key").isNotNull() & F.col("ms").isNotNull())
    if carry is not None:
        # What the carry holds back goes first, so that a key's chain starts with its first row.
        timed = timed.join(carry.select("key", "sent_ms"), "key", "left").where(
            F.col("sent_ms").isNull() | (F.col("ms") > F.col("sent_ms") + gap_ms)
        )
    block_ms = block_ms or block_length(timed.select("key", "ms"))
    per_ms = timed.groupBy("key", "ms").agg(F.min("_id").alias("message_id"))
    block = F.floor(F.col("ms") / block_ms).cast("bigint")
    blocks = stored(
        per_ms.groupBy("key", block.alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct("ms", "message_id"))).alias("rows"))
        .withColumn("times", F.transform("rows", lambda r: r["ms"]))
    )
    starts = stored(
        blocks.select("key", "block", _summaries(gap_ms, block_ms)("block", "times").alias("s"))
        .select("key", "block", F.inline(F.arrays_zip(F.col("s.firsts").alias("first"), F.col("s.lasts").alias("last"))))
        .toDF("key", "block", "first", "last")
    )
    return (
        blocks.join(_entries(starts, gap_ms, block_ms), ["key", "block"])
        .withColumn("_kept", _replay(gap_ms)("times", "sent"))
        .select("key", F.explode(F.transform("_kept", lambda i: F.get("rows", i))).alias("r"))
        .select("key", "r.ms", "r.message_id")
    )


def left_out(messages: DataFrame, key: str, ts: str, carry: DataFrame | None = None) -> DataFrame:
    """One row: null_keys, null_times (of the others) and late messages, from before the last one sent."""
    rows = messages.select(F.col(key).alias("key"), millis(messages, ts).alias("ms"))
    if carry is None:
        rows = rows.withColumn("sent_ms", F.lit(None).cast("bigint"))
    else:
        rows = rows.join(carry.select("key", "sent_ms"), "key", "left")
    return rows.agg(
        F.count_if(F.col("key").isNull()).alias("null_keys"),
        F.count_if(F.col("key").isNotNull() & F.col("ms").isNull()).alias("null_times"),
        F.count_if(F.col("ms") < F.col("sent_ms")).alias("late"),
    )


def last_sent(forwarded: DataFrame, carry: DataFrame | None = None) -> DataFrame:
    """(key, sent_ms) to carry into the next run."""
    now = forwarded.select("key", F.col("ms").alias("sent_ms"))
    both = now if carry is None else now.unionByName(carry.select("key", "sent_ms"))
    return both.groupBy("key").agg(F.max("sent_ms").alias("sent_ms"))
