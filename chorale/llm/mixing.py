"""Mixing sources to target shares by cube-method balanced sampling.

A source's rate is its target over its size. Every document is repeated by the whole part
of the rate, and by one more with the fraction as its probability. The fractions are
settled by the cube method: probabilities move along directions that leave the sums of
words and of documents unchanged (the null space of both constraints, over three
documents at a time) until one of them is 0 or 1. A block of documents is worked in one
task and keeps at most two open ones; these meet in new blocks, round by round, until one
block per source is left. Its last two are landed on the choice nearest the target.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import kept, prepared, word_count
from chorale.llm.sharding import positions

WEIGHTS = (5, 2, 1)
MOST = 3  # times its size a source, and so a document, may be taken
BLOCK = 4000  # documents of a block at most, on average
EPS = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, n_docs and target of each source, from rows of source, size and how many times they stand for.

    Sources by code point (null last) weigh ``weights``, repeating. The sum of all sizes
    is shared by weight; what a source gets beyond ``most`` times its size is shared among
    the others by weight, until none is above. Nothing but sums of the table of sources
    comes to the driver.
    """
    totals = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("times")).alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    placed, _, total = positions(totals.withColumn("last", F.col("source").isNull()), ["last", "source"], "source_size")
    weight = F.coalesce(*(F.when(F.col("row_number") % len(weights) == k, F.lit(w)) for k, w in enumerate(weights)))
    table = kept(placed.select("source", "source_size", "n_docs", weight.alias("weight")))
    full = F.col("source_size") * most
    level, before = None, -1
    while True:
        capped = F.lit(False) if level is None else full < F.col("weight") * level
        found = table.agg(
            F.sum(F.when(capped, full)).alias("fixed"), F.sum(F.when(~capped, F.col("weight"))).alias("open"),
            F.count(F.when(capped, 1)).alias("n"),
        ).first()
        if not found["open"] or found["n"] == before:
            break
        before, level = found["n"], (total - (found["fixed"] or 0)) / found["open"]
    target = full.cast("double") if level is None else F.least(full.cast("double"), F.col("weight") * F.lit(float(level)))
    return table.select("source", "source_size", "n_docs", target.alias("target"))


def flight(p: np.ndarray, sizes: np.ndarray, draw) -> list[int]:
    """Settle probabilities in place; the positions still open (two at most) are returned.

    The sums of ``p`` and of ``p * sizes`` stay as they are.
    """
    open_, waiting = [], iter(range(len(p)))
    while True:
        while len(open_) < 3:
            k = next(waiting, None)
            if k is None:
                return open_
            if EPS < p[k] < 1 - EPS:
                open_.append(k)
            else:
                p[k] = round(p[k])
        i, j, k = open_
        a, b, c = sizes[k] - sizes[j], sizes[i] - sizes[k], sizes[j] - sizes[i]
        if a == b == c == 0:
            a, b = 1.0, -1.0
        moves = ((i, a), (j, b), (k, c))
        up = min((1 - p[x]) / v if v > 0 else p[x] / -v for x, v in moves if v)
        down = min(p[x] / v if v > 0 else (1 - p[x]) / -v for x, v in moves if v)
        step = up if draw() * (up + down) < down else -down
        for x, v in moves:
            p[x] = min(1.0, max(0.0, p[x] + step * v))
            if p[x] < EPS or p[x] > 1 - EPS:
                p[x] = round(p[x])
        open_ = [x for x in open_ if 0 < p[x] < 1]


def land(p: np.ndarray, sizes: np.ndarray, left: list[int], due: float) -> None:
    """Settle the last two on the choice whose words are nearest what is due.

    Two large documents may leave a gap of half a document. The block's others close it: from
    the largest on, each that brings the block's words nearer to ``due`` when it is taken or
    left instead, is.
    """
    before = sum(p[x] * sizes[x] for x in left)
    best = min(
        range(1 << len(left)),
        key=lambda bits: (abs(sum(sizes[x] for n, x in enumerate(left) if bits >> n & 1) - before), bits),
    )
    for n, x in enumerate(left):
        p[x] = best >> n & 1
    gap = due - float(p @ sizes)
    for k in np.argsort(-sizes, kind="stable").tolist():
        gain = -sizes[k] if p[k] else sizes[k]
        if abs(gap - gain) < abs(gap):
            p[k], gap = 1 - p[k], gap - gain


def _block(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["order", "doc_id", "key"], kind="stable")
    p, sizes = frame["p"].to_numpy(float).copy(), frame["size"].to_numpy(float)
    seed = int(frame["order"].iloc[0]) & 0xFFFFFFFF
    due = float(p @ sizes)
    left = flight(p, sizes, np.random.default_rng([seed, len(p)]).random)
    if frame["blocks"].iloc[0] == 1:
        land(p, sizes, left, due)
    return frame.assign(p=p)


def choose(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, source, key, size, source_size, target and copies of every document.

    ``key`` is a hash of the text. Texts are read once and not moved. Copies are at most
    ``most``; reruns agree. A document without words (a null text too) takes no part: 0
    copies. Rows equal in doc_id, source and text are counted and drawn as one: of so many
    with a fraction each the whole part of its multiple is sure, and one is drawn with the
    rest; each row is given. An empty table gives no rows.
    """
    prepared(docs.sparkSession)
    sized = kept(
        docs.select("doc_id", "source", F.xxhash64("text").alias("key"), word_count("text").alias("size"))
        .groupBy("doc_id", "source", "key", "size").agg(F.count(F.lit(1)).alias("times"))
    )
    targets = source_targets(sized, weights, most).withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate + EPS)
    part = F.when(rate - whole > EPS, rate - whole).otherwise(0.0) * F.col("times")
    sure = F.floor(part + EPS)
    rest_ = F.when(part - sure > EPS, part - sure).otherwise(0.0)
    planned = sized.join(targets, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "key", "size", "source_size", "target",
        F.when(F.col("size") > 0, whole).otherwise(0).cast("int").alias("copies"),
        F.when(F.col("size") > 0, rest_).otherwise(0.0).alias("p"),
        F.xxhash64("doc_id", "key", F.lit(7)).alias("order"), F.col("n_docs").alias("n"), "times",
        F.when(F.col("size") > 0, sure).otherwise(0).alias("sure"),
    )
    shape = "doc_id {}, source {}, key bigint, size bigint, source_size bigint, target double, copies int, p double, `order` bigint, n bigint, times bigint, sure bigint, blocks bigint, block bigint".format(
        *(docs.schema[c].dataType.simpleString() for c in ("doc_id", "source")))
    settled, round_ = [], 0
    todo = planned
    while True:
        blocks = F.ceil(F.col("n") / F.lit(BLOCK))
        dealt = todo.withColumn("blocks", blocks).withColumn(
            "block", F.pmod(F.xxhash64("order", F.lit(round_)), F.col("blocks"))
        )
        open_ = dealt.where(F.col("p") > 0)
        done = kept(open_.groupBy("source", "block").applyInPandas(_block, shape))
        if round_ == 0:
            settled.append(dealt.where(F.col("p") == 0))
        settled.append(done.where((F.col("p") == 0) | (F.col("p") == 1)))
        rest = done.where((F.col("p") > 0) & (F.col("p") < 1))
        if rest.isEmpty():
            break
        # At most two of each block stay open, so the next round has as many rows per source.
        todo, round_ = rest.withColumn("n", F.col("blocks") * 2).drop("blocks", "block"), round_ + 1
    out = settled[0]
    for part_ in settled[1:]:
        out = out.unionByName(part_)
    each = out.withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))))
    more = (F.col("row") <= F.col("sure") + F.round("p").cast("bigint")).cast("int")
    return each.select(
        "doc_id", "source", "key", "size", "source_size", "target", (F.col("copies") + more).alias("copies")
    )


def mixed_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken words of every document."""
    return choose(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents of the mix, all columns, each row as often as it is taken.

    Rows equal in doc_id, source and text share their copies evenly.
    """
    drawn = choose(docs, weights, most).groupBy(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("key").alias("_key")
    ).agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    rows = docs.withColumn("_text", F.xxhash64("text"))
    joined = rows.join(
        drawn.where(F.col("_copies") > 0),
        F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
        & (F.col("_text") == F.col("_key")),
    )
    # Equal rows differ in other columns at most; a hash of these says which get the odd copies.
    each = F.floor(F.col("_copies") / F.col("_rows")).cast("int")
    odd = (F.col("_copies") % F.col("_rows")).cast("int")
    rank = F.row_number().over(Window.partitionBy("_id", "_source", "_key").orderBy(F.xxhash64(*docs.columns)))
    number = F.when(F.col("_rows") == 1, F.col("_copies").cast("int")).otherwise(each + F.when(rank <= odd, 1).otherwise(0))
    counted = joined.withColumn("_number", number).where(F.col("_number") > 0)
    return counted.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_number")))).select(*docs.columns)
