"""Passages that occur more than once, by seed and extend.

Seeds: every stretch of ``window`` words has an anchor, the smallest hash of the short
word sequences in it (winnowing), so equal stretches have equal anchors and only anchors
that occur at least twice are followed up. Extension: an anchor stands for a span, all the
stretches it was chosen for, reaching to its left and right. Occurrences whose spans are
equal match to both ends. Where spans of one anchor differ, each distinct span is taken
apart once, and its stretches are counted over all occurrences, which finds how far each
match reaches. Overlapping stretches that match join to maximal repeats; no pair of
occurrences is ever made.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import kept, per_batch, prepared, text_column
from chorale.llm.words import U, grams, mix, word_hashes

WINDOW = 35
SEED = 10  # words of an anchor
_BASE = 0xC2B2AE3D27D4EB4F


def _leftmost(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of each ``width`` values in a row, the last of equal ones."""
    at, have = np.arange(len(values)), 1

    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[b] <= values[a], b, a)

    while have * 2 <= width:
        at, have = merge(at[:-have], at[have:]), have * 2
    return merge(at[: len(at) - (width - have)], at[width - have :]) if have < width else at


def _spans(column: pa.Array, window: int, seed: int):
    """Of each anchor occurrence: text, first and last stretch (word positions in the text), anchor, span hash."""
    _, _, words, first = word_hashes(column)
    lengths = np.diff(first)
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    if not (lengths >= window).any():
        return none
    hashed = grams(words, seed)
    at = _leftmost(hashed, window - seed + 1)
    row = np.repeat(np.arange(len(lengths)), lengths)[: len(at)]
    starts = np.flatnonzero(np.arange(len(at)) + window <= first[row + 1])
    if not len(starts):
        return none
    row, at = row[starts], at[starts]
    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (at[1:] != at[:-1])])
    last = np.r_[new[1:], len(starts)] - 1
    s0, s1, at, row = starts[new], starts[last], at[new], row[new]
    up = np.full(len(words) + 1, U(_BASE))
    down = np.full(len(words) + 1, U(pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    up, down = np.cumprod(up), np.cumprod(down)
    sums = np.r_[U(0), np.cumsum(words * up[:-1])]
    span = mix((sums[s1 + window] - sums[s0]) * down[s0] + ((s1 - s0) * 4096 + (at - s0)).astype(np.uint64))
    return row, s0 - first[row], s1 - first[row], hashed[at], span


def _seeds(window: int, seed: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        anchor = np.sort(_spans(text_column(batch, "text"), window, seed)[3])
        new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]]) if len(anchor) else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor[new].view(np.int64)), pa.array(np.diff(np.r_[new, len(anchor)]))], names=["seed", "n"]
        )

    return per_batch(work)


def _occurrences(window: int, seed: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, s0, s1, anchor, span = _spans(text_column(batch, "text"), window, seed)
        take = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [batch.column("k").take(take), batch.column("h").take(take), pa.array(s0.astype(np.int32)),
             pa.array(s1.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(span.view(np.int64))],
            names=["k", "h", "s0", "s1", "anchor", "span"],
        )

    return per_batch(work)


def _stretches(window: int):
    """Hashes of the single stretches of the spans that stand for all equal ones."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, _, words, first = word_hashes(text_column(batch, "text"))
        hashed = grams(words, window).view(np.int64)
        out: dict[str, list] = {c: [] for c in ("anchor", "span", "n", "w", "stretch")}
        for start, spans in zip(first[:-1].tolist(), batch.column("spans").to_pylist()):
            for x in spans:
                a, b = start + x["s0"], start + x["s1"] + 1
                count = b - a
                for c in ("anchor", "span", "n"):
                    out[c].append(np.full(count, x[c], np.int64))
                out["w"].append(np.arange(count, dtype=np.int32))
                out["stretch"].append(hashed[a:b])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in out.values()], names=list(out))

    return per_batch(work)


def covered(n: int, spans: list[dict], window: int = WINDOW) -> np.ndarray:
    """Which of n words lie in a repeated stretch: bit w of a span's mask is its stretch s0 + w."""
    edge = np.zeros(n + 1, np.int64)
    for x in spans:
        s0, s1, bits = x["s0"], x["s1"], x["mask"]
        if bits is None:
            edge[s0] += 1
            edge[s1 + window] -= 1
            continue
        hit = s0 + np.flatnonzero([bits >> w & 1 for w in range(s1 - s0 + 1)])
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + window, -1)
    return np.cumsum(edge[:n]) > 0


def _cut(window: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = text_column(batch, "text")
        starts, ends, _, first = word_hashes(column)
        data = "".join(column.to_pylist()).encode()
        totals, gone, texts = [], [], []
        for a, b, spans in zip(first[:-1].tolist(), first[1:].tolist(), batch.column("spans").to_pylist()):
            out = covered(b - a, spans or [], window)
            stay = np.flatnonzero(~out) + a
            totals.append(b - a)
            gone.append(int(out.sum()))
            texts.append(b" ".join(data[x:y] for x, y in zip(starts[stay].tolist(), ends[stay].tolist())).decode())
        names = [c for c in batch.schema.names if c not in ("k", "h", "spans")]
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in names]
            + [pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())],
            names=[*names, "n_words", "n_removed", "kept"],
        )

    return per_batch(work)


def repeated_spans(rows: DataFrame, texts: DataFrame, window: int, seed: int) -> DataFrame:
    """k, h and spans (s0, s1, mask) of texts that hold repeated stretches.

    A null mask means all stretches of the span.
    """
    # Written first, so that the join has exchanges of its own and a frequent seed is split.
    seeds = kept(
        rows.select("text").mapInArrow(_seeds(window, seed), "seed bigint, n bigint").groupBy("seed").agg(
            F.sum("n").alias("n")
        ).where("n >= 2").drop("n")
    )
    found = rows.select("k", "h", "text").mapInArrow(
        _occurrences(window, seed), "k bigint, h bigint, s0 int, s1 int, anchor bigint, span bigint"
    )
    hits = kept(found.join(seeds, F.col("anchor") == F.col("seed")).drop("seed"))
    # One occurrence stands for all with its span; spans matter where an anchor has several.
    spans = hits.groupBy("anchor", "span").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "h", "s0", "s1")).alias("at")
    )
    several = spans.groupBy("anchor").agg(F.count(F.lit(1)).alias("spans")).where("spans > 1").drop("spans")
    stand = kept(spans.join(several, "anchor"))
    by_text = stand.groupBy(F.col("at.k").alias("k"), F.col("at.h").alias("h")).agg(
        F.collect_list(F.struct("anchor", "span", "n", "at.s0", "at.s1")).alias("spans")
    )
    stretches = texts.join(by_text, ["k", "h"]).mapInArrow(
        _stretches(window), "anchor bigint, span bigint, n bigint, w int, stretch bigint"
    )
    again = stretches.groupBy("anchor", "stretch").agg(F.sum("n").alias("n")).where("n >= 2").drop("n")
    masks = stretches.join(again, ["anchor", "stretch"]).groupBy("anchor", "span").agg(
        F.bit_or(F.expr("shiftleft(1L, w)")).alias("bits")
    )
    # Written too, so that the occurrences of a frequent span are split in the join.
    found = kept(stand.select("anchor", "span").join(masks, ["anchor", "span"], "left").select(
        "anchor", "span", F.coalesce("bits", F.lit(0).cast("bigint")).alias("mask")
    ))
    # A set: rows equal in id and text have the same spans, which each of them needs once.
    return hits.join(found, ["anchor", "span"], "left").groupBy("k", "h").agg(
        F.collect_set(F.struct("s0", "s1", "mask")).alias("spans")
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """All columns of the documents, with n_words, n_removed and kept (the words left, joined by one space).

    A word goes when it lies in a stretch of ``window`` words that also starts anywhere
    else, in the same document too, as the input stands. A null text has no words.
    Repeated rows are documents of their own, so all stretches of theirs repeat. Columns
    named n_words, n_removed or kept are replaced. An empty table gives no rows.
    """
    if not 0 < seed <= window < seed + 63:
        raise ValueError("seed must be shorter than the window, by 62 words at most")
    prepared(docs.sparkSession)
    body = F.coalesce(F.col("text"), F.lit(""))
    rest = [c for c in docs.columns if c not in ("text", "n_words", "n_removed", "kept")]
    rows = docs.select(
        F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("k"), F.xxhash64(body, F.col("doc_id").isNull()).alias("h"),
        F.struct(*rest, F.col("text").isNull().alias("_null")).alias("row"), body.alias("text"),
    )
    # Both joins below move the texts by the same keys with the same columns: one exchange.
    spans = repeated_spans(rows, rows, window, seed)
    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in rows.schema["row"].dataType.fields)
    out = rows.join(spans, ["k", "h"], "left").mapInArrow(
        _cut(window), f"row struct<{fields}>, text string, n_words bigint, n_removed bigint, kept string"
    )
    text = F.when(~F.col("row._null"), F.col("text")).alias("text")
    return out.select(
        *(text if c == "text" else F.col(f"row.`{c}`") for c in docs.columns if c == "text" or c in rest),
        "n_words", "n_removed", "kept",
    )


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words of every document."""
    return remove_repeats(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def shortened(docs: DataFrame) -> DataFrame:
    """The documents without their repeated passages; columns as they were.

    Texts without a repeat stay as they are, others are their kept words.
    """
    cut = remove_repeats(docs).withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)
