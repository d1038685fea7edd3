"""Periodic runs of words, by tiles per octave of periods.

A run is a longest stretch of words that repeats with a smallest period q, at least three
times over and at least ``LEAST`` words long. Periods are taken by octave, P to 2P - 1. For
each octave a document is cut into overlapping tiles with a boundary every 2P words, and
every run of the octave holds a boundary b with words to match on both sides. There the
boundary Z-functions say, for each period, how far the words after b equal those q further
on, and how far the words before b do; both reach 2P words at most. So each boundary is
solved from its tile alone and gives a fragment of the run. Fragments are shuffled by
document and period and those that touch are stitched. Of periods that give one stretch the
smallest is its period.

The Z values of all boundaries and periods of a tile are found in step, widest stretches
first, from prefix hashes modulo two primes. Short documents are laid end to end and tiled
in the task that reads them; tiles of long ones are rows of their own, dealt to all tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from copy import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import per_batch, prepared, text_column
from chorale.llm.words import U, mix, word_hashes

LEAST = 24  # words of a run
TIMES = 3  # periods of a run
FIRST = 8  # the first octave holds all periods below 2 * FIRST
LONG = 1 << 16  # bytes from which a text's tiles are dealt out
REGION = 8192  # words whose boundaries one tile row holds, at least
LOW = 512  # octaves up to this one share their tile rows
TOGETHER = 1 << 18  # words of short documents solved at once
# Of a doc_id and a number of words: the places of the words to take, or None for all as they are.
Edit = Callable[[int | None, int], np.ndarray | None]
_PRIMES = (2147483647, 2147483629)
_BASES = (1103515245, 1664525017)


def octaves(n: int) -> list[int]:
    """Lower ends of the octaves that n words can hold a run of."""
    out, p = [], FIRST
    while n >= LEAST and (p == FIRST or n >= TIMES * p):
        out.append(p)
        p *= 2
    return out


def _powers(base: int, n: int, prime: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:
        step = U(pow(base, have, prime))
        out[have : 2 * have] = out[: min(have, n - have)] * step % U(prime)
        have *= 2
    return out


class Stretches:
    """Equality of stretches of one sequence of word codes."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.powers, self.sums = [], []
        for prime, base, values in zip(_PRIMES, _BASES, (codes & U(0xFFFFFFFF), codes >> U(32))):
            powers = _powers(base, self.n + 1, prime)
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(values % U(prime) * powers[:-1] % U(prime), out=sums[1:])
            self.powers.append(powers)
            self.sums.append(sums % U(prime))

    def head(self, n: int) -> Stretches:
        """The first n words."""
        out = copy(self)
        out.n, out.sums = n, [sums[: n + 1] for sums in self.sums]
        return out

    def same(self, i: np.ndarray, j: np.ndarray, width: int) -> np.ndarray:
        """Whether the ``width`` words from i on equal those from j on (i < j)."""
        out = np.ones(len(i), bool)
        for prime, powers, sums in zip(_PRIMES, self.powers, self.sums):
            p = U(prime)
            out &= (sums[i + width] + p - sums[i]) * powers[j - i] % p == (sums[j + width] + p - sums[j]) % p
        return out

    def marks(self, width: int) -> np.ndarray:
        """One number per position that is equal where the ``width`` words from there are."""
        p = U(_PRIMES[0])
        part = (self.sums[0][width:] + p - self.sums[0][: self.n + 1 - width]) % p
        return part * self.powers[0][self.n - np.arange(len(part))] % p


def boundary_z(words: Stretches, octave: int, bounds: np.ndarray):
    """Boundaries, periods, and how many words before and from each boundary on match.

    Only pairs that match over 2P words altogether are given, as every run's do; each then
    matches P words on one side, which is looked at first.
    """
    low = 1 if octave == FIRST else octave
    width, n = 2 * octave - low, words.n
    none = (np.zeros(0, np.int64),) * 4
    if n < octave + low or not len(bounds):
        return none
    marks = np.append(words.marks(octave), np.full(4 * octave, np.iinfo(np.uint64).max))
    windows = np.lib.stride_tricks.sliding_window_view(marks, width)
    b_of, q_of = [], []
    per_step = max(1, (1 << 20) // width)
    for k in range(0, len(bounds), per_step):
        b = bounds[k : k + per_step]
        after = np.zeros((len(b), width), bool)
        fits = b + octave + low <= n
        after[fits] = windows[b[fits] + low] == marks[b[fits], None]
        fits = (b >= octave) & (b + low <= n)
        after[fits] |= windows[b[fits] - octave + low] == marks[b[fits] - octave, None]
        row, column = np.nonzero(after)
        b_of.append(b[row])
        q_of.append(column + low)
    b, q = np.concatenate(b_of), np.concatenate(q_of)
    after, before = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
    to = 2 * octave
    while to:
        fits = np.flatnonzero((after + to <= 2 * octave) & (b + q + after + to <= n))
        i = b[fits] + after[fits]
        after[fits] += to * words.same(i, i + q[fits], to)
        fits = np.flatnonzero((before + to <= 2 * octave) & (b - before - to >= 0) & (b + q <= n))
        i = b[fits] - before[fits] - to
        before[fits] += to * words.same(i, i + q[fits], to)
        to //= 2
    good = after + before >= 2 * octave
    return b[good], q[good], before[good], after[good]


def fragments(words: Stretches, octave: int, bounds: np.ndarray):
    """Period, first and last + 1 of the places i where words i and i + period are equal, touching ones joined."""
    b, q, before, after = boundary_z(words, octave, bounds)
    s, e = b - before, b + after
    order = np.lexsort((s, q))
    q, s, e = q[order], s[order], e[order]
    new = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]) | (s[1:] > e[:-1])]) if len(q) else np.zeros(0, np.int64)
    last = np.r_[new[1:], len(q)] - 1 if len(new) else new
    return q[new], s[new], e[last]


def _smallest(q: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Places of the fragments whose stretch no smaller period gives too."""
    order = np.lexsort((q, e + q, s))
    ends = (e + q)[order]
    return order[np.r_[True, (s[order][1:] != s[order][:-1]) | (ends[1:] != ends[:-1])]] if len(q) else order


def solve_documents(texts: list[np.ndarray]):
    """Number of the document, period, first and last + 1 equal place, of whole documents of word codes."""
    by_length = sorted((k for k, w in enumerate(texts) if len(w) >= LEAST), key=lambda k: -len(texts[k]))
    found, at = [], 0
    while at < len(by_length):
        group, size = [], 0
        while at < len(by_length) and (not group or size + len(texts[by_length[at]]) <= TOGETHER):
            group.append(by_length[at])
            size += len(texts[by_length[at]]) + 1
            at += 1
        # A code of its own after each document parts it from the next.
        parts = []
        for k in group:
            parts += [texts[k], mix(np.array([k + 1], np.uint64) * U(0x9E3779B97F4A7C15))]
        lengths = np.array([len(texts[k]) for k in group])
        starts = np.r_[0, np.cumsum(lengths + 1)]
        words = Stretches(np.concatenate(parts))
        out = []
        for octave in octaves(int(lengths[0])):
            # Documents stand by falling length: those too short for the octave come last.
            to = int(starts[np.searchsorted(-lengths, -TIMES * octave, "right")])
            out.append(fragments(words.head(to), octave, np.arange(0, to, 2 * octave)))
        q, s, e = (np.concatenate(c) for c in zip(*out))
        long = np.flatnonzero(e - s + q >= np.maximum(LEAST, TIMES * q))
        q, s, e = q[long], s[long], e[long]
        keep = _smallest(q, s, e)
        row = np.searchsorted(starts, s[keep], "right") - 1
        found.append((np.array(group)[row], q[keep], s[keep] - starts[row], e[keep] - starts[row]))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(c) for c in zip(*found))


def _codes(batch: pa.RecordBatch, edit: Edit | None) -> list[np.ndarray]:
    _, _, words, first = word_hashes(text_column(batch, "text"))
    out = [words[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
    if edit:
        places = [edit(i, len(w)) for i, w in zip(batch.column("doc_id").to_pylist(), out)]
        out = [w if p is None else w[p] for w, p in zip(out, places)]
    return out


_FRAGMENT = "k bigint, h bigint, q bigint, s bigint, e bigint"


def _rows(batch: pa.RecordBatch, row: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    take = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [batch.column("k").take(take), batch.column("h").take(take), *(pa.array(c.astype(np.int64)) for c in columns)],
        names=["k", "h", "q", "s", "e"],
    )


def _solve_short(edit: Edit | None):
    return per_batch(lambda batch: _rows(batch, *solve_documents(_codes(batch, edit))))


def tiles(n: int) -> list[tuple[list[int], int, int, int, int]]:
    """Of n words: octaves, first and last + 1 word of the tile, first and last + 1 place of its boundaries."""
    out, every = [], octaves(n)
    low = [p for p in every if p <= LOW]
    for group in [low] * bool(low) + [[p] for p in every if p > LOW]:
        top = group[-1]
        region = max(REGION, 8 * top)
        for a in range(0, n, region):
            out.append((group, max(0, a - 2 * top), min(n, a + region + 4 * top), a, min(n, a + region)))
    return out


def _cut_tiles(edit: Edit | None):
    def run(batches):
        for batch in batches:
            for i, words in enumerate(_codes(batch, edit)):
                # Numbers of the distinct words of the text, half as wide as their hashes.
                codes = np.unique(words, return_inverse=True)[1].astype(np.int32)
                for group, a, b, first, stop in tiles(len(codes)):
                    yield pa.RecordBatch.from_pydict({
                        "k": batch.column("k").slice(i, 1), "h": batch.column("h").slice(i, 1),
                        "octaves": pa.array([group], pa.list_(pa.int64())), "start": pa.array([a], pa.int64()),
                        "first": pa.array([first], pa.int64()), "stop": pa.array([stop], pa.int64()),
                        "words": pa.array([codes[a:b].tobytes()], pa.binary()),
                    })

    return run


@per_batch
def _solve_tiles(batch: pa.RecordBatch) -> pa.RecordBatch:
    out = []
    for i, tile in enumerate(batch.to_pylist()):
        codes = np.frombuffer(tile["words"], np.int32).astype(np.uint64)
        words = Stretches(mix((codes + U(1)) * U(0x9E3779B97F4A7C15)))
        for octave in tile["octaves"]:
            q, s, e = fragments(words, octave, np.arange(tile["first"], tile["stop"], 2 * octave) - tile["start"])
            out.append((np.full(len(q), i), q, s + tile["start"], e + tile["start"]))
    return _rows(batch, *(np.concatenate(c) for c in zip(*out)))


def _fragments(rows: DataFrame, edit: Edit | None) -> DataFrame:
    """Fragments (k, h, q, s, e) of all texts."""
    long = F.octet_length("text") > LONG
    short = rows.where(~long).mapInArrow(_solve_short(edit), _FRAGMENT)
    dealt = rows.where(long).mapInArrow(
        _cut_tiles(edit), "k bigint, h bigint, octaves array<bigint>, start bigint, first bigint, stop bigint, words binary"
    ).repartition("k", "h", "octaves", "start")
    # Rows equal in id and text give the same fragments.
    return short.unionByName(dealt.mapInArrow(_solve_tiles, _FRAGMENT)).distinct()


def _stitched(found: DataFrame) -> DataFrame:
    """k, h and the runs (start, period, length) of every text that has any, by start and period."""
    along = Window.partitionBy("k", "h", "q").orderBy("s", "e")
    reach = F.max("e").over(along.rowsBetween(Window.unboundedPreceding, -1))
    joined = found.withColumn("new", F.when(F.col("s") <= reach, 0).otherwise(1)).withColumn(
        "run", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0))
    ).groupBy("k", "h", "q", "run").agg(F.min("s").alias("start"), F.max("e").alias("e"))
    length = (F.col("e") - F.col("start") + F.col("q")).alias("length")
    return (
        joined.select("k", "h", "start", length, "q")
        .where((F.col("length") >= LEAST) & (F.col("length") >= TIMES * F.col("q")))
        .groupBy("k", "h", "start", "length").agg(F.min("q").alias("period"))
        .groupBy("k", "h").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    )


def _collapsed(edit: Edit | None):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = []
        ids = batch.column("doc_id").to_pylist()
        for doc_id, text, runs in zip(ids, text_column(batch, "text").to_pylist(), batch.column("runs").to_pylist()):
            # Splits at 0x20 and 0x09-0x0D alone, as bytes do.
            words = text.encode().split()
            places = edit(doc_id, len(words)) if edit else None
            if runs:
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, [r["start"] + r["period"] for r in runs], 1)
                np.add.at(edge, [r["start"] + r["length"] for r in runs], -1)
                stay = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                places = stay if places is None else places[stay]
            if places is not None:
                words = [words[i] for i in places.tolist()]
            kept.append(b" ".join(words).decode())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("runs"), pa.array(kept, pa.large_string())], names=["doc_id", "runs", "collapsed"]
        )

    return per_batch(work)


def periodic_runs(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """doc_id, runs (array of start, period, length, by start and period) and collapsed of every document.

    Words are runs of anything but 0x20 and 0x09-0x0D, numbered from 0. ``collapsed`` is the
    words that lie in the first period of every run they are in, joined by one space. A null
    text has no words; without a run ``runs`` is empty. Rows repeated, under one doc_id or a
    null one too, come out alike, a row each. Other columns are not read, and an empty table
    gives no rows. Words are told apart by 64-bit hashes, stretches by two of 31 bits.
    ``edit`` says which words of a document, by number, are taken in place of all in order.
    """
    prepared(docs.sparkSession)
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("k"),
        F.xxhash64(body, F.col("doc_id").isNull()).alias("h"), body.alias("text"),
    )
    runs = _stitched(_fragments(rows, edit))
    run = "array<struct<start: bigint, period: bigint, length: bigint>>"
    none = F.array().cast(run)
    return rows.join(runs, ["k", "h"], "left").select("doc_id", "text", F.coalesce("runs", none).alias("runs")).mapInArrow(
        _collapsed(edit), f"doc_id bigint, runs {run}, collapsed string"
    )


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places of the n words of a document that, for one of ten by a checksum of its id, repeats itself from some word on.

    None where a document stays as it is, as without words or with a null id.
    """
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % (1 + (n - a) // (TIMES + g % 8))
    return places


def digest(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """Per document: number of runs, the one of most periods, and digests of all runs and of the words kept."""
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # Runs stand by start and period, so the first of equal ones stays.
    best = F.reduce(
        "runs", F.get("runs", F.lit(0)),
        lambda top, r: F.when(r["length"] * top["period"] > top["length"] * r["period"], r).otherwise(top),
    )
    return periodic_runs(docs, edit).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
