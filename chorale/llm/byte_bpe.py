"""Byte-level BPE by overlapping chunks.

A text is cut into chunks that overlap. Every chunk is pre-tokenised on its own, so
chunks of one long text are worked in parallel, and its pieces are encoded there.
Chunks of a text are then stitched: the pattern looks ahead but never back, so from
the first boundary that two neighbours share inside their overlap on, they agree, and
the left one's ids stop where the right one's start. Where no boundary is shared (a
piece longer than the overlap), the text between is pre-tokenised once more from the
last sound boundary on. Decoding joins the bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import per_batch, prepared, text_column, written

CHUNK = 1 << 16  # code points a chunk adds
OVERLAP = 1 << 12  # code points it shares with the next
MARGIN = 8  # code points the pattern may look ahead past a match
CACHED = 400_000  # distinct pieces a Python worker remembers at most
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@cache
def vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@cache
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


@cache
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens in a row, and where each token's start and how many they are."""
    known = vocabulary(path)
    out = [b""] * (max(known.values()) + 1)
    for token, i in known.items():
        out[i] = token
    sizes = np.array([len(x) for x in out])
    return np.frombuffer(b"".join(out), np.uint8), np.cumsum(sizes) - sizes, sizes


# Classes of code points the pattern tells apart.
OTHER, LETTER, NUMBER, SPACE = range(4)
# White space as the tokeniser's own library sees it: without the separators 0x1C-0x1F.
FINDER = regex.compile(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}"))


@cache
def classes() -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    points = np.r_[0:0xD800, 0xE000:0x110000].astype("<u4")
    every = points.tobytes().decode("utf-32-le")
    for kind, name in ((LETTER, "L"), (NUMBER, "N"), (SPACE, "White_Space")):
        for run in regex.finditer(rf"\p{{{name}}}+", every):
            out[points[run.start() : run.end()]] = kind
    return out


def piece_ends(text: str) -> np.ndarray:
    """Where the pattern's successive matches end, in code points, found by runs of classes.

    A run of letters, numbers or other signs is a piece, with the one space (0x20) right
    before it. White space before such a run gives up its last character: a 0x20 goes to
    the run, anything else is a piece of its own. A sign run that starts with an
    apostrophe and goes on with an English ending is cut after the ending.
    """
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[points]
    starts = np.ones(n + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=starts[1:n])
    after_space = np.flatnonzero(starts[1:n] & (kind[:-1] == SPACE)) + 1
    starts[after_space - 1] = True
    starts[after_space[points[after_space - 1] == 0x20]] = False
    for i in np.flatnonzero((points[:-1] == 0x27) & starts[: n - 1] & starts[1:n]).tolist():
        if text[i + 1] in "stmd":
            starts[i + 1], starts[i + 2] = False, True
        elif text[i + 1 : i + 3] in ("re", "ve", "ll"):
            starts[i + 1], starts[i + 3] = False, True
    return np.flatnonzero(starts[1:]) + 1


class Pieces(dict):
    """Ids of a pre-token as packed little-endian 32-bit integers, merged on first use."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.merge = tiktoken.Encoding(
            "chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary(path), special_tokens={}
        )._encode_single_piece

    def __missing__(self, piece: str) -> bytes:
        found = self.merge(piece)
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(self) >= CACHED:
            self.clear()
        self[piece] = ids
        return ids

    def encoded(self, text: str, ends: np.ndarray) -> list[bytes]:
        at = ends.tolist()
        return [self[text[a:b]] for a, b in zip([0, *at], at)]


def decode(ids: bytes, path: str = RANKS) -> bytes:
    flat, offsets, sizes = token_bytes(path)
    out = []
    for at in range(0, len(ids), 4 * CHUNK):
        tokens = np.frombuffer(ids[at : at + 4 * CHUNK], "<u4")
        long = sizes[tokens]
        ends = np.cumsum(long)
        shift = np.repeat(offsets[tokens] - (ends - long), long)
        out.append(flat[shift + np.arange(len(shift))].tobytes())
    return b"".join(out)


def _cut_chunks(batches):
    """Every chunk of every text as a row; a text is gone through once."""
    for batch in batches:
        for row, n, text in zip(*(batch.column(c).to_pylist() for c in ("row", "n", "text"))):
            for start in range(0, n, CHUNK):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row], pa.int64()), pa.array([n], pa.int32()), pa.array([start], pa.int32()),
                     pa.array([text[start : start + CHUNK + OVERLAP]], pa.string())],
                    names=["row", "n", "start", "chunk"],
                )


def _encode_chunks(path: str):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        book, rows = pieces_of(path), []
        starts, totals = batch.column("start").to_pylist(), batch.column("n").to_pylist()
        for text, start, total in zip(text_column(batch, "chunk").to_pylist(), starts, totals):
            ends = piece_ends(text)
            packed = book.encoded(text, ends)
            if start == 0 and len(text) == total:
                rows.append((b"".join(packed), None, None))
                continue
            bytes_at = np.cumsum([len(p) for p in packed], dtype=np.int64)
            ends += start
            last = start + len(text) == total
            # Boundaries that a neighbour can be stitched at: those in either overlap.
            sound = (ends <= start + len(text) - MARGIN) if not last else np.ones(len(ends), bool)
            near = sound & ((ends <= start + OVERLAP) | (ends > start + CHUNK - OVERLAP))
            rows.append((b"".join(packed), ends[near], bytes_at[near]))
        keep = [i for i, name in enumerate(batch.schema.names) if name != "chunk"]
        return pa.RecordBatch.from_arrays(
            [batch.column(i) for i in keep]
            + [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.list_(pa.int64())),
               pa.array([r[2] for r in rows], pa.list_(pa.int64()))],
            names=[batch.schema.names[i] for i in keep] + ["ids", "ends", "at"],
        )

    return per_batch(work)


def stitch(parts: list[dict], text: str, path: str = RANKS) -> bytes:
    """Packed ids of a text from those of its chunks, in order of their starts.

    ``parts`` hold start, ids, ends and at; ``text`` is read only where two chunks
    share no boundary.
    """
    book, out = pieces_of(path), []
    begin = 0  # bytes of the current chunk's ids that the ones before have given
    resume = None  # text position from which pieces must be found anew
    for k, part in enumerate(parts):
        cut_text, cut_ids = np.asarray(part["ends"], np.int64), np.asarray(part["at"], np.int64)
        if resume is not None:
            # The last chunks did not meet: go on alone until this one agrees.
            known = dict(zip(cut_text.tolist(), cut_ids.tolist()))
            found = None
            for match in FINDER.finditer(text, resume):
                out.append(book[match.group()])
                resume = match.end()
                if resume in known:
                    found = known[resume]
                    break
                if k + 1 < len(parts) and resume >= parts[k + 1]["start"] + MARGIN:
                    break
            if found is None:
                continue
            begin, resume = found, None
        if k + 1 == len(parts):
            out.append(part["ids"][begin:])
            break
        theirs = dict(zip(*(np.asarray(parts[k + 1][c]).tolist() for c in ("ends", "at"))))
        usable = cut_ids >= begin
        meet = [(t, i) for t, i in zip(cut_text[usable].tolist(), cut_ids[usable].tolist()) if t in theirs]
        if meet:
            out.append(part["ids"][begin : meet[0][1]])
            begin = theirs[meet[0][0]]
        else:
            sound = [(t, i) for t, i in zip(cut_text.tolist(), cut_ids.tolist()) if i >= begin]
            to, upto = sound[-1] if sound else (None, begin)
            if to is None:
                # No sound boundary at all: from where this chunk's part began.
                to = _text_at(part, begin)
            out.append(part["ids"][begin:upto])
            resume = to
    return b"".join(out)


def _text_at(part: dict, begin: int) -> int:
    """The text position of a byte of a chunk's ids."""
    known = dict(zip(np.asarray(part["at"]).tolist(), np.asarray(part["ends"]).tolist()))
    return known.get(begin, part["start"])


def _stitch_rows(path: str):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, ids = text_column(batch, "text").to_pylist(), []
        for text, parts in zip(texts, batch.column("parts").to_pylist()):
            ids.append(stitch(sorted(parts, key=lambda p: p["start"]), text, path))
        names = [c for c in batch.schema.names if c not in ("parts", "text")]
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in names] + [pa.array(ids, pa.binary())], names=[*names, "ids"]
        )

    return per_batch(work)


def encode(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), path: str = RANKS) -> DataFrame:
    """Columns of ``keep`` and ``ids``: each text's ids, packed as little-endian unsigned 32-bit.

    One row out for each row in, in any order; null and empty texts have no ids.
    Repeated rows are encoded each. Other columns are not read. Only texts of more than one
    chunk are shuffled, to bring their chunks together.
    """
    prepared(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    kept = ", ".join(f"`k{i}` {kinds[c]}" for i, c in enumerate(keep))
    rows = docs.select(
        *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), body.alias("text")
    ).withColumn("n", F.length("text"))
    # A text no longer than one chunk and its overlap is a chunk by itself.
    single = rows.where(F.col("n") <= CHUNK + OVERLAP).withColumn("start", F.lit(0))
    short = single.withColumnRenamed("text", "chunk").mapInArrow(
        _encode_chunks(path), f"{kept}, n int, start int, ids binary, ends array<bigint>, at array<bigint>"
    )
    # Written, so that a row's number is the same for its chunks and its text, however often a task is run.
    long = written(
        rows.where(F.col("n") > CHUNK + OVERLAP).withColumn("row", F.monotonically_increasing_id()), "long-texts"
    )
    chunks = long.select("row", "n", "text").mapInArrow(_cut_chunks, "row bigint, n int, start int, chunk string")
    pieces = chunks.repartition("row", "start").mapInArrow(
        _encode_chunks(path), "row bigint, n int, start int, ids binary, ends array<bigint>, at array<bigint>"
    )
    parts = pieces.groupBy("row").agg(F.collect_list(F.struct("start", "ids", "ends", "at")).alias("parts"))
    stitched = (
        long.drop("n").join(parts, "row").drop("row")
        .mapInArrow(_stitch_rows(path), f"{kept}, ids binary")
    )
    both = short.select(*(f"k{i}" for i in range(len(keep))), "ids").unionByName(stitched)
    return both.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "ids")


def _digest(path: str, with_ids: bool):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("ids").to_pylist()
        columns = {c: batch.column(c) for c in batch.schema.names if c != "ids"}
        columns["n_tokens"] = pa.array([len(x) // 4 for x in ids], pa.int64())
        if with_ids:
            flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            columns["tokens"] = pa.ListArray.from_arrays(pa.array(ends), flat)
        else:
            columns["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string())
        columns["decoded_sha256"] = pa.array([hashlib.sha256(decode(x, path)).hexdigest() for x in ids], pa.string())
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return per_batch(work)


def round_trip(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """doc_id, number of tokens, digests of the ids and of the bytes they decode to."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return encode(docs, path=path).mapInArrow(
        _digest(path, False), f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def tokens(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), path: str = RANKS) -> DataFrame:
    """Columns of ``keep``, n_tokens, tokens and the digest of the bytes they decode to."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return encode(docs, keep=keep, path=path).mapInArrow(
        _digest(path, True), f"{kinds}, n_tokens bigint, tokens array<int>, decoded_sha256 string"
    )
