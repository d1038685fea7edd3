"""Fill-in-middle forms of texts, by rotating blocks in place.

A text is cut twice between units; a unit is a word with the white space before it, or the
white space at the text's end. Three sentinels are put into a bytearray of the text, before
the prefix, the middle and the suffix. The segments then change places inside that buffer:
two blocks next to each other are exchanged by reversing each and then both together. The
same rotation, with the lengths that the sentinels tell, takes an output back to its text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import per_batch, prepared, text_column
from chorale.llm.words import SPACE

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = len(PREFIX)
SEED = 42
RATE = 50  # of 100 texts that are rearranged
SUFFIX_FIRST = 80  # of 100 rearranged texts whose suffix comes first
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def unit_ends(data: bytes) -> np.ndarray:
    """Where the units of a text end, in bytes."""
    if not data:
        return np.zeros(0, np.int64)
    space = SPACE[np.frombuffer(data, np.uint8)]
    return np.append(np.flatnonzero(space[1:] & ~space[:-1]) + 1, len(data))


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits that follow from the seed and the id."""
    text = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(text[i : i + 8], 16) for i in (0, 8, 16, 24)]


def _rotate(buffer: bytearray, start: int, middle: int) -> None:
    """Exchange buffer[start:middle] and buffer[middle:], by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    for a, b in ((start, middle), (middle, len(view)), (start, len(view))):
        view[a:b] = view[a:b][::-1]


def rearranged(data: bytes, a: int, b: int, form: str) -> bytes:
    """A text cut at bytes a <= b in form psm or spm."""
    buffer = bytearray(data)
    # From the back, so that the cuts before stay where they are.
    buffer[b:b] = SUFFIX
    buffer[a:a] = MIDDLE
    buffer[0:0] = PREFIX
    _rotate(buffer, a + MARK if form == "psm" else 0, b + 2 * MARK)
    return bytes(buffer)


def restored(output: bytes, form: str) -> bytes:
    """The text of an output, told from the output and its form alone."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    if form == "psm":
        _rotate(buffer, buffer.index(SUFFIX), buffer.index(MIDDLE))
    else:
        _rotate(buffer, 0, buffer.index(PREFIX))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.index(mark)
        del buffer[at : at + MARK]
    return bytes(buffer)


def _code_points(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def _formed(seed: int, rate: int, suffix_first: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, text in zip(batch.column("_id").to_pylist(), text_column(batch, "_text").to_pylist()):
            data = text.encode()
            ends = unit_ends(data)
            n = len(ends)
            one, two, apply, order = draws(seed, doc_id)
            if not data or apply % 100 >= rate or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)):
                rows.append((n, "plain", None, None, text))
                continue
            cuts = [0, *ends.tolist()]
            a, b = (cuts[k] for k in sorted((one % (n + 1), two % (n + 1))))
            form = "spm" if order % 100 < suffix_first else "psm"
            rows.append((n, form, _code_points(data[:a]), _code_points(data[a:b]), rearranged(data, a, b, form).decode()))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_string())
        names = [c for c in batch.schema.names if c not in ("_id", "_text")]
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in names] + [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
            names=[*names, *ADDED],
        )

    return per_batch(work)


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """All columns of the documents with n (units), form, prefix_chars, middle_chars and output.

    The cuts, and whether and how a text is rearranged, follow from ``seed`` and doc_id, so
    rows repeated under one doc_id and text come out alike; a null doc_id counts as empty
    digits. A null text counts as an empty one. Empty texts and those that hold a sentinel
    stay plain, with no cuts. Columns that have one of the new names are replaced. An empty
    table gives no rows.
    """
    prepared(docs.sparkSession)
    rest = [c for c in docs.columns if c not in ADDED]
    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in docs.select(*(F.col(f"`{c}`") for c in rest)).schema)
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in rest)).alias("_row"), F.col("doc_id").cast("bigint").alias("_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("_text"),
    )
    return rows.mapInArrow(
        _formed(seed, rate, suffix_first),
        f"_row struct<{fields}>, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string",
    ).select(*(F.col(f"_row.`{c}`") for c in rest), *ADDED)


def _inverted(batch: pa.RecordBatch) -> pa.RecordBatch:
    outputs, forms = text_column(batch, "output"), batch.column("form").to_pylist()
    texts = [restored(o.encode(), f).decode() for o, f in zip(outputs.to_pylist(), forms)]
    names = [c for c in batch.schema.names if c != "restored"]
    return pa.RecordBatch.from_arrays(
        [batch.column(c) for c in names] + [pa.array(texts, pa.large_string())], names=[*names, "restored"]
    )


def with_restored(rows: DataFrame) -> DataFrame:
    """Rows that have output and form with ``restored``, the text they were made of.

    A null output counts as an empty one, whose form must be plain.
    """
    prepared(rows.sparkSession)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "restored"]
    return rows.mapInArrow(per_batch(_inverted), ", ".join([*fields, "restored string"]))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, the lengths of prefix and middle, SHA-256 of the output and of the text restored from it."""
    formed = fill_in_middle(docs.select("doc_id", "text")).drop("text")
    return with_restored(formed).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
SQL = rf"""WITH units AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
           regexp_extract_all(coalesce(text, ''), '{_UNIT}') AS u
    FROM documents),
drawn AS (
    SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS c2,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
                WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM units),
parts AS (
    SELECT *, array_to_string(u[1:least(c1, c2)], '') AS p, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
           array_to_string(u[greatest(c1, c2) + 1:], '') AS s
    FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""
