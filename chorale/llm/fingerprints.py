"""One-permutation MinHash fingerprints, in SQL functions only.

Every five-word shingle is hashed once; the hash's upper bits choose a bin and each bin
keeps its smallest hash. Empty bins borrow from the first filled bin of a fixed
pseudo-random order of their own (optimal densification). Of each bin's hash the lowest
bits are packed into the fingerprint, and the likeness of two is corrected for bits that
agree by chance.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import SPACES, kept, prepared

BINS = 128  # a power of two
BIN_SHIFT = 64 - 7  # the hash's upper seven bits, signed: -64 to 63
BITS = 8  # kept of each bin
WIDTH = 5  # words of a shingle
FIRST_PROBES = 16


def _probes() -> np.ndarray:
    """For every bin an order of all bins, from a fixed seed."""
    order = np.random.default_rng(20240501)
    return np.array([order.permutation(BINS) - BINS // 2 for _ in range(BINS)], np.int64).ravel()


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def shingle_hashes(words: Column) -> Column:
    """Hashes of all five-word shingles; of the whole sequence if it is shorter; none without words."""
    n = F.size(words)
    rolled = F.transform(
        F.slice(words, F.lit(1), n - (WIDTH - 1)),
        lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, WIDTH))),
    )
    return F.when(n >= WIDTH, rolled).when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))


def bin_minima(hashes: Column) -> Column:
    """The smallest hash of each filled bin, by bin."""
    return let(
        F.sort_array(hashes),
        lambda s: F.filter(
            s, lambda h, i: (i == 0) | (F.shiftright(h, BIN_SHIFT) != F.shiftright(F.get(s, i - 1), BIN_SHIFT))
        ),
    )


def densified(minima: Column) -> Column:
    """One hash for every bin; empty bins borrow. ``minima`` must not be empty."""
    probes = F.lit(_probes())

    def fill(bins: Column) -> Column:
        def of(j: Column) -> Column:
            at = (j + BINS // 2) * BINS + 1
            near = F.get(F.array_intersect(F.slice(probes, at, F.lit(FIRST_PROBES)), bins), 0)
            far = F.get(F.array_intersect(F.slice(probes, at, F.lit(BINS)), bins), 0)
            own = F.array_position(bins, j)
            lent = F.array_position(bins, F.coalesce(near, far))
            return F.get(minima, (F.when(own > 0, own).otherwise(lent) - 1).cast("int"))

        return F.transform(F.sequence(F.lit(-(BINS // 2)).cast("bigint"), F.lit(BINS // 2 - 1).cast("bigint")), of)

    bins = F.transform(minima, lambda h: F.shiftright(h, BIN_SHIFT))
    return F.when(F.size(minima) == BINS, minima).otherwise(let(bins, fill))


def fingerprint(text: Column) -> Column:
    """Packed low-order bits of all bins as hex digits; empty for a text without words.

    Words are runs of anything but 0x20 and 0x09-0x0D. Equal texts have equal fingerprints.
    """
    mask = (1 << BITS) - 1
    digits = BITS // 4

    def pack(minima: Column) -> Column:
        low = F.transform(
            densified(minima), lambda h: F.substring(F.hex(h.bitwiseAND(F.lit(mask)).bitwiseOR(F.lit(mask + 1))), 2, digits)
        )
        return F.when(F.size(minima) > 0, F.array_join(low, "")).otherwise("")

    words = F.array_remove(F.split(text, SPACES), "")
    return F.lower(let(let(words, lambda w: bin_minima(shingle_hashes(w))), pack))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two fingerprints, 0 to 1.

    The share of equal bins less what chance makes equal. Two empty fingerprints are
    alike, an empty and a filled one are not.
    """
    digits, chance = BITS // 4, 1 / (1 << BITS)
    same = F.size(
        F.filter(
            F.sequence(F.lit(0), F.lit(BINS - 1)),
            lambda i: F.substring(a, i * digits + 1, F.lit(digits)) == F.substring(b, i * digits + 1, F.lit(digits)),
        )
    )
    corrected = F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(corrected)


def followers(ids: DataFrame) -> DataFrame:
    """``ids`` (id, key, and more) with next_id and next_key: the row before, by id and key.

    Going down the ids, the last (the smallest) is followed by the first; a null id is the
    smallest. Rows are put in ranges; inside each a window looks back one row, and the
    table of the ranges' last rows (one per range) links the ranges.
    """
    placed = kept(
        ids.repartitionByRange("id", "key").withColumn("part", F.spark_partition_id())
    )
    me = F.struct("id", "key")
    tails = placed.groupBy("part").agg(F.max(me).alias("tail"))
    before = F.coalesce(F.lag("tail").over(Window.orderBy("part")), F.max("tail").over(Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)))
    linked = tails.select(F.col("part").alias("of"), before.alias("before"))
    back = F.lag(me).over(Window.partitionBy("part").orderBy("id", "key"))
    return (
        placed.withColumn("back", back).join(linked, F.col("part") == F.col("of"))
        .withColumn("next", F.coalesce("back", "before"))
        .select(*ids.columns, F.col("next.id").alias("next_id"), F.col("next.key").alias("next_key"))
    )


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, near_edited and near_next of every document.

    The edited text has its last half (rounded down) replaced by as much of the beginning
    of the next document, going down the doc_ids. A null text is empty. Rows with one
    doc_id follow each other by a hash of their text; equal rows count once in that order
    and are given once each. A null doc_id is the smallest. Other columns are not read.
    Each text is moved once, and its beginning once more to the document it goes into. An
    empty table gives no rows.
    """
    prepared(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.coalesce("doc_id", F.lit(0)).alias("k"), F.xxhash64(text, F.col("doc_id").isNull()).alias("h"),
        F.struct("doc_id", text.alias("text"), fingerprint(text).alias("print")).alias("doc"),
    )
    # Equal rows meet here; the exchange is the one both joins below need.
    held = rows.groupBy("k", "h").agg(F.first("doc").alias("doc"), F.count(F.lit(1)).alias("times"))
    ids = docs.select("doc_id", F.xxhash64(text, F.col("doc_id").isNull()).alias("key"), F.length(text).alias("n")).distinct()
    asked = followers(ids.withColumnRenamed("doc_id", "id")).select(
        F.coalesce("id", F.lit(0)).alias("to_k"), F.col("key").alias("to_h"), "n",
        F.coalesce("next_id", F.lit(0)).alias("k"), F.col("next_key").alias("h"),
    )
    lent = asked.join(held.where("times > 0"), ["k", "h"]).select(
        F.col("to_k").alias("k"), F.col("to_h").alias("h"),
        F.expr("substring(doc.text, 1, cast(n div 2 as int))").alias("start"), F.col("doc.print").alias("next_print"),
    )
    both = held.where("times > 0").join(lent, ["k", "h"])
    n = F.length("doc.text")
    edited = both.select(
        F.col("doc.doc_id").alias("doc_id"), n.cast("bigint").alias("n_chars"), F.col("doc.print").alias("fingerprint"),
        "next_print", "times",
        F.expr("concat(substring(doc.text, 1, length(doc.text) - cast(length(doc.text) div 2 as int)), start)").alias("edited"),
    )
    printed = edited.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
        fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_print", "times",
    )
    return printed.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))).alias("copy"),
    ).drop("copy")
