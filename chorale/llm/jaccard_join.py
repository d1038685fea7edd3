"""Similarity join of documents on five-word shingles, by parity sketches.

Documents with equal shingle sets are one class. A class's sketch has a word of 64 bits
for every slice of the hash range; each shingle XORs its hash into the word of its slice.
Two sets differ in at most as many words as their symmetric difference has shingles, and
at a Jaccard of 3/4 that is at most a third of the smaller set. So a sketch of more words
than that, per band of sizes, leaves a pair equal words (pigeonhole), which are the join
keys. It leaves so many that a class may do without its most frequent keys: what a passage
of many documents gives them in common groups no one. A second, one-bit-per-shingle parity
sketch bounds the symmetric difference of candidates by its Hamming distance before
shingles are compared.

Groups of equal words are joined as stars to a few hubs each, and of what the sketches allow
every class verifies its likeliest links. Groups that are in one component then are done.
What still lies in different components meets on every key it shares: the rows of a key are
dealt to blocks, sketches of two blocks are compared at once, and only pairs they allow become
rows. Connected copies are never expanded into pairs.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import kept, per_batch, prepared, text_column, tidied, written
from chorale.llm.components import components
from chorale.llm.words import U, mix, shingle_sets

# A pair is linked from this share on: 100 * intersection >= 75 * union.
LEAST = 75
# A class goes on only if MEET of its LOWEST smallest shingles are in another class too. Of a
# set with a partner each is with probability 3/4 or more: fewer than MEET has odds of 1e-14.
# One of LOWEST or fewer must find its share of them all, so sets up to WHOLE, the size of its
# largest partner, are counted whole.
LOWEST, MEET = 32, 4
WHOLE = LOWEST * 100 // LEAST
# Hubs of a group, and links that a class verifies with the hubs it meets.
HUBS = 2
# Rows of a block of a group left apart, 64-bit integers of the sketch that each carries, and
# pairs of rows compared at once.
BLOCK, LONGS, AT_ONCE = 512, 16, 1 << 17


@cache
def _bands() -> list[int]:
    """Lower ends of size bands; a set's larger partners lie in its band or the next."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * 100 // LEAST + 1)
    return out


def band(size: int) -> int:
    return bisect_right(_bands(), size) - 1


def bound(k: int) -> int:
    """Most differing shingles of a linked pair whose smaller set is in band k."""
    return (_bands()[k + 1] - 1) * (100 - LEAST) // LEAST


def width(k: int) -> int:
    """Words of the sketches of band k: twice the bound, so that a linked pair has many equal ones and more than are empty."""
    return (bound(k) + 1) * 2 + 3


def sketch_words(hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and contents of the words that a sorted set fills."""
    slot = ((hashes >> U(32)) * U(width(k))) >> U(32)
    new = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
    return slot[new].astype(np.int64), np.bitwise_xor.reduceat(mix(hashes + U(1)), new)


def join_keys(hashes: np.ndarray, k: int) -> np.ndarray:
    """Keys a set is joined on in band k; the last bit of a key is that of its band.

    A linked pair has more than ``width - bound`` equal words. Empty ones are left out,
    unless a set has so many that they might be all that is equal.
    """
    slot, words = sketch_words(hashes, k)
    if width(k) - len(slot) >= width(k) - bound(k):
        full = np.zeros(width(k), np.uint64)
        full[slot] = words
        slot, words = np.arange(width(k)), full
    keys = mix(words ^ mix(slot.astype(np.uint64) * U(64) + U(k + 1)))
    return keys & ~U(1) | U(k & 1)


def differing(size: int, k: int) -> int:
    """Most differing shingles of a set and one it is linked with and meets in band k.

    They are a seventh of both sizes together: the other set is a third larger at most, and
    one of the band below is no larger than that band's sets.
    """
    largest = size * 100 // LEAST if k == band(size) else _bands()[k + 1] - 1
    return (size + largest) * (100 - LEAST) // (100 + LEAST)


def needed(hashes: np.ndarray, k: int) -> int:
    """How many of a set's keys of band k any linked set has too, at least.

    Every differing shingle spoils one of the words it fills; 1 where that may be all of them.
    """
    return max(1, len(sketch_words(hashes, k)[0]) - differing(len(hashes), k))


def parity(hashes: np.ndarray, k: int) -> np.ndarray:
    """Bits that hold the parity of how many shingles fall on each, in 64-bit integers.

    One bit per shingle, and four for small sets, as far as these fit a block's rows.
    """
    most = _bands()[k + 1]
    bits = -(-max(most, min(4 * most, 64 * LONGS)) // 64) * 64
    at = ((mix(hashes ^ U(0x5555555555555555)) >> U(32)) * U(bits)) >> U(32)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def roles(size: int) -> list[int]:
    """Bands a set is sketched for: its own, and the one below as a larger partner."""
    k = band(size)
    return [k, k - 1] if k and size * LEAST <= (_bands()[k] - 1) * 100 else [k]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= LEAST * (len(a) + len(b) - both)


def counted(hashes: np.ndarray) -> np.ndarray:
    """The shingles of a sorted set that are looked for in other classes."""
    return hashes if len(hashes) <= WHOLE else hashes[:LOWEST]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _classes(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = shingle_sets(text_column(batch, "text"))
    node = [int(np.bitwise_xor.reduce(mix(s * U(3) + U(len(s)))).view(np.int64)) if len(s) else None for s in sets]
    names = [c for c in batch.schema.names if c != "text"]
    return pa.RecordBatch.from_arrays(
        [batch.column(c) for c in names]
        + [pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.int64()), _lists([counted(s) for s in sets])],
        names=[*names, "n", "node", "lowest"],
    )


def _keys(batch: pa.RecordBatch) -> pa.RecordBatch:
    nodes, keys = [], []
    for node, s in zip(batch.column("node").to_pylist(), shingle_sets(text_column(batch, "text"))):
        for k in roles(len(s)):
            found = join_keys(s, k)
            keys.append(found)
            nodes.append(np.full(len(found), node, np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes))], names=["key", "node"],
    )


def _marks(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Per class its size, band, and for its own band and the one below a sketch and the keys needed (none: empty, null)."""
    sizes, bands, sketches, needs = [], [], ([], []), ([], [])
    for s in shingle_sets(text_column(batch, "text")):
        ks = roles(len(s))
        sizes.append(len(s))
        bands.append(ks[0])
        for i in range(2):
            sketches[i].append(parity(s, ks[i]) if i < len(ks) else np.zeros(0, np.int64))
            needs[i].append(needed(s, ks[i]) if i < len(ks) else None)
    return pa.RecordBatch.from_arrays(
        [batch.column("node"), pa.array(sizes, pa.int64()), pa.array(bands, pa.int32()), _lists(sketches[0]), _lists(sketches[1]),
         pa.array(needs[0], pa.int32()), pa.array(needs[1], pa.int32())],
        names=["node", "n", "band", "own", "below", "need", "need_below"],
    )


def _verify(batch: pa.RecordBatch) -> pa.RecordBatch:
    good = [linked(x, y) for x, y in zip(*(shingle_sets(text_column(batch, c)) for c in ("text_a", "text_b")))]
    return pa.RecordBatch.from_arrays([batch.column(c) for c in ("a", "b")], names=["a", "b"]).filter(pa.array(good))


def _apart(a: str, b: str) -> Column:
    """Hamming distance of the sketches two rows have for the lower of their bands; null without."""
    def sketch(x: str, y: str) -> Column:
        lower = F.when((F.col(f"{x}.band") == F.col(f"{y}.band") + 1) & (F.size(f"{x}.below") > 0), F.col(f"{x}.below"))
        return F.when(F.col(f"{x}.band") <= F.col(f"{y}.band"), F.col(f"{x}.own")).otherwise(lower)

    return F.aggregate(
        F.zip_with(sketch(a, b), sketch(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x
    )


def _near(a: str, b: str) -> Column:
    """Whether sizes and sketches of two rows allow a link (7 differences <= both sizes together)."""
    low, high = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (low * 100 >= high * LEAST) & (_apart(a, b) * (100 + LEAST) <= (low + high) * (100 - LEAST))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    good = kept(pairs.join(one, "a").join(two, "b").mapInArrow(per_batch(_verify), "a bigint, b bigint"))
    tidied(texts.sparkSession)
    return good


def _groups(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """(key, node, own, n) of the keys that classes share, without the most frequent ones that a class can spare.

    A key is a class's own if it is one of its band; n is the size of the class.

    All keys that two linked classes share stand in one order, by frequency. A class needs
    so many of them, and gives up one less, its last ones: the first of all is kept by both.
    """
    found = texts.mapInArrow(per_batch(_keys), "key bigint, node bigint")
    here = Window.partitionBy("key")
    shared = found.withColumn("classes", F.count(F.lit(1)).over(here)).where("classes > 1")
    # A class has fewer keys than shingles, so this list is no longer than its text.
    ranked = shared.groupBy("node", F.col("key").bitwiseAND(F.lit(1)).alias("odd")).agg(
        F.sort_array(F.collect_list(F.struct("classes", "key"))).alias("keys")
    )
    own = F.col("band").bitwiseAND(F.lit(1)) == F.col("odd")
    spared = ranked.join(marks.select("node", "n", "band", "need", "need_below"), "node").withColumn("own", own).withColumn(
        "stay", F.size("keys") + 1 - F.when(F.col("own"), F.col("need")).otherwise(F.col("need_below"))
    )
    left = spared.where("stay > 0").select("node", "own", "n", F.explode(F.slice("keys", 1, F.col("stay"))).alias("x"))
    return left.select("x.key", "node", "own", "n")


def _stars(groups: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs (a, b) of a class b with those hubs of its groups that its sketches make the likeliest links."""
    here = Window.partitionBy("key")
    hubs = F.array(*(F.min_by("node", F.xxhash64("node", F.lit(k))).over(here) for k in range(HUBS)))
    met = groups.withColumn("hubs", hubs).select(F.explode(F.array_distinct("hubs")).alias("a"), F.col("node").alias("b")).where(
        "a <> b").distinct()
    x, y = marks.alias("x"), marks.alias("y")
    near = met.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node")).where(_near("x", "y")).select(
        "a", "b", _apart("x", "y").alias("apart"))
    best = Window.partitionBy("b").orderBy("apart", "a")
    return near.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= HUBS).select("a", "b")


def _folded(sketch: str) -> Column:
    """A sketch laid over itself so that LONGS are left; sketches differ in no fewer bits than these."""
    def over(i: Column) -> Column:
        return F.aggregate(F.filter(sketch, lambda _, at: at % LONGS == i), F.lit(0).cast("bigint"), lambda s, x: s.bitwiseXOR(x))

    return F.when(F.size(sketch) <= LONGS, F.col(sketch)).otherwise(F.transform(F.sequence(F.lit(0), F.lit(LONGS - 1)), over))


def _block_rows(column: pa.ListArray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Ends of the blocks, node, label, n, own and band of their rows, and the rows' sketches (zeros fill them up)."""
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    *plain, lists = column.flatten().flatten()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    sketches = np.zeros((len(lists), LONGS), np.int64)
    sketches[np.arange(LONGS) < sizes[:, None]] = lists.flatten().to_numpy()
    # numpy counts the bits of a signed number's absolute value.
    return ends, [c.to_numpy(zero_copy_only=False) for c in plain], sketches.view(np.uint64)


def _compare(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Pairs (a, b) of a row of block x and one of block y, or of two rows if that is one block, that may be linked."""
    ends_x, (node_x, label_x, n_x, own_x, band_x), sketch_x = _block_rows(batch.column("x"))
    ends_y, (node_y, label_y, n_y, own_y, band_y), sketch_y = _block_rows(batch.column("y"))
    block = np.repeat(np.arange(batch.num_rows), np.diff(ends_x, prepend=0))
    same = batch.column("same").to_numpy(zero_copy_only=False)[block]
    start_x, start_y = (np.r_[0, e[:-1]][block] for e in (ends_x, ends_y))
    # A row meets those of the other block from ``first`` on, in its own block those after it.
    first = np.where(same, start_y + np.arange(len(block)) - start_x + 1, start_y)
    meets = ends_y[block] - first
    upto = np.cumsum(meets)
    found, at = [], 0
    while at < len(block):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] - meets[at] + AT_ONCE, "right")))
        i = np.repeat(np.arange(at, to), meets[at:to])
        j = np.arange(len(i)) - np.repeat(upto[at:to] - meets[at:to] - (upto[at] - meets[at]), meets[at:to]) + first[i]
        low, high = np.minimum(n_x[i], n_y[j]), np.maximum(n_x[i], n_y[j])
        open_ = (label_x[i] != label_y[j]) & (own_x[i] | own_y[j]) & (low * 100 >= high * LEAST)
        i, j = i[open_], j[open_]
        apart = np.bitwise_count(sketch_x[i] ^ sketch_y[j]).sum(axis=1, dtype=np.int64)
        # Sketches of two bands tell nothing.
        near = (apart * (100 + LEAST) <= (n_x[i] + n_y[j]) * (100 - LEAST)) | (band_x[i] != band_y[j])
        a, b = node_x[i[near]], node_y[j[near]]
        found.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
        at = to
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def _blocks_met(groups: DataFrame, labels: DataFrame, marks: DataFrame) -> DataFrame:
    """Blocks x and y of a key's rows, each once with itself (``same``) and with each other one, but none of one label only."""
    here = Window.partitionBy("key")
    placed = groups.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_ = placed.withColumn("low", F.min("label").over(here)).withColumn("high", F.max("label").over(here)).where("low <> high")
    short = marks.select("node", "band", _folded("own").alias("short"), _folded("below").alias("short_below"))
    row = F.struct(
        "node", "label", "n", "own", (F.col("band") - F.when(F.col("own"), 0).otherwise(1)).alias("band"),
        F.when(F.col("own"), F.col("short")).otherwise(F.col("short_below")).alias("sketch"),
    )
    rows = open_.join(short, "node").select("key", "label", "node", row.alias("row"))
    blocks = rows.withColumn("part", F.floor((F.row_number().over(here.orderBy("label", "node")) - 1) / BLOCK)).groupBy(
        "key", "part").agg(F.collect_list("row").alias("rows"), F.min("label").alias("low"), F.max("label").alias("high"))
    x, y = blocks.alias("x"), blocks.alias("y")
    return x.join(
        y, (F.col("x.key") == F.col("y.key")) & (F.col("x.part") <= F.col("y.part"))
        & (F.least("x.low", "y.low") != F.greatest("x.high", "y.high")),
    ).select(F.col("x.rows").alias("x"), F.col("y.rows").alias("y"), (F.col("x.part") == F.col("y.part")).alias("same"))


def _left_apart(groups: DataFrame, labels: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs (a, b) with different labels that share any key and whose sketches allow a link, once each.

    Two classes sketched for a band below both of theirs need no key there: they meet in their own.
    """
    pairs = _blocks_met(groups, labels, marks).mapInArrow(per_batch(_compare), "a bigint, b bigint").distinct()
    x, y = marks.alias("x"), marks.alias("y")
    return pairs.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node")).where(_near("x", "y")).select("a", "b")


def links(texts: DataFrame) -> DataFrame:
    """Links (a, b) that connect all linked classes; ``texts`` holds a node and a text of each."""
    marks = kept(texts.mapInArrow(
        per_batch(_marks),
        "node bigint, n bigint, band int, own array<bigint>, below array<bigint>, need int, need_below int",
    ))
    groups = written(_groups(texts, marks), "groups")
    first = _verified(_stars(groups, marks), texts)
    return first.unionByName(_verified(_left_apart(groups, components(first), marks), texts))


def similar(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    A-Z are lower-cased, words are runs of anything but 0x20 and 0x09-0x0D. Fewer than five
    words are one shingle; without words (a null text too) a document is linked with nothing.
    component_id is the smallest doc_id reachable; null ids do not count, and a component of
    null ids only has null. Repeated rows are rows of one class. Other columns are not read.
    """
    prepared(docs.sparkSession)
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("k"),
        F.xxhash64(body).alias("h"), body.alias("text"),
    )
    signed = kept(rows.mapInArrow(
        per_batch(_classes), "doc_id bigint, k bigint, h bigint, n bigint, node bigint, lowest array<bigint>"
    ))
    classes = signed.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("first_doc"), F.max("n").alias("n"), F.min(F.struct("k", "h", "lowest")).alias("at")
    )
    lowest = classes.select("node", F.explode("at.lowest").alias("shingle"))
    times = F.count(F.lit(1)).over(Window.partitionBy("shingle"))
    met = lowest.withColumn("times", times).where("times > 1").groupBy("node").agg(F.count(F.lit(1)).alias("met"))
    enough = F.when(F.col("n") <= LOWEST, F.ceil(F.col("n") * LEAST / 100)).otherwise(MEET)
    likely = met.join(classes, "node").where(F.col("met") >= enough).select("node", "at.k", "at.h")
    texts = written(
        # A class has one k and h, so rows repeated meet where the join has brought them.
        rows.select("k", "h", "text").join(likely, ["k", "h"]).dropDuplicates(["k", "h"]).select("node", "text"),
        "class-texts",
    )
    labels = components(links(texts))
    firsts = classes.select("node", "first_doc")
    known = labels.join(firsts, "node")
    smallest = known.groupBy("label").agg(F.min("first_doc").alias("component_id"))
    of_node = known.select("node", "label").join(smallest, "label").select("node", "component_id")
    own = firsts.join(of_node, "node", "left").select("node", F.coalesce("component_id", "first_doc").alias("component_id"))
    return signed.select("doc_id", "n", "node").join(own, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without near copies: of every component the one with the smallest doc_id.

    Documents without words stay. Of rows with one doc_id all stay or go together; rows with
    a null doc_id stay.
    """
    stay = similar(docs).where("doc_id = component_id").select("doc_id").distinct()
    with_id = docs.where("doc_id is not null").join(stay, "doc_id", "left_semi")
    return with_id.unionByName(docs.where("doc_id is null"))
