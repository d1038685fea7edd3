"""Approximate nearest neighbours by inner product: a navigable small-world graph per shard.

Vectors of similar length (a bucket of a factor of two) are dealt to shards by a hash of
their id, as many as fit in ``SHARD_BYTES``; equal vectors of a shard are one node. Each
shard's graph has layers that thin out geometrically and is stored as flat arrays: the
nodes of each layer and, for each, a row of neighbours padded with -1. A layer's first nodes
are linked by comparing all of them; the others are inserted a batch at a time, each where a
beam search over the graph so far, and the batch itself, finds its nearest nodes. Of those
the usual diversity rule chooses, and links are kept both ways. A search goes down greedily
to the lowest layer and there keeps a beam of the best nodes; blocks of queries move through
a shard's arrays in step. Every query asks all shards, and the shards' lists are merged.

For the graph a coordinate is added that makes all vectors of a shard equally long, which
turns the largest inner product into the nearest point; lengths of a shard being similar, it
is no larger than the others. Scores are taken on the vectors as given. The beam is as wide
as some of the queries need: these are compared with all rows, and it is doubled until they
find ``RECALL`` of their nearest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import kept, prepared
from chorale.llm.words import U, mix
from chorale.session import settings

SHARD_BYTES = 16 << 20  # vectors of a shard, on average
LINKS = 16  # neighbours a node chooses; on the lowest layer it has up to three times as many
NEAREST = 48  # nearest nodes it chooses among
FIRST = 2048  # nodes of a layer that are compared with each other
INSERTED = 4096  # nodes inserted at a time at most
BEAMS = (64, 128, 256, 512, 1024)
RECALL = 0.97  # of the nearest, that the queries looked at must find
LOOKED_AT = 64  # queries compared with all rows
STEP = 8  # nodes of the beam expanded at once
QUERIES = 4096  # queries of one block
TOP = 20


def usable(column: str):
    """Vectors with components, all of them finite and not all zero."""
    x = F.col(column)
    fine = F.forall(x, lambda v: F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    return F.coalesce(x.isNotNull() & (F.size(x) > 0) & fine & F.exists(x, lambda v: v != 0), F.lit(False))


def _nearest(x: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` most similar other rows of each row, best first, found in blocks."""
    n = len(x)
    out = np.empty((n, count), np.int32)
    for a in range(0, n, 512):
        near = x[a : a + 512] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        part = np.argpartition(-near, count - 1, axis=1)[:, :count] if count < n else np.tile(np.arange(n), (len(near), 1))
        order = np.argsort(-np.take_along_axis(near, part, 1), axis=1, kind="stable")
        out[a : a + 512] = np.take_along_axis(part, order, 1)
    return out


def _diverse(own: np.ndarray, x: np.ndarray, near: np.ndarray, links: int) -> np.ndarray:
    """Of the nearest rows of ``x`` to each own vector those nearer to it than to others chosen before; -1 where there are fewer."""
    n, count = near.shape
    out = np.full((n, links), -1, np.int32)
    for a in range(0, n, 256):
        rows = near[a : a + 256]
        vectors = x[rows]
        mine = np.einsum("nd,ncd->nc", own[a : a + len(rows)], vectors)
        among = vectors @ vectors.transpose(0, 2, 1)
        chosen = np.zeros(rows.shape, bool)
        for c in range(count):
            closer = np.where(chosen, among[:, c, :], -np.inf).max(1)
            chosen[:, c] = (mine[:, c] > closer) & (chosen.sum(1) < links)
        # Room that is left goes to the nearest not chosen.
        rank = np.argsort(np.where(chosen, 0, 1), axis=1, kind="stable")[:, :links]
        out[a : a + len(rows), : rank.shape[1]] = np.take_along_axis(rows, rank, 1)
    return out


def _add_back(links_in: np.ndarray, x: np.ndarray, src: np.ndarray, dst: np.ndarray, own: int) -> None:
    """Links from dst back to src in the columns from ``own`` on, the nearest where there are too many."""
    new = dst >= 0
    src, dst = src[new], dst[new]
    # Those that link here already need no link back.
    new = ~(links_in[dst, :own] == src[:, None]).any(1)
    src, dst = src[new], dst[new]
    at = np.unique(dst)
    old = links_in[at, own:]
    row, _ = np.nonzero(old >= 0)
    a, b = np.r_[at[row], dst], np.r_[old[old >= 0], src]
    near = np.empty(len(a))
    for k in range(0, len(a), 1 << 16):
        near[k : k + (1 << 16)] = np.einsum("nd,nd->n", x[a[k : k + (1 << 16)]], x[b[k : k + (1 << 16)]])
    order = np.lexsort((b, -near, a))
    a, b = a[order], b[order]
    rank = np.arange(len(a)) - np.searchsorted(a, a)
    room = links_in.shape[1] - own
    links_in[at, own:] = -1
    links_in[a[rank < room], own + rank[rank < room]] = b[rank < room]


def _layer(x: np.ndarray, links: int, width: int) -> np.ndarray:
    """Neighbours of each row of ``x``: those it chooses and, in the room left, those that choose it."""
    n = len(x)
    out = np.full((n, width), -1, np.int32)
    at = min(n, FIRST)
    near = _nearest(x[:at], min(NEAREST, at - 1))
    out[:at, : min(links, at - 1)] = _diverse(x[:at], x[:at], near, min(links, at - 1))
    _add_back(out, x, np.repeat(np.arange(at), links), out[:at, :links].ravel(), links)
    while at < n:
        new = np.arange(at, min(n, at + min(INSERTED, max(256, at // 4))))
        found, scores = [], []
        for k in range(0, len(new), 512):
            part = x[new[k : k + 512]]
            entry = (part @ x[: min(256, at)].T).argmax(1)
            nodes, values = _beam(part, x[:at], out[:at], entry, BEAMS[0])
            found.append(nodes)
            scores.append(values)
        beside = _nearest(x[new], min(links, len(new) - 1))
        own = np.einsum("nd,ncd->nc", x[new], x[new[beside]])
        nodes, values = np.c_[np.concatenate(found), new[beside]], np.c_[np.concatenate(scores), own]
        order = np.argsort(-values, axis=1, kind="stable")[:, :NEAREST]
        near = np.take_along_axis(nodes, order, 1).astype(np.int32)
        # Where the beam found fewer nodes, the nearest stands for those that lack.
        near = np.where(np.isfinite(np.take_along_axis(values, order, 1)), near, near[:, :1])
        out[new, :links] = _diverse(x[new], x, near, links)
        _add_back(out, x, np.repeat(new, links), out[new, :links].ravel(), links)
        at += len(new)
    return out


def build(ids: np.ndarray, vectors: np.ndarray, links: int = LINKS) -> dict:
    """The index of one shard as flat arrays."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
    nodes, first, node_of = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
    # Nodes stand in the order of a hash of their smallest id, in which they are inserted.
    draw = mix(ids[first].astype(np.uint64))
    place = np.argsort(draw, kind="stable")
    nodes, draw = nodes[place], draw[place]
    back = np.empty(len(place), np.int64)
    back[place] = np.arange(len(place))
    node_of = back[node_of.ravel()]
    by_node = np.argsort(node_of, kind="stable")
    starts = np.searchsorted(node_of[by_node], np.arange(len(nodes) + 1))
    # A power of two takes the lengths near 1, so that squares stay in range.
    scale = np.ldexp(1.0, -int(np.frexp(np.abs(nodes).max())[1]))
    x = nodes * scale
    lengths = np.einsum("nd,nd->n", x, x)
    x = np.c_[x, np.sqrt(np.maximum(lengths.max() - lengths, 0))]
    # A second hash draws the layer, so that it does not follow from the order.
    share = (mix(draw + U(1)) >> U(11)).astype(float) / (1 << 53)
    level = np.floor(-np.log(np.maximum(share, 1e-12)) / np.log(links)).astype(int)
    layers = []
    for k in range(level.max() + 1):
        on = np.flatnonzero(level >= k).astype(np.int32)
        if k and len(on) < 2:
            break
        few = min(links, len(on) - 1)
        near = _layer(x[on], few, few * (3 if k == 0 else 2)) if few > 0 else np.full((len(on), 1), -1, np.int32)
        layers.append((on, np.where(near >= 0, on[near], -1).astype(np.int32)))
    return {"ids": ids[by_node], "starts": starts.astype(np.int32), "vectors": nodes, "layers": layers, "scale": scale}


def _beam(queries, vectors, neighbours, entry, beam):
    """The best ``beam`` nodes found for each query on the lowest layer: nodes and similarities."""
    n, q = len(vectors), len(queries)
    beam = min(beam, n)
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True
    nodes = np.full((q, beam), n, np.int64)
    scores = np.full((q, beam), -np.inf)
    done = np.ones((q, beam), bool)
    nodes[:, 0], done[:, 0] = entry, False
    scores[:, 0] = np.einsum("qd,qd->q", queries, vectors[entry])
    seen[np.arange(q), entry] = True
    live = np.arange(q)
    while len(live):
        # Scores are in order, so the first open places are the best open nodes.
        pick = np.argsort(done[live], axis=1, kind="stable")[:, :STEP]
        open_ = ~np.take_along_axis(done[live], pick, 1)
        live, pick, open_ = live[open_.any(1)], pick[open_.any(1)], open_[open_.any(1)]
        if not len(live):
            break
        at = np.where(open_, np.take_along_axis(nodes[live], pick, 1), n)
        done[live[:, None], pick] = True
        near = np.where(at[..., None] < n, neighbours[np.minimum(at, n - 1)], -1).reshape(len(live), -1)
        near = np.sort(np.where(near < 0, n, near), axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        near = np.where(seen[live[:, None], near], n, near)
        seen[live[:, None], near] = True
        row, column = np.nonzero(near < n)
        found = np.full(near.shape, -np.inf)
        found[row, column] = np.einsum("md,md->m", queries[live[row]], vectors[near[row, column]])
        every = np.c_[nodes[live], near], np.c_[scores[live], found], np.c_[done[live], near == n]
        order = np.argsort(-every[1], axis=1, kind="stable")[:, :beam]
        nodes[live], scores[live], done[live] = (np.take_along_axis(e, order, 1) for e in every)
    return nodes, scores


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each that takes their largest component near 1."""
    return x * np.ldexp(1.0, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) if x.size else x


def _best_rows(index: dict, found: np.ndarray, query: np.ndarray, query_id: int, top: int):
    """Row ids and scores of the nodes found, best first."""
    with np.errstate(over="ignore", invalid="ignore"):
        exact = np.nan_to_num((index["vectors"][found] * query).sum(1), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
    # More nodes than rows wanted are never needed, nor more rows of a node.
    keep = np.argsort(-exact, kind="stable")
    rows, scores, have = [], [], 0
    for k in keep:
        if have > top and exact[k] < scores[-1][0]:
            break
        member = index["ids"][index["starts"][found[k]] : index["starts"][found[k] + 1]][: top + 1]
        rows.append(member)
        scores.append(np.full(len(member), exact[k]))
        have += len(member)
    ids, values = np.concatenate(rows), np.concatenate(scores)
    other = ids != query_id
    ids, values = ids[other], values[other]
    take = np.lexsort((ids, -values))[:top]
    return ids[take], values[take]


def search(index: dict, query_ids: np.ndarray, queries: np.ndarray, top: int = TOP, beam: int | None = BEAMS[1]):
    """The nearest rows of a shard: query ids, row ids and scores, at most ``top`` each.

    A query's own id is left out. Scores are inner products in double precision. Without a
    beam all rows are looked at.
    """
    layers, out = index["layers"], []
    vectors = index["vectors"] * index["scale"]
    n = len(vectors)
    low, last = layers[0][1], n
    places = np.full(n, -1, np.int64)
    for a in range(0, len(queries), 256):
        part = _scaled(queries[a : a + 256])
        if beam is None:
            for j in range(len(part)):
                ids, values = _best_rows(index, np.arange(n), queries[a + j], query_ids[a + j], top)
                out.append((np.full(len(ids), query_ids[a + j]), ids, values))
            continue
        entry = np.full(len(part), layers[-1][0][0], np.int64)
        best = part @ vectors[entry[0]] if len(part) else np.zeros(0)
        for on, near in reversed(layers[1:]):
            places[on] = np.arange(len(on))
            moving = np.arange(len(part))
            while len(moving):
                step = near[places[entry[moving]]]
                found = np.einsum("qd,qmd->qm", part[moving], vectors[np.maximum(step, 0)])
                found[step < 0] = -np.inf
                k = found.argmax(1)
                better = found[np.arange(len(k)), k] > best[moving]
                entry[moving[better]] = step[better, k[better]]
                best[moving[better]] = found[better, k[better]]
                moving = moving[better]
        nodes, _ = _beam(part, vectors, low, entry, max(beam, top + 1))
        for j, found in enumerate(nodes):
            ids, values = _best_rows(index, found[found < last], queries[a + j], query_ids[a + j], top)
            out.append((np.full(len(ids), query_ids[a + j]), ids, values))
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else empty


_INDEX = "ids binary, starts binary, vectors binary, layers array<struct<nodes: binary, links: binary>>"
_FOUND = "query_id bigint, vec_id bigint, score double"


def _pack(shard: pa.Table) -> pa.Table:
    ids = shard.column("vec_id").to_numpy()
    d = shard.column("d")[0].as_py()
    flat = shard.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    index = build(ids, flat.reshape(len(ids), d))
    return pa.table({
        **{c: pa.array([shard.column(c)[0].as_py()], pa.int32()) for c in ("d", "bucket", "shard")},
        "ids": [index["ids"].astype(np.int64).tobytes()], "starts": [index["starts"].tobytes()],
        "vectors": [index["vectors"].tobytes()],
        "layers": pa.array([[{"nodes": a.tobytes(), "links": b.tobytes()} for a, b in index["layers"]]],
                           pa.list_(pa.struct([("nodes", pa.binary()), ("links", pa.binary())]))),
    })


def _unpack(row: dict) -> dict:
    layers = []
    for x in row["layers"]:
        on = np.frombuffer(x["nodes"], np.int32)
        layers.append((on, np.frombuffer(x["links"], np.int32).reshape(len(on), -1)))
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["d"])
    return {
        "ids": np.frombuffer(row["ids"], np.int64), "starts": np.frombuffer(row["starts"], np.int32),
        "vectors": vectors, "layers": layers, "scale": np.ldexp(1.0, -int(np.frexp(np.abs(vectors).max())[1])),
    }


def _ask(top: int, beam: int | None):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                queries = np.frombuffer(row["queries"], np.float64).reshape(-1, row["d"])
                q, v, s = search(_unpack(row), np.frombuffer(row["query_ids"], np.int64), queries, top, beam)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s)], names=["query_id", "vec_id", "score"])

    return run


def _block(rows: pa.Table) -> pa.Table:
    flat = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return pa.table({
        "d": pa.array([rows.column("d")[0].as_py()], pa.int32()),
        "query_ids": [rows.column("vec_id").to_numpy().astype(np.int64).tobytes()], "queries": [flat.tobytes()],
    })


def index(vectors: DataFrame, shard_rows: int | None = None) -> DataFrame:
    """A row per dimension, bucket of lengths and shard, with the graph's flat arrays.

    ``vectors`` has vec_id, vector and d. The rows are written to the checkpoint folder.
    """
    most = F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))
    # The length's logarithm, by way of the largest component; buckets end away from powers of two.
    length = F.log2(most) + F.log2(F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / F.col("most")) ** 2)) / 2
    placed = vectors.withColumn("most", most).withColumn("bucket", F.floor(length + 0.37).cast("int")).drop("most")
    rows = F.greatest(F.lit(1024), F.floor(F.lit(SHARD_BYTES // 8) / F.col("d"))) if shard_rows is None else F.lit(shard_rows)
    sizes = placed.groupBy("d", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "d", "bucket", F.ceil(F.col("n") / rows).alias("shards"))
    # The hash takes the vector too, so that repeated ids spread.
    dealt = placed.join(sizes, ["d", "bucket"]).withColumn(
        "shard", F.pmod(F.xxhash64("vec_id", "vector"), F.col("shards")).cast("int"))
    return kept(dealt.groupBy("d", "bucket", "shard").applyInArrow(_pack, f"d int, bucket int, shard int, {_INDEX}"))


def ask(graphs: DataFrame, queries: DataFrame, blocks: int, top: int, beam: int | None) -> DataFrame:
    """What every shard finds for every query (vec_id, vector, d) of its dimension, in ``blocks`` blocks."""
    packed = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).groupBy("d", "block").applyInArrow(
        _block, "d int, query_ids binary, queries binary"
    )
    # One row per dimension.
    places = graphs.groupBy("d").agg(F.collect_list(F.struct("bucket", "shard")).alias("places"))
    everywhere = packed.join(places, "d").select("*", F.explode("places").alias("place")).select(
        "d", "place.bucket", "place.shard", "query_ids", "queries")
    # A joined row holds a shard and a block of queries, some megabytes: few to a batch.
    with settings(graphs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "2"}):
        return kept(everywhere.join(graphs, ["d", "bucket", "shard"]).mapInArrow(_ask(top, beam), _FOUND))


def ranked(found: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def wide_enough(graphs: DataFrame, queries: DataFrame, top: int, least: float = RECALL) -> int:
    """The first of ``BEAMS`` at which some of the queries find ``least`` of their nearest, or the last."""
    some = kept(queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(LOOKED_AT))
    exact = ranked(ask(graphs, some, 1, top, None), top).groupBy("query_id").agg(
        F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    exact = kept(exact)
    for beam in BEAMS:
        found = ranked(ask(graphs, some, 1, top, beam), top).join(exact, "query_id")
        hits = found.agg(F.count_if(F.col("score") >= F.col("least"))).first()[0]
        if hits >= least * (exact.agg(F.sum("n")).first()[0] or 0):
            return beam
    return BEAMS[-1]


def nearest(
    rows: DataFrame, queries: DataFrame, top: int = TOP, beam: int | None = None, shard_rows: int | None = None
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the ``top`` nearest of ``rows`` for each query.

    Both have vec_id and embedding. Vectors that are null, zero or hold null or non-finite
    components take no part, nor do null ids; a query only meets vectors of its own
    dimension. Rows repeated under one id stay rows each; a query's own id is no candidate.
    Of queries with one id the smallest vector asks. Ties go to the smaller vec_id. With
    either table empty there are no rows. Without a ``beam`` it is found by trial.
    """
    prepared(rows.sparkSession)

    def clean(df: DataFrame) -> DataFrame:
        x = F.col("embedding").cast("array<double>")
        return df.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("vector")).where(
            usable("vector") & F.col("vec_id").isNotNull()
        ).withColumn("d", F.size("vector"))

    graphs = index(clean(rows), shard_rows)
    asked = kept(clean(queries).groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("d", F.size("vector")))
    blocks = max(1, -(-asked.count() // QUERIES))
    found = ask(graphs, asked, blocks, top, beam or wide_enough(graphs, asked, top))
    return ranked(found, top).select("query_id", "rank", "vec_id", "score")
