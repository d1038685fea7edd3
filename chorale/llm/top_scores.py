"""Exact top-k by histogram selection over quantised vectors.

Every round scores all rows against all queries, in blocks, and keeps nothing but a
histogram of the scores per query. The sums of these histograms over all blocks say in which
bin a query's k-th highest score lies; the next round looks into that bin alone, until bins
are one score wide. A last round then gives the rows over that score, and of those equal to
it the ones with the smallest ids.

A block reports the bins from its highest down to the one that holds its own k-th score. The
k-th score of all rows is no lower than that of any block, so no count that matters is left
out and a query sends at most k counts from each block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import kept, prepared
from chorale.session import settings

TOP = 5
SCALE = 256
BINS = 1024
ROWS = 1 << 15  # candidate rows of a block, on average
QUERIES = 1024  # queries of a block, on average
STEP = 1 << 22  # scores held at a time
LIMIT = (1 << 63) - 1


def usable(column: str):
    """Vectors that are not null and hold neither null nor non-finite components."""
    fine = F.forall(column, lambda v: F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    return F.coalesce(F.col(column).isNotNull() & fine, F.lit(False))


def quantised(flat: np.ndarray) -> np.ndarray:
    """floor(256 * x) as whole numbers: doubles where these are exact, else Python integers."""
    with np.errstate(over="ignore"):
        out = np.floor(flat * SCALE)
    if np.all(np.abs(out) < 2.0**53):
        return out
    # 256 * x may pass the largest double.
    return np.array([int(x) * SCALE if abs(x) >= 2.0**53 else int(np.floor(x * SCALE)) for x in flat.tolist()], object)


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond 64 bits they stop at the largest and smallest number."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    most = int(np.abs(queries).max()) * int(np.abs(rows).max()) * queries.shape[1]
    if most < 1 << 53:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return queries.astype(np.int64) @ rows.astype(np.int64).T
    exact = np.array([[int(x) for x in q] for q in queries], object) @ np.array([[int(x) for x in r] for r in rows], object).T
    return np.clip(exact, -LIMIT, LIMIT).astype(np.int64)


def _packed(rows: pa.Table, extra: tuple[str, ...]) -> pa.Table:
    d = rows.column("d")[0].as_py()
    flat = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return pa.table({
        "d": pa.array([d], pa.int32()), "block": rows.column("block").slice(0, 1),
        "ids": [rows.column("vec_id").to_numpy().astype(np.int64).tobytes()], "vectors": [flat.tobytes()],
        **{c: [rows.column(c).to_numpy().astype(np.int64).tobytes()] for c in extra},
    })


def _vectors(data: bytes, d: int, n: int) -> np.ndarray:
    return quantised(np.frombuffer(data, np.float64)).reshape(n, d)


def _pairs(batches):
    """Of every joined row the query ids, low ends, high ends, row ids, times and a function that scores some queries."""
    for batch in batches:
        for row in batch.to_pylist():
            ids, qids = (np.frombuffer(row[c], np.int64) for c in ("ids", "query_ids"))
            rows, queries = _vectors(row["vectors"], row["d"], len(ids)), _vectors(row["queries"], row["d"], len(qids))
            low, high, times = (np.frombuffer(row[c], np.int64) for c in ("low", "high", "times"))
            step = max(1, STEP // max(1, len(ids)))
            for a in range(0, len(qids), step):
                part = slice(a, a + step)
                own = qids[part, None] == ids[None, :]
                yield qids[part], low[part], high[part], ids, times, scores(queries[part], rows), own


def _histogram(top: int, bins: int):
    def run(batches):
        for qids, low, high, _, times, found, own in _pairs(batches):
            out_q, out_bin, out_n = [], [], []
            for j, q in enumerate(qids.tolist()):
                inside = np.flatnonzero((found[j] >= low[j]) & ~own[j])
                # Bins of equal width; what lies over the high end is counted in one bin of its own.
                width = -(-(int(high[j]) - int(low[j]) + 1) // bins)
                over = found[j, inside] > high[j]
                at = np.minimum(found[j, inside], high[j]).astype(object) - int(low[j]) if width > 1 << 40 else (
                    np.minimum(found[j, inside], high[j]) - low[j])
                at = np.where(over, bins, (at // width).astype(np.int64))
                counts = np.bincount(at, weights=times[inside], minlength=bins + 1).astype(np.int64)
                some = np.flatnonzero(counts)[::-1]
                until = np.searchsorted(np.cumsum(counts[some]), top) + 1
                some = some[:until]
                out_q.append(np.full(len(some), q))
                out_bin.append(some)
                out_n.append(counts[some])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).astype(np.int64)) for c in (out_q, out_bin, out_n)], names=["vec_id", "bin", "n"]
            )

    return run


def _chosen(top: int):
    def run(batches):
        for qids, low, _, ids, times, found, own in _pairs(batches):
            out = []
            for j, q in enumerate(qids.tolist()):
                rows = np.flatnonzero((found[j] >= low[j]) & ~own[j])
                # Rows over the k-th score are fewer than k; of those at it the smallest ids may count.
                rows = rows[np.lexsort((ids[rows], -found[j, rows]))][:top]
                out.append((np.full(len(rows), q), ids[rows], found[j, rows], times[rows]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], names=["query_id", "vec_id", "score", "times"]
            )

    return run


def _clean(rows: DataFrame, vector: str) -> DataFrame:
    x = F.col(vector).cast("array<double>")
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("vector")).where(
        usable("vector") & F.col("vec_id").isNotNull()
    ).withColumn("d", F.size("vector"))


def _dealt(df: DataFrame, blocks: int) -> DataFrame:
    return df.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int"))


def top_scores(
    rows: DataFrame, queries: DataFrame, top: int = TOP, bins: int = BINS, vector: str = "embedding",
    block_rows: int = ROWS, block_queries: int = QUERIES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the ``top`` rows of highest score for each query, all if fewer.

    Both frames have vec_id and ``vector``, whose components x count as floor(256 * x); a
    score is their inner product, in whole numbers, held at 64 bits. Vectors that are null or
    hold null or non-finite components take no part, nor do rows with a null id; zero and
    empty vectors do. A query meets vectors of its own dimension, and not the rows of its own
    id. Rows repeated under one id stay rows each; of queries with one id the smallest vector
    asks. Ties go to the smaller vec_id. Other columns are not read, and with either table
    empty there are no rows.
    """
    spark = prepared(rows.sparkSession)
    # Equal rows are counted once, so that a row repeated very often is one row of one block.
    once = kept(_clean(rows, vector).groupBy("vec_id", "vector", "d").agg(F.count(F.lit(1)).alias("times")))
    ends = F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))
    n, most = once.agg(F.count(F.lit(1)), F.max(ends)).first()
    # Past this no bound is told from the largest number.
    most = min(int(np.abs(quantised(np.array([most or 0.0, -(most or 0.0)]))).max()), 10**300)
    blocks = max(1, -(-n // block_rows))
    candidates = kept(_dealt(once, blocks).groupBy("d", "block").applyInArrow(
        lambda t: _packed(t, ("times",)), "d int, block int, ids binary, vectors binary, times binary"
    ))
    asked = _clean(queries, vector).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    # No score passes this by size, so the first histogram spans them all.
    reach = F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.abs(x) * SCALE + 2) * float(most)
    high = F.when(reach < 9e18, F.ceil(reach).cast("bigint")).otherwise(F.lit(LIMIT))
    asked = kept(asked.withColumn("d", F.size("vector")).withColumn("high", high).withColumn("low", -F.col("high")))
    groups = max(1, -(-asked.count() // block_queries))

    def everywhere(open_: DataFrame) -> DataFrame:
        """All blocks of queries beside all blocks of rows of their dimension."""
        packed = _dealt(open_, groups).groupBy("d", "block").applyInArrow(
            lambda t: _packed(t, ("low", "high")), "d int, block int, ids binary, vectors binary, low binary, high binary"
        ).select(
            "d", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.col("ids").alias("query_ids"),
            F.col("vectors").alias("queries"), "low", "high",
        )
        return packed.join(candidates, ["d", "block"])

    state = asked
    # A joined row holds two blocks, some megabytes: few to a batch.
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "2"}):
        while not (open_ := state.where("low < high")).isEmpty():
            counts = everywhere(open_).mapInArrow(_histogram(top, bins), "vec_id bigint, bin bigint, n bigint").groupBy(
                "vec_id", "bin").agg(F.sum("n").alias("n"))
            down = Window.partitionBy("vec_id").orderBy(F.desc("bin"))
            # The first bin, from above, up to which there are k rows; with fewer rows in all, the lowest one.
            total = F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0))
            kth = counts.withColumn("total", total).groupBy("vec_id").agg(
                F.max(F.when(F.col("total") >= top, F.col("bin"))).alias("bin")
            )
            # ceil((high - low + 1) / bins), where the sum may pass 63 bits.
            span = F.col("high").cast("decimal(38,0)") - F.col("low") + 1
            width = F.ceil(span / F.lit(bins).cast("decimal(38,0)")).cast("decimal(38,0)")
            start = F.col("low") + F.col("bin") * F.col("width")
            state = kept(
                state.join(kth, "vec_id", "left").withColumn("width", width).select(
                    "vec_id", "vector", "d",
                    # Without a k-th row all rows count: the lowest score will do.
                    F.when(F.col("low") == F.col("high"), F.col("low")).when(F.col("bin").isNull(), F.col("low")).otherwise(start)
                    .cast("bigint").alias("low"),
                    F.when(F.col("low") == F.col("high"), F.col("high")).when(F.col("bin").isNull(), F.col("low"))
                    .otherwise(F.least(F.col("high").cast("decimal(38,0)"), start + F.col("width") - 1)).cast("bigint").alias("high"),
                )
            )
        found = kept(everywhere(state).mapInArrow(
            _chosen(top), "query_id bigint, vec_id bigint, score bigint, times bigint"
        ))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    before = F.coalesce(F.sum("times").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = found.withColumn("before", before).where(F.col("before") < top)
    ranks = F.sequence((F.col("before") + 1).cast("int"), F.least(F.col("before") + F.col("times"), F.lit(top)).cast("int"))
    return ranked.select("query_id", F.explode(ranks).alias("rank"), "vec_id", "score")


SQL = """WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, r.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM whole q JOIN whole r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id AND len(q.v) = len(r.v)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""
