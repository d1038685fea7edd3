"""The most frequent values, with memory bounded by a summary and not by the number of values (TOP-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.operators.rows import ranked
from chorale.session import stored

# Spark's frequent-items summary that tracks m values of n rows is wrong by at most
# ERROR * n / m in what it says of a value, and names all values it knows to be over that.
ERROR = 3.5
TRACKED = 4096
MOST = 1_000_000


def top_frequent(
    values: DataFrame, key: str, n: int, tracked: int = TRACKED, most: int = MOST, count: str = "n"
) -> DataFrame:
    """The ``n`` most frequent values of column ``key`` and how often they occur, exactly; smaller values first of equal ones.

    Each task summarises its rows, and summaries merge. Values that cannot be among the
    first n by the summary's error bound are left out; the rest, few where there are heavy
    values, are counted in a second pass. A value the summary does not name has at most
    twice its error, so the result stands where the n-th count is over that. If it is not,
    eight times as many values are tracked, and past ``most`` all values are counted. Nulls
    do not count.
    """
    rows = values.select(F.col(key).alias(key)).where(F.col(key).isNotNull())
    while tracked <= most:
        summary = rows.agg(
            F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("summary"), F.count("*").alias("rows")
        ).select(F.expr(f"approx_top_k_estimate(summary, {tracked})").alias("found"), "rows")
        error = F.col("rows") * F.lit(ERROR / tracked)
        # What is said of a value is no less than its count and no more than the error over it.
        least = F.coalesce(F.get("found", F.lit(n - 1))["count"], F.lit(0)) - error
        picked = stored(summary.select("rows", F.filter("found", lambda x: x["count"] >= least).alias("found")))
        candidates = picked.select(F.explode("found").alias("x")).select(F.col("x.item").alias(key))
        counts = stored(rows.join(candidates, key).groupBy(key).agg(F.count("*").alias(count)))
        top = ranked(counts, count, key, n)
        reached = top.agg(F.count("*").alias("values"), F.min(count).alias("nth")).first()
        if reached["values"] == n and reached["nth"] > 2 * ERROR * picked.first()["rows"] / tracked:
            return top
        tracked *= 8
    return ranked(rows.groupBy(key).agg(F.count("*").alias(count)), count, key, n)
