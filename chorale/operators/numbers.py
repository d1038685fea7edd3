"""Statistics of number columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_variance(df: DataFrame, column: str) -> DataFrame:
    """Mean and population variance (AGG-1)."""
    value = F.col(column)
    return df.agg(F.avg(value).alias("mean"), F.var_pop(value).alias("variance"))
