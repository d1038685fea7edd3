"""Vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def euclidean(a: Column, b: Column) -> Column:
    """Straight-line distance of two equally long number arrays (SCL-13)."""
    squares = F.zip_with(
        a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))
    )
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def padded_mean(old: Column, new: Column) -> Column:
    """Element-wise mean of two lists, the shorter padded with 0.0 (SCL-18)."""
    return F.zip_with(
        old, new, lambda a, b: (F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0))) / 2
    )


def closer(distance: Column, other: Column) -> Column:
    """``Yes`` when the first distance is strictly smaller (SCL-14)."""
    return F.when(distance < other, "Yes").otherwise("No")
