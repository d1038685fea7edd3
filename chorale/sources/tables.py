"""Batch sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from chorale.schemas import GRAPH_EDGE, GRAPH_NODE


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str],
    column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options of a table scan, split into range queries when a column is named."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **properties}
    if column is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned scan needs both bounds")
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str], **split) -> DataFrame:
    """JDBC table scan (SRC-2); rows outside the bounds fall into the end ranges."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, properties, **split)).load()


def _xml(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    return (
        spark.read.format("xml")
        .option("rowTag", tag)
        .option("attributePrefix", "@")
        .option("valueTag", "#VALUE")
        .schema(schema)
        .load(path)
    )


def read_graph_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Node rows of GraphML (SRC-3); a fixed schema keeps a lone child an array."""
    return _xml(spark, path, "node", GRAPH_NODE)


def read_graph_edges(spark: SparkSession, path: str) -> DataFrame:
    return _xml(spark, path, "edge", GRAPH_EDGE)


def number_range(spark: SparkSession, start: int, end: int, partitions: int | None = None) -> DataFrame:
    return spark.range(start, end, 1, partitions)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A short list as a frame (SRC-5)."""
    return spark.createDataFrame(list(rows), schema)
