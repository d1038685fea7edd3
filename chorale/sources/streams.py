"""Unbounded sources and message decoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chorale.schemas import MESSAGE_VALUE


def read_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    only: str | None = None,
) -> DataFrame:
    """Files of a folder as they arrive (SRC-6)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if only:
        reader = reader.option("pathGlobFilter", only)
    return reader.load(path)


def topic_options(servers: str, topics: Sequence[str], starting: str = "latest", **more: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        **more,
    }


def read_topics(spark: SparkSession, servers: str, topics: Sequence[str], **options: str) -> DataFrame:
    """Topic messages as string key and value (SRC-7); needs the Kafka connector."""
    raw = spark.readStream.format("kafka").options(**topic_options(servers, topics, **options)).load()
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"))


def decode_status(messages: DataFrame, value: str = "value") -> DataFrame:
    """Status records out of JSON message values (SRC-8).

    Missing or null fields, and whole values that are no JSON, take the
    defaults: empty text and 0.0.
    """
    parsed = F.from_json(F.col(value), MESSAGE_VALUE)

    def text(field: Column, name: str) -> Column:
        return F.coalesce(field, F.lit("")).alias(name)

    def number(field: Column, name: str) -> Column:
        return F.coalesce(field, F.lit(0.0)).alias(name)

    kept = [c for c in messages.columns if c != value]
    return messages.withColumn("_m", parsed).select(
        *kept,
        text(F.col("_m.user.name"), "userName"),
        text(F.col("_m.user.userid"), "userId"),
        text(F.col("_m.user.lang"), "userLang"),
        text(F.col("_m.created_at"), "createdAt"),
        text(F.col("_m.text"), "text"),
        number(F.col("_m.geo.long"), "long"),
        number(F.col("_m.geo.lat"), "lat"),
    )


def flat_posts(status: DataFrame, *more: str) -> DataFrame:
    """Status records as posts, matched by name (PRJ-3)."""
    return status.select(
        F.col("userName").alias("author"),
        F.col("userId").alias("userid"),
        F.col("createdAt").alias("date"),
        F.col("userLang").alias("lang"),
        "text",
        F.coalesce("lat", F.lit(0.0)).alias("lat"),
        F.coalesce("long", F.lit(0.0)).alias("long"),
        *more,
    )
