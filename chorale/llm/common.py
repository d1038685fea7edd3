"""What several operators share: tables, checkpoints, Arrow batches."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.session import scratch_path, scratch_root

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Rows of one Arrow batch: texts are wide, so few of them go to Python at once.
BATCH_ROWS = 256
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepared(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, a checkpoint folder that executors share, skewed joins split.

    Python workers look for this package where the driver found it, besides their own paths.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, *paths]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return spark


def kept(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder; lineage ends there."""
    prepared(df.sparkSession)
    return df.checkpoint()


def tidied(spark: SparkSession) -> None:
    """Let go of the shuffle files of earlier steps: Spark drops them once its driver has collected what refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written as a table to the shared folder, compressed, and read again; lineage ends there."""
    place = scratch_path(df.sparkSession, name)
    df.write.parquet(place)
    tidied(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column without nulls and with 64-bit offsets."""
    return pc.fill_null(batch.column(name).cast(pa.large_string()), "")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offset of each (one more than rows)."""
    _, offsets, data = column.buffers()
    marks = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[marks[0] : marks[-1]], marks - marks[0]


def per_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch | None]):
    """A function of one batch as a function of all batches of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = work(batch)
                if out is not None and out.num_rows:
                    yield out

    return run


def word_count(text: str):
    """Number of words of a text column; null and blank texts have none."""
    body = F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " "))
    return F.when(body == "", F.lit(0)).otherwise(F.size(F.split(body, " "))).cast("long")
