"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings the operators count on. Shuffle width is left to the cluster: AQE
# coalesces small partitions and splits the hot ones of a sort-merge join.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join keys even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Streaming state on the executors' disks rather than in their heaps.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call-site capture for every column call doubles the time plans take to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "chorale", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session of a single JVM without that setting gets a temporary folder of
    its own, since executors of a cluster, a local one too, would not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="chorale-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows in the shared checkpoint folder, which Spark can clean; lineage ends there."""
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the time of a block."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield spark
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def cached(df: DataFrame):
    """Keep a frame hot while several reports read it (MAT-1)."""
    hot = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield hot
    finally:
        hot.unpersist()
