"""A sink of message rows that publishes each micro-batch once (SNK-6, SNK-7).

``chorale-channel`` is a streaming data source for writing. Each task writes its rows to a
file of its own under ``data`` and hands the file's name to the commit of the batch, which
publishes the batch by one small file under ``batches`` that names them. Readers take the
published files only, so what failed tasks and batches leave behind is never seen, and a
batch that is run again after its commit publishes nothing more.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import StructType

NAME = "chorale-channel"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder, of any kind that Arrow knows, and the folder's path there."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _batch_file(root: str, batch_id: int) -> str:
    return f"{root}/batches/{batch_id:020d}.json"


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    rows: int


class ChannelWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = _open(self.path)
        files.create_dir(f"{root}/data")
        name, rows, writer = f"{uuid.uuid4().hex}.parquet", 0, None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                writer = pq.ParquetWriter(f"{root}/data/{name}", batch.schema, filesystem=files)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is None:
            return Written(None, 0)
        writer.close()
        return Written(name, rows)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        files, root = _open(self.path)
        files.create_dir(f"{root}/batches")
        place = _batch_file(root, batchId)
        if files.get_file_info(place).type != pafs.FileType.NotFound:
            return
        listed = {"files": [m.name for m in messages if m and m.name], "rows": sum(m.rows for m in messages if m)}
        # Written aside and moved, so that a batch is published whole or not at all.
        aside = f"{root}/{uuid.uuid4().hex}.tmp"
        with files.open_output_stream(aside) as out:
            out.write(json.dumps(listed).encode())
        files.move(aside, place)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        files, root = _open(self.path)
        for m in messages:
            if m and m.name:
                files.delete_file(f"{root}/data/{m.name}")


class ChannelSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def streamWriter(self, schema: StructType, overwrite: bool) -> ChannelWriter:
        return ChannelWriter(self.options["path"])


def publish(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A stream of rows published batch by batch under a folder all executors reach."""
    rows.sparkSession.dataSource.register(ChannelSource)
    return (
        rows.writeStream.format(NAME).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    )


def published_batches(spark: SparkSession, path: str) -> list[Row]:
    """batch_id, files and rows of every published batch, in order; a batch is one small row."""
    files, root = _open(path)
    found = files.get_file_info(pafs.FileSelector(f"{root}/batches", allow_not_found=True))
    out = []
    for info in sorted(found, key=lambda i: i.base_name):
        with files.open_input_stream(info.path) as f:
            listed = json.loads(f.read())
        out.append(Row(batch_id=int(info.base_name.split(".")[0]), files=listed["files"], rows=listed["rows"]))
    return out


def published(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All published rows."""
    names = [f"{path.rstrip('/')}/data/{name}" for batch in published_batches(spark, path) for name in batch["files"]]
    return spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)
