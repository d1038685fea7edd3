"""Start, stop and watch streaming queries."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.readwriter import DataStreamWriter

# Fixed value: the batch clock.
BATCH_CLOCK = "5 seconds"


class StreamJob:
    """Handle of one streaming query (STR-6).

    ``build`` returns the writer; a restart builds it anew and resumes from the
    writer's checkpoint location (STR-7).
    """

    def __init__(self, build: Callable[[], DataStreamWriter], clock: str = BATCH_CLOCK):
        self._build = build
        self._clock = clock
        self.query: StreamingQuery | None = None

    @property
    def running(self) -> bool:
        return self.query is not None and self.query.isActive

    def start(self, stop_after: float | None = None) -> StreamJob:
        """Start once; with ``stop_after`` seconds, wait that long and stop after the running batch."""
        if self.running:
            raise RuntimeError("the stream is already running; stop it first")
        self.query = self._build().trigger(processingTime=self._clock).start()
        if stop_after:
            self.query.awaitTermination(stop_after)
            while self.running and self.query.status["isTriggerActive"]:
                time.sleep(0.02)
            self.stop()
        return self

    def run_available(self) -> StreamJob:
        """Work off what is there, batch by batch, and stop."""
        if self.running:
            raise RuntimeError("the stream is already running; stop it first")
        self.query = self._build().trigger(availableNow=True).start()
        self.query.awaitTermination()
        return self

    def stop(self) -> bool:
        """Stop now, in the middle of a batch too (a restart works it again); False when nothing was running."""
        if not self.running:
            return False
        self.query.stop()
        return True


class ProgressLog(StreamingQueryListener):
    """Lifecycle and batch rows of the session's queries, appended to a table (STR-8).

    A batch row has the numbers of rows read and of late rows dropped, and ``observed``: the
    whole numbers that the batch's plan reported by ``DataFrame.observe``, by metric and
    column, which Spark gathers while the batch runs. Rows wait until ``every`` of them are
    there, or :meth:`frame` asks for the table.
    """

    SCHEMA = (
        "query string, event string, batch_id bigint, rows bigint, late bigint, observed map<string,bigint>, error string"
    )

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self._spark, self.path, self._every = spark, path, every
        self._waiting: list[tuple] = []
        self._lock = threading.Lock()
        self._stopped: dict[str, int] = {}
        self._news = threading.Condition()

    def _add(self, *row) -> None:
        with self._lock:
            self._waiting.append(row)
        if len(self._waiting) >= self._every:
            self.flush()

    def onQueryStarted(self, event) -> None:
        self._add(str(event.id), "started", None, None, None, None, None)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {
            f"{name}.{column}": int(value)
            for name, row in p.observedMetrics.items()
            for column, value in row.asDict().items() if isinstance(value, int)
        }
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self._add(str(p.id), "batch", p.batchId, p.numInputRows, late, observed, None)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._add(str(event.id), "stopped", None, None, None, None, event.exception)
        with self._news:
            self._stopped[str(event.id)] = self._stopped.get(str(event.id), 0) + 1
            self._news.notify_all()

    def wait_stopped(self, query: StreamingQuery, times: int = 1, seconds: float = 60) -> bool:
        """Wait until the query's end has been reported, which comes after all its batches; False when it was not."""
        with self._news:
            return self._news.wait_for(lambda: self._stopped.get(str(query.id), 0) >= times, seconds)

    def flush(self) -> None:
        with self._lock:
            rows, self._waiting = self._waiting, []
        # The empty write makes the table exist.
        self._spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def frame(self, spark: SparkSession) -> DataFrame:
        self.flush()
        return spark.read.schema(self.SCHEMA).parquet(self.path)


@contextmanager
def watched(spark: SparkSession, path: str) -> Iterator[ProgressLog]:
    """A progress log that listens for the time of a block."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)
