"""A table of what each micro-batch read, wrote and left out."""

from __future__ import annotations

import threading
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemill.operators.decode import DECODE_METRICS
from tidemill.workspace import ensure_folder

LEDGER_SCHEMA = (
    "table_name STRING, run_id STRING, batch_id BIGINT, written BIGINT, input_rows BIGINT,"
    " rejected BIGINT, late_dropped BIGINT, recorded_at TIMESTAMP"
)
#: Seconds to wait for the last events of a query, which arrive on a thread of their own.
_PATIENCE = 30.0


class RunLedger(StreamingQueryListener):
    """Collects counts while queries run and appends them to a Parquet folder when each ends.

    Sinks report the rows of each batch (:meth:`wrote`); the listener adds input rows, rejected
    messages and rows that came too late. A batch of a broken run that is done again is recorded
    again; :func:`read_ledger` shows each batch once. Use as a context manager around the runs.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self._folder = folder
        self._lock = threading.Lock()
        self._written: dict[tuple[str, int], dict[str, int]] = {}
        self._progress: dict[tuple[str, int], tuple[int, int, int]] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition(self._lock)

    def __enter__(self) -> RunLedger:
        ensure_folder(self._spark, self._folder)
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        try:
            self.flush()
        finally:
            self._spark.streams.removeListener(self)

    def wrote(self, table: str, run_id: str, batch_id: int, rows: int) -> None:
        with self._lock:
            self._written.setdefault((run_id, batch_id), {})[table] = rows
            self._ended.discard(run_id)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's name
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802 - Spark's name
        progress = event.progress
        metrics = progress.observedMetrics.get(DECODE_METRICS)
        rejected = int(metrics["rejected"]) if metrics is not None else 0
        late = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        with self._lock:
            key = (str(progress.id), progress.batchId)
            before = self._progress.get(key, (0, 0, 0))
            counts = (progress.numInputRows, rejected, late)
            # A progress without a batch repeats the number of the last one, with zeros.
            self._progress[key] = tuple(map(max, before, counts))

    def onQueryTerminated(self, event) -> None:  # noqa: N802 - Spark's name
        with self._changed:
            self._ended.add(str(event.id))
            self._changed.notify_all()

    def flush(self) -> int:
        """Append what was collected, once the queries that wrote have ended; the number of rows."""
        with self._changed:
            waiting = {run for run, _ in self._written}
            self._changed.wait_for(lambda: waiting <= self._ended, _PATIENCE)
            now = datetime.now(UTC)
            rows = [
                (table, run, batch, count, *self._progress.get((run, batch), (None, None, None)), now)
                for (run, batch), tables in self._written.items()
                for table, count in tables.items()
            ]
            self._written.clear()
            self._progress.clear()
        if rows:
            recorded = self._spark.createDataFrame(rows, LEDGER_SCHEMA)
            recorded.coalesce(1).write.mode("append").parquet(self._folder)
        return len(rows)


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """One row per table and micro-batch, the latest record of each."""
    records = spark.read.schema(LEDGER_SCHEMA).parquet(folder)
    keys = ["table_name", "run_id", "batch_id"]
    rest = [c for c in records.columns if c not in keys]
    latest = records.groupBy(*keys).agg(F.max_by(F.struct(*rest), "recorded_at").alias("last"))
    return latest.select(*keys, *(f"last.{c}" for c in rest))
