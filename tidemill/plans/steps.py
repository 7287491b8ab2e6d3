"""A table of the steps of a run: what ended, what failed, and where to go on."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from tidemill.workspace import ensure_folder

STEP_SCHEMA = (
    "run STRING, step STRING, attempt INT, counts MAP<STRING, BIGINT>, error STRING,"
    " recorded_at TIMESTAMP"
)
Counts = dict[str, int | None]


class StepLog:
    """Steps of the run named ``run``, each tried ``1 + retries`` times, done ones skipped.

    Every attempt is appended to a Parquet folder as it ends, so a run that was broken off goes on
    at its failed step when it is started again under the same name. A schedule names its runs by
    their date. A step that was killed between its end and its record is done again, which is
    safe for layers: their checkpoints know what was published.
    """

    def __init__(
        self, spark: SparkSession, folder: str, run: str, retries: int = 1, wait_seconds: float = 0
    ) -> None:
        if retries < 0 or wait_seconds < 0:
            raise ValueError("retries and wait_seconds cannot be negative")
        self._spark, self._folder, self._run = spark, folder, run
        self._attempts, self._wait = retries + 1, wait_seconds
        self._lock = threading.Lock()
        ensure_folder(spark, folder)
        ended = read_steps(spark, folder).filter("error IS NULL")
        rows = ended.filter(ended["run"] == run).select("step", "counts").collect()
        self._done: dict[str, Counts] = {r["step"]: dict(r["counts"]) for r in rows}

    def do(self, step: str, action: Callable[[], Counts]) -> Counts:
        """The counts of a step, from the log if it has ended before; the last error is raised."""
        if step in self._done:
            return self._done[step]
        for attempt in range(1, self._attempts + 1):
            try:
                counts = action()
            except Exception as error:
                self._record(step, attempt, None, f"{type(error).__name__}: {error}")
                if attempt == self._attempts:
                    raise
                time.sleep(self._wait)
            else:
                self._record(step, attempt, counts, None)
                self._done[step] = counts
                break
        return self._done[step]

    def _record(self, step: str, attempt: int, counts: Counts | None, error: str | None) -> None:
        row = (self._run, step, attempt, counts, error, datetime.now(UTC))
        with self._lock:
            recorded = self._spark.createDataFrame([row], STEP_SCHEMA)
            recorded.coalesce(1).write.mode("append").parquet(self._folder)


def read_steps(spark: SparkSession, folder: str) -> DataFrame:
    """All attempts of all runs: counts by table where a step ended well, its error otherwise."""
    return spark.read.schema(STEP_SCHEMA).parquet(folder)
