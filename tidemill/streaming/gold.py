"""Aggregated layer: each job is one query that emits windows when they are final."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemill.config import GoldJob, TopicConfig
from tidemill.operators import DEFAULT_WATERMARK, DEFAULT_WINDOW, windowed_aggregate
from tidemill.session import isolated
from tidemill.sources import count_rows, stream_table
from tidemill.streaming.ledger import RunLedger
from tidemill.streaming.sinks import announce, append_stream, await_all


@dataclass(frozen=True)
class StartedJob:
    """A running job with what is needed to report on it."""

    job: GoldJob
    query: StreamingQuery
    schema: StructType

    def rows(self, spark: SparkSession, table_format: str) -> int:
        total = count_rows(spark, self.job.table, table_format, self.schema)
        return announce(self.job.table, total)


def start_gold_aggregation(
    events: DataFrame,
    job: GoldJob,
    watermark: str = DEFAULT_WATERMARK,
    window: str = DEFAULT_WINDOW,
    watermark_scope: str = "matching",
    table_format: str = "parquet",
    ledger: RunLedger | None = None,
) -> StartedJob:
    """Start one job on a stream of events; it stops when everything available is done."""
    result = windowed_aggregate(events, job, watermark, window, watermark_scope)
    query = append_stream(result, job.table, job.checkpoint, table_format, ledger)
    return StartedJob(job, query, result.schema)


def session_of(spark: SparkSession, job: GoldJob) -> SparkSession:
    """The session a job's first run has to start in.

    A new checkpoint fixes the number of state partitions for good, so it is a declared
    number of the job and not a guess from what the first run happens to find.
    """
    if job.state_partitions is None:
        return spark
    return isolated(spark, {"spark.sql.shuffle.partitions": str(job.state_partitions)})


def run_gold_aggregation(
    spark: SparkSession,
    silver: str | DataFrame,
    job: GoldJob,
    watermark: str = DEFAULT_WATERMARK,
    window: str = DEFAULT_WINDOW,
    watermark_scope: str = "matching",
    table_format: str = "parquet",
    report_counts: bool = True,
    max_files_per_trigger: int | None = None,
    ledger: RunLedger | None = None,
) -> int | None:
    """Drain new silver rows through one job and return the row count of its table.

    ``silver`` is a table, or a streaming DataFrame (then the state is partitioned by
    the settings of its session; see :func:`session_of`). ``max_files_per_trigger`` cuts a
    large backlog of a table into micro-batches that are committed one by one.
    """
    if isinstance(silver, str):
        session = session_of(spark, job)
        events = stream_table(
            session, silver, table_format, max_files_per_trigger=max_files_per_trigger
        )
    else:
        events = silver
    started = start_gold_aggregation(
        events, job, watermark, window, watermark_scope, table_format, ledger
    )
    started.query.awaitTermination()
    return started.rows(spark, table_format) if report_counts else None


def run_all_gold_jobs(
    spark: SparkSession,
    config: TopicConfig,
    watermark: str = DEFAULT_WATERMARK,
    window: str = DEFAULT_WINDOW,
    concurrent: bool = False,
    report_counts: bool = True,
    watermark_scope: str = "matching",
    max_files_per_trigger: int | None = None,
    ledger: RunLedger | None = None,
) -> dict[str, int | None]:
    """Run every job of a topic and return row counts by job name.

    Jobs keep separate queries, state and checkpoints, since each has its own
    watermark. ``concurrent`` starts them together; the first failure is
    raised after all have ended.
    """
    started: list[StartedJob] = []
    for job in config.gold_jobs:
        events = stream_table(
            session_of(spark, job),
            config.silver_table,
            config.table_format,
            config.silver_schema,
            max_files_per_trigger,
        )
        running = start_gold_aggregation(
            events, job, watermark, window, watermark_scope, config.table_format, ledger
        )
        started.append(running)
        if not concurrent:
            running.query.awaitTermination()
    await_all([s.query for s in started])
    return {
        s.job.name: s.rows(spark, config.table_format) if report_counts else None for s in started
    }
