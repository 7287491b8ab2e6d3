"""Deduplicated layer: per micro-batch dedup, projection, insert-only merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.config import PROCESSED_COLUMN, TopicConfig
from tidemill.operators import first_per_key
from tidemill.sources import count_rows, ensure_merge_table, stream_table
from tidemill.streaming.ledger import RunLedger
from tidemill.streaming.sinks import InsertOnlyMerge, announce, query_id, start_batches


def ensure_silver_table(spark: SparkSession, config: TopicConfig) -> str:
    """Create the topic's silver table if it is absent, add columns it lacks; its catalog name."""
    return ensure_merge_table(
        spark,
        config.silver_table,
        config.silver_schema,
        config.table_format,
        config.dedup_keys,
        config.silver_buckets,
    )


def silver_rows(arrivals: DataFrame, config: TopicConfig) -> DataFrame:
    """First arrival per key, projected to the silver columns and stamped."""
    return (
        first_per_key(arrivals, config.dedup_keys)
        .select(*config.silver_columns)
        .withColumn(PROCESSED_COLUMN, F.current_timestamp())
    )


def silver_merge(config: TopicConfig, ledger: RunLedger | None = None) -> InsertOnlyMerge:
    return InsertOnlyMerge(
        config.silver_table,
        config.silver_schema,
        config.dedup_keys,
        config.table_format,
        config.silver_buckets,
        config.merge_partitions,
        ledger,
    )


def upsert_batch(
    merge: InsertOnlyMerge, config: TopicConfig, arrivals: DataFrame, run_id: str, batch_id: int
) -> None:
    """Process one micro-batch of bronze rows; safe to repeat with the same ids."""
    merge(arrivals, silver_rows(arrivals, config), run_id, batch_id)


def clean_silver(
    spark: SparkSession,
    config: TopicConfig,
    report_counts: bool = True,
    max_files_per_trigger: int | None = None,
    ledger: RunLedger | None = None,
) -> int | None:
    """Drain new bronze rows into the silver table and return its row count.

    Rows whose key is already there are left out: the first write wins, within
    a batch the lowest partition and offset.
    """
    ensure_silver_table(spark, config)
    bronze = stream_table(
        spark,
        config.bronze_table,
        config.table_format,
        config.bronze_schema,
        max_files_per_trigger,
    )
    merge = silver_merge(config, ledger)

    def on_batch(arrivals: DataFrame, batch_id: int) -> None:
        upsert_batch(merge, config, arrivals, query_id(arrivals), batch_id)

    start_batches(bronze, on_batch, config.silver_checkpoint).awaitTermination()
    if not report_counts:
        return None
    total = count_rows(spark, config.silver_table, config.table_format, config.silver_schema)
    return announce(config.silver_table, total)
