"""Small hand-made inputs for scenario tests."""

from __future__ import annotations

import os
import time
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from tidemill.config import TopicConfig
from tidemill.operators import encode_messages
from tidemill.sources import MESSAGE_SCHEMA
from tidemill.topics import USER_ACTIVITY


def millis(clock: str, day: str = "2024-01-01") -> int:
    """Epoch milliseconds of a UTC wall-clock time."""
    text = f"{day} {clock}" + (":00" if clock.count(":") == 1 else "")
    return int(datetime.fromisoformat(text).replace(tzinfo=UTC).timestamp() * 1000)


def write_batch(df: DataFrame, folder: str) -> None:
    """Append exactly one file, with a modification time after all earlier files."""
    existing = [f for f in os.listdir(folder) if f.endswith(".parquet")] if os.path.isdir(folder) else []
    df.coalesce(1).write.mode("append").parquet(folder)
    added = [f for f in os.listdir(folder) if f.endswith(".parquet") and f not in existing]
    stamp = time.time() - 1000 + 10 * len(existing)
    for name in added:
        os.utime(os.path.join(folder, name), (stamp, stamp))


def activity(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """user_activity events from (event_id, event_type, clock, amount)."""
    schema = USER_ACTIVITY.payload_schema
    return spark.createDataFrame(
        [
            (i, "user_1", "s", kind, None, None, amount, "mobile", "IN", millis(clock))
            for i, kind, clock, amount in rows
        ],
        schema,
    )


def messages(
    spark: SparkSession,
    events: DataFrame,
    config: TopicConfig = USER_ACTIVITY,
    schema_id: int = 7,
    first_offset: int = 0,
) -> DataFrame:
    """Frame events in row order on partition 0."""
    columns = config.payload_schema.names
    rows = [
        (*r, 0, first_offset + i, datetime(2024, 1, 1, tzinfo=UTC))
        for i, r in enumerate(events.select(*columns).collect())
    ]
    position = "source_partition INT, source_offset BIGINT, source_timestamp TIMESTAMP"
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in config.payload_schema)
    placed = spark.createDataFrame(rows, f"{ddl}, {position}")
    return encode_messages(placed, columns, config.message_key, config.kafka_topic, schema_id)


def raw_messages(spark: SparkSession, values: list[bytes | None]) -> DataFrame:
    rows = [
        (b"k", v, "user-activity", 0, i, datetime(2024, 1, 1, tzinfo=UTC), 0)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)
