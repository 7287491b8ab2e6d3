"""A folder of Parquet files standing in for a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemill.sources.tables import file_options

#: The columns of Spark's Kafka source.
MESSAGE_SCHEMA = (
    StructType()
    .add("key", "binary")
    .add("value", "binary")
    .add("topic", "string")
    .add("partition", "integer")
    .add("offset", "long")
    .add("timestamp", "timestamp")
    .add("timestampType", "integer")
)


def append_messages(messages: DataFrame, folder: str) -> None:
    """Publish messages by adding files to the folder."""
    messages.select(*MESSAGE_SCHEMA.names).write.mode("append").parquet(folder)


def stream_topic_files(
    spark: SparkSession,
    folder: str,
    max_files_per_trigger: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Stream the messages of a folder, oldest files first, however old they are."""
    options = file_options(max_files_per_trigger, archive)
    return spark.readStream.schema(MESSAGE_SCHEMA).options(**options).parquet(folder)
