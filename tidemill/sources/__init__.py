"""Where messages, tables and schemas come from."""

from tidemill.sources.kafka import (
    jaas_config,
    kafka_options,
    kafka_sink_options,
    publish_messages,
    read_topic_stream,
)
from tidemill.sources.schema_table import SchemaNotFound, latest_schema, schemas_by_id
from tidemill.sources.tables import count_rows, ensure_merge_table, scan_table, stream_table
from tidemill.sources.topic_files import MESSAGE_SCHEMA, append_messages, stream_topic_files

__all__ = [
    "MESSAGE_SCHEMA",
    "SchemaNotFound",
    "append_messages",
    "count_rows",
    "ensure_merge_table",
    "jaas_config",
    "kafka_options",
    "kafka_sink_options",
    "latest_schema",
    "publish_messages",
    "read_topic_stream",
    "scan_table",
    "schemas_by_id",
    "stream_table",
    "stream_topic_files",
]
