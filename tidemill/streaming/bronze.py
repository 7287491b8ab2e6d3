"""Ingestion layer: decode a topic and append it, exactly once per checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemill.config import TopicConfig, is_location
from tidemill.operators import Judged, decode_by_schema_id, decode_messages, judge_messages
from tidemill.sources import count_rows, jaas_config, read_topic_stream
from tidemill.sources.schema_table import schemas_by_id as known_schemas
from tidemill.sources.tables import ensure_append_table
from tidemill.streaming.ledger import RunLedger
from tidemill.streaming.sinks import announce, append_stream, split_stream

ON_ERROR = ("fail", "quarantine")


def ingest_bronze(
    spark: SparkSession,
    config: TopicConfig,
    messages: DataFrame,
    schema: StructType | str | None = None,
    codec: str = "json",
    on_error: str = "fail",
    schemas_by_id: dict[int, StructType] | None = None,
    avro_schemas_by_id: dict[int, str] | None = None,
    report_counts: bool = True,
    ledger: RunLedger | None = None,
    schema_table: Callable[[SparkSession], DataFrame] | None = None,
) -> int | None:
    """Drain ``messages`` into the topic's bronze table and return its row count.

    ``schema`` defaults to the configured payload (for Avro, pass the schema
    text). With ``schemas_by_id`` each message is decoded with the schema its
    header names (for Avro, the texts go in ``avro_schemas_by_id``). ``schema_table`` opens a table
    of schemas by id instead (see :mod:`tidemill.sources.schema_table`); it is asked anew for each
    micro-batch, so ids that appear while the query runs are known when their messages
    come. With
    ``on_error="quarantine"`` messages that do not decode go to the quarantine
    table instead of failing the run, also those with a schema id that is not listed; one query
    reads the topic, parses each payload once and writes both tables of a batch.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    if schema_table and (schemas_by_id or codec == "avro"):
        raise ValueError("a schema table has JSON schemas and stands in for schemas_by_id")

    def known(session: SparkSession) -> dict[int, StructType] | None:
        return known_schemas(schema_table(session), config.schema_subject) if schema_table else schemas_by_id

    def judge(batch: DataFrame) -> Judged:
        return judge_messages(
            batch,
            config.payload_schema if codec == "avro" or schema is None else schema,
            config.dedup_keys[0],
            codec,
            schema if codec == "avro" else None,
            known(batch.sparkSession),
            avro_schemas_by_id,
        )

    def decode(batch: DataFrame) -> DataFrame:
        by_id = known(batch.sparkSession)
        if by_id:
            return decode_by_schema_id(batch, by_id, codec, avro_schemas_by_id)
        return decode_messages(batch, schema or config.payload_schema, codec)

    def parts(judged: Judged) -> dict[str, Callable[[DataFrame], DataFrame]]:
        return {config.bronze_table: judged.accepted, config.quarantine_table: judged.rejected}

    def judge_late(batch: DataFrame) -> tuple[DataFrame, dict]:
        judged = judge(batch)
        return judged.rows, parts(judged)

    place = (config.bronze_checkpoint, config.table_format, ledger)
    if on_error == "quarantine" and schema_table:
        query = split_stream(messages, judge_late, *place)
    elif on_error == "quarantine":
        # Decoded in the streaming plan, so that rejects are counted in the query's progress.
        judged = judge(messages)
        query = split_stream(judged.rows, lambda batch: (batch, parts(judged)), *place)
    elif schema_table:
        query = append_stream(messages, config.bronze_table, *place, prepare=decode)
    else:
        query = append_stream(decode(messages), config.bronze_table, *place)
    query.awaitTermination()
    if config.table_format != "delta" and not is_location(config.bronze_table):
        # A table of the catalog is there after the first run, even if no message came.
        ensure_append_table(spark, config.bronze_table, config.bronze_schema)
    if not report_counts:
        return None
    total = count_rows(spark, config.bronze_table, config.table_format, config.bronze_schema)
    return announce(config.bronze_table, total)


def ingest_bronze_from_kafka(
    spark: SparkSession,
    config: TopicConfig,
    creds: dict[str, str],
    avro_schema: str,
    shaded_prefix: str = "",
    report_counts: bool = True,
    **limits: int,
) -> int | None:
    """Drain the Kafka topic of a config; ``creds`` has bootstrap_servers, username, password.

    Needs the Kafka and Avro packages; ``avro_schema`` is the topic's latest
    schema text (see :func:`tidemill.sources.latest_schema`).
    """
    jaas = jaas_config(creds["username"], creds["password"], shaded_prefix)
    messages = read_topic_stream(
        spark, creds["bootstrap_servers"], jaas, config.kafka_topic, **limits
    )
    return ingest_bronze(
        spark, config, messages, avro_schema, codec="avro", report_counts=report_counts
    )
