"""Kafka as the message source (needs the spark-sql-kafka package)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_LOGIN_MODULE = "org.apache.kafka.common.security.scram.ScramLoginModule"


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace('"', '\\"')
    return f'"{escaped}"'


def jaas_config(username: str, password: str, shaded_prefix: str = "") -> str:
    """SCRAM login line; a runtime with a shaded client needs its prefix."""
    return (
        f"{shaded_prefix}{_LOGIN_MODULE} required "
        f"username={_quoted(username)} password={_quoted(password)};"
    )


def _login_options(jaas: str | None) -> dict[str, str]:
    if not jaas:
        return {}
    return {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "SCRAM-SHA-256",
        "kafka.sasl.jaas.config": jaas,
    }


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    jaas: str | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Source options: whole topic on the first start, aged-out offsets tolerated.

    ``min_partitions`` splits large offset ranges over more tasks than the
    topic has partitions, which also splits a hot topic partition;
    ``max_offsets_per_trigger`` bounds one micro-batch.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    options |= _login_options(jaas)
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_topic_stream(
    spark: SparkSession, bootstrap_servers: str, jaas: str | None, topic: str, **limits: int
) -> DataFrame:
    """Stream one topic with the columns key, value, topic, partition, offset, timestamp, …"""
    options = kafka_options(bootstrap_servers, topic, jaas, **limits)
    return spark.readStream.format("kafka").options(**options).load()


def kafka_sink_options(bootstrap_servers: str, jaas: str | None = None) -> dict[str, str]:
    """Sink options: wait for all replicas, compress and batch a little."""
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "kafka.acks": "all",
        "kafka.compression.type": "lz4",
        "kafka.linger.ms": "5",
        **_login_options(jaas),
    }


def publish_messages(messages: DataFrame, bootstrap_servers: str, jaas: str | None = None) -> None:
    """Write framed messages to the topics they name."""
    options = kafka_sink_options(bootstrap_servers, jaas)
    messages.select("key", "value", "topic").write.format("kafka").options(**options).save()
