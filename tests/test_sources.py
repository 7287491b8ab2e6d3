from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemill.operators import RULES, rule_violations
from tidemill.sources import (
    SchemaNotFound,
    jaas_config,
    kafka_options,
    kafka_sink_options,
    latest_schema,
    schemas_by_id,
)
from tidemill.sources.sample_topics import batch_events, delivered_twice
from tidemill.topics import TOPICS
from tidemill.workspace import new_run_folder, shared_folder
from tidemill import contracts

TABLES = "/root/testdata/sf0.001"


def test_kafka_options():
    jaas = jaas_config("me", 'pa"ss\\word')
    assert jaas == (
        "org.apache.kafka.common.security.scram.ScramLoginModule required "
        'username="me" password="pa\\"ss\\\\word";'
    )
    assert jaas_config("a", "b", "shaded.").startswith("shaded.org.apache.kafka")
    assert kafka_options("host:9092", "orders", jaas, 1000, 64) == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "orders",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "SCRAM-SHA-256",
        "kafka.sasl.jaas.config": jaas,
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "64",
    }
    assert "kafka.security.protocol" not in kafka_options("host:9092", "orders")
    assert kafka_sink_options("host:9092", jaas) == {
        "kafka.bootstrap.servers": "host:9092",
        "kafka.acks": "all",
        "kafka.compression.type": "lz4",
        "kafka.linger.ms": "5",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "SCRAM-SHA-256",
        "kafka.sasl.jaas.config": jaas,
    }


def test_schema_table(spark):
    table = spark.createDataFrame(
        [("s", 1, 10, "a STRING"), ("s", 2, 12, "a STRING, b INT"), ("t", 5, 11, "z INT")],
        "subject STRING, version INT, schema_id INT, schema STRING",
    )
    assert latest_schema(table, "s") == "a STRING, b INT"
    assert {i: s.names for i, s in schemas_by_id(table, "s").items()} == {10: ["a"], 12: ["a", "b"]}
    for lookup in (latest_schema, schemas_by_id):
        with pytest.raises(SchemaNotFound):
            lookup(table, "nope")


@pytest.mark.parametrize("topic", list(TOPICS))
def test_sample_topics_follow_their_contract(spark, topic):
    events = batch_events(spark, TABLES, topic)
    config = TOPICS[topic]
    assert events.select(*config.payload_schema.names).schema.simpleString() == (
        config.payload_schema.simpleString()
    )
    assert {r.violations for r in rule_violations(events, topic, RULES[topic]).collect()} == {0}
    types = {r.event_type for r in events.select("event_type").distinct().collect()}
    expected = {
        "user_activity": contracts.USER_ACTIVITY_TYPES,
        "product_events": contracts.PRODUCT_EVENT_TYPES,
        "order_events": contracts.ORDER_EVENT_TYPES,
    }[topic]
    assert types == set(expected)
    positions = events.filter(
        (F.col("source_partition") < 0) | (F.col("source_partition") >= config.topic_partitions)
    )
    assert positions.count() == 0
    assert "Exchange" not in events._jdf.queryExecution().executedPlan().toString()


def test_delivered_twice(spark):
    events = batch_events(spark, TABLES, "order_events")
    twice = delivered_twice(events)
    assert twice.count() == 2 * events.count()
    assert twice.select("source_offset").distinct().count() == 2 * events.count()


def test_run_folders_are_in_the_shared_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == configured
    folders = {new_run_folder(spark, "x") for _ in range(3)}
    assert len(folders) == 3 and all(f.startswith(configured) for f in folders)
