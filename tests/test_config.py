from __future__ import annotations

from dataclasses import replace

import pytest

from tidemill import ConfigError, GoldJob, TOPICS, TopicConfig, topic_from_mapping, topics_at
from tidemill.config import is_location
from tidemill.plans.pipeline import with_fresh_checkpoints
from tidemill.topics import USER_ACTIVITY, topics_in_catalog


def test_registry_has_three_topics_with_two_jobs_each():
    assert list(TOPICS) == ["user_activity", "product_events", "order_events"]
    assert [len(t.gold_jobs) for t in TOPICS.values()] == [2, 2, 2]
    assert [t.topic_partitions for t in TOPICS.values()] == [3, 2, 2]


def test_silver_columns_follow_the_payload():
    assert USER_ACTIVITY.silver_columns[-2:] == ("kafka_timestamp", "ingested_at")
    assert USER_ACTIVITY.silver_schema.names == [
        *USER_ACTIVITY.payload_schema.names,
        "kafka_timestamp",
        "ingested_at",
        "processed_timestamp",
    ]
    assert USER_ACTIVITY.bronze_schema.names[-4:] == [
        "partition",
        "offset",
        "kafka_timestamp",
        "ingested_at",
    ]


@pytest.mark.parametrize(
    "change",
    [
        {"dedup_keys": ()},
        {"dedup_keys": ("nope",)},
        {"silver_columns": ("event_id", "nope", "timestamp_ms")},
        {"silver_columns": ("event_id", "event_type")},
        {"message_key": "nope"},
        {"table_format": "csv"},
        {"bronze_table": "/x/same", "silver_table": "/x/same"},
        {"bronze_checkpoint": "/x/same", "silver_checkpoint": "/x/same"},
        {"gold_jobs": (GoldJob("a", {"n": "count(*)"}), GoldJob("a", {"n": "count(*)"}))},
        {"gold_jobs": (GoldJob("a", {"n": "count(*)"}, group_by=("nope",)),)},
    ],
)
def test_bad_topics_are_refused(change):
    with pytest.raises(ConfigError):
        replace(USER_ACTIVITY, **change)


@pytest.mark.parametrize(
    "arguments",
    [
        {"aggs": {}},
        {"aggs": {"event_type": "count(*)"}, "group_by": ("event_type",)},
        {"aggs": {"window_start": "count(*)"}},
        {"aggs": {"n": "count(*)"}, "group_by": ("a", "a")},
    ],
)
def test_bad_jobs_are_refused(arguments):
    with pytest.raises(ConfigError):
        GoldJob("job", **arguments)


def test_placement():
    topics = topics_at("/lake/")
    config = topics["order_events"]
    assert config.bronze_table == "/lake/bronze/order_events"
    assert config.job("order_revenue_hourly").table == "/lake/gold/order_revenue_hourly"
    places = [
        place
        for t in topics.values()
        for place in (t.bronze_checkpoint, t.silver_checkpoint, *(j.checkpoint for j in t.gold_jobs))
    ]
    assert len(set(places)) == 12
    named = topics_in_catalog("main.shop", "/marks", "delta")["order_events"]
    assert named.silver_table == "main.shop.silver_order_events"
    assert not is_location(named.silver_table)
    with pytest.raises(KeyError):
        config.job("nope")


def test_topic_from_mapping():
    entry = {
        "kafka_topic": "clicks",
        "schema_subject": "clicks-value",
        "bronze_table": "db.bronze_clicks",
        "silver_table": "db.silver_clicks",
        "dedup_keys": ["event_id"],
        "bronze_checkpoint": "/marks/b",
        "silver_checkpoint": "/marks/s",
        "silver_columns": ["event_id", "event_type", "timestamp_ms", "kafka_timestamp"],
        "gold_jobs": [
            {
                "name": "hourly",
                "gold_table": "db.gold_hourly",
                "checkpoint": "/marks/g",
                "filter": "event_type = 'x'",
                "group_by": [],
                "aggs": {"n": "count(*)"},
            }
        ],
    }
    config = topic_from_mapping("clicks", entry, USER_ACTIVITY.payload_schema, "user_id")
    assert isinstance(config, TopicConfig)
    assert config.job("hourly").filter == "event_type = 'x'"
    assert config.job("hourly").output_columns == ["window_start", "window_end", "n"]
    assert config.silver_schema.names[-1] == "processed_timestamp"


def test_fresh_checkpoints_move_append_only_tables_but_not_silver():
    config = USER_ACTIVITY.at("/lake")
    moved = with_fresh_checkpoints(config)
    assert moved.silver_table == config.silver_table
    assert moved.silver_checkpoint != config.silver_checkpoint
    assert moved.bronze_table != config.bronze_table
    assert all(
        a.table != b.table and a.checkpoint != b.checkpoint
        for a, b in zip(moved.gold_jobs, config.gold_jobs, strict=True)
    )
    delta = with_fresh_checkpoints(replace(config, table_format="delta"))
    assert delta.bronze_table == config.bronze_table
    assert delta.bronze_checkpoint != config.bronze_checkpoint
