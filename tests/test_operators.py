from __future__ import annotations

import re

import pytest
from helpers import activity, messages, millis, raw_messages
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill import GoldJob
from tidemill.functions import utc_wall_clock
from tidemill.operators import (
    RULES,
    decode_by_schema_id,
    decode_messages,
    first_per_key,
    frame_header,
    rows_to_insert,
    rule_violations,
    split_decodable,
    windowed_aggregate,
)
from tidemill.topics import USER_ACTIVITY


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- decoding ----------------------------------------------------------------


def test_decode_carries_the_source_position(spark):
    events = activity(spark, [("a", "payment", "00:05", 1.5), ("b", "login", "00:06", None)])
    rows = decode_messages(messages(spark, events), USER_ACTIVITY.payload_schema)
    assert rows.columns == USER_ACTIVITY.bronze_schema.names
    got = rows.orderBy("offset").collect()
    assert [(r.event_id, r.amount, r.partition, r.offset) for r in got] == [
        ("a", 1.5, 0, 0),
        ("b", None, 0, 1),
    ]
    assert all(r.ingested_at is not None and r.kafka_timestamp is not None for r in got)


def test_decode_parses_each_payload_once(spark):
    events = activity(spark, [("a", "payment", "00:05", 1.5)])
    rows = decode_messages(messages(spark, events), USER_ACTIVITY.payload_schema)
    assert plan(rows).count("from_json(") == 1


def test_tombstone_decodes_to_nulls_and_garbage_fails(spark):
    schema = USER_ACTIVITY.payload_schema
    row = decode_messages(raw_messages(spark, [None]), schema).first()
    assert row.event_id is None and row.timestamp_ms is None and row.offset == 0
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        decode_messages(raw_messages(spark, [b"\x00\x00\x00\x00\x07garbage"]), schema).collect()


def test_decode_by_schema_id(spark):
    full = USER_ACTIVITY.payload_schema
    old = StructType([f for f in full.fields if f.name != "device_type"])
    events = activity(spark, [("a", "payment", "00:05", 1.5)])
    both = messages(spark, events, schema_id=1).unionByName(
        messages(spark, events, schema_id=2, first_offset=1)
    )
    both = both.unionByName(raw_messages(spark, [None]).withColumn("offset", F.lit(2)))
    rows = decode_by_schema_id(both, {1: old, 2: full}).orderBy("offset").collect()
    assert [(r.event_id, r.device_type) for r in rows] == [
        ("a", None),
        ("a", "mobile"),
        (None, None),
    ]
    with pytest.raises(Exception, match="no schema for id 2"):
        decode_by_schema_id(both, {1: old}).collect()


def test_schemas_must_agree_on_types(spark):
    with pytest.raises(ValueError, match="changes type"):
        decode_by_schema_id(
            raw_messages(spark, [None]),
            {1: StructType().add("a", "string"), 2: StructType().add("a", "long")},
        )


def test_split_decodable(spark):
    good = messages(spark, activity(spark, [("a", "payment", "00:05", 1.5)])).first()["value"]
    values = [
        bytes(good),
        bytes(good)[:-3],
        b"\x01" + bytes(good)[1:],
        b"\x00\x00",
        b'\x00\x00\x00\x00\x07{"user_id": "u"}',
        b"\x00\x00\x00\x00\x07",
        None,
    ]
    accepted, rejected = split_decodable(raw_messages(spark, values), USER_ACTIVITY.payload_schema)
    assert accepted.columns == USER_ACTIVITY.bronze_schema.names
    assert sorted((r.offset, r.event_id) for r in accepted.collect()) == [(0, "a"), (6, None)]
    assert {r.offset: (r.reason, r.schema_id) for r in rejected.collect()} == {
        1: ("malformed_payload", 7),
        2: ("bad_header", None),
        3: ("bad_header", None),
        4: ("missing_key", 7),
        5: ("missing_key", 7),
    }
    assert plan(accepted).count("from_json(") == plan(rejected).count("from_json(") == 1
    kept = rejected.filter("offset = 1").first()
    assert bytes(kept.value) == values[1]


def test_frame_header(spark):
    rows = frame_header(raw_messages(spark, [bytes.fromhex("0000000007AABB"), b"\x00\x01", None]))
    assert [(r.magic, r.framed, r.schema_id) for r in rows.orderBy("offset").collect()] == [
        ("00", True, 7),
        ("00", False, None),
        (None, None, None),
    ]


# --- deduplication and merge -------------------------------------------------


def test_first_per_key_takes_the_earliest_and_groups_nulls(spark):
    rows = spark.createDataFrame(
        [
            ("a", 1, 5, "late"),
            ("a", 0, 9, "first"),
            ("b", 0, 1, None),
            (None, 0, 2, "n1"),
            (None, 0, 3, "n2"),
        ],
        "k STRING, partition INT, offset BIGINT, v STRING",
    )
    got = {(r.k, r.partition, r.offset, r.v) for r in first_per_key(rows, ["k"]).collect()}
    assert got == {("a", 0, 9, "first"), ("b", 0, 1, None), (None, 0, 2, "n1")}


def test_first_per_key_breaks_ties_by_value(spark):
    rows = spark.createDataFrame(
        [("a", 0, 1, "z"), ("a", 0, 1, "y"), ("a", 0, 1, None)],
        "k STRING, partition INT, offset BIGINT, v STRING",
    )
    for shuffled in (rows, rows.orderBy(F.desc("v")), rows.repartition(3)):
        assert [r.v for r in first_per_key(shuffled, ["k"]).collect()] == [None]


def test_first_per_key_on_several_keys_keeps_column_order(spark):
    rows = spark.range(100).select(
        (F.col("id") % 3).alias("v"),
        (F.col("id") % 5).alias("k1"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        (F.col("id") % 2).alias("k2"),
    )
    got = first_per_key(rows, ["k1", "k2"])
    assert got.columns == rows.columns
    assert sorted(r.offset for r in got.collect()) == list(range(10))


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    """A key with a third of the rows sends at most one row per task."""
    rows = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
    )
    got = first_per_key(rows, ["k"])
    assert got.count() == 20_001
    text = plan(got)
    assert "partial_min" in text[text.index("Exchange") :]
    assert "Window" not in text


def test_rows_to_insert(spark):
    target = spark.createDataFrame([("a",), (None,)], "k STRING")
    batch = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k STRING, v INT")
    got = rows_to_insert(batch, batch, target, ["k"]).collect()
    assert {(r.k, r.v) for r in got} == {("b", 2), (None, 3)}


def test_rows_to_insert_with_a_null_in_one_of_two_keys(spark):
    ddl = "k1 STRING, k2 STRING"
    target = spark.createDataFrame([("a", "x"), ("b", None)], ddl)
    batch = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None)], ddl)
    got = rows_to_insert(batch, batch, target, ["k1", "k2"]).collect()
    assert {tuple(r) for r in got} == {("a", "y"), ("b", None)}


@pytest.mark.parametrize("broadcast", [True, False])
def test_merge_reads_only_key_columns_of_the_target(spark, tmp_path, broadcast):
    path = str(tmp_path / "target")
    spark.range(1000).select(
        F.col("id").cast("string").alias("k"), F.lit("payload").alias("v")
    ).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB" if broadcast else "-1")
    try:
        batch = spark.range(990, 1010).select(
            F.col("id").cast("string").alias("k"), F.lit("new").alias("v")
        )
        new = rows_to_insert(batch, batch, spark.read.parquet(path), ["k"])
        assert new.count() == 10
        text = plan(new)
        assert "ReadSchema: struct<k:string>" in text
        if broadcast:
            # The scan of the target meets the batch without being shuffled.
            semi = text[text.index("LeftSemi") :]
            assert "BroadcastExchange" in semi
            scan = next(i for i, l in enumerate(semi.splitlines()) if "FileScan" in l)
            assert not any("Exchange hash" in l for l in semi.splitlines()[:scan])
        else:
            # Which join it is, is left to Spark.
            assert "LeftSemi" in text and "Exchange hashpartitioning" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# --- windows -----------------------------------------------------------------


def windows(df):
    df = utc_wall_clock(df, "window_start", "window_end")
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_batch_windows_with_filter_and_nulls(spark):
    events = activity(
        spark,
        [
            ("a", "payment", "00:05", 1.5),
            ("b", "payment", "00:59:59", None),
            ("c", "payment", "01:00", None),
            ("d", "login", "00:10", None),
        ],
    )
    assert windows(windowed_aggregate(events, USER_ACTIVITY.job("revenue_hourly"))) == [
        ("2024-01-01 00:00:00", "2024-01-01 01:00:00", "1.5", "2"),
        ("2024-01-01 01:00:00", "2024-01-01 02:00:00", "None", "1"),
    ]


def test_scope_all_gives_the_same_batch_result(spark):
    events = activity(
        spark,
        [(str(i), ["payment", "login", "search"][i % 3], f"0{i % 4}:0{i % 6}", i / 4) for i in range(60)],
    )
    job = GoldJob(
        "j",
        {"n": "count(*)", "total": "sum(amount)", "mean": "sum(amount) / count(*)"},
        group_by=("event_type", "device_type"),
        filter="event_type <> 'search' AND amount > 2",
    )
    matching = windows(windowed_aggregate(events, job))
    assert len(matching) == 8
    assert windows(windowed_aggregate(events, job, watermark_scope="all")) == matching
    with pytest.raises(ValueError, match="watermark_scope"):
        windowed_aggregate(events, job, watermark_scope="some")


def test_window_starts_at_the_epoch_whatever_the_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        events = activity(spark, [("a", "login", "00:05", None)])
        result = windowed_aggregate(events, USER_ACTIVITY.job("funnel_metrics_hourly"))
        assert windows(result) == [("2024-01-01 00:00:00", "2024-01-01 01:00:00", "login", "1")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_aggregation_reads_only_what_it_needs_and_combines_first(spark, tmp_path):
    path = str(tmp_path / "silver")
    activity(spark, [("a", "payment", "00:05", 1.5)]).write.parquet(path)
    result = windowed_aggregate(spark.read.parquet(path), USER_ACTIVITY.job("revenue_hourly"))
    text = plan(result)
    assert re.search(r"ReadSchema: struct<event_type:string,amount:double,timestamp_ms:bigint>", text)
    assert "EqualTo(event_type,payment)" in text
    assert "partial_sum" in text and "partial_count" in text
    assert text.count("Exchange") == 1
    assert "Expand" not in text


# --- quality -----------------------------------------------------------------


def test_rule_violations(spark):
    events = activity(
        spark,
        [("a", "payment", "00:05", 1.5), ("b", "payment", "00:06", None), ("c", "login", "00:07", 2.0)],
    )
    report = rule_violations(events, "user_activity", RULES["user_activity"]).collect()
    assert {(r.rule, r.rows_checked, r.violations) for r in report} == {
        ("product_id null iff search", 3, 3),
        ("search_query set iff search", 3, 0),
        ("amount set iff payment", 3, 2),
    }


def test_millis_helper():
    assert millis("00:00") == 1704067200000


def test_first_per_key_with_columns_that_have_no_order(spark):
    rows = spark.sql(
        "SELECT 'k' AS event_id, map('a', 1) AS tags, 0 AS partition, 5L AS offset"
        " UNION ALL SELECT 'k', map('b', 2), 0, 3L"
        " UNION ALL SELECT 'k', map('b', 2), 0, 3L"
    )
    kept = first_per_key(rows, ["event_id"]).collect()
    assert [(r.tags, r.offset) for r in kept] == [({"b": 2}, 3)]
