"""Random micro-batches against plain-Python restatements of the semantics."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from helpers import write_batch
from pyspark.sql import functions as F

from tidemill import GoldJob, TopicConfig, clean_silver, run_gold_aggregation
from tidemill.functions import utc_wall_clock
from tidemill.sources import scan_table, stream_table
from tidemill.sources.tables import with_batch_fields
from tidemill.topics import USER_ACTIVITY

HOUR = 3_600_000
DELAY = 1_800_000
START = 1704067200000


def final_windows(batches, keep):
    """Windows emitted by a drained append-mode query that takes one batch at a time.

    Batch n runs under the watermark set by the batches before it, and windows
    whose end that watermark has reached come out. Rows are late by the
    watermark batch n - 1 ran under.
    """
    open_windows: dict[tuple, int] = defaultdict(int)
    emitted: dict[tuple, int] = {}
    newest = watermark = late_limit = 0
    for batch in [*batches, []]:
        for kind, ms in batch:
            start = ms // HOUR * HOUR
            if keep(kind) and start + HOUR > late_limit:
                open_windows[(start, kind)] += 1
        for key in [k for k in open_windows if k[0] + HOUR <= watermark]:
            emitted[key] = open_windows.pop(key)
        newest = max([newest, *(ms for kind, ms in batch if keep(kind))])
        late_limit, watermark = watermark, max(watermark, newest - DELAY)
    return emitted


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("filtered", [False, True])
def test_windows(spark, root, seed, filtered):
    draw = random.Random(seed)
    batches = []
    for n in range(5):
        center = START + n * 2 * HOUR
        batches.append(
            [
                (draw.choice(["payment", "login"]), center + draw.randint(-4 * HOUR, 3 * HOUR))
                for _ in range(40)
            ]
        )
    job = GoldJob(
        "j",
        {"n": "count(*)"},
        ("event_type",),
        "event_type = 'payment'" if filtered else None,
        f"{root}/gold",
        f"{root}/mark",
    )
    schema = "event_type STRING, timestamp_ms BIGINT"
    for batch in batches:
        write_batch(spark.createDataFrame(batch, schema), f"{root}/silver")
    source = stream_table(
        spark,
        f"{root}/silver",
        schema=spark.createDataFrame([], schema).schema,
        max_files_per_trigger=1,
    )
    run_gold_aggregation(spark, source, job)
    rows = scan_table(spark, job.table).withColumn("ms", F.unix_millis("window_start")).collect()
    got = {(r.ms, r.event_type): r.n for r in rows}
    assert len(got) == len(rows)
    expected = final_windows(batches, lambda kind: not filtered or kind == "payment")
    assert got == expected
    assert expected


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("keys", [("event_id",), ("event_id", "user_id")])
def test_first_write_wins(spark, root, seed, keys):
    """Random duplicates, NULL keys and a hot key over several micro-batches."""
    draw = random.Random(seed)
    config: TopicConfig = TopicConfig(
        name="t",
        kafka_topic="t",
        schema_subject="t-value",
        payload_schema=USER_ACTIVITY.payload_schema,
        message_key="user_id",
        dedup_keys=keys,
    ).at(root)
    names = config.bronze_schema.names
    offset = 0
    batches = []
    for _ in range(4):
        batch = []
        for _ in range(60):
            ident = draw.choice([None, "hot", "hot", *(f"e{i}" for i in range(30))])
            row = dict.fromkeys(names)
            row |= {
                "event_id": ident,
                "user_id": draw.choice(["u1", "u2", None]),
                "amount": float(offset),
                "partition": draw.randint(0, 2),
                "offset": offset,
                "timestamp_ms": START,
            }
            batch.append(row)
            offset += 1
        draw.shuffle(batch)
        batches.append(batch)
        rows = [tuple(r[n] for n in names) for r in batch]
        write_batch(spark.createDataFrame(rows, config.bronze_schema), config.bronze_table)

    expected, present = [], set()
    for batch in batches:
        first = {}
        for row in sorted(batch, key=lambda r: (r["partition"], r["offset"])):
            first.setdefault(tuple(row[k] for k in keys), row)
        for key, row in first.items():
            if None in key or key not in present:
                expected.append(row["amount"])
                present.add(key)
    clean_silver(spark, config, max_files_per_trigger=1)
    silver = scan_table(
        spark, config.silver_table, schema=with_batch_fields(config.silver_schema)
    )
    assert sorted(r.amount for r in silver.select("amount").collect()) == sorted(expected)
    assert silver.select("batch_id").distinct().count() > 1


def test_wall_clock_of_windows_is_utc(spark):
    df = spark.range(1).select(F.timestamp_millis(F.lit(START)).alias("t"))
    assert str(utc_wall_clock(df, "t").first()["t"]) == "2024-01-01 00:00:00"
