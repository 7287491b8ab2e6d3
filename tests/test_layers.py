"""Bronze, silver and the whole chain, on locations and in the catalog."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest
from helpers import activity, messages, millis, raw_messages
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill import (
    ConfigError,
    clean_silver,
    ingest_bronze,
    run_all_gold_jobs,
    run_layer,
    run_pipeline,
    topics_at,
    with_fresh_checkpoints,
)
from tidemill.functions import decode_payload
from tidemill.operators import (
    encode_messages,
    merge_with_delta,
    rows_to_insert,
    split_decodable,
)
from tidemill.operators.decode import DECODE_METRICS
from tidemill.sources import append_messages, scan_table, stream_table, stream_topic_files
from tidemill.sources.sample_topics import as_messages, batch_events
from tidemill.sources.tables import read_manifest, with_batch_fields
from tidemill.streaming import (
    InsertOnlyMerge,
    RunLedger,
    append_stream,
    compact,
    ensure_silver_table,
    read_ledger,
    remove_replaced,
)
from tidemill.streaming.silver import silver_merge, upsert_batch
from tidemill.streaming.sinks import publish, settings
from tidemill.topics import TOPICS, USER_ACTIVITY


@pytest.fixture(params=["location", "plain location", "catalog", "bucketed"])
def config(request, root, database):
    buckets = {"location": 5, "bucketed": 3}.get(request.param, 0)
    if request.param.endswith("location"):
        return replace(USER_ACTIVITY.at(root), silver_buckets=buckets)
    return replace(USER_ACTIVITY.in_catalog(database, f"{root}/marks"), silver_buckets=buckets)


def silver(spark, config):
    return scan_table(
        spark, config.silver_table, schema=with_batch_fields(config.silver_schema)
    )


def deliver(spark, root, config, batch):
    append_messages(batch, f"{root}/topic")
    return ingest_bronze(spark, config, stream_topic_files(spark, f"{root}/topic"))


def test_redelivery_across_runs(spark, root, config):
    first = activity(spark, [("a", "payment", "00:05", 1.0), ("b", "login", "00:06", None)])
    second = activity(spark, [("b", "payment", "00:06", 9.0), ("c", "payment", "00:07", 3.0)])
    assert deliver(spark, root, config, messages(spark, first)) == 2
    assert clean_silver(spark, config) == 2
    assert deliver(spark, root, config, messages(spark, second, first_offset=2)) == 4
    assert clean_silver(spark, config) == 3
    assert clean_silver(spark, config) == 3
    got = {(r.event_id, r.amount) for r in silver(spark, config).collect()}
    assert got == {("a", 1.0), ("b", None), ("c", 3.0)}
    assert run_all_gold_jobs(spark, config) == {"funnel_metrics_hourly": 0, "revenue_hourly": 0}
    late = activity(spark, [("d", "payment", "04:00", 1.0)])
    deliver(spark, root, config, messages(spark, late, first_offset=4))
    clean_silver(spark, config)
    counts = run_all_gold_jobs(spark, config, concurrent=True)
    assert counts == {"funnel_metrics_hourly": 2, "revenue_hourly": 1}
    revenue = scan_table(spark, config.job("revenue_hourly").table).first()
    assert (revenue.total_revenue, revenue.payment_count) == (4.0, 2)


def bronze_rows(spark, rows):
    """Bronze rows from (event_id, amount); the amount doubles as the offset."""
    events = activity(spark, [(i, "payment", "00:05", a) for i, a in rows])
    return events.withColumns(
        {
            "partition": F.lit(0),
            "offset": F.col("amount").cast("bigint"),
            "kafka_timestamp": F.current_timestamp(),
            "ingested_at": F.current_timestamp(),
        }
    )


BATCH_0 = [("a", 1.0), ("a", 2.0), ("b", 3.0), (None, 4.0), (None, 5.0)]
BATCH_1 = [("b", 30.0), ("c", 6.0), (None, 7.0)]
EXPECTED = [("None", 4.0), ("None", 7.0), ("a", 1.0), ("b", 3.0), ("c", 6.0)]


def merged(spark, config):
    return sorted((str(r.event_id), r.amount) for r in silver(spark, config).collect())


def test_insert_only_merge_and_replay(spark, config):
    ensure_silver_table(spark, config)
    merge = silver_merge(config)
    upsert_batch(merge, config, bronze_rows(spark, BATCH_0), "run", 0)
    upsert_batch(merge, config, bronze_rows(spark, BATCH_1), "run", 1)
    assert merged(spark, config) == EXPECTED
    assert merge.inserted == {0: 3, 1: 2}
    files = sorted(silver(spark, config).inputFiles())
    upsert_batch(silver_merge(config), config, bronze_rows(spark, BATCH_1), "run", 1)
    upsert_batch(silver_merge(config), config, bronze_rows(spark, BATCH_0), "run", 0)
    assert merged(spark, config) == EXPECTED
    assert sorted(silver(spark, config).inputFiles()) == files
    # A new checkpoint numbers its batches from zero again, under another run id.
    upsert_batch(merge, config, bronze_rows(spark, BATCH_0), "later-run", 0)
    assert merged(spark, config) == sorted([*EXPECTED, ("None", 4.0)])


def location_of(spark, config):
    return spark.table(silver_merge(config).name).inputFiles()[0].split("/run_id=")[0].removeprefix("file:")


def leave_behind(spark, config, run_id, batch_id):
    """What a merge that was killed while it wrote leaves in the table's folder; how many files."""
    place = f"{location_of(spark, config)}/.spark-staging-killed/run_id={run_id}/batch_id={batch_id}"
    stray = silver(spark, config).drop("run_id", "batch_id").filter("event_id = 'a'")
    stray.withColumn("event_id", F.lit("c")).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(place)
    return len([f for f in os.listdir(place) if f.endswith(".parquet")])


def test_unfinished_batch_is_redone(spark, config):
    """Files of a write that never published its batch are read by nobody, and it is done again."""
    ensure_silver_table(spark, config)
    merge = silver_merge(config)
    upsert_batch(merge, config, bronze_rows(spark, BATCH_0), "run", 0)
    assert leave_behind(spark, config, "run", 1)
    assert len(merged(spark, config)) == 3
    run_all_gold_jobs(spark, config)
    upsert_batch(merge, config, bronze_rows(spark, BATCH_1), "run", 1)
    assert merged(spark, config) == EXPECTED
    later = bronze_rows(spark, [("d", 9.0)]).withColumn("timestamp_ms", F.lit(millis("09:00")))
    upsert_batch(merge, config, later, "run", 2)
    run_all_gold_jobs(spark, config)
    revenue = scan_table(spark, config.job("revenue_hourly").table).first()
    assert (revenue.total_revenue, revenue.payment_count) == (21.0, 5)


def test_published_batch_that_was_not_registered(spark, config):
    """Killed between the rename and the entry in the catalog: the next run enters it and leaves it as it is."""
    ensure_silver_table(spark, config)
    merge = silver_merge(config)
    upsert_batch(merge, config, bronze_rows(spark, BATCH_0), "run", 0)
    upsert_batch(merge, config, bronze_rows(spark, BATCH_1), "run", 1)
    files = sorted(silver(spark, config).inputFiles())
    spark.sql(f"ALTER TABLE {merge.name} DROP PARTITION (run_id='run', batch_id=1)")
    if location_of(spark, config) and not os.path.exists(f"{location_of(spark, config)}/run_id=run/batch_id=1"):
        pytest.skip("a managed table loses the files with the partition")
    ensure_silver_table(spark, config)
    upsert_batch(merge, config, bronze_rows(spark, BATCH_1), "run", 1)
    assert merged(spark, config) == EXPECTED
    assert sorted(silver(spark, config).inputFiles()) == files


def test_another_number_of_buckets_is_refused(spark, root):
    config = USER_ACTIVITY.at(root)
    ensure_silver_table(spark, config)
    ensure_silver_table(spark, config)
    with pytest.raises(ConfigError, match="bucket layout"):
        ensure_silver_table(spark, replace(config, silver_buckets=7))


def test_second_merge_leaves_the_target_where_it_is(spark, root):
    """The default layout of a location: no exchange between the target's files and the join."""
    config = USER_ACTIVITY.at(root)
    ensure_silver_table(spark, config)
    merge = silver_merge(config)
    upsert_batch(merge, config, bronze_rows(spark, BATCH_0), "run", 0)
    batch = bronze_rows(spark, BATCH_1)
    with settings(spark, {**merge._settings(), "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        new = rows_to_insert(batch, batch, scan_table(spark, merge.name), ["event_id"])
        assert new.count() == 2
        new.collect()
        text = new._jdf.queryExecution().executedPlan().toString()
    semi = text[text.index("LeftSemi") :].splitlines()
    scan = next(i for i, line in enumerate(semi) if "FileScan" in line)
    assert "SelectedBucketsCount: 16 out of 16" in semi[scan]
    assert not any("Exchange" in line for line in semi[:scan])


@pytest.mark.parametrize("named", [False, True])
def test_appended_tables_have_no_log_and_replays_write_nothing(spark, root, database, named):
    config = USER_ACTIVITY.in_catalog(database, f"{root}/marks") if named else USER_ACTIVITY.at(root)
    events = activity(spark, [("a", "payment", "00:05", 1.0), ("b", "login", "04:06", None)])
    deliver(spark, root, config, messages(spark, events))
    bronze = scan_table(spark, config.bronze_table, schema=with_batch_fields(config.bronze_schema))
    (where,) = {(r.run_id, r.batch_id) for r in bronze.collect()}
    files = bronze.inputFiles()
    assert not any("_spark_metadata" in folder for folder, *_ in os.walk(root))
    assert publish(bronze.drop("run_id", "batch_id"), config.bronze_table, *where) == 2
    assert scan_table(spark, config.bronze_table, schema=config.bronze_schema).inputFiles() == files


def test_crash_between_publishing_and_the_checkpoint(spark, root, monkeypatch):
    """Bronze and quarantine of a batch: the replay writes only what is not there."""
    config = USER_ACTIVITY.at(root)
    good = bytes(messages(spark, activity(spark, [("a", "login", "00:05", None)])).first()["value"])
    append_messages(raw_messages(spark, [good, good[:-2], None]), f"{root}/topic")
    stream = stream_topic_files(spark, f"{root}/topic")

    def dies_at_quarantine(rows, table, *where):
        return 1 / 0 if table == config.quarantine_table else publish(rows, table, *where)

    with monkeypatch.context() as patch:
        patch.setattr("tidemill.streaming.sinks.publish", dies_at_quarantine)
        with pytest.raises(Exception, match="division by zero"):
            ingest_bronze(spark, config, stream, on_error="quarantine")
    files = scan_table(spark, config.bronze_table).inputFiles()
    assert ingest_bronze(spark, config, stream, on_error="quarantine") == 2
    assert scan_table(spark, config.bronze_table).inputFiles() == files
    assert scan_table(spark, config.quarantine_table).count() == 1
    assert len([m for m in os.listdir(f"{root}/checkpoints") if "quarantine" in m]) == 0


def test_ledger(spark, root):
    config = USER_ACTIVITY.at(root)
    good = bytes(messages(spark, activity(spark, [("a", "payment", "00:05", 1.0)])).first()["value"])
    append_messages(raw_messages(spark, [good, good[:-2], good]), f"{root}/topic")
    with RunLedger(spark, f"{root}/ledger") as ledger:
        stream = stream_topic_files(spark, f"{root}/topic")
        ingest_bronze(spark, config, stream, on_error="quarantine", ledger=ledger)
        clean_silver(spark, config, ledger=ledger)
        run_all_gold_jobs(spark, config, ledger=ledger)
        for clock, offset in (("09:00", 5), ("01:00", 6)):
            deliver(spark, root, config, messages(spark, activity(spark, [(clock, "payment", clock, 1.0)]), first_offset=offset))
            clean_silver(spark, config)
            run_all_gold_jobs(spark, config, ledger=ledger)
    rows = {(r.table_name, r.batch_id): r for r in read_ledger(spark, f"{root}/ledger").collect()}
    bronze, rejects, inserted = (rows[t, 0] for t in (config.bronze_table, config.quarantine_table, config.silver_table))
    assert (bronze.written, bronze.input_rows, bronze.rejected) == (2, 3, 1)
    assert (rejects.written, rejects.rejected) == (1, 1)
    assert (inserted.written, inserted.input_rows) == (1, 2)
    revenue = [r for (table, _), r in rows.items() if table == config.job("revenue_hourly").table]
    assert sum(r.late_dropped for r in revenue) == 1
    assert sum(r.written for r in revenue) == scan_table(spark, config.job("revenue_hourly").table).count()


def test_compaction(spark, root):
    """Batches turn into one file at once, streams on the table see nothing of it, and what was replaced can go."""
    table = f"{root}/table"
    schema = StructType().add("n", "long")
    for batch in range(4):
        publish(spark.range(3 * batch, 3 * batch + 3).toDF("n").repartition(3), table, "run", batch)
    rows = lambda: sorted(r.n for r in scan_table(spark, table, schema=schema).collect())
    before = scan_table(spark, table, schema=schema)
    assert compact(spark, table, schema) == 4 and compact(spark, table, schema) == 0
    assert rows() == list(range(12)) and len(scan_table(spark, table, schema=schema).inputFiles()) == 1
    assert before.count() == 12  # a reader that began earlier
    publish(spark.range(12, 14).toDF("n"), table, "run", 4)
    assert rows() == list(range(14))
    assert compact(spark, table, schema) == 1  # the small part is taken along
    with_batches = scan_table(spark, table, schema=with_batch_fields(schema))
    assert {(r.run_id, r.batch_id) for r in with_batches.collect()} == {("run", b) for b in range(5)}
    stream = stream_table(spark, table, schema=schema)
    append_stream(stream, f"{root}/copy", f"{root}/mark").awaitTermination()
    assert scan_table(spark, f"{root}/copy").count() == 14
    assert remove_replaced(spark, table) == 6
    assert rows() == list(range(14)) and scan_table(spark, table).count() == 14
    large = compact(spark, table, schema, target_bytes=1)
    assert large == 0
    publish(spark.range(14, 15).toDF("n"), table, "other", 0)
    assert compact(spark, table, schema, target_bytes=1) == 1
    assert rows() == list(range(15)) and len(read_manifest(spark, table).parts) == 2
    with pytest.raises(ConfigError):
        compact(spark, "catalog_name", schema)


@pytest.mark.parametrize("on_error", ["fail", "quarantine"])
def test_schema_id_that_appears_during_a_run(spark, root, on_error):
    """The second file of a run has an id that the schema table does not have when the run starts."""
    config = USER_ACTIVITY.at(root)
    older = StructType([f for f in config.payload_schema.fields if f.name != "device_type"])
    events = activity(spark, [("a", "login", "00:05", None), ("b", "login", "00:06", None)])
    for n, (ident, schema) in enumerate(((11, older), (12, config.payload_schema))):
        one = replace(config, payload_schema=schema, silver_columns=("event_id", "timestamp_ms"), gold_jobs=())
        append_messages(messages(spark, events.select(*schema.names), one, ident, 2 * n).coalesce(1), f"{root}/topic")
    known = []

    def schema_table(session):
        ident, schema = ((11, older), (12, config.payload_schema))[len(known)]
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        known.append((config.schema_subject, len(known) + 1, ident, ddl))
        return session.createDataFrame(known, "subject STRING, version INT, schema_id BIGINT, schema STRING")

    stream = stream_topic_files(spark, f"{root}/topic", max_files_per_trigger=1)
    assert ingest_bronze(spark, config, stream, on_error=on_error, schema_table=schema_table) == 4
    bronze = scan_table(spark, config.bronze_table, schema=config.bronze_schema)
    kinds = {(r.offset, r.device_type) for r in bronze.collect()}
    assert kinds == {(0, None), (1, None), (2, "mobile"), (3, "mobile")}


def test_new_columns_reach_an_existing_silver_table(spark, config):
    older = replace(
        config,
        payload_schema=StructType([f for f in config.payload_schema.fields if f.name != "device_type"]),
        silver_columns=tuple(c for c in config.silver_columns if c != "device_type"),
    )
    ensure_silver_table(spark, older)
    upsert_batch(silver_merge(older), older, bronze_rows(spark, BATCH_0).drop("device_type"), "run", 0)
    ensure_silver_table(spark, config)
    upsert_batch(silver_merge(config), config, bronze_rows(spark, BATCH_1), "run", 1)
    assert merged(spark, config) == EXPECTED
    kinds = {(r.batch_id, r.device_type) for r in silver(spark, config).collect()}
    assert kinds == {(0, None), (1, "mobile")}


def test_failing_batch_is_retried_by_the_next_run(spark, root, monkeypatch):
    config = USER_ACTIVITY.at(root)
    events = activity(spark, [("a", "payment", "00:05", 1.0)])
    deliver(spark, root, config, messages(spark, events))
    with monkeypatch.context() as patch:
        patch.setattr(InsertOnlyMerge, "_insert", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="division by zero"):
            clean_silver(spark, config)
    assert clean_silver(spark, config) == 1


@pytest.mark.parametrize("buckets", [3, 6])
def test_bucketed_target_is_not_shuffled(spark, root, database, buckets):
    """Fewer or more buckets than shuffle partitions: only the batch moves, and once."""
    config = replace(USER_ACTIVITY.in_catalog(database, f"{root}/marks"), silver_buckets=buckets)
    ensure_silver_table(spark, config)
    merge = silver_merge(config)
    upsert_batch(merge, config, bronze_rows(spark, BATCH_0), "run", 0)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    no_broadcast = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    bronze_rows(spark, BATCH_1).write.parquet(f"{root}/batch")
    batch = spark.read.parquet(f"{root}/batch")
    with settings(spark, {**merge._settings(), **no_broadcast}):
        new = rows_to_insert(batch, batch, spark.table(config.silver_table), ["event_id"])
        assert new.count() == 2
        new.collect()
        text = new._jdf.queryExecution().executedPlan().toString()
    semi = text[text.index("LeftSemi") :].splitlines()
    scan = next(i for i, line in enumerate(semi) if "FileScan" in line)
    assert f"SelectedBucketsCount: {buckets} out of {buckets}" in semi[scan]
    assert not any("Exchange" in line for line in semi[:scan])
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    upsert_batch(merge, config, bronze_rows(spark, BATCH_1), "run", 1)
    assert merged(spark, config) == EXPECTED


def test_several_micro_batches(spark, root):
    config = USER_ACTIVITY.at(root)
    for n in range(3):
        events = activity(spark, [(f"e{n}", "login", "00:05", None), ("x", "login", "00:05", None)])
        deliver(spark, root, config, messages(spark, events, first_offset=2 * n))
    assert clean_silver(spark, config, max_files_per_trigger=1) == 4
    per_batch = silver(spark, config).groupBy("batch_id").count().collect()
    assert sum(r["count"] for r in per_batch) == 4 and len(per_batch) > 1


def test_quarantine(spark, root):
    config = USER_ACTIVITY.at(root)
    good = bytes(messages(spark, activity(spark, [("a", "login", "00:05", None)])).first()["value"])
    append_messages(raw_messages(spark, [good, good[:-2], None]), f"{root}/topic")
    stream = stream_topic_files(spark, f"{root}/topic")
    assert ingest_bronze(spark, config, stream, on_error="quarantine") == 2
    kept = scan_table(spark, config.quarantine_table).collect()
    assert [(r.offset, r.reason, bytes(r.value)) for r in kept] == [
        (1, "malformed_payload", good[:-2])
    ]
    with pytest.raises(ValueError, match="on_error"):
        ingest_bronze(spark, config, stream, on_error="ignore")


def test_malformed_message_fails_the_run(spark, root):
    config = USER_ACTIVITY.at(root)
    append_messages(raw_messages(spark, [b"\x00\x00\x00\x00\x07garbage"]), f"{root}/topic")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        ingest_bronze(spark, config, stream_topic_files(spark, f"{root}/topic"))


@pytest.mark.parametrize("files", [0, 1])
def test_empty_topic(spark, root, files):
    config = USER_ACTIVITY.at(root)
    os.makedirs(f"{root}/topic")
    if files:
        append_messages(raw_messages(spark, []), f"{root}/topic")
    assert ingest_bronze(spark, config, stream_topic_files(spark, f"{root}/topic")) == 0
    assert clean_silver(spark, config) == 0
    assert run_all_gold_jobs(spark, config) == {"funnel_metrics_hourly": 0, "revenue_hourly": 0}


def test_checkpoint_reset_rebuilds_without_duplicates_in_silver(spark, root):
    config = USER_ACTIVITY.at(root)
    events = activity(spark, [("a", "login", "00:05", None), ("b", "login", "00:05", None)])
    deliver(spark, root, config, messages(spark, events))
    clean_silver(spark, config)
    fresh = with_fresh_checkpoints(config)
    assert ingest_bronze(spark, fresh, stream_topic_files(spark, f"{root}/topic")) == 2
    assert clean_silver(spark, fresh) == 2


@pytest.mark.parametrize("concurrent", [False, True])
def test_pipeline_over_all_topics(spark, root, concurrent):
    topics = topics_at(root)
    rows = {}
    for name in TOPICS:
        batch = as_messages(batch_events(spark, "/root/testdata/sf0.001", name), name)
        append_messages(batch, f"{root}/topic/{name}")
        rows[name] = batch.count()

    def source(config):
        return stream_topic_files(spark, f"{root}/topic/{config.name}")

    counts = run_pipeline(spark, topics, source, concurrent=concurrent)
    assert len(counts) == 12
    assert all(counts[f"bronze.{t}"] == rows[t] for t in TOPICS)
    assert all(0 < counts[f"silver.{t}"] <= rows[t] for t in TOPICS)
    assert all(n > 0 for step, n in counts.items() if step.startswith("gold."))


def test_run_layer_arguments(spark, root):
    topics = topics_at(root)
    with pytest.raises(ValueError, match="message source"):
        run_layer(spark, "bronze", "user_activity", topics)
    with pytest.raises(ValueError, match="unknown layer"):
        run_layer(spark, "platinum", "user_activity", topics)
    with pytest.raises(KeyError):
        run_layer(spark, "silver", "nope", topics)


def test_missing_packages_are_reported(spark, root):
    """Without the Avro and Delta packages their paths fail with a clear error."""
    try:
        import delta  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError):
            merge_with_delta(spark, "t", spark.range(1), ["id"])
    df = spark.createDataFrame([(b"",)], "value BINARY")
    with pytest.raises(Exception, match="AVRO"):
        df.select(decode_payload(F.col("value"), '"string"', "avro")).collect()


@pytest.mark.parametrize(("declared", "expected"), [(None, 7), (3, 3)])
def test_state_partitions_are_declared(spark, root, declared, expected):
    """The first backlog, however small, does not decide them."""
    config = USER_ACTIVITY.at(root)
    jobs = tuple(replace(j, state_partitions=declared) for j in config.gold_jobs)
    config = replace(config, gold_jobs=jobs)
    deliver(spark, root, config, messages(spark, activity(spark, [("a", "login", "00:05", None)])))
    clean_silver(spark, config)
    with settings(spark, {"spark.sql.shuffle.partitions": "7"}):
        assert run_all_gold_jobs(spark, config, concurrent=True)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "7"
    for job in config.gold_jobs:
        stores = os.listdir(f"{job.checkpoint}/state/0")
        assert len([s for s in stores if s.isdigit()]) == expected


def test_rejects_are_counted_in_the_progress(spark, root):
    good = bytes(messages(spark, activity(spark, [("a", "login", "00:05", None)])).first()["value"])
    append_messages(raw_messages(spark, [good, good[:-2], good]), f"{root}/topic")
    stream = stream_topic_files(spark, f"{root}/topic")
    _, rejected = split_decodable(stream, USER_ACTIVITY.payload_schema)
    query = append_stream(rejected, f"{root}/rejected", f"{root}/mark")
    query.awaitTermination()
    metrics = [p.observedMetrics[DECODE_METRICS] for p in query.recentProgress if p.numInputRows]
    assert [(m.messages, m.rejected) for m in metrics] == [(3, 1)]


def test_merge_partitions_are_declared():
    config = USER_ACTIVITY.at("/nowhere")

    def partitions(**changes):
        return silver_merge(replace(config, **changes))._settings().get("spark.sql.shuffle.partitions")

    assert partitions() == "16"  # as many as buckets
    assert partitions(silver_buckets=0) is None  # the session's
    assert partitions(silver_buckets=0, merge_partitions=900) == "900"
    assert partitions(merge_partitions=900, silver_buckets=7) == "7"


def test_late_files_are_not_left_out(spark, root):
    """A file dated long before the newest one counts, in topics and in tables."""
    config = USER_ACTIVITY.at(root)
    first = [(f"a{i}", "login", "00:05", None) for i in range(5)]
    late = [(f"b{i}", "login", "00:05", None) for i in range(5)]
    deliver(spark, root, config, messages(spark, activity(spark, first)))
    before = set(os.listdir(f"{root}/topic"))
    append_messages(messages(spark, activity(spark, late)), f"{root}/topic")
    for name in set(os.listdir(f"{root}/topic")) - before:
        os.utime(f"{root}/topic/{name}", (0, 0))
    assert ingest_bronze(spark, config, stream_topic_files(spark, f"{root}/topic")) == 10


def test_reset_after_a_broken_merge(spark, root):
    """The query that could finish the batch is gone; nobody has to clear what it left."""
    config = USER_ACTIVITY.at(root)
    events = activity(spark, [("a", "payment", "00:05", 1.0), ("b", "payment", "09:00", 1.0)])
    deliver(spark, root, config, messages(spark, events))
    clean_silver(spark, config)
    assert leave_behind(spark, config, "dead", 0)
    fresh = with_fresh_checkpoints(config)
    deliver(spark, root, fresh, messages(spark, activity(spark, [])))
    assert clean_silver(spark, fresh) == 2
    assert run_all_gold_jobs(spark, fresh) == {"funnel_metrics_hourly": 1, "revenue_hourly": 1}
