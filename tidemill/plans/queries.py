"""The registered queries: each runs an operator or layer over whole tables.

Every query takes a session and the folder of the tables and returns a
DataFrame whose timestamps are UTC wall-clock values. Streaming queries drain
their input into tables under a fresh run folder and return a scan of the
result. Money is rounded on output only, since the order in which doubles are
added differs from run to run.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.config import GoldJob, TopicConfig
from tidemill.functions import utc_wall_clock
from tidemill.operators import RULES, frame_header, rule_violations, windowed_aggregate
from tidemill.plans.pipeline import run_pipeline, with_fresh_checkpoints
from tidemill.plans.steps import StepLog
from tidemill.sources import append_messages, scan_table, stream_table, stream_topic_files
from tidemill.sources.sample_topics import (
    as_messages,
    batch_events,
    delivered_twice,
    redelivery,
    source_table,
    stream_events,
)
from tidemill.streaming import (
    RunLedger,
    clean_silver,
    compact,
    ingest_bronze,
    read_ledger,
    remove_replaced,
    run_gold_aggregation,
    session_of,
)
from tidemill.topics import TOPICS
from tidemill.workspace import date_files, new_run_folder

Query = Callable[[SparkSession, str], DataFrame]

#: Query prefix -> topic and job.
JOBS = {
    "j1_funnel": ("user_activity", "funnel_metrics_hourly"),
    "j2_revenue": ("user_activity", "revenue_hourly"),
    "j3_product_activity": ("product_events", "product_activity_hourly"),
    "j4_price_changes": ("product_events", "price_changes_hourly"),
    "j5_order_metrics": ("order_events", "order_metrics_hourly"),
    "j6_order_revenue": ("order_events", "order_revenue_hourly"),
}

#: Output rounding of aggregates over doubles.
ROUNDED = {"total_revenue": 2, "avg_price": 6}

#: When late files claim to be from: 2001-09-09.
LATE_FILE_MS = 1_000_000_000_000
#: Values that break the nullability rules of every row they are put in.
FILLERS = {
    "amount": 0.0,
    "product_id": "none",
    "search_query": "none",
    "previous_price": 0.0,
    "previous_stock_quantity": 0,
    "cancellation_reason": "none",
}
#: Fields an older writer schema of user_activity does not have.
LATER_FIELDS = ("search_query", "device_type")


#: Declared sizes of the registered queries: state partitions of a job, buckets of a table.
STATE_PARTITIONS = 16
BUCKETS = 16


def _config(spark: SparkSession, topic: str, label: str) -> TopicConfig:
    return _sized(TOPICS[topic].at(new_run_folder(spark, f"tidemill-{label}")))


def _sized(config: TopicConfig) -> TopicConfig:
    jobs = (replace(job, state_partitions=STATE_PARTITIONS) for job in config.gold_jobs)
    return replace(config, gold_jobs=tuple(jobs))


def _present(result: DataFrame, job: GoldJob) -> DataFrame:
    result = utc_wall_clock(result, "window_start", "window_end")
    rounded = {c: F.round(c, digits) for c, digits in ROUNDED.items() if c in job.aggs}
    return result.withColumns(rounded) if rounded else result


def _gold_table(spark: SparkSession, job: GoldJob, events: DataFrame) -> DataFrame:
    """Scan of a job's table; the schema comes from the plan, as there may be no file yet."""
    schema = windowed_aggregate(events, job).schema
    return _present(scan_table(spark, job.table, schema=schema), job)


def _delivered(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Events of a topic as a stream, about to be framed and decoded."""
    table = source_table(spark, sf_dir, topic)
    return stream_events(spark, sf_dir, topic, table.schema)


def _published(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Events of a topic at rest, about to be framed and written to a message folder."""
    return batch_events(spark, sf_dir, topic)


# --- windowed aggregates ---------------------------------------------------------------


def gold_stream(spark: SparkSession, sf_dir: str, prefix: str, **options) -> DataFrame:
    """One job as a drained stream: final windows only."""
    topic, name = JOBS[prefix]
    job = _config(spark, topic, prefix).job(name)
    table = source_table(spark, sf_dir, topic)
    session = session_of(spark, job)
    events = stream_events(session, sf_dir, topic, table.schema)
    run_gold_aggregation(session, events, job, report_counts=False, **options)
    return _gold_table(spark, job, events)


def gold_batch(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """The same job on the table at rest: all windows."""
    topic, name = JOBS[prefix]
    job = TOPICS[topic].job(name)
    return _present(windowed_aggregate(batch_events(spark, sf_dir, topic), job), job)


def _gold_in_runs(spark: SparkSession, job: GoldJob, silver: str, deliveries: list[DataFrame]) -> DataFrame:
    """A job run on one checkpoint for each delivery of events."""
    session = session_of(spark, job)
    for events in deliveries:
        events.write.mode("append").parquet(silver)
        stream = stream_table(session, silver, schema=events.schema)
        run_gold_aggregation(session, stream, job, report_counts=False)
    return _gold_table(spark, job, events)


def _halves(
    spark: SparkSession, sf_dir: str, label: str
) -> tuple[TopicConfig, DataFrame, DataFrame]:
    """A topic and its events, up to the cut and after it."""
    config = _config(spark, "user_activity", label)
    events = batch_events(spark, sf_dir, "user_activity").select("event_type", "timestamp_ms")
    cut = _cut(events)
    return config, events.filter(F.col("timestamp_ms") < cut), events.filter(F.col("timestamp_ms") >= cut)


def gold_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open windows survive in the checkpoint and are finished by the next run."""
    config, early, late = _halves(spark, sf_dir, "resume")
    return _gold_in_runs(spark, config.job("funnel_metrics_hourly"), config.silver_table, [early, late])


def gold_late_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows behind the watermark of an earlier run do not count any more."""
    config, early, late = _halves(spark, sf_dir, "late")
    return _gold_in_runs(spark, config.job("funnel_metrics_hourly"), config.silver_table, [late, early])


def gold_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table compacted after each of several runs; what was replaced is gone before it is read."""
    config, early, late = _halves(spark, sf_dir, "compacted")
    job = config.job("funnel_metrics_hourly")
    middle = _cut(late)
    deliveries = [early, late.filter(F.col("timestamp_ms") < middle), late.filter(F.col("timestamp_ms") >= middle)]
    schema = windowed_aggregate(early, job).schema
    for events in deliveries:
        _gold_in_runs(spark, job, config.silver_table, [events])
        compact(spark, job.table, schema)
        remove_replaced(spark, job.table)
    return _present(scan_table(spark, job.table, schema=schema), job)


# --- ingestion -------------------------------------------------------------------------


def _readable(rows: DataFrame) -> DataFrame:
    """Columns in types that data frames of all engines show alike.

    Arrays as text, instants as wall-clock values, integers with NULLs as doubles.
    """
    if "product_ids" in rows.columns:
        rows = rows.withColumn("product_ids", F.concat_ws(",", "product_ids"))
    if "previous_stock_quantity" in rows.columns:
        rows = rows.withColumn(
            "previous_stock_quantity", F.col("previous_stock_quantity").cast("double")
        )
    return utc_wall_clock(rows, "kafka_timestamp")


def bronze_decode(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Encode a topic, ingest it, read the bronze table back."""
    config = _config(spark, topic, f"bronze-{topic}")
    messages = as_messages(_delivered(spark, sf_dir, topic), topic)
    ingest_bronze(spark, config, messages, report_counts=False)
    bronze = scan_table(spark, config.bronze_table, schema=config.bronze_schema)
    return _readable(bronze.drop("ingested_at"))


def header_schema_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per topic, magic byte and writer schema id."""
    headers = [
        frame_header(as_messages(batch_events(spark, sf_dir, t), t)) for t in TOPICS
    ]
    united = reduce(DataFrame.unionByName, headers)
    return united.groupBy("topic", "magic", "framed", "schema_id").agg(
        F.count(F.lit(1)).alias("messages")
    )


def _cut(events: DataFrame) -> int:
    """Where queries with two deliveries cut the events: halfway between the first and the last."""
    return events.agg(F.expr("(min(timestamp_ms) + max(timestamp_ms)) div 2")).first()[0]


def _older(schema: StructType) -> StructType:
    return StructType([f for f in schema.fields if f.name not in LATER_FIELDS])


def decode_by_schema_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic with two writer schemas: messages up to the cut lack the later fields."""
    config = _config(spark, "user_activity", "schema-ids")
    newer, older = config.payload_schema, _older(config.payload_schema)
    is_old = F.col("timestamp_ms") < _cut(_published(spark, sf_dir, "user_activity"))
    events = _delivered(spark, sf_dir, "user_activity").withColumns(
        {name: F.when(~is_old, F.col(name)) for name in LATER_FIELDS}
    )
    messages = as_messages(
        events, "user_activity", schema_id=F.when(is_old, 11).otherwise(12)
    )
    ingest_bronze(
        spark, config, messages, schemas_by_id={11: older, 12: newer}, report_counts=False
    )
    bronze = scan_table(spark, config.bronze_table, schema=config.bronze_schema)
    return bronze.select("event_id", "event_type", "product_id", "amount", *LATER_FIELDS)


def bronze_additive_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs into one bronze table, the second with more fields than the first."""
    config = _config(spark, "user_activity", "additive")
    topic_folder = f"{config.bronze_checkpoint}_topic"
    events = _published(spark, sf_dir, "user_activity")
    cut = _cut(events)
    runs = (
        (f"timestamp_ms < {cut}", _older(config.payload_schema)),
        (f"timestamp_ms >= {cut}", config.payload_schema),
    )
    for arrivals, schema in runs:
        messages = as_messages(events.filter(arrivals), "user_activity", schema.names)
        append_messages(messages, topic_folder)
        stream = stream_topic_files(spark, topic_folder)
        ingest_bronze(spark, config, stream, schema, report_counts=False)
    bronze = scan_table(spark, config.bronze_table, schema=config.bronze_schema)
    return bronze.select("event_id", "event_type", "product_id", "amount", *LATER_FIELDS)


def bronze_new_schema_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries drained by one run, the second under a schema id that the run was not told of.

    Ids are looked up in a schema table when their batch comes.
    """
    config = _config(spark, "user_activity", "new-schema-id")
    topic_folder, schemas = (f"{config.bronze_checkpoint}_{name}" for name in ("topic", "schemas"))
    events = _published(spark, sf_dir, "user_activity")
    cut = _cut(events)
    newer, older = config.payload_schema, _older(config.payload_schema)
    versions = [
        (config.schema_subject, version, ident, _as_ddl(schema))
        for version, (ident, schema) in enumerate(((11, older), (12, newer)), 1)
    ]
    columns = "subject STRING, version INT, schema_id BIGINT, schema STRING"
    spark.createDataFrame(versions, columns).write.parquet(schemas)
    for arrivals, schema, ident in (
        (f"timestamp_ms < {cut}", older, 11),
        (f"timestamp_ms >= {cut}", newer, 12),
    ):
        messages = as_messages(events.filter(arrivals), "user_activity", schema.names, ident)
        append_messages(messages, topic_folder)
    stream = stream_topic_files(spark, topic_folder, max_files_per_trigger=1)
    ingest_bronze(
        spark, config, stream, report_counts=False, schema_table=lambda s: s.read.parquet(schemas)
    )
    bronze = scan_table(spark, config.bronze_table, schema=config.bronze_schema)
    return bronze.select("event_id", "event_type", "product_id", "amount", *LATER_FIELDS)


def _as_ddl(schema: StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def bronze_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, the second in files dated a year earlier: every message arrives."""
    config = _config(spark, "order_events", "late-files")
    folder = f"{config.bronze_checkpoint}_topic"
    for name, arrivals in (("newer", "offset % 2 = 0"), ("older", "offset % 2 <> 0")):
        messages = as_messages(_published(spark, sf_dir, "order_events"), "order_events")
        append_messages(messages.filter(arrivals), f"{folder}/{name}")
        if name == "older":
            date_files(spark, f"{folder}/{name}", LATE_FILE_MS)
        stream = stream_topic_files(spark, f"{folder}/*")
        ingest_bronze(spark, config, stream, report_counts=False)
    bronze = scan_table(spark, config.bronze_table, schema=config.bronze_schema)
    return bronze.select("event_id", "event_type", "total_amount", "partition", "offset")


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage some event types on the wire; count what bronze and quarantine receive.

    Searches lose the end of their payload, logins the magic byte, reviews
    their event id; payments become tombstones, which pass.
    """
    config = _config(spark, "user_activity", "quarantine")
    kind, value = F.col("event_type"), F.col("value")
    events = _delivered(spark, sf_dir, "user_activity").withColumn(
        "event_id", F.when(kind != "review", F.col("event_id"))
    )
    messages = as_messages(events, "user_activity", keep=["event_type"]).withColumn(
        "value",
        F.when(kind == "search", F.substring(value, F.lit(1), F.length(value) - 10))
        .when(kind == "login", F.concat(F.unhex(F.lit("01")), F.substring(value, 2, 1 << 30)))
        .when(kind != "payment", value),
    )
    ingest_bronze(spark, config, messages, on_error="quarantine", report_counts=False)
    bronze = scan_table(spark, config.bronze_table, schema=config.bronze_schema)
    accepted = bronze.select(
        F.lit("bronze").alias("destination"),
        F.coalesce("event_type", F.lit("tombstone")).alias("detail"),
    )
    rejected = scan_table(spark, config.quarantine_table).select(
        F.lit("quarantine").alias("destination"), F.col("reason").alias("detail")
    )
    return (
        accepted.unionByName(rejected)
        .groupBy("destination", "detail")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


def quarantine_by_schema_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writer schemas, and logins that name a third nobody knows: those are quarantined.

    Searches come with the older schema, which lacks the later fields.
    """
    config = _config(spark, "user_activity", "quarantine-ids")
    newer, older = config.payload_schema, _older(config.payload_schema)
    kind = F.col("event_type")
    events = _delivered(spark, sf_dir, "user_activity").withColumns(
        {name: F.when(kind != "search", F.col(name)) for name in LATER_FIELDS}
    )
    ident = F.when(kind == "login", 99).when(kind == "search", 11).otherwise(12)
    messages = as_messages(events, "user_activity", schema_id=ident)
    ingest_bronze(
        spark,
        config,
        messages,
        on_error="quarantine",
        schemas_by_id={11: older, 12: newer},
        report_counts=False,
    )
    bronze = scan_table(spark, config.bronze_table, schema=config.bronze_schema)
    accepted = bronze.select(F.lit("accepted").alias("verdict"), "event_type", "device_type")
    rejected = scan_table(spark, config.quarantine_table).select(
        F.col("reason").alias("verdict"),
        F.lit(None).cast("string").alias("event_type"),
        F.lit(None).cast("string").alias("device_type"),
    )
    return (
        accepted.unionByName(rejected)
        .groupBy("verdict", "event_type")
        .agg(F.count(F.lit(1)).alias("messages"), F.count("device_type").alias("devices"))
    )


# --- deduplication and merge -----------------------------------------------------------


def _silver(spark: SparkSession, config: TopicConfig) -> DataFrame:
    return scan_table(spark, config.silver_table, schema=config.silver_schema)


def silver_dedup(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """The whole topic delivered twice: the first arrival of each key stays."""
    config = _config(spark, topic, f"silver-{topic}")
    messages = as_messages(delivered_twice(_delivered(spark, sf_dir, topic)), topic)
    ingest_bronze(spark, config, messages, report_counts=False)
    clean_silver(spark, config, report_counts=False)
    columns = [c for c in config.silver_columns if c != "ingested_at"]
    return _readable(_silver(spark, config).select(*columns))


def _two_deliveries(
    spark: SparkSession,
    config: TopicConfig,
    first: DataFrame,
    second: DataFrame,
    ledger: RunLedger | None = None,
) -> DataFrame:
    """Bronze and silver run after each delivery."""
    topic_folder = f"{config.bronze_checkpoint}_topic"
    for messages in (first, second):
        append_messages(messages, topic_folder)
        stream = stream_topic_files(spark, topic_folder)
        ingest_bronze(spark, config, stream, report_counts=False, ledger=ledger)
        clean_silver(spark, config, report_counts=False, ledger=ledger)
    return _silver(spark, config)


def _catalog_config(
    spark: SparkSession, sf_dir: str, topic: str, label: str
) -> TopicConfig:
    """A topic whose tables are named, in a database kept in the run folder.

    Silver is bucketed on its keys.
    """
    folder = new_run_folder(spark, f"tidemill-{label}")
    database = "tidemill_" + folder.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/warehouse'")
    config = TOPICS[topic].in_catalog(database, f"{folder}/checkpoints")
    return replace(config, silver_buckets=BUCKETS)


def silver_two_batches(spark: SparkSession, sf_dir: str, in_catalog: bool = False) -> DataFrame:
    """Events up to the cut, then all events with changed payloads: first write wins."""
    config = (
        _catalog_config(spark, sf_dir, "user_activity", "two-batches")
        if in_catalog
        else _config(spark, "user_activity", "two-batches")
    )
    events = _published(spark, sf_dir, "user_activity")
    changed = redelivery(events).withColumns(
        {"amount": F.col("amount") + 1, "device_type": F.lit("changed")}
    )
    silver = _two_deliveries(
        spark,
        config,
        as_messages(events.filter(F.col("timestamp_ms") < _cut(events)), "user_activity"),
        as_messages(changed, "user_activity"),
    )
    return _readable(
        silver.select("event_id", "event_type", "amount", "device_type", "kafka_timestamp")
    )


def silver_additive_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver table that gets more columns between two runs: NULL in the rows of the first."""
    newer = _config(spark, "user_activity", "additive-silver")
    older = replace(
        newer,
        payload_schema=_older(newer.payload_schema),
        silver_columns=tuple(c for c in newer.silver_columns if c not in LATER_FIELDS),
    )
    topic_folder = f"{newer.bronze_checkpoint}_topic"
    events = _published(spark, sf_dir, "user_activity")
    cut = _cut(events)
    for config, arrivals in ((older, f"timestamp_ms < {cut}"), (newer, f"timestamp_ms >= {cut}")):
        messages = as_messages(events.filter(arrivals), "user_activity", config.payload_schema.names)
        append_messages(messages, topic_folder)
        stream = stream_topic_files(spark, topic_folder)
        ingest_bronze(spark, config, stream, report_counts=False)
        clean_silver(spark, config, report_counts=False)
    silver = _silver(spark, newer)
    return silver.select("event_id", "event_type", "product_id", "amount", *LATER_FIELDS)


def silver_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge killed while it wrote, then a checkpoint reset: the rerun is right without help.

    The first half of the events is merged. Of the second half a merge leaves its files in the
    folder that a killed one leaves behind. All checkpoints are new after that.
    """
    config = _config(spark, "user_activity", "recovered")
    topic_folder = f"{config.bronze_checkpoint}_topic"
    events = _published(spark, sf_dir, "user_activity")
    cut = _cut(events)
    append_messages(as_messages(events.filter(F.col("timestamp_ms") < cut), "user_activity"), topic_folder)
    ingest_bronze(spark, config, stream_topic_files(spark, topic_folder), report_counts=False)
    clean_silver(spark, config, report_counts=False)
    late = events.filter(F.col("timestamp_ms") >= cut)
    killed = f"{config.silver_table}/.spark-staging-killed/run_id=killed/batch_id=1"
    late.select(*(c for c in late.columns if c in config.silver_columns)).write.parquet(killed)
    append_messages(as_messages(late, "user_activity"), topic_folder)
    fresh = with_fresh_checkpoints(config)
    ingest_bronze(spark, fresh, stream_topic_files(spark, topic_folder), report_counts=False)
    clean_silver(spark, fresh, report_counts=False)
    return _readable(_silver(spark, fresh).select("event_id", "event_type", "amount", "kafka_timestamp"))


def silver_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows inserted by each of two micro-batches, from the ledger; product events, whose keys repeat."""
    config = _config(spark, "product_events", "batch-counts")
    folder = f"{config.bronze_checkpoint}_ledger"
    events = _published(spark, sf_dir, "product_events")
    with RunLedger(spark, folder) as ledger:
        _two_deliveries(
            spark,
            config,
            as_messages(events.filter("event_type = 'price_changed'"), "product_events"),
            as_messages(redelivery(events), "product_events"),
            ledger,
        )
    recorded = read_ledger(spark, folder).filter(F.col("table_name") == config.silver_table)
    return recorded.select("batch_id", F.col("written").alias("inserted"))


def silver_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments become NULL values: each micro-batch inserts one row without a key."""
    config = _config(spark, "user_activity", "tombstones")
    events = _published(spark, sf_dir, "user_activity")

    def messages(delivered: DataFrame) -> DataFrame:
        framed = as_messages(delivered, "user_activity", keep=["event_type"])
        return framed.withColumn("value", F.expr("if(event_type = 'payment', NULL, value)"))

    silver = _two_deliveries(spark, config, messages(events), messages(redelivery(events)))
    return silver.groupBy(F.col("event_id").isNull().alias("without_key")).agg(
        F.count(F.lit(1)).alias("n")
    )


# --- whole chain and data quality ------------------------------------------------------


def pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers of all topics, every message delivered twice: rows per table."""
    folder = new_run_folder(spark, "tidemill-pipeline")
    topics = {name: _sized(topic.at(folder)) for name, topic in TOPICS.items()}

    def source(config: TopicConfig) -> DataFrame:
        events = _delivered(spark, sf_dir, config.name)
        return as_messages(delivered_twice(events), config.name)

    counts = run_pipeline(spark, topics, source, concurrent=True)
    return spark.createDataFrame(sorted(counts.items()), "table_name STRING, row_count BIGINT")


def pipeline_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same chain where the last topic cannot be read for three attempts: two runs of one name.

    The first run ends with the failure of its retry. The second goes on at the failed step, whose
    retry succeeds; the tables are those of a run without failures.
    """
    folder = new_run_folder(spark, "tidemill-resumed")
    topics = {name: _sized(topic.at(folder)) for name, topic in TOPICS.items()}
    failures = iter(range(3))

    def source(config: TopicConfig) -> DataFrame:
        if config.name == list(TOPICS)[-1] and next(failures, None) is not None:
            raise ConnectionError("the topic cannot be read")
        events = _delivered(spark, sf_dir, config.name)
        return as_messages(delivered_twice(events), config.name)

    with suppress(ConnectionError):
        run_pipeline(spark, topics, source, steps=StepLog(spark, f"{folder}/steps", "daily"))
    counts = run_pipeline(spark, topics, source, steps=StepLog(spark, f"{folder}/steps", "daily"))
    return spark.createDataFrame(sorted(counts.items()), "table_name STRING, row_count BIGINT")


def quality_invariants(spark: SparkSession, sf_dir: str, filled: bool = False) -> DataFrame:
    """Rows checked and rows violating each nullability rule.

    With ``filled`` the nullable fields are filled first, so that the rules fail.
    """
    reports = []
    for name in TOPICS:
        events = batch_events(spark, sf_dir, name)
        if filled:
            fillers = {c: value for c, value in FILLERS.items() if c in events.columns}
            events = events.fillna(fillers)
        reports.append(rule_violations(events, name, RULES[name]))
    return reduce(DataFrame.unionByName, reports)


def registered_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for prefix in JOBS:
        found[f"{prefix}_hourly"] = partial(gold_stream, prefix=prefix)
        found[f"{prefix}_batch"] = partial(gold_batch, prefix=prefix)
    for prefix in ("j2_revenue", "j4_price_changes", "j6_order_revenue"):
        found[f"{prefix}_watermark_all"] = partial(
            gold_stream, prefix=prefix, watermark_scope="all"
        )
    found["j6_order_revenue_daily"] = partial(
        gold_stream, prefix="j6_order_revenue", window="1 day", watermark="2 days"
    )
    found["gold_resume"] = gold_resume
    found["gold_late_dropped"] = gold_late_dropped
    found["gold_compacted"] = gold_compacted
    for topic in TOPICS:
        found[f"bronze_decode_{topic}"] = partial(bronze_decode, topic=topic)
    found["header_schema_id"] = header_schema_id
    found["decode_by_schema_id"] = decode_by_schema_id
    found["bronze_additive_schema"] = bronze_additive_schema
    found["bronze_new_schema_id"] = bronze_new_schema_id
    found["bronze_late_files"] = bronze_late_files
    found["quarantine"] = quarantine
    found["quarantine_by_schema_id"] = quarantine_by_schema_id
    for topic in TOPICS:
        found[f"silver_dedup_{topic}"] = partial(silver_dedup, topic=topic)
    found["silver_two_batches"] = silver_two_batches
    found["silver_two_batches_bucketed"] = partial(silver_two_batches, in_catalog=True)
    found["silver_batch_counts"] = silver_batch_counts
    found["silver_additive_columns"] = silver_additive_columns
    found["silver_recovered"] = silver_recovered
    found["silver_tombstones"] = silver_tombstones
    found["pipeline_end_to_end"] = pipeline_end_to_end
    found["pipeline_resumed"] = pipeline_resumed
    found["quality_invariants"] = quality_invariants
    found["quality_violations"] = partial(quality_invariants, filled=True)
    return found
