"""Running layers: one layer of one topic, or the whole chain."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tidemill.config import TopicConfig
from tidemill.plans.steps import Counts, StepLog
from tidemill.streaming import clean_silver, ingest_bronze, run_all_gold_jobs

LAYERS = ("bronze", "silver", "gold")

#: Opens the message stream of a topic.
MessageSource = Callable[[TopicConfig], DataFrame]


def run_layer(
    spark: SparkSession,
    layer: str,
    topic: str,
    topics: Mapping[str, TopicConfig],
    source: MessageSource | None = None,
    **options,
) -> int | None | dict[str, int | None]:
    """Run one layer of one topic; bronze needs the message source."""
    config = topics[topic]
    if layer == "bronze":
        if source is None:
            raise ValueError("the bronze layer needs a message source")
        return ingest_bronze(spark, config, source(config), **options)
    if layer == "silver":
        return clean_silver(spark, config, **options)
    if layer == "gold":
        return run_all_gold_jobs(spark, config, **options)
    raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")


def run_pipeline(
    spark: SparkSession,
    topics: Mapping[str, TopicConfig],
    source: MessageSource,
    concurrent: bool = False,
    max_files_per_trigger: int | None = None,
    bronze_options: Callable[[TopicConfig], Mapping] | None = None,
    gold_options: Mapping | None = None,
    report_counts: bool = True,
    steps: StepLog | None = None,
) -> dict[str, int | None]:
    """Run all layers of all topics; row counts by ``layer.table``.

    By default the steps form one chain and the first failure ends it. With
    ``concurrent`` the topics, which share no table, run side by side, and so
    do the jobs of a topic. ``max_files_per_trigger`` cuts a large backlog of bronze or
    silver into several micro-batches, each of which is committed. ``bronze_options``
    gives the arguments of :func:`ingest_bronze` for a topic: schema, codec, schemas by id,
    what to do with messages that do not decode; ``gold_options`` those of
    :func:`run_all_gold_jobs`. Without ``report_counts`` no table is counted.

    With ``steps`` a failed layer of a topic is tried again, and a run of the same name goes on at
    the layer that failed instead of starting over.
    """
    limit = {"max_files_per_trigger": max_files_per_trigger, "report_counts": report_counts}

    def step(layer: str, name: str, action: Callable[[], Counts]) -> Counts:
        return steps.do(f"{layer}.{name}", action) if steps else action()

    def chain(name: str) -> dict[str, int | None]:
        decoding = dict(bronze_options(topics[name])) if bronze_options else {}
        decoding["report_counts"] = report_counts
        jobs = {**limit, "concurrent": concurrent, **(gold_options or {})}

        def bronze() -> Counts:
            return {f"bronze.{name}": run_layer(spark, "bronze", name, topics, source, **decoding)}

        def silver() -> Counts:
            return {f"silver.{name}": run_layer(spark, "silver", name, topics, **limit)}

        def gold() -> Counts:
            counts = run_layer(spark, "gold", name, topics, **jobs)
            return {f"gold.{job}": rows for job, rows in counts.items()}

        layers = zip(LAYERS, (bronze, silver, gold), strict=True)
        ended = [step(layer, name, action) for layer, action in layers]
        return {table: rows for counts in ended for table, rows in counts.items()}

    if not concurrent:
        results = [chain(name) for name in topics]
    else:
        with ThreadPoolExecutor(max_workers=len(topics)) as pool:
            results = list(pool.map(inheritable_thread_target(spark)(chain), topics))
    return {step: rows for result in results for step, rows in result.items()}


def with_fresh_checkpoints(config: TopicConfig) -> TopicConfig:
    """The topic with new checkpoints, for when a source table was recreated.

    Silver keeps its table: everything is read again and the merge leaves out
    what is there. Bronze and gold tables are append-only and would have every row once for each
    checkpoint, so they get new names along with their checkpoints. What a broken run left
    behind needs no attention: it was never published.
    """
    mark = uuid.uuid4().hex[:8]

    def renamed(place: str) -> str:
        return f"{place}_{mark}" if place else place

    table = renamed if config.table_format == "parquet" else str
    return replace(
        config,
        bronze_table=table(config.bronze_table),
        bronze_checkpoint=renamed(config.bronze_checkpoint),
        silver_checkpoint=renamed(config.silver_checkpoint),
        quarantine_table=table(config.quarantine_table),
        gold_jobs=tuple(
            replace(job, table=table(job.table), checkpoint=renamed(job.checkpoint))
            for job in config.gold_jobs
        ),
    )
