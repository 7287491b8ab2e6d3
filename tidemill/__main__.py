"""Run one layer of one topic, or everything: ``python -m tidemill gold order_events --root …``.

Messages come from a folder (``--topics``, one sub-folder per topic) or from
Kafka (``--kafka``). The Kafka user and password are read from the environment
variables TIDEMILL_KAFKA_USERNAME and TIDEMILL_KAFKA_PASSWORD, the Avro schema
texts from ``--avro-schemas``, a folder with one ``<subject>.avsc`` per topic; without
it, payloads are JSON. ``--schema-table`` names a Parquet folder of JSON payload schemas by id
(subject, version, schema_id, schema), looked up for each micro-batch.
"""

from __future__ import annotations

import argparse
import json
import os
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidemill.config import TopicConfig
from tidemill.plans.pipeline import LAYERS, run_layer, run_pipeline
from tidemill.plans.steps import StepLog
from tidemill.sources import jaas_config, read_topic_stream, stream_topic_files
from tidemill.streaming.bronze import ON_ERROR
from tidemill.topics import TOPICS, topics_at, topics_in_catalog


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(prog="tidemill", description=__doc__)
    options.add_argument("layer", choices=[*LAYERS, "all"])
    options.add_argument("topic", nargs="?", choices=list(TOPICS), help="not with layer 'all'")
    options.add_argument("--root", required=True, help="folder of tables and checkpoints")
    options.add_argument("--catalog", help="namespace of catalog tables; root keeps checkpoints")
    options.add_argument("--format", default="parquet", choices=["parquet", "delta"])
    options.add_argument("--topics", help="folder with one sub-folder of messages per topic")
    options.add_argument("--kafka", help="bootstrap servers")
    options.add_argument("--avro-schemas", help="folder of <subject>.avsc files")
    options.add_argument("--schema-table", help="folder of payload schemas by id")
    options.add_argument("--concurrent", action="store_true", help="run independent steps together")
    options.add_argument("--max-files", type=int, help="files per micro-batch")
    options.add_argument("--max-offsets", type=int, help="Kafka offsets per micro-batch")
    options.add_argument("--min-partitions", type=int, help="tasks a Kafka range is split over")
    options.add_argument("--run", help="name of a run of 'all'; the same name goes on where it failed")
    options.add_argument("--retries", type=int, default=1, help="of a failed step, with --run")
    options.add_argument("--on-error", default="fail", choices=ON_ERROR)
    return options


def _schema_text(spark: SparkSession, folder: str, subject: str) -> str:
    return spark.read.text(f"{folder}/{subject}.avsc", wholetext=True).first()["value"]


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> object:
    options = parser().parse_args(arguments)
    if (options.layer == "all") == bool(options.topic):
        parser().error("name a topic for a single layer, and none for 'all'")
    spark = spark or SparkSession.builder.appName("tidemill").getOrCreate()
    topics = (
        topics_in_catalog(options.catalog, options.root, options.format)
        if options.catalog
        else topics_at(options.root, options.format)
    )

    def source(config: TopicConfig):
        if options.kafka:
            user, password = (os.environ[f"TIDEMILL_KAFKA_{x}"] for x in ("USERNAME", "PASSWORD"))
            limits = {
                "max_offsets_per_trigger": options.max_offsets,
                "min_partitions": options.min_partitions,
            }
            jaas = jaas_config(user, password)
            return read_topic_stream(spark, options.kafka, jaas, config.kafka_topic, **limits)
        if not options.topics:
            parser().error("the bronze layer needs --topics or --kafka")
        return stream_topic_files(spark, f"{options.topics}/{config.name}", options.max_files)

    def decoding(config: TopicConfig) -> dict:
        chosen: dict = {"on_error": options.on_error}
        if options.avro_schemas:
            schema = _schema_text(spark, options.avro_schemas, config.schema_subject)
            chosen |= {"schema": schema, "codec": "avro"}
        if options.schema_table:
            chosen["schema_table"] = lambda session: session.read.parquet(options.schema_table)
        return chosen

    if options.layer == "all":
        steps = None
        if options.run:
            steps = StepLog(spark, f"{options.root}/_steps", options.run, options.retries)
        result = run_pipeline(
            spark, topics, source, options.concurrent, options.max_files, decoding, steps=steps
        )
    elif options.layer == "bronze":
        chosen = decoding(topics[options.topic])
        result = run_layer(spark, "bronze", options.topic, topics, source, **chosen)
    else:
        chosen = {"max_files_per_trigger": options.max_files}
        if options.layer == "gold":
            chosen["concurrent"] = options.concurrent
        result = run_layer(spark, options.layer, options.topic, topics, **chosen)
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
