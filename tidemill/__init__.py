"""Config-driven event pipelines on Spark: ingest, deduplicate, aggregate.

Topics are declared in :mod:`tidemill.topics`; :mod:`tidemill.streaming` runs
their layers and :mod:`tidemill.plans.pipeline` chains them.
"""

from tidemill.config import ConfigError, GoldJob, TopicConfig, topic_from_mapping
from tidemill.plans.pipeline import run_layer, run_pipeline, with_fresh_checkpoints
from tidemill.plans.steps import StepLog, read_steps
from tidemill.streaming import (
    clean_silver,
    ingest_bronze,
    ingest_bronze_from_kafka,
    run_all_gold_jobs,
    run_gold_aggregation,
)
from tidemill.topics import TOPICS, topics_at, topics_in_catalog

__all__ = [
    "ConfigError",
    "GoldJob",
    "StepLog",
    "TOPICS",
    "TopicConfig",
    "clean_silver",
    "ingest_bronze",
    "ingest_bronze_from_kafka",
    "read_steps",
    "run_all_gold_jobs",
    "run_gold_aggregation",
    "run_layer",
    "run_pipeline",
    "topic_from_mapping",
    "topics_at",
    "topics_in_catalog",
    "with_fresh_checkpoints",
]
