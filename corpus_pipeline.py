"""The corpus pipeline: stages that each apply one operator to what the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm._scratch import spool
from tidemill.llm.decontaminate import without_leaks
from tidemill.llm.exact_dedup import exact_duplicates, keep_rows
from tidemill.llm.jaccard_join import jaccard_components
from tidemill.llm.queries import TOXIC_FROM, encoded_digests, importable
from tidemill.llm.toxicity import train, without_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _side_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from labels outside the held-out fold."""
    return without_toxic(docs, train(docs, _side_table(spark, sf_dir, "labels")), TOXIC_FROM)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, the one with the smallest doc_id."""
    importable(spark)
    return keep_rows(docs, exact_duplicates(docs).filter("kept").select("row"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar texts stays, the one with the smallest doc_id."""
    importable(spark)
    return keep_rows(docs, jaccard_components(docs).filter("kept").select("row"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return without_leaks(docs, _side_table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids of what is left."""
    importable(spark)
    return encoded_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: A trained model and components of links are not expressible; ``tests/llm/test_queries.py`` compares
#: each stage with a plain version of it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, starting from the documents table; stages hand over tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = spool(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
