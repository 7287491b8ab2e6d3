"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemill.workspace import new_run_folder


def spool(df: DataFrame, label: str) -> DataFrame:
    """Write a result once and read it back: cuts lineage, survives lost executors.

    Tables go under ``spark.checkpoint.dir``, which has to be set on a cluster. A table stays until
    ``tidemill.workspace.remove_run_folders``; names never repeat.
    """
    spark = df.sparkSession
    place = new_run_folder(spark, f"llm-{label}")
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)
