"""Watermarked tumbling-window aggregation driven by a job declaration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.config import GoldJob
from tidemill.functions import event_time

DEFAULT_WATERMARK = "30 minutes"
DEFAULT_WINDOW = "1 hour"
WATERMARK_SCOPES = ("matching", "all")


def windowed_aggregate(
    events: DataFrame,
    job: GoldJob,
    watermark: str = DEFAULT_WATERMARK,
    window: str = DEFAULT_WINDOW,
    watermark_scope: str = "matching",
) -> DataFrame:
    """Aggregate events per window and group.

    On a stream in append mode a window comes out once, when the watermark
    has passed its end; on a batch DataFrame the watermark has no effect and
    all windows come out. Aggregates are computed partially before the
    shuffle, so a group that holds most of the rows costs one row per task.

    With ``watermark_scope="matching"`` a filtered job advances its watermark
    from matching rows only, because the optimizer moves the filter below the
    watermark. With ``"all"`` every row advances it: rows that do not match
    stay in the aggregation under a marker and their groups are dropped after.
    """
    if watermark_scope not in WATERMARK_SCOPES:
        raise ValueError(f"watermark_scope must be one of {WATERMARK_SCOPES}")
    timed = events.withColumn("event_time", event_time("timestamp_ms")).withWatermark(
        "event_time", watermark
    )
    bucket = F.window("event_time", window)
    aggregates = [F.expr(sql).alias(alias) for alias, sql in job.aggs.items()]
    if job.filter and watermark_scope == "all":
        matches = F.coalesce(F.expr(job.filter), F.lit(False))
        # Non-matching rows share one group per window, whatever their keys.
        keys = [F.when(F.col("_matches"), F.col(c)).alias(c) for c in job.group_by]
        grouped = (
            timed.withColumn("_matches", matches)
            .groupBy(bucket, "_matches", *keys)
            # The test is on an aggregate, so it cannot move below the watermark.
            .agg(*aggregates, F.max("_matches").alias("_keep"))
            .filter("_keep")
        )
    else:
        if job.filter:
            timed = timed.filter(job.filter)
        grouped = timed.groupBy(bucket, *job.group_by).agg(*aggregates)
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *job.group_by,
        *job.aggs,
    )
