"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of the tables      (default /root/testdata/sf0.1)
BENCH_CPUS    local cores               (default 8)
BENCH_MEMORY  driver memory             (default 8g)
BENCH_FILES   files per event table     (default 16)
BENCH_ONLY    comma-separated substrings of query names (default: all headline queries)

Topics are streams of many files. The three event tables, each one file that a single task reads, are
therefore published as folders of BENCH_FILES files first, outside the clock; all rows stay.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemill.plans.queries import JOBS, registered_queries  # noqa: E402
from tidemill.session import local_session  # noqa: E402
from tidemill.sources.sample_topics import SOURCE_TABLES  # noqa: E402
from tidemill.workspace import new_run_folder, remove_run_folders  # noqa: E402

STREAMING = [f"{job}_hourly" for job in JOBS]
BATCH = [f"{job}_batch" for job in JOBS]
LAYERS = [
    *(f"bronze_decode_{topic}" for topic in SOURCE_TABLES),
    *(f"silver_dedup_{topic}" for topic in SOURCE_TABLES),
    "silver_two_batches",
    "silver_batch_counts",
    "pipeline_end_to_end",
]


def drain(df) -> None:
    """Compute every row and column without moving them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def published(spark, tables: str, files: int) -> str:
    """The event tables again, each as a folder of so many files."""
    folder = new_run_folder(spark, "bench-tables")
    for table in SOURCE_TABLES.values():
        rows = spark.read.parquet(f"{tables}/{table}.parquet")
        rows.repartition(files).write.parquet(f"{folder}/{table}.parquet")
    return folder


def main() -> None:
    tables = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [w for w in os.environ.get("BENCH_ONLY", "").split(",") if w]
    spark = local_session(cpus, os.environ.get("BENCH_MEMORY", "8g"), "tidemill-bench")
    queries = registered_queries()
    names = [
        n for n in [*STREAMING, *BATCH, *LAYERS] if not wanted or any(w in n for w in wanted)
    ]
    rows = {
        table: spark.read.parquet(f"{tables}/{table}.parquet").count()
        for table in SOURCE_TABLES.values()
    }
    files = int(os.environ.get("BENCH_FILES", "16"))
    source, tables = tables, published(spark, tables, files)
    # Class loading and code generation of the first queries are not of interest.
    for name in ("j1_funnel_hourly", "j1_funnel_batch", "silver_dedup_user_activity"):
        drain(queries[name](spark, tables))
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        drain(queries[name](spark, tables))
        seconds[name] = round(time.perf_counter() - start, 3)

    def total(group: list[str]) -> float:
        return round(sum(seconds.get(n, 0.0) for n in group), 3)

    report = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(source).removeprefix("sf"),
        "streaming_sec": total(STREAMING),
        "batch_sec": total(BATCH),
        "layers_sec": total(LAYERS),
        "cpus": cpus,
        "files_per_event_table": files,
        "input_rows": rows,
    }
    if "pipeline_end_to_end" in seconds:
        # Every message is delivered twice.
        delivered = 2 * sum(rows.values())
        report["pipeline_messages_per_sec"] = round(delivered / seconds["pipeline_end_to_end"])
    remove_run_folders(spark)
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
