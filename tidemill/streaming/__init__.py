"""The three layers as streaming queries that drain what is available and stop."""

from tidemill.streaming.bronze import ingest_bronze, ingest_bronze_from_kafka
from tidemill.streaming.compaction import compact, remove_replaced
from tidemill.streaming.gold import (
    run_all_gold_jobs,
    run_gold_aggregation,
    session_of,
    start_gold_aggregation,
)
from tidemill.streaming.ledger import RunLedger, read_ledger
from tidemill.streaming.silver import clean_silver, ensure_silver_table, upsert_batch
from tidemill.streaming.sinks import InsertOnlyMerge, append_stream, split_stream

__all__ = [
    "InsertOnlyMerge",
    "RunLedger",
    "append_stream",
    "clean_silver",
    "compact",
    "ensure_silver_table",
    "ingest_bronze",
    "ingest_bronze_from_kafka",
    "read_ledger",
    "remove_replaced",
    "run_all_gold_jobs",
    "run_gold_aggregation",
    "session_of",
    "split_stream",
    "start_gold_aggregation",
    "upsert_batch",
]
