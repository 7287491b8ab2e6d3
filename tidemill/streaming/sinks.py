"""Stream sinks: append to a table, and the per-batch insert-only merge.

File tables keep one partition per streaming query and micro-batch. Spark writes a batch into a hidden
staging folder and moves it to its place by one rename (dynamic partition overwrite), so
a batch is published or it is not there: a table has no log of files that the driver
would have to keep, and what a broken run leaves behind is never read. The partition itself
is the mark that a batch is done; a replay finds it and does nothing. A query on a new checkpoint has
a new id and so partitions of its own.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemill.config import is_location
from tidemill.operators import merge_with_delta, rows_to_insert
from tidemill.sources.tables import (
    BATCH_COLUMNS,
    ensure_append_table,
    registered_name,
    scan_table,
    with_batch_fields,
)
from tidemill.streaming.ledger import RunLedger
from tidemill.workspace import exists

log = logging.getLogger("tidemill")

Transform = Callable[[DataFrame], DataFrame]

#: Only the partition of the batch may be replaced.
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def announce(table: str, rows: int) -> int:
    log.info("%s: %d rows in total", table, rows)
    return rows


def query_id(batch: DataFrame) -> str:
    """The id of the streaming query that a micro-batch belongs to; checkpoints keep it."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        # All checkpoints would write to the same partitions and overwrite each other.
        raise RuntimeError("the streaming query's id is not known in this thread")
    return found


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the plans made inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def is_published(spark: SparkSession, table: str, run_id: str, batch_id: int) -> bool:
    if is_location(table):
        return exists(spark, f"{table}/run_id={run_id}/batch_id={batch_id}")
    spec = f"run_id='{run_id}', batch_id={batch_id}"
    return bool(spark.sql(f"SHOW PARTITIONS {table} PARTITION ({spec})").take(1))


def publish(rows: DataFrame, table: str, run_id: str, batch_id: int) -> int:
    """Write the partition of a micro-batch, all or nothing; the number of rows in it.

    A batch that is published already is left as it is: readers may have its files.
    """
    spark = rows.sparkSession
    if is_published(spark, table, run_id, batch_id):
        log.info("%s: batch %d is in already", table, batch_id)
        done = F.expr(f"run_id = '{run_id}' AND batch_id = {batch_id}")
        schema = with_batch_fields(rows.schema)
        return scan_table(spark, table, schema=schema).filter(done).count()
    # Counted while writing; no job of its own.
    written = Observation()
    counted = rows.observe(written, F.count(F.lit(1)).alias("rows")).withColumns(
        {"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("bigint")}
    )
    with settings(spark, {_OVERWRITE: "dynamic"}):
        if is_location(table):
            counted.write.mode("overwrite").partitionBy(*BATCH_COLUMNS).parquet(table)
        else:
            columns = spark.table(table).columns
            lacking = {c: F.lit(None) for c in columns if c not in counted.columns}
            counted.withColumns(lacking).select(*columns).write.insertInto(table, overwrite=True)
    total = written.get["rows"]
    log.info("%s: batch %d has %d rows", table, batch_id, total)
    return total


def start_batches(
    rows: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Drain what is available now through ``on_batch``, then stop."""
    return (
        rows.writeStream.outputMode("append")
        .foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_stream(
    rows: DataFrame,
    table: str,
    checkpoint: str,
    table_format: str = "parquet",
    ledger: RunLedger | None = None,
    prepare: Transform | None = None,
) -> StreamingQuery:
    """Start a query that appends everything available now to a table, then stops.

    New columns are allowed: tables of the catalog and formats that track a schema extend it,
    readers of Parquet locations unite the file schemas on request. ``prepare`` is applied to each
    micro-batch when its turn comes, for what is not known when the query starts.
    """
    if table_format != "delta" and prepare is None:
        ensure_append_table(rows.sparkSession, table, rows.schema)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        _append(prepare(batch) if prepare else batch, table, table_format, query_id(batch), batch_id, ledger)

    return start_batches(rows, on_batch, checkpoint)


def _append(
    rows: DataFrame, table: str, table_format: str, run_id: str, batch_id: int, ledger: RunLedger | None
) -> None:
    if table_format == "delta":
        writer = rows.write.format("delta").mode("append").option("mergeSchema", "true")
        # The format itself leaves out a batch that it has from this query already.
        writer = writer.option("txnAppId", f"{run_id}-{table}").option("txnVersion", batch_id)
        writer.save(table) if is_location(table) else writer.saveAsTable(table)
        return
    ensure_append_table(rows.sparkSession, table, rows.schema)
    total = publish(rows, table, run_id, batch_id)
    if ledger:
        ledger.wrote(table, run_id, batch_id, total)


def split_stream(
    rows: DataFrame,
    split: Callable[[DataFrame], tuple[DataFrame, Mapping[str, Transform]]],
    checkpoint: str,
    table_format: str = "parquet",
    ledger: RunLedger | None = None,
) -> StreamingQuery:
    """One query that appends parts of each micro-batch to several tables.

    ``split`` turns a batch into rows, which are computed once and kept (in memory, beyond it on
    disk) while the tables are written, and the part of them that each table gets. After a crash
    between two tables the replay writes only those that lack the batch.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        run_id = query_id(batch)
        judged, parts = split(batch)
        kept = judged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for table, part in parts.items():
                _append(part(kept), table, table_format, run_id, batch_id, ledger)
        finally:
            kept.unpersist()

    return start_batches(rows, on_batch, checkpoint)


def await_all(queries: list[StreamingQuery]) -> None:
    """Wait for every query, then raise the first failure, if any."""
    failure: Exception | None = None
    for query in queries:
        try:
            query.awaitTermination()
        except Exception as error:  # noqa: BLE001 - raised below
            failure = failure or error
    if failure is not None:
        raise failure


class InsertOnlyMerge:
    """The body of a ``foreachBatch`` sink that inserts rows with unseen keys.

    Replaying a batch that was published does nothing; one that was not is
    done against the rest of the table. ``inserted`` has the rows of each batch.
    """

    def __init__(
        self,
        table: str,
        schema: StructType,
        keys: Sequence[str],
        table_format: str = "parquet",
        buckets: int | None = None,
        partitions: int | None = None,
        ledger: RunLedger | None = None,
    ) -> None:
        self.table = table
        self.schema = schema
        self.keys = list(keys)
        self.table_format = table_format
        self.buckets = buckets
        self.partitions = partitions
        self.ledger = ledger
        self.inserted: dict[int, int] = {}

    @property
    def name(self) -> str:
        """The target's name in the catalog."""
        return registered_name(self.table) if is_location(self.table) else self.table

    def __call__(
        self, arrivals: DataFrame, deduplicated: DataFrame, run_id: str, batch_id: int
    ) -> None:
        spark = arrivals.sparkSession
        if self.table_format == "delta":
            merge_with_delta(spark, self.table, deduplicated, self.keys)
            return
        with settings(spark, self._settings()):
            self.inserted[batch_id] = self._insert(spark, deduplicated, run_id, batch_id)
        if self.ledger:
            self.ledger.wrote(self.table, run_id, batch_id, self.inserted[batch_id])

    def _insert(self, spark: SparkSession, deduplicated: DataFrame, run_id: str, batch_id: int) -> int:
        # The first batch, often the largest, has nothing to be compared with; nor has one that is in.
        first = not spark.sql(f"SHOW PARTITIONS {self.name}").take(1)
        if first or is_published(spark, self.name, run_id, batch_id):
            return publish(deduplicated, self.name, run_id, batch_id)
        # Its keys and its rows are both asked for; the batch is read and reduced once.
        kept = deduplicated.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            target = scan_table(spark, self.name)
            return publish(rows_to_insert(kept, kept, target, self.keys), self.name, run_id, batch_id)
        finally:
            kept.unpersist()

    def _settings(self) -> dict[str, str]:
        # With as many shuffle partitions as buckets, the batch is shuffled
        # once, onto the buckets; the target stays where it is, and the result
        # is written without moving again.
        partitions = self.buckets or self.partitions
        return {"spark.sql.shuffle.partitions": str(partitions)} if partitions else {}
