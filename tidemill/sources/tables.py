"""Layer tables: batch scans, streaming scans, creation.

A table is a catalog name or a location (see :func:`tidemill.config.is_location`). File tables
have one partition per streaming query and micro-batch, ``run_id=…/batch_id=…``. A batch is written
to a hidden folder and published by one rename, so no reader ever sees part of one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemill.config import ConfigError, is_location
from tidemill.workspace import ensure_folder, forget_with_run_folders, matching

#: A file stream leaves out files much older than the newest one it has seen, after a week by
#: default. Late deliveries and restored folders have to count, so no file is too old here.
MAX_FILE_AGE = "365000d"


def file_options(
    max_files_per_trigger: int | None = None, archive: str | None = None
) -> dict[str, str]:
    """Options of every file stream. ``archive`` moves files there once they are processed,
    which keeps the list of files that the stream remembers short."""
    options = {"maxFileAge": MAX_FILE_AGE}
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    return options


#: Sub-folders of a file table, one per micro-batch that wrote rows.
BATCH_FIELDS = [StructField("run_id", StringType()), StructField("batch_id", LongType())]
BATCH_COLUMNS = [f.name for f in BATCH_FIELDS]
_PARTITIONED = "PARTITIONED BY (run_id, batch_id)"


def with_batch_fields(schema: StructType) -> StructType:
    known = [f for f in schema.fields if f.name not in BATCH_COLUMNS]
    return StructType([*known, *BATCH_FIELDS])


def scan_table(
    spark: SparkSession,
    table: str,
    table_format: str = "parquet",
    schema: StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Batch scan of what is published.

    A schema names the columns wanted, run_id and batch_id only if it has them.
    ``merge_schema`` unites the columns of all files (reads every footer).
    """
    if not is_location(table):
        if table_format != "delta":
            # Streams write from sessions of their own; this one may remember
            # an older list of files.
            spark.catalog.refreshTable(table)
        return _wanted(spark.table(table), schema)
    if table_format == "parquet":
        manifest = read_manifest(spark, table)
        known = schema
        if known is None and manifest.parts:
            parts = spark.read.option("mergeSchema", str(merge_schema)).option("recursiveFileLookup", "true")
            known = parts.parquet(*(f"{table}/{p}" for p in manifest.parts)).schema
        if known is not None:
            return _wanted(_published_rows(spark, table, known, manifest), schema)
    reader = spark.read.format(table_format)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return _wanted(reader.load(table), schema)


def _published_rows(
    spark: SparkSession, table: str, schema: StructType, manifest: Manifest
) -> DataFrame:
    if not manifest.parts:
        return spark.read.schema(with_batch_fields(schema)).parquet(table)
    rows = read_parts(spark, table, schema, manifest.parts)
    fresh = [b for b in published_batches(spark, table) if b not in manifest.replaced]
    return rows.unionByName(read_batches(spark, table, schema, fresh)) if fresh else rows


def published_batches(spark: SparkSession, table: str) -> list[str]:
    """The folders run_id=…/batch_id=… of a location."""
    found = matching(spark, f"{table}/run_id=*/batch_id=*")
    return sorted("/".join(f.split("/")[-2:]) for f in found)


def read_batches(spark: SparkSession, table: str, schema: StructType, batches: Sequence[str]) -> DataFrame:
    reader = spark.read.schema(with_batch_fields(schema)).option("basePath", table)
    return reader.parquet(*(f"{table}/{b}" for b in batches))


def read_parts(spark: SparkSession, table: str, schema: StructType, parts: Sequence[str]) -> DataFrame:
    """Rows of compacted parts, which have run_id and batch_id as columns of their own."""
    columns = with_batch_fields(schema)
    rows = spark.read.schema(columns).option("recursiveFileLookup", "true")
    return rows.parquet(*(f"{table}/{p}" for p in parts)).select(*columns.names)


@dataclass(frozen=True)
class Manifest:
    """Which compacted parts of a table count, and the batches that are in them."""

    generation: int = 0
    parts: list[str] = field(default_factory=list)
    replaced: list[str] = field(default_factory=list)


_MANIFEST = "kind STRING, name STRING"


def read_manifest(spark: SparkSession, table: str) -> Manifest:
    """The last manifest that was written to its end; there is a row per part and batch folder."""
    done = matching(spark, f"{table}/_manifests/generation=*/_SUCCESS")
    generations = [int(d.split("/")[-2].removeprefix("generation=")) for d in done]
    if not generations:
        return Manifest()
    last = max(generations)
    rows = spark.read.schema(_MANIFEST).parquet(f"{table}/_manifests/generation={last}").collect()
    names = {kind: [r["name"] for r in rows if r["kind"] == kind] for kind in ("part", "replaced")}
    return Manifest(last, names["part"], names["replaced"])


def write_manifest(spark: SparkSession, table: str, manifest: Manifest) -> None:
    rows = [("part", p) for p in manifest.parts] + [("replaced", b) for b in manifest.replaced]
    writer = spark.createDataFrame(rows, _MANIFEST).coalesce(1).write
    writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    writer.parquet(f"{table}/_manifests/generation={manifest.generation}")


def _wanted(rows: DataFrame, schema: StructType | None) -> DataFrame:
    if schema is None:
        return rows.drop(*BATCH_COLUMNS)
    return rows.select(*(f"`{name}`" for name in schema.names if name in rows.columns))


def stream_table(
    spark: SparkSession,
    table: str,
    table_format: str = "parquet",
    schema: StructType | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Incremental scan of what is published. File tables need a schema; without one, it is
    read from the data."""
    reader = spark.readStream.options(**file_options(max_files_per_trigger))
    if not is_location(table):
        return _wanted(reader.table(table), schema)
    reader = reader.format(table_format)
    if table_format != "delta":
        schema = schema or spark.read.format(table_format).load(table).schema
        reader = reader.schema(with_batch_fields(schema))
    return _wanted(reader.load(table), schema)


def count_rows(
    spark: SparkSession,
    table: str,
    table_format: str = "parquet",
    schema: StructType | None = None,
) -> int:
    """Row count; for Parquet it is answered from file footers."""
    return scan_table(spark, table, table_format, schema).count()


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def registered_name(location: str) -> str:
    """The catalog name under which a bucketed table at a location is known."""
    return f"tidemill_{hashlib.sha256(location.rstrip('/').encode()).hexdigest()[:24]}"


def ensure_append_table(spark: SparkSession, table: str, schema: StructType) -> None:
    """Create an append-only file table if it is absent; columns that it lacks are added."""
    if is_location(table):
        ensure_folder(spark, table)
        return
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_ddl(with_batch_fields(schema))}) USING parquet {_PARTITIONED}")
    add_columns(spark, table, schema)


def add_columns(spark: SparkSession, table: str, schema: StructType) -> None:
    """Schema union on a table of the catalog: new columns are NULL in old rows."""
    present = set(spark.table(table).columns)
    missing = StructType([f for f in schema.fields if f.name not in present])
    if missing:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_ddl(missing)})")


def ensure_merge_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    table_format: str = "parquet",
    bucket_keys: Sequence[str] = (),
    buckets: int | None = None,
) -> str:
    """Create the target of an insert-only merge if it is absent; its name in the catalog.

    File tables are bucketed on the merge keys where ``buckets`` is set, which spares the target its
    shuffle in every merge. A location is registered as an external table under a name derived from it;
    the number of buckets is kept with the files, since reading them with another would
    be wrong. Columns that an existing table lacks are added. Batches that were published but not
    registered before a crash are registered here.
    """
    if table_format == "delta":
        name = f"delta.`{table}`" if is_location(table) else table
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}) USING delta")
        return name
    bucketing = ""
    if buckets:
        keys = ", ".join(f"`{k}`" for k in bucket_keys)
        bucketing = f" CLUSTERED BY ({keys}) INTO {buckets} BUCKETS"
    name, place = table, ""
    if is_location(table):
        ensure_folder(spark, table)
        _keep_layout(spark, table, f"{buckets or 0}-{'-'.join(bucket_keys) if buckets else ''}")
        name, place = registered_name(table), f" LOCATION '{table}'"
        forget_with_run_folders(spark, table, name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(with_batch_fields(schema))}) USING parquet {_PARTITIONED}{bucketing}{place}")
    add_columns(spark, name, schema)
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def _keep_layout(spark: SparkSession, location: str, layout: str) -> None:
    known = [p.rsplit("/_layout-", 1)[1] for p in matching(spark, f"{location}/_layout-*")]
    if known and known != [layout]:
        raise ConfigError(f"{location} has the bucket layout {known[0]!r}, not {layout!r}")
    if not known:
        ensure_folder(spark, f"{location}/_layout-{layout}")
