"""Compaction of file tables that many micro-batches have written to.

The rows of published batches are rewritten into few files in a hidden folder; then a manifest,
written at once, tells batch readers to read those files and to leave out the batches in them.
The batches stay where they are: streams that follow the table keep reading batches and never see a
row twice, and readers that started before keep their files. :func:`remove_replaced`
deletes them when nobody needs them any more.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tidemill.config import ConfigError, is_location
from tidemill.session import isolated
from tidemill.sources.tables import (
    Manifest,
    published_batches,
    read_batches,
    read_manifest,
    read_parts,
    write_manifest,
)
from tidemill.workspace import matching, remove, size_of

log = logging.getLogger("tidemill")

#: Bytes of a compacted file.
TARGET_BYTES = 128 << 20


def compact(
    spark: SparkSession, table: str, schema: StructType, target_bytes: int = TARGET_BYTES
) -> int:
    """Rewrite the batches of a table that are not compacted yet; how many they were.

    Compacted parts smaller than a file are rewritten along with them, so that small parts do not add up
    and large ones are never touched again. ``schema`` has the columns to keep. Files are packed into
    splits of the wanted size as they are read, so nothing is shuffled. Of two runs at the same time one
    fails and changes nothing.
    """
    if not is_location(table):
        raise ConfigError(f"{table}: only tables at a location are compacted")
    before = read_manifest(spark, table)
    published = published_batches(spark, table)
    fresh = [b for b in published if b not in before.replaced]
    if not fresh:
        return 0
    small = [p for p in before.parts if size_of(spark, f"{table}/{p}") < target_bytes]
    session = isolated(
        spark,
        {
            "spark.sql.files.maxPartitionBytes": str(target_bytes),
            "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1",
        },
    )
    rows = read_batches(session, table, schema, fresh)
    if small:
        rows = rows.unionByName(read_parts(session, table, schema, small))
    part = f"_compacted/part={uuid.uuid4().hex}"
    rows.write.parquet(f"{table}/{part}")
    parts = [p for p in before.parts if p not in small] + [part]
    # Every batch folder that is there is in some part now.
    write_manifest(spark, table, Manifest(before.generation + 1, parts, published))
    log.info("%s: %d batches compacted", table, len(fresh))
    return len(fresh)


def remove_replaced(spark: SparkSession, table: str) -> int:
    """Delete the batches and parts that the manifest has replaced; how many.

    For when every reader that began before the last compaction has ended, and every stream on the
    table has read the batches.
    """
    manifest = read_manifest(spark, table)
    gone = [b for b in published_batches(spark, table) if b in manifest.replaced]
    written = ("/".join(p.split("/")[-2:]) for p in matching(spark, f"{table}/_compacted/part=*"))
    stale = [p for p in written if p not in manifest.parts]
    for name in [*gone, *stale]:
        remove(spark, f"{table}/{name}")
    return len(gone) + len(stale)
