"""Insert-only merge: rows whose key the target does not hold yet."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.config import is_location


def rows_to_insert(
    deduplicated: DataFrame, arrivals: DataFrame, target: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Rows of ``deduplicated`` without a partner in ``target``.

    ``arrivals`` is the batch ``deduplicated`` was made from. Only key columns
    of the target are read. The target is first reduced to the keys that occur
    in the batch. Which join that is, Spark decides from the sizes it sees: small
    batch keys are broadcast and the target stays where it is; otherwise both
    sides shuffle on the key, or only the batch does if the target is bucketed on it. A key with a NULL in it
    matches nothing, so such rows are always inserted.
    """
    keys = list(keys)
    batch_keys = arrivals.select(*keys).distinct()
    seen = target.select(*keys).join(batch_keys, keys, "left_semi")
    return deduplicated.join(seen, keys, "left_anti")


def merge_with_delta(spark, target_table: str, source: DataFrame, keys: Sequence[str]) -> None:
    """The same merge on a Delta table, where the delta package is installed."""
    from delta.tables import DeltaTable

    target = (
        DeltaTable.forPath(spark, target_table)
        if is_location(target_table)
        else DeltaTable.forName(spark, target_table)
    )
    condition = reduce(and_, (F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys))
    (
        target.alias("target")
        .merge(source.alias("source"), condition)
        .whenNotMatchedInsertAll()
        .execute()
    )
