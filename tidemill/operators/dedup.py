"""One row per key, the earliest in the topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

ARRIVAL_ORDER = ("partition", "offset")


def first_per_key(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ARRIVAL_ORDER
) -> DataFrame:
    """Keep, for each key, the row that comes first in ``order``.

    Written as a grouped minimum over whole rows instead of a ranking window:
    the minimum is taken per task before the shuffle, so a key that repeats
    across a third of the input sends one row per task and never gathers in a
    single task. Remaining columns break ties, so the survivor is a function
    of the data alone; those without an order (maps) do so by a hash of their text.
    NULL keys form one group.
    """
    keys, order = list(keys), [c for c in order if c not in keys]
    rest = [c for c in rows.columns if c not in keys and c not in order]
    unordered = [c for c in rest if _has_no_order(rows.schema[c].dataType)]
    if unordered:
        text = F.to_json(F.struct(*unordered))
        position = F.struct(*order, *(c for c in rest if c not in unordered), F.xxhash64(text))
        first = F.min_by(F.struct(*order, *rest), position)
    else:
        first = F.min(F.struct(*order, *rest))
    picked = rows.groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*")
    return picked.select(*rows.columns)


def _has_no_order(kind: DataType) -> bool:
    return any(name in kind.simpleString() for name in ("map<", "variant"))
