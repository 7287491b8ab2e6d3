"""Event-time conversions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def event_time(millis: Column | str) -> Column:
    """Epoch milliseconds as an instant, without going through floating point."""
    return F.timestamp_millis(F.col(millis) if isinstance(millis, str) else millis)


def epoch_millis(df: DataFrame, column: str) -> Column:
    """Milliseconds since the epoch of a timestamp column; zone-less values count as UTC.

    Zone-less values are taken apart into fields, because ``timestampdiff``
    reads them in the session zone and is an hour off across a clock change.
    """
    value = F.col(column)
    if not isinstance(df.schema[column].dataType, TimestampNTZType):
        return F.unix_millis(value)
    days = F.unix_date(value.cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(value)) * 60 + F.minute(value)
    in_minute = F.floor(F.extract(F.lit("SECOND"), value) * 1000).cast("bigint")
    return minutes * 60_000 + in_minute


def utc_wall_clock(df: DataFrame, *columns: str) -> DataFrame:
    """Replace instants by their UTC wall-clock reading, whatever the session zone."""
    return df.withColumns(
        {
            name: F.expr(f"timestampadd(MILLISECOND, unix_millis(`{name}`), {_EPOCH})")
            for name in columns
        }
    )
