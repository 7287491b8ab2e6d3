"""The five-byte header in front of every registry-encoded message.

Layout: one zero byte, the writer schema id as a big-endian 32-bit integer,
then the payload. Everything here is a native column expression, so framing
and unframing stay inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADER_BYTES = 5


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip_header(value: Column | str) -> Column:
    """Payload behind the header; too-short values give empty binary, NULL stays NULL."""
    value = _column(value)
    return F.substring(value, HEADER_BYTES + 1, F.length(value) - HEADER_BYTES)


def magic_byte(value: Column | str) -> Column:
    """First byte as two hex digits."""
    return F.hex(F.substring(_column(value), 1, 1))


def has_header(value: Column | str) -> Column:
    """True when the value is long enough and opens with the zero byte."""
    value = _column(value)
    return (F.length(value) >= HEADER_BYTES) & (magic_byte(value) == "00")


def schema_id(value: Column | str) -> Column:
    """Writer schema id, or NULL when the header is missing or truncated."""
    value = _column(value)
    digits = F.hex(F.substring(value, 2, 4))
    return F.when(has_header(value), F.conv(digits, 16, 10).cast("bigint"))


def add_header(payload: Column | str, writer_schema_id: Column | int) -> Column:
    """Frame a binary payload; a NULL payload stays NULL (a tombstone)."""
    ident = writer_schema_id if isinstance(writer_schema_id, Column) else F.lit(writer_schema_id)
    ident_bytes = F.unhex(F.lpad(F.hex(ident.cast("bigint")), 8, "0"))
    return F.concat(F.unhex(F.lit("00")), ident_bytes, _column(payload))
