"""Payload codecs: Avro when the spark-avro package is on the classpath, JSON otherwise.

Both decode in FAILFAST mode unless told otherwise: a malformed payload fails
the query, a NULL payload decodes to a NULL struct.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CODECS = ("json", "avro")


def _check(codec: str) -> None:
    if codec not in CODECS:
        raise ValueError(f"unknown codec {codec!r}; expected one of {CODECS}")


def decode_payload(
    payload: Column,
    schema: StructType | str,
    codec: str = "json",
    mode: str = "FAILFAST",
    corrupt_column: str | None = None,
) -> Column:
    """Decode a binary payload into a struct.

    ``schema`` is a StructType or DDL string for JSON and the Avro schema text
    for Avro. ``corrupt_column`` (JSON, PERMISSIVE) names a string field of
    ``schema`` that receives the raw text of records which do not parse.
    """
    _check(codec)
    options = {"mode": mode}
    if codec == "avro":
        from pyspark.sql.avro.functions import from_avro

        return from_avro(payload, schema, options)
    if corrupt_column:
        options["columnNameOfCorruptRecord"] = corrupt_column
    return F.from_json(payload.cast("string"), schema, options)


def encode_payload(record: Column, codec: str = "json", schema: str | None = None) -> Column:
    """Encode a struct column as a binary payload."""
    _check(codec)
    if codec == "avro":
        from pyspark.sql.avro.functions import to_avro

        return to_avro(record, schema) if schema else to_avro(record)
    return F.to_json(record).cast("binary")
