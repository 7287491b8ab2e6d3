"""Payload schemas kept in a table: subject, version, schema_id, schema text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class SchemaNotFound(LookupError):
    """The subject or schema id is not in the table."""


def latest_schema(schemas: DataFrame, subject: str) -> str:
    """Schema text of the highest version of a subject."""
    row = (
        schemas.filter(F.col("subject") == subject)
        .agg(F.max_by("schema", "version").alias("schema"))
        .first()
    )
    if row is None or row["schema"] is None:
        raise SchemaNotFound(subject)
    return row["schema"]


def schemas_by_id(schemas: DataFrame, subject: str) -> dict[int, StructType]:
    """All schemas a subject ever had, by id; DDL text. There are as many as versions."""
    rows = schemas.filter(F.col("subject") == subject).select("schema_id", "schema").collect()
    if not rows:
        raise SchemaNotFound(subject)
    return {r["schema_id"]: StructType.fromDDL(r["schema"]) for r in rows}
