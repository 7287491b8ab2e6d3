"""From framed messages to typed rows, and back.

Messages have the columns of Spark's Kafka source: key, value, topic,
partition, offset, timestamp, timestampType. All functions here take and
return DataFrames and work on batch and streaming input alike; none shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from tidemill.functions import (
    add_header,
    decode_payload,
    encode_payload,
    has_header,
    magic_byte,
    schema_id,
    strip_header,
)

_CORRUPT = "_corrupt_record"
#: Name under which a query's progress reports messages and rejected messages.
DECODE_METRICS = "decoded_messages"


def _source_columns() -> list[Column]:
    return [
        F.col("partition"),
        F.col("offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    ]


def _flatten(messages: DataFrame, decoded: Column) -> DataFrame:
    return (
        messages.select(decoded.alias("decoded"), *_source_columns())
        .select("decoded.*", "partition", "offset", "kafka_timestamp")
        .withColumn("ingested_at", F.current_timestamp())
    )


def decode_messages(
    messages: DataFrame, schema: StructType | str, codec: str = "json", mode: str = "FAILFAST"
) -> DataFrame:
    """Strip the header, decode the payload with one schema, add source columns.

    The schema id in the header is ignored, so one reader schema serves the
    whole topic. A malformed payload fails the query; a NULL value yields a row
    whose payload columns are all NULL.
    """
    payload = strip_header("value")
    return _flatten(messages, decode_payload(payload, schema, codec, mode))


def decode_by_schema_id(
    messages: DataFrame,
    schemas: Mapping[int, StructType],
    codec: str = "json",
    avro_schemas: Mapping[int, str] | None = None,
) -> DataFrame:
    """Decode every message with the schema its header names, in one pass.

    The result has the union of the fields, NULL where a writer schema lacks
    one. A schema id that is not in ``schemas`` fails the query. For Avro,
    ``avro_schemas`` holds the writer schema texts by id.
    """
    fields = _merge_fields(schemas)
    ident = F.col("_schema_id")
    prepared = messages.withColumns(
        {"_schema_id": schema_id("value"), "_payload": strip_header("value")}
    )
    # One column per writer schema, so that each payload is parsed once.
    prepared = prepared.withColumns(
        {
            f"_record_{number}": F.when(
                ident == number,
                decode_payload(
                    F.col("_payload"),
                    avro_schemas[number] if codec == "avro" else schema,
                    codec,
                ),
            )
            for number, schema in schemas.items()
        }
    )
    unknown = F.raise_error(
        F.concat(F.lit("no schema for id "), F.coalesce(ident.cast("string"), F.lit("?")))
    ).cast(StructType(fields))
    decoded = F.when(F.col("value").isNull(), F.lit(None).cast(StructType(fields)))
    for number, schema in sorted(schemas.items()):
        record = F.col(f"_record_{number}")
        decoded = decoded.when(
            ident == number, F.when(record.isNotNull(), _widen(record, schema, fields))
        )
    return _flatten(prepared, decoded.otherwise(unknown))


#: Types that a reader may take for another: each for those after it in its row.
_PROMOTIONS = (("int", "bigint", "double"), ("int", "float", "double"), ("bigint", "float"))


def _wider(name: str, one: DataType, other: DataType) -> DataType:
    """The type that holds values of both, as far as schema evolution allows."""
    if one == other:
        return one
    for row in _PROMOTIONS:
        if one.simpleString() in row and other.simpleString() in row:
            return max(one, other, key=lambda kind: row.index(kind.simpleString()))
    raise ValueError(f"field {name} changes type between schema ids")


def _merge_fields(schemas: Mapping[int, StructType]) -> list[StructField]:
    merged: dict[str, StructField] = {}
    for _, schema in sorted(schemas.items()):
        for item in schema.fields:
            known = merged.get(item.name)
            kind = _wider(item.name, known.dataType, item.dataType) if known else item.dataType
            merged[item.name] = StructField(item.name, kind, True)
    if not merged:
        raise ValueError("no schemas given")
    return list(merged.values())


def _widen(decoded: Column, schema: StructType, fields: list[StructField]) -> Column:
    own = set(schema.names)
    return F.struct(
        *(
            (decoded[f.name] if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in fields
        )
    )


@dataclass(frozen=True)
class Judged:
    """Messages with their decoded payload and, where it is no good, the reason."""

    rows: DataFrame
    fields: list[StructField]

    def accepted(self, rows: DataFrame) -> DataFrame:
        """The decoded rows of ``rows``, which is :attr:`rows` or a micro-batch of it."""
        good = rows.filter("reason IS NULL")
        return _flatten(good, F.struct(*(F.col("decoded")[f.name].alias(f.name) for f in self.fields)))

    def rejected(self, rows: DataFrame) -> DataFrame:
        """The raw messages of ``rows`` that do not decode."""
        return rows.filter("reason IS NOT NULL").select(
            "topic",
            "partition",
            "offset",
            F.col("timestamp").alias("kafka_timestamp"),
            "key",
            "value",
            schema_id("value").alias("schema_id"),
            "reason",
            F.current_timestamp().alias("quarantined_at"),
        )


def judge_messages(
    messages: DataFrame,
    schema: StructType | str,
    required: str = "event_id",
    codec: str = "json",
    avro_schema: str | None = None,
    schemas_by_id: Mapping[int, StructType] | None = None,
    avro_schemas_by_id: Mapping[int, str] | None = None,
) -> Judged:
    """Decode messages, and say of each that does not decode why.

    A message is rejected when its header is missing, when its header names a schema
    that is not among ``schemas_by_id`` (if given), when its payload does not parse, or
    when the required field comes out NULL. Tombstones (NULL value) are not rejected:
    they pass as rows of NULLs, as in :func:`decode_messages`. Every payload is parsed once.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    by_id = {n: (s, (avro_schemas_by_id or {}).get(n)) for n, s in (schemas_by_id or {}).items()}
    rows, fields = _judge(messages, by_id or {None: (schema, avro_schema)}, required, codec)
    # What the parts are made of; helper columns and the key of each attempt end here.
    return Judged(rows.select(*messages.columns, "decoded", "reason"), fields)


def split_decodable(messages: DataFrame, *arguments, **options) -> tuple[DataFrame, DataFrame]:
    """Rows that decode, and raw messages that do not; arguments of :func:`judge_messages`."""
    judged = judge_messages(messages, *arguments, **options)
    return judged.accepted(judged.rows), judged.rejected(judged.rows)


def _judge(
    messages: DataFrame,
    schemas: Mapping[int | None, tuple[StructType, str | None]],
    required: str,
    codec: str,
) -> tuple[DataFrame, list[StructField]]:
    """Messages with ``decoded`` and ``reason``; a schema under None reads every message."""
    fields = _merge_fields({n or 0: s for n, (s, _) in schemas.items()})
    prepared = messages.withColumns(
        {"_schema_id": schema_id("value"), "_payload": strip_header("value")}
    )
    attempts, decoded, broken, known = {}, [], [], F.lit(False)
    for number, (schema, text) in schemas.items():
        applies = F.lit(True) if number is None else F.col("_schema_id") == number
        name = f"_record_{'any' if number is None else number}"
        if codec == "avro":
            attempt = decode_payload(F.col("_payload"), text, codec, "PERMISSIVE")
            # A broken record comes out as NULL or as a struct of NULLs.
            failed = reduce(and_, (F.col(name)[f].isNull() for f in schema.names))
        else:
            reading = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
            attempt = decode_payload(F.col("_payload"), reading, codec, "PERMISSIVE", _CORRUPT)
            failed = F.col(name)[_CORRUPT].isNotNull()
        attempts[name] = F.when(applies, attempt)
        decoded.append(F.when(applies, _widen(F.col(name), schema, fields)))
        broken.append(applies & failed)
        known = known | applies
    verdict = F.when(
        F.col("value").isNotNull(),
        F.when(~has_header("value"), "bad_header")
        .when(~F.coalesce(known, F.lit(False)), "unknown_schema")
        .when(reduce(or_, broken), "malformed_payload")
        .when(F.col("decoded")[required].isNull(), "missing_key"),
    )
    prepared = prepared.withColumns(attempts).withColumn("decoded", F.coalesce(*decoded))
    judged = prepared.withColumn("reason", verdict)
    # Counting here shows up in the query's progress; it also keeps filters on
    # the verdict above the decoding, which would otherwise be done once for
    # the filter and once more for the result.
    observed = judged.observe(
        DECODE_METRICS,
        F.count(F.lit(1)).alias("messages"),
        F.count("reason").alias("rejected"),
    )
    return observed, fields


def frame_header(messages: DataFrame) -> DataFrame:
    """Magic byte, writer schema id and header check next to the source position."""
    return messages.select(
        "topic",
        "partition",
        "offset",
        magic_byte("value").alias("magic"),
        has_header("value").alias("framed"),
        schema_id("value").alias("schema_id"),
    )


def encode_messages(
    events: DataFrame,
    payload_columns: list[str],
    key: str,
    topic: str,
    writer_schema_id: Column | int = 1,
    codec: str = "json",
    partition: str = "source_partition",
    offset: str = "source_offset",
    timestamp: str = "source_timestamp",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Frame events as messages of a topic (the producer side).

    A Kafka sink needs only key, value and topic; partition, offset and
    timestamp come from the named columns so that a stored topic has them too.
    ``keep`` passes further columns through.
    """
    payload = encode_payload(F.struct(*payload_columns), codec)
    return events.select(
        F.col(key).cast("binary").alias("key"),
        add_header(payload, writer_schema_id).alias("value"),
        F.lit(topic).alias("topic"),
        F.col(partition).cast("int").alias("partition"),
        F.col(offset).cast("bigint").alias("offset"),
        F.col(timestamp).alias("timestamp"),
        F.lit(0).alias("timestampType"),
        *keep,
    )
