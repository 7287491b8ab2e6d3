from __future__ import annotations

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemill.functions import (
    add_header,
    decode_payload,
    encode_payload,
    epoch_millis,
    event_time,
    has_header,
    magic_byte,
    schema_id,
    strip_header,
    utc_wall_clock,
)


def one(spark, value, *columns):
    df = spark.createDataFrame([(value,)], "value BINARY")
    return df.select(*columns).first()


@pytest.mark.parametrize(
    ("value", "payload"),
    [
        (bytes.fromhex("0000000007AABB"), b"\xaa\xbb"),
        (bytes.fromhex("0000000007"), b""),
        (b"\x00\x01", b""),
        (b"", b""),
        (None, None),
    ],
)
def test_strip_header(spark, value, payload):
    got = one(spark, value, strip_header("value").alias("p"))["p"]
    assert (bytes(got) if got is not None else None) == payload


@pytest.mark.parametrize(
    ("value", "ident", "framed"),
    [
        (bytes.fromhex("0000000007AABB"), 7, True),
        (bytes.fromhex("00FFFFFFFF"), 2**32 - 1, True),
        (bytes.fromhex("0100000007AA"), None, False),
        (b"\x00\x01", None, False),
        (None, None, None),
    ],
)
def test_schema_id(spark, value, ident, framed):
    row = one(spark, value, schema_id("value").alias("i"), has_header("value").alias("h"))
    assert row["i"] == ident
    assert row["h"] is framed


def test_magic_byte(spark):
    assert one(spark, b"\x0a\x01", magic_byte("value").alias("m"))["m"] == "0A"


@pytest.mark.parametrize("ident", [0, 7, 65536, 2**31 - 1])
def test_frame_round_trip_of_json(spark, ident):
    schema = "name STRING, tags ARRAY<STRING>, amount DOUBLE, note STRING"
    record = ("ä", ["x", "y"], 1.25, None)
    df = spark.createDataFrame([record], schema)
    framed = df.select(add_header(encode_payload(F.struct(*df.columns)), ident).alias("value"))
    row = framed.select(
        schema_id("value").alias("i"),
        decode_payload(strip_header("value"), schema).alias("d"),
    ).first()
    assert row["i"] == ident
    assert tuple(row["d"]) == record


def test_null_payload_stays_null(spark):
    assert one(spark, None, add_header("value", 7).alias("v"))["v"] is None


def test_decode_modes(spark):
    schema = "a STRING, b DOUBLE"

    def decode(value, mode):
        return one(spark, value, decode_payload(F.col("value"), schema, mode=mode).alias("d"))["d"]

    assert tuple(decode(b"garbage", "PERMISSIVE")) == (None, None)
    assert decode(None, "FAILFAST") is None
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        decode(b"garbage", "FAILFAST")
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        decode(b'{"a": "x", "b": ', "FAILFAST")


def test_corrupt_column_catches_truncated_records(spark):
    schema = "a STRING, b DOUBLE, _bad STRING"
    decoded = decode_payload(F.col("value"), schema, mode="PERMISSIVE", corrupt_column="_bad")
    assert one(spark, b'{"a": "x", "b": 1', decoded.alias("d"))["d"]["_bad"] is not None
    assert one(spark, b'{"a": "x", "b": 1}', decoded.alias("d"))["d"]["_bad"] is None


def test_unknown_codec():
    with pytest.raises(ValueError, match="codec"):
        encode_payload(None, "xml")


def test_event_time_keeps_milliseconds(spark):
    row = spark.range(1).select(event_time(F.lit(1704067200123)).alias("t")).first()
    assert row["t"].astimezone(UTC) == datetime(2024, 1, 1, 0, 0, 0, 123000, tzinfo=UTC)


@pytest.mark.parametrize(
    "text",
    [
        "2024-03-10 02:30:00.123",  # skipped by New York clocks
        "2024-11-03 01:30:00.999",  # read twice by New York clocks
        "2024-07-01 12:00:59.001",
        "1969-12-31 23:59:59.999",
        "1900-01-01 00:00:00.000",
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_conversions_ignore_the_session_zone(spark, zone, text):
    expected = datetime.fromisoformat(text).replace(tzinfo=UTC) - datetime(1970, 1, 1, tzinfo=UTC)
    expected_ms = expected // timedelta(milliseconds=1)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'" + text + "456' AS ts")
        ms = df.select(epoch_millis(df, "ts").alias("ms")).first()["ms"]
        assert ms == expected_ms
        back = utc_wall_clock(df.select(event_time(F.lit(ms)).alias("ts")), "ts")
        assert back.first()["ts"] == datetime.fromisoformat(text)
        instants = df.select(event_time(F.lit(ms)).alias("ts"))
        assert instants.select(epoch_millis(instants, "ts")).first()[0] == ms
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
