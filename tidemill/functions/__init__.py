"""Column-level building blocks: wire framing, payload codecs, event time."""

from tidemill.functions.codecs import decode_payload, encode_payload
from tidemill.functions.framing import (
    add_header,
    has_header,
    magic_byte,
    schema_id,
    strip_header,
)
from tidemill.functions.timing import epoch_millis, event_time, utc_wall_clock

__all__ = [
    "add_header",
    "decode_payload",
    "encode_payload",
    "epoch_millis",
    "event_time",
    "has_header",
    "magic_byte",
    "schema_id",
    "strip_header",
    "utc_wall_clock",
]
