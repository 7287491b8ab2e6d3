"""DataFrame-to-DataFrame transforms; each works on batch and streaming input."""

from tidemill.operators.decode import (
    Judged,
    decode_by_schema_id,
    decode_messages,
    encode_messages,
    frame_header,
    judge_messages,
    split_decodable,
)
from tidemill.operators.dedup import first_per_key
from tidemill.operators.merge import merge_with_delta, rows_to_insert
from tidemill.operators.quality import RULES, rule_violations
from tidemill.operators.windowed import (
    DEFAULT_WATERMARK,
    DEFAULT_WINDOW,
    windowed_aggregate,
)

__all__ = [
    "DEFAULT_WATERMARK",
    "DEFAULT_WINDOW",
    "Judged",
    "RULES",
    "decode_by_schema_id",
    "decode_messages",
    "encode_messages",
    "first_per_key",
    "frame_header",
    "judge_messages",
    "merge_with_delta",
    "rows_to_insert",
    "rule_violations",
    "split_decodable",
    "windowed_aggregate",
]
