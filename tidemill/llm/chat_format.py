"""Chat formatting with a grammar round trip.

Grammar of formatted text:

    conversation = { turn }
    turn         = "### " role ": " text " </turn>" newline
    control      = "### " [A-Za-z0-9_%]* ":"  |  "</turn>"

Inside a text, 2k+1 backslashes before a control string stand for k backslashes and the string;
an even number is a syntax error, since the string would then be a control. The
parser is deterministic: it reads a header, then text up to the first control that is not escaped.

Rendering writes a text as it is, parses the result and compares. Only if the turn read back
differs are its control strings escaped, and it is parsed again; a turn that still
differs is an error, never output.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = r"### [A-Za-z0-9_%]*:|</turn>"
_CONTROL = re.compile(rf"(\\*)({CONTROL})")
_HEADER = re.compile(r"### ([A-Za-z0-9_%]*): ")
_END = " </turn>\n"
_ROLE = re.compile(rb"[^A-Za-z0-9_]")
#: The role whose texts are trained on.
TRAINED_ROLE = "assistant"


class FormatError(ValueError):
    """Formatted text that the grammar does not allow, or that does not read back as its source."""


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\1\\\2", text)


def _unescape(match: re.Match) -> str:
    return match[1][: len(match[1]) // 2] + match[2]


def _write_role(role: str) -> str:
    if role.isascii() and role.islower() and role.isalpha():
        return role.capitalize()
    return "_" + _ROLE.sub(lambda m: b"%%%02X" % m[0][0], role.encode()).decode()


def _read_role(name: str) -> str:
    if not name.startswith("_"):
        return name.lower()
    return re.sub(rb"%(..)", lambda m: bytes([int(m[1], 16)]), name[1:].encode()).decode()


def render_raw(role: str, text: str) -> str:
    return f"### {_write_role(role)}: {text}{_END}"


@dataclass
class Parser:
    """Reads turns from formatted text that arrives in pieces; holds one turn at most."""

    _held: str = field(default="", repr=False)

    def feed(self, piece: str) -> Iterator[tuple[str, str, str]]:
        """(role, text, text as written) of each turn that is complete."""
        self._held += piece
        at = 0
        while at < len(self._held):
            header = _HEADER.match(self._held, at)
            if header is None:
                break
            end = None
            for found in _CONTROL.finditer(self._held, header.end()):
                if len(found[1]) % 2 == 0:
                    end = found
                    break
            if end is None:
                break
            stop = end.start(2) - 1
            # The space before the end mark belongs to it, and no backslash may stand between.
            if end[2] != "</turn>" or end[1] or stop < header.end() or self._held[stop : stop + len(_END)] != _END:
                raise FormatError("a control string inside a text is not escaped")
            written = self._held[header.end() : stop]
            yield _read_role(header[1]), _CONTROL.sub(_unescape, written), written
            at = stop + len(_END)
        self._held = self._held[at:]

    def close(self) -> None:
        if self._held:
            raise FormatError("the text ends inside a turn")


def parse(formatted: str) -> list[tuple[str, str]]:
    parser = Parser()
    turns = [(role, text) for role, text, _ in parser.feed(formatted)]
    parser.close()
    return turns


def render(role: str, text: str) -> str:
    """One turn, escaped only if it would not read back otherwise."""
    plain = render_raw(role, text)
    if _reads_back(plain, role, text):
        return plain
    escaped = render_raw(role, escape(text))
    if not _reads_back(escaped, role, text):
        raise FormatError("the turn cannot be written reversibly")
    return escaped


def _reads_back(formatted: str, role: str, text: str) -> bool:
    try:
        return parse(formatted) == [(role, text)]
    except FormatError:
        return False


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, formatted, loss_start, loss_end) for every row of ``turns``.

    ``formatted`` is the rendered turn; the conversation is their concatenation by turn.
    ``loss_start`` and ``loss_end`` are the code points of ``formatted`` that are trained on,
    equal where there are none. Null role and text count as empty; an empty
    conversation does not exist. Rows are independent: no shuffle, so a conversation may have
    any length. Other columns are not looked at.
    """

    def formatted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = batch["role"].to_pylist(), batch["text"].to_pylist()
            out = [render(r, t) for r, t in zip(roles, texts, strict=True)]
            starts = [len(f"### {_write_role(r)}: ") for r in roles]
            ends = [len(o) - len(_END) if r == TRAINED_ROLE else s for o, s, r in zip(out, starts, roles, strict=True)]
            columns = [*batch.columns, pa.array(out, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())]
            yield pa.record_batch(columns, [*batch.schema.names, "formatted", "loss_start", "loss_end"])

    rows = turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    schema = "conv_id long, turn long, role string, text string, formatted string, loss_start long, loss_end long"
    return rows.mapInArrow(formatted, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation as the parser reads it from the formatted text.

    ``formatted`` has conv_id, turn, formatted, loss_start, loss_end (see ``format_turns``).
    Turns of a conversation come together sorted by (turn, formatted), nulls first, and are read
    as a stream: a task holds one turn, however long the conversation. A null
    conv_id is one conversation of its own. Repeated rows are turns of their own.
    """

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        current: object = digests  # no conversation yet
        parser, n, length, lost = Parser(), 0, 0, 0
        turns, loss = hashlib.sha256(), hashlib.sha256()

        def close() -> None:
            parser.close()
            done.append((current, n, turns.hexdigest(), lost, loss.hexdigest(), length))

        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end"))
            for conv, piece, start, end in zip(*columns, strict=True):
                if conv != current:
                    if current is not digests:
                        close()
                    current, parser, n, length, lost = conv, Parser(), 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, text, _ in parser.feed(piece):
                    turns.update(f"{role}\n{text}\n".encode())
                    n += 1
                masked = _CONTROL.sub(_unescape, piece[start:end])
                loss.update(masked.encode())
                length, lost = length + len(piece), lost + len(masked)
            if len(done) >= 1000:
                yield _conversations(done)
                done = []
        if current is not digests:
            close()
        yield _conversations(done)

    ordered = formatted.select("conv_id", "turn", "formatted", "loss_start", "loss_end").repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "turn", "formatted").mapInArrow(digests, _READ)


_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _conversations(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)
