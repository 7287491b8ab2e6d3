"""Questions about hashes between partitions, answered without gathering documents.

Documents are read in chunks: runs of rows of one partition, bounded in text bytes and
rows. A chunk's number is a function of the partition and of the row order alone, so
later scans of the same table cut the same chunks. A chunk sends sorted,
Golomb-Rice-coded hashes to the owners of the hash ranges; answers come back per chunk
and meet its rows again (``with_answers``). Only there are texts shuffled, packed by chunk.

The input must give the same rows in the same order whenever it is read: a table,
projected or filtered. A result of joins or aggregations has to be written to a table
first. A chunk that changed between the scans raises an error.
"""

from __future__ import annotations

import ctypes
import gc
import io
import struct
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Text bytes of a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 2 << 20
CHUNK_ROWS = 1 << 16
#: Hashes that one owner gets on average.
HASHES_PER_OWNER = 1 << 20


def pin_splits(docs: DataFrame) -> None:
    """Keep the number of splits of file scans in this session independent of the executors alive.

    Spark cuts small tables by the number of cores it sees when it plans a scan, which
    changes if an executor is lost between two scans.
    """
    spark = docs.sparkSession
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))


def encode_sorted(values: np.ndarray) -> bytes:
    """Golomb-Rice code of ascending 64-bit values: quotients in unary, then remainders."""
    n = len(values)
    if not n:
        return struct.pack("<IB", 0, 0)
    gaps = np.diff(values, prepend=np.uint64(0))
    width = max(0, int(values[-1] // np.uint64(n)).bit_length() - 1)
    quotients = (gaps >> np.uint64(width)).astype(np.int64)
    unary = np.ones(int(quotients.sum()) + n, np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    shifts = np.arange(width, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    head = struct.pack("<IBI", n, width, len(unary))
    return head + np.packbits(unary).tobytes() + np.packbits(rest.ravel()).tobytes()


def decode_sorted(code: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<IB", code)
    if not n:
        return np.zeros(0, np.uint64)
    (length,) = struct.unpack_from("<I", code, 5)
    at = 9 + (length + 7) // 8
    unary = np.unpackbits(np.frombuffer(code, np.uint8, (length + 7) // 8, 9), count=length)
    quotients = np.diff(np.flatnonzero(unary == 0), prepend=-1) - 1
    gaps = quotients.astype(np.uint64) << np.uint64(width)
    if width:
        bits = np.unpackbits(np.frombuffer(code, np.uint8, offset=at), count=n * width)
        places = np.uint64(1) << np.arange(width, dtype=np.uint64)
        gaps += (bits.reshape(n, width) * places).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def give_back() -> None:
    """Return free memory to the system: Python workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def chunks(batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Table]]:
    """Numbered runs of rows; where they end depends on the rows alone, not on the batches."""
    partition = TaskContext.get().partitionId()
    held: list[pa.RecordBatch] = []
    rows = size = ordinal = 0

    def closed() -> tuple[int, pa.Table]:
        return (partition << 20) | ordinal, pa.Table.from_batches(held)

    for batch in batches:
        lengths = batch.column("text").cast(pa.large_binary())
        lengths = np.diff(np.frombuffer(lengths.buffers()[1], np.int64)[lengths.offset :][: len(batch) + 1])
        start = 0
        for i, length in enumerate(lengths.tolist()):
            if rows and (size + length > limit or rows == CHUNK_ROWS):
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield closed()
                held, start, rows, size, ordinal = [], i, 0, 0, ordinal + 1
            rows, size = rows + 1, size + length
        if len(batch) > start:
            held.append(batch.slice(start))
    if held:
        yield closed()
    held = []
    give_back()


def row_address(chunk: int, row: int | np.ndarray) -> int | np.ndarray:
    return (chunk << 16) | row


def owners_for(rows: int, per_row: float = 1.0) -> int:
    return int(rows * per_row) // HASHES_PER_OWNER + 1


def letters(chunk: int, hashes: np.ndarray, owners: int) -> Iterator[tuple[int, int, bytes]]:
    """(owner, chunk, code) for ascending distinct hashes; one empty letter if there are none.

    Owners have equal ranges of the hash values.
    """
    edges = owner_edges(hashes, owners)
    sent = False
    for owner in np.flatnonzero(np.diff(edges)).tolist():
        sent = True
        yield owner, chunk, encode_sorted(hashes[edges[owner] : edges[owner + 1]])
    if not sent:
        yield chunk % owners, chunk, encode_sorted(hashes[:0])


def owner_edges(hashes: np.ndarray, owners: int) -> np.ndarray:
    """Where each owner's part of ascending hashes starts, and the end."""
    return np.concatenate(([0], np.searchsorted(hashes, _bounds(owners)), [len(hashes)]))


def owner_of(hashes: np.ndarray, owners: int) -> np.ndarray:
    return np.searchsorted(_bounds(owners), hashes, side="right")


def _bounds(owners: int) -> np.ndarray:
    step = (1 << 64) // owners + 1
    return np.array([o * step for o in range(1, owners)], np.uint64)


def shared_hashes(letters_df: DataFrame) -> DataFrame:
    """Answers (chunk, part, answer): a bit per hash, set if another chunk has it too."""

    def answer(table: pa.Table) -> pa.Table:
        sets = [decode_sorted(code) for code in table["code"].to_pylist()]
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        repeated = values[counts > 1]
        bits = [np.packbits(_in_sorted(s, repeated)).tobytes() for s in sets]
        answers = [struct.pack("<I", len(s)) + b for s, b in zip(sets, bits, strict=True)]
        del sets, values, counts, bits
        give_back()
        return pa.table({"chunk": table["chunk"].cast(pa.int64()), "part": table["owner"].cast(pa.int32()), "answer": pa.array(answers, pa.binary())})

    return letters_df.groupBy("owner").applyInArrow(answer, "chunk long, part int, answer binary")


def _in_sorted(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


def read_bits(hashes: np.ndarray, owners: int, answers: dict[int, bytes]) -> np.ndarray:
    """Undo ``letters`` for the answers of ``shared_hashes``: a flag per hash."""
    edges = owner_edges(hashes, owners)
    flags = np.zeros(len(hashes), bool)
    for owner in np.flatnonzero(np.diff(edges)).tolist():
        a, b = int(edges[owner]), int(edges[owner + 1])
        answer = answers.get(owner)
        if answer is None or struct.unpack_from("<I", answer)[0] != b - a:
            raise RuntimeError("the input changed between two scans: write it to a table first")
        flags[a:b] = np.unpackbits(np.frombuffer(answer, np.uint8, offset=4), count=b - a)
    return flags


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressed = pa.ipc.IpcWriteOptions(compression="zstd")
    for chunk, table in chunks(batches):
        body = io.BytesIO()
        with pa.ipc.new_stream(body, table.schema, options=compressed) as writer:
            writer.write_table(table)
        yield pa.record_batch({"chunk": pa.array([chunk], pa.int64()), "body": pa.array([body.getvalue()], pa.binary())})


#: A chunk, its rows, and its answers by part.
Met = tuple[int, pa.Table, dict[int, bytes]]


def with_answers(
    docs: DataFrame, answers: DataFrame, work: Callable[[Iterable[Met]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``work`` on each chunk of ``docs`` together with what was answered to it, as rows of ``schema``.

    ``answers`` has (chunk, part, answer) with at least one row for every chunk. Chunks are packed and
    shuffled to their answers, so that a task has one Python worker and one chunk at a time.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    nothing = to_arrow_schema(schema).empty_table()

    def one(rows: pa.Table, found: pa.Table) -> pa.Table:
        if len(rows) != 1 or not len(found):
            raise RuntimeError("the input changed between two scans: write it to a table first")
        by_part = dict(zip(found["part"].to_pylist(), found["answer"].to_pylist(), strict=True))
        table = pa.ipc.open_stream(rows["body"][0].as_buffer()).read_all()
        batches = [b for b in work([(rows["chunk"][0].as_py(), table, by_part)]) if len(b)]
        result = pa.Table.from_batches(batches) if batches else nothing
        del table, batches, by_part
        give_back()
        return result

    packed = docs.mapInArrow(_packed, "chunk long, body binary")
    answers = answers.select(F.col("chunk").alias("asked_by"), "part", "answer")
    return packed.groupBy("chunk").cogroup(answers.groupBy("asked_by")).applyInArrow(one, schema)
