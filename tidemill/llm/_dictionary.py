"""Questions about keys that many rows share, asked once for each chunk of rows.

A task goes through its rows in chunks, bounded in text bytes. What it has to ask about
(words, pairs of ids) goes into a dictionary of the chunk, each key once, and the rows keep
positions in it. The chunks are written to a table. Keys are then joined with a table of
answers, and the answers meet their chunk again by its number. A key is sent
once for each chunk that has it, however often it occurs there, so none has more than a small
share of the rows of any join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Text bytes of a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Of messages between chunks and tables, which go to disk more than once.
COMPRESSION = 9


def text_chunks(batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Numbered runs of rows of Arrow batches with a column ``text``; no run crosses a batch.

    Numbers are unique in the stage. They need not be the same in another run, as the result
    is written once.
    """
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        column = batch.column("text").cast(pa.large_binary())
        lengths = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(batch) + 1])
        start = size = 0
        for i, length in enumerate(lengths.tolist()):
            if i > start and size + length > limit:
                yield number, batch.slice(start, i - start)
                number, start, size = number + 1, i, 0
            size += length
        if len(batch) > start:
            yield number, batch.slice(start)
            number += 1


def compressed(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=COMPRESSION).compress(data, asbytes=True)


def packed(values: np.ndarray) -> bytes:
    """32-bit values, compressed by place: the high bytes of small numbers are all alike."""
    places = np.ascontiguousarray(values, "<i4").view(np.uint8).reshape(-1, 4).T
    return compressed(np.ascontiguousarray(places).tobytes())


def unpacked(code: bytes, count: int) -> np.ndarray:
    if not count:
        return np.zeros(0, np.int32)
    places = np.frombuffer(pa.decompress(code, 4 * count, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(places.reshape(4, count).T).view("<i4").ravel()


def entries(chunks: DataFrame) -> DataFrame:
    """(chunk, place, key) of all dictionaries; ``chunks`` has chunk long and keys array."""
    return chunks.select("chunk", F.posexplode("keys").alias("place", "key"))


def meet(chunks: DataFrame, answers: DataFrame, finish: Callable, schema: str | StructType) -> DataFrame:
    """Each chunk with its answers: ``finish(rows of the chunk, answers by place)`` in Arrow.

    ``answers`` has chunk, place and what was asked for, one row for each entry. Spark sorts
    both sides by chunk and hands over one chunk at a time.
    """

    def one(rows: pa.Table, found: pa.Table) -> pa.Table:
        if not len(rows):
            raise RuntimeError("answers to a chunk that is not there")
        if len(found) != rows["n_keys"][0].as_py():
            raise RuntimeError("a dictionary entry has no answer")
        order = np.argsort(found["place"].to_numpy())
        return finish(rows, found.take(pa.array(order)))

    chunks = chunks.withColumn("n_keys", F.size("keys")).drop("keys")
    answers = answers.withColumnRenamed("chunk", "asked_by")
    return chunks.groupBy("chunk").cogroup(answers.groupBy("asked_by")).applyInArrow(one, schema)
