"""Exact deduplication by a Golomb-coded exchange of fingerprints.

1. Each chunk of rows sends the sorted, Golomb-Rice-coded fingerprints of its texts to
   the owners of the fingerprint ranges. A fingerprint is sent once per chunk, so a
   text that a third of all rows share costs its owner one entry per chunk.
2. Owners answer with a bit per fingerprint: some other chunk has it too.
3. The chunks' rows meet the answers in place. Only texts whose fingerprint repeats are
   shuffled, once per chunk, and grouped by their bytes. Fingerprints never decide.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm._exchange import (
    Met,
    chunks,
    letters,
    owners_for,
    pin_splits,
    read_bits,
    row_address,
    shared_hashes,
    with_answers,
)
from tidemill.llm._scratch import spool
from tidemill.llm._text import utf8

_BLANKS = re.compile(rb"[\x20\x09-\x0D]+")


def _digests(table: pa.Table) -> tuple[list[bytes], list[bytes]]:
    texts = [_BLANKS.sub(b" ", t) for t in utf8(table["text"])]
    return texts, [hashlib.sha256(t).digest() for t in texts]


def _fingerprints(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8] for d in digests), ">u8").astype(np.uint64)


def _sent(owners: int):
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, table in chunks(batches):
            hashes = np.unique(_fingerprints(_digests(table)[1]))
            owner, sender, code = zip(*letters(chunk, hashes, owners), strict=True)
            yield pa.record_batch({"owner": pa.array(owner, pa.int32()), "chunk": pa.array(sender, pa.int64()), "code": pa.array(code, pa.binary())})

    return send


_LETTER = "owner int, chunk long, code binary"
_JUDGED = "sha string, ids array<long>, rows array<long>, text binary"


def _judged(owners: int):
    """A row per chunk and text: its rows, and its bytes only where they may repeat."""

    def judge(met: Iterable[Met]) -> Iterator[pa.RecordBatch]:
        for chunk, table, answers in met:
            texts, digests = _digests(table)
            prints = _fingerprints(digests)
            distinct, inverse, counts = np.unique(prints, return_inverse=True, return_counts=True)
            suspect = (read_bits(distinct, owners, answers) | (counts > 1))[inverse]
            groups: dict[bytes, list[int]] = {}
            for row, text in enumerate(texts):
                groups.setdefault(text, []).append(row)
            ids = table["doc_id"].cast(pa.int64()).to_pylist()
            firsts = [rows[0] for rows in groups.values()]
            yield pa.record_batch(
                {
                    "sha": pa.array([digests[r].hex() for r in firsts]),
                    "ids": pa.array([[ids[r] for r in rows] for rows in groups.values()], pa.list_(pa.int64())),
                    "rows": pa.array([[row_address(chunk, r) for r in rows] for rows in groups.values()], pa.list_(pa.int64())),
                    "text": pa.array([texts[r] if suspect[r] else None for r in firsts], pa.binary()),
                }
            )

    return judge


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): class and survivor of its text.

    Returns doc_id, keep_id, group_size, kept, text_sha256 and ``row``, the row's address in
    the input (see ``_exchange``). Texts are equal if their bytes are, after every run of
    white space has become one space; null counts as empty, and empty texts are equal to
    each other. The smallest doc_id stays; a null doc_id comes after all others; among
    rows with the same doc_id and text the first in the table stays, so that exactly one
    row of each class is kept. An empty table gives an empty result. Other columns of
    ``docs`` are not looked at.
    """
    pin_splits(docs)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    owners = owners_for(docs.count())
    answers = shared_hashes(docs.mapInArrow(_sent(owners), _LETTER))
    judged = spool(with_answers(docs, answers, _judged(owners), _JUDGED), "exact")

    rank = F.struct(F.col("m.ids").isNull().alias("no_id"), F.col("m.ids").alias("id"), F.col("m.rows").alias("row"))
    best = F.array_min(F.transform(F.arrays_zip("ids", "rows"), lambda m: F.struct(m.ids.isNull().alias("no_id"), m.ids.alias("id"), m.rows.alias("row"))))
    verified = (
        judged.filter("text IS NOT NULL")
        .select("sha", "text", F.size("ids").cast("long").alias("n"), best.alias("best"))
        .groupBy("sha", "text")
        .agg(F.min("best").alias("best"), F.sum("n").alias("n"))
        .groupBy("sha")
        .agg(F.min("best").alias("best"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
        .select("sha", "best", F.when(F.col("texts") == 1, F.col("n")).otherwise(F.raise_error(F.lit("two texts share a SHA-256 digest")).cast("long")).alias("n"))
    )
    # A row per chunk and text until here; the rows of the table come out of them at the end.
    held = judged.select("sha", F.arrays_zip("ids", "rows").alias("members"), F.col("text").isNotNull().alias("suspect"))
    grouped = held.filter("suspect").join(verified, "sha").select(F.explode("members").alias("m"), "best", "n", "sha")
    alone = held.filter("NOT suspect").select(F.explode("members").alias("m"), "sha")
    alone = alone.select("m", rank.alias("best"), F.lit(1).cast("long").alias("n"), "sha")
    everyone = alone.unionByName(grouped).select(rank.alias("own"), "best", "n", "sha")
    return everyone.select(
        F.col("own.id").alias("doc_id"),
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("own.row") == F.col("best.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        F.col("own.row").alias("row"),
    )


def keep_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose addresses are in ``rows`` (row long), with all columns."""
    columns = [f"c{i}" for i in range(len(docs.columns))]
    inner = docs.toDF(*columns)
    at = docs.columns.index("text")
    inner = inner.withColumn("text", F.col(columns[at]).cast("string"))
    schema = inner.drop("text").schema

    def present(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, _ in chunks(batches):
            yield pa.record_batch({"chunk": pa.array([chunk], pa.int64()), "part": pa.array([-1], pa.int32()), "answer": pa.array([b""], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        kept = np.sort(np.array(table["row"].to_pylist(), np.int64) & 0xFFFF).astype(np.uint16)
        return pa.table({"chunk": table["chunk"].slice(0, 1), "part": pa.array([0], pa.int32()), "answer": pa.array([kept.tobytes()], pa.binary())})

    def chosen(met: Iterable[Met]) -> Iterator[pa.RecordBatch]:
        for _, table, answers in met:
            kept = np.frombuffer(answers.get(0, b""), np.uint16).astype(np.int64)
            yield from table.drop_columns(["text"]).take(pa.array(kept)).to_batches()

    reply = "chunk long, part int, answer binary"
    per_chunk = rows.select(F.shiftright("row", 16).alias("chunk"), "row").groupBy("chunk").applyInArrow(answer, reply)
    everyone = docs.select(F.col("text").cast("string")).mapInArrow(present, reply)
    kept = with_answers(inner, everyone.unionByName(per_chunk), chosen, schema)
    return kept.toDF(*docs.columns)

