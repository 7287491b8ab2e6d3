"""BPE encoding and decoding through a table of distinct words.

The tokenizer drops white space before it merges, and neither its special tokens nor its
normalisation reach across a space, tab or line end. So a text's ids are those of its words, in
order, where a word is what stands between such characters:

1. Tasks split texts into words. A chunk of texts numbers its distinct words, keeps the positions as
   numbers, and sends the words, each once and packed, to owners of hash ranges.
2. An owner has the distinct words of its range, the partitioned table, and encodes each once.
3. Owners are joined with the vocabulary's id-to-piece table; a word is decoded by its ids' pieces.
4. Ids and pieces go back to the chunks that asked, and by position to the texts.

A word is sent once for each chunk that has it, however often it occurs there, so a word
that is everywhere costs its owner one entry for each chunk.

Texts are scanned twice, once for the words and once for the positions, which is less than
keeping the positions of all words on disk until the answers come. The input must give the same rows in
the same order both times: a table, projected or filtered. A chunk that changed between the scans raises an error.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm._dictionary import compressed, packed, unpacked
from tidemill.llm._exchange import chunks, pin_splits
from tidemill.llm._text import utf8

#: Words encoded with one call.
_WORDS = 4096
#: Text bytes for each owner of a hash range.
OWNER_BYTES = 32 << 20
#: Text bytes of a chunk; larger chunks repeat fewer words.
CHUNK_BYTES = 16 << 20


@lru_cache(maxsize=2)
def tokenizer(path: str):
    # One thread for each task; Spark has the others.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The vocabulary as a table (id, piece), added tokens included; its size is the file's."""
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=True)
    return spark.createDataFrame([(i, p) for p, i in vocabulary.items()], "id int, piece string")


def _joiner(path: str) -> str:
    """What stands between pieces: without a decoder of its own, the library joins them by spaces."""
    with open(path, encoding="utf-8") as file:
        if json.load(file).get("decoder") is not None:
            raise ValueError("the tokenizer has a decoder; only joined pieces are decoded here")
    return " "


def _compressed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + compressed(data) if data else b""


def _expanded(code: bytes) -> bytes:
    return pa.decompress(code[8:], int.from_bytes(code[:8], "little"), "zstd", asbytes=True) if code else b""


def _numbered(texts: list[bytes], owners: int) -> tuple[np.ndarray, list[int], list[bytes], np.ndarray]:
    """Texts as word numbers, the most frequent word first; words for each text, words, their owners."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    found, lengths = [], []
    for text in texts:
        words = text.split()
        found.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        lengths.append(len(words))
    codes, words = np.concatenate(found), list(numbers)
    frequent = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
    words = [words[i] for i in frequent.tolist()]
    owner = np.fromiter(map(crc32, words), np.uint32, len(words)) % np.uint32(owners)
    return _inverse(frequent)[codes], lengths, words, owner


def _check(words: list[bytes]) -> int:
    """Equal if both scans saw the same words of a chunk in the same order."""
    return crc32(b"\n".join(words))


def _letters(owners: int):
    """Each chunk's distinct words, packed by owner."""

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in chunks(batches, CHUNK_BYTES):
            _, _, words, owner = _numbered(utf8(rows.column("text")), owners)
            order = np.argsort(owner, kind="stable")
            edges = np.searchsorted(owner[order], np.arange(owners + 1)).tolist()
            sent = [words[i] for i in order.tolist()]
            parts = [(o, a, b) for o, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if b > a]
            yield pa.record_batch(
                {
                    "chunk": pa.array([chunk] * len(parts), pa.int64()),
                    "check": pa.array([_check(words)] * len(parts), pa.int64()),
                    "owner": pa.array([o for o, _, _ in parts], pa.int32()),
                    "body": pa.array([_compressed(b"\n".join(sent[a:b])) for _, a, b in parts], pa.binary()),
                }
            )

    return split


def _positions(owners: int):
    """Each chunk's texts as numbers of its distinct words."""

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in chunks(batches, CHUNK_BYTES):
            codes, lengths, words, owner = _numbered(utf8(rows.column("text")), owners)
            yield pa.record_batch(
                {
                    "chunk": pa.array([chunk], pa.int64()),
                    "check": pa.array([_check(words)], pa.int64()),
                    "n_letters": pa.array([len(np.unique(owner))], pa.int32()),
                    "ids": pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    "lengths": pa.array([lengths], pa.list_(pa.int64())),
                    "codes": pa.array([packed(codes)], pa.binary()),
                    "owners": pa.array([_compressed(owner.astype("<u4").tobytes())], pa.binary()),
                }
            )

    return split


def _inverse(order: np.ndarray) -> np.ndarray:
    places = np.empty(len(order), np.int32)
    places[order] = np.arange(len(order), dtype=np.int32)
    return places


_ANSWER = "asked_by long, check long, owner int, counts binary, tokens binary, decoded binary"


def _answered(path: str, joiner: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """An owner's letters and the id-to-piece table: each word's ids and decoded text."""

    def answer(letters: pa.Table, vocabulary: pa.Table) -> pa.Table:
        if not len(letters):
            return _no_answers()
        asked = [_expanded(body).split(b"\n") for body in letters["body"].to_pylist()]
        distinct = list(dict.fromkeys(chain.from_iterable(asked)))
        piece = dict(zip(vocabulary["id"].to_pylist(), vocabulary["piece"].to_pylist(), strict=True))
        loaded = tokenizer(path)
        table: dict[bytes, tuple[list[int], str]] = {}
        for start in range(0, len(distinct), _WORDS):
            part = distinct[start : start + _WORDS]
            found = loaded.encode_batch_fast([w.decode("utf-8") for w in part], add_special_tokens=False)
            for word, ids in zip(part, (f.ids for f in found), strict=True):
                table[word] = ids, joiner.join([piece[i] for i in ids])
        out = []
        for words in asked:
            entries = [table[w] for w in words]
            counts = np.fromiter((len(ids) for ids, _ in entries), np.int32, len(entries))
            flat = np.fromiter(chain.from_iterable(ids for ids, _ in entries), np.int32, int(counts.sum()))
            spoken = "\n".join([text for _, text in entries]).encode("utf-8")
            out.append((_compressed(counts.tobytes()), _compressed(flat.tobytes()), _compressed(spoken)))
        counts, tokens, decoded = zip(*out, strict=True)
        return pa.table(
            {
                "asked_by": letters["chunk"].combine_chunks().cast(pa.int64()),
                "check": letters["check"].combine_chunks().cast(pa.int64()),
                "owner": letters["owner"].combine_chunks().cast(pa.int32()),
                "counts": pa.array(counts, pa.binary()),
                "tokens": pa.array(tokens, pa.binary()),
                "decoded": pa.array(decoded, pa.binary()),
            }
        )

    return answer


def _no_answers() -> pa.Table:
    fields = [("asked_by", pa.int64()), ("check", pa.int64()), ("owner", pa.int32())] + [(c, pa.binary()) for c in ("counts", "tokens", "decoded")]
    return pa.schema(fields).empty_table()


class _Words:
    """What a chunk's words are, by number."""

    def __init__(self, answers: pa.Table):
        answers = answers.sort_by("owner")
        counts, tokens, spoken = (
            [_expanded(code) for code in answers[c].to_pylist()] for c in ("counts", "tokens", "decoded")
        )
        self.counts = np.frombuffer(b"".join(counts), np.int32).astype(np.int64)
        self.tokens = np.frombuffer(b"".join(tokens), np.int32)
        self.firsts = np.cumsum(self.counts) - self.counts
        self.spoken = list(chain.from_iterable(s.decode("utf-8").split("\n") for s in spoken))


def _by_text(finish: Callable, arrow: pa.Schema, joiner: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Turn a chunk and its answers into ids and decoded text of each row."""

    def assemble(rows: pa.Table, answers: pa.Table) -> pa.Table:
        checks = {*rows["check"].to_pylist(), *answers["check"].to_pylist()}
        if len(rows) != 1 or len(answers) != rows["n_letters"][0].as_py() or len(checks) != 1:
            raise RuntimeError("the input changed between two scans: write it to a table first")
        words = _Words(answers)
        ids, lengths = rows["ids"][0].as_py(), rows["lengths"][0].as_py()
        owners = np.frombuffer(_expanded(rows["owners"][0].as_py()), "<u4")
        codes = _inverse(np.argsort(owners, kind="stable"))[unpacked(rows["codes"][0].as_py(), sum(lengths))]
        out, at = [], 0
        for doc_id, length in zip(ids, lengths, strict=True):
            own = codes[at : at + length]
            at += length
            taken = words.counts[own]
            ends = np.cumsum(taken)
            total = int(ends[-1]) if length else 0
            places = np.arange(total) + np.repeat(words.firsts[own] - (ends - taken), taken)
            # A word of characters that the tokenizer drops has no ids and no text.
            decoded = joiner.join(map(words.spoken.__getitem__, own[taken > 0].tolist()))
            out.append((doc_id, *finish(words.tokens[places], decoded)))
        columns = zip(*out, strict=True)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return assemble


def _encoded(docs: DataFrame, path: str, finish: Callable, schema: str, arrow: pa.Schema) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    owners = int(size) // OWNER_BYTES + 1
    joiner = _joiner(path)
    pin_splits(docs)
    letters = docs.mapInArrow(_letters(owners), "chunk long, check long, owner int, body binary")
    # The vocabulary's size is fixed, and so is its share of each owner's input.
    every = F.explode(F.sequence(F.lit(0), F.lit(owners - 1)))
    vocabulary = pieces(docs.sparkSession, path).select(every.alias("of"), "id", "piece")
    answers = letters.groupBy("owner").cogroup(vocabulary.groupBy("of")).applyInArrow(_answered(path, joiner), _ANSWER)
    rows = docs.mapInArrow(
        _positions(owners),
        "chunk long, check long, n_letters int, ids array<long>, lengths array<long>, codes binary, owners binary",
    )
    return rows.groupBy("chunk").cogroup(answers.groupBy("asked_by")).applyInArrow(_by_text(finish, arrow, joiner), schema)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, tokens array<int>, decoded string) of every row of ``docs`` (doc_id, text).

    ``path`` is a tokenizer file whose normalizer and pre-tokenizer drop ASCII white space. The
    ids are those of the library without added special tokens; strings of special tokens in a
    text are their ids, as in the library. ``decoded`` joins the ids' pieces as the library's
    ``decode`` does. A null text counts as empty and has no tokens; a null doc_id stays null;
    repeated rows each come out. A text of any length is one row; a word of any length is encoded
    as one. An empty table gives an empty result. Other columns are not looked at.
    """
    arrow = pa.schema({"doc_id": pa.int64(), "tokens": pa.list_(pa.int32()), "decoded": pa.string()})
    schema = "doc_id long, tokens array<int>, decoded string"
    return _encoded(docs, path, lambda ids, text: (ids, text), schema, arrow)


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    """As :func:`encode_documents`, with digests in place of ids and text.

    ``ids_sha256`` is of the ids as little-endian 32-bit integers, ``decoded_sha256`` of UTF-8.
    """

    def finish(ids: np.ndarray, text: str) -> tuple[int, str, str]:
        spelled = hashlib.sha256(text.encode("utf-8")).hexdigest()
        return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), spelled

    arrow = pa.schema({"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()})
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _encoded(docs, path, finish, schema, arrow)
