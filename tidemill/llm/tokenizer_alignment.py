"""Alignment of two tokenizers over the distinct texts of a corpus.

1. Equal texts are brought together by a shuffle on the full text, and each distinct text is
   tokenised and aligned once, with the number of its copies.
2. Both tokenizers cut the same bytes. A stretch between two neighbouring cuts of either lies
   in one token of each, so the stretches are the links, and a cut of both ends a group.
3. A chunk of texts lists its id pairs once, each weighted with the copies of the texts that
   have it; weights are added over the corpus, and the sums go back to the chunks.
4. Measures are joined to doc_ids by the text's digest. Texts with a thousandth or more of all
   copies are fewer than a thousand and are broadcast, so no join gathers a hot text.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm._dictionary import entries, meet, packed, text_chunks, unpacked
from tidemill.llm._scratch import spool
from tidemill.llm._text import utf8

#: A text with this share of all rows, or more, is hot; there are at most as many as the inverse.
HOT_SHARE = 1_000
#: Characters encoded with one call; a longer text has one of its own.
_CALL_CHARS = 1 << 18
_SHIFT = 32

MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _byte_alphabet() -> dict[str, int]:
    """Byte-level spelling: printable bytes stand for themselves, the rest for characters from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def byte_level(path: str):
    """The tokenizer of a file with a byte-level vocabulary, and each id's bytes."""
    # One thread for each task; Spark has the others.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    loaded.encode_special_tokens = True
    alphabet = _byte_alphabet()
    vocabulary = loaded.get_vocab(with_added_tokens=True)
    spelled = [b""] * (max(vocabulary.values()) + 1)
    for piece, number in vocabulary.items():
        spelled[number] = bytes(alphabet[c] for c in piece)
    return loaded, spelled


@lru_cache(maxsize=2)
def byte_fallback(path: str):
    """The processor of a model with byte fallback, and each id's bytes."""
    import sentencepiece

    loaded = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled = []
    for number in range(loaded.get_piece_size()):
        piece = loaded.id_to_piece(number)
        spelled.append(bytes([int(piece[3:5], 16)]) if loaded.is_byte(number) else piece.replace("▁", " ").encode("utf-8"))
    return loaded, spelled


def _calls(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > _CALL_CHARS:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


class Aligned:
    """Both token sequences of several texts, end to end, over the same bytes.

    All tokenizers cut where a text ends, so nothing below reaches across texts.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray, a_counts: np.ndarray, b_counts: np.ndarray):
        self.a, self.b = a, b
        a_ends, b_ends = np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b])
        n_bytes = int(a_ends[-1]) + 1 if len(a) else 1
        in_a, in_b = np.zeros(n_bytes, bool), np.zeros(n_bytes, bool)
        in_a[a_ends] = in_b[b_ends] = True
        cuts = np.flatnonzero(in_a | in_b)
        # The token that a cut ends or lies in: as many as end before it.
        self._a_of = np.cumsum(in_a)[cuts] - in_a[cuts]
        self._b_of = np.cumsum(in_b)[cuts] - in_b[cuts]
        both = np.flatnonzero(in_a & in_b)
        self._a_last, self._b_last = np.searchsorted(a_ends, both), np.searchsorted(b_ends, both)
        self._a_stops, self._b_stops = np.cumsum(a_counts), np.cumsum(b_counts)
        # A text starts where its first token does.
        self._text_of_a = np.repeat(np.arange(len(a_counts)), a_counts)
        self.n_groups = np.bincount(self._text_of_a[self._a_last], minlength=len(a_counts))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """A number for each link, the A id above the B id, and the text it is in."""
        return (self.a[self._a_of] << _SHIFT) | self.b[self._b_of], self._text_of_a[self._a_of]

    def groups(self, spelled: list[str], a_size: int, b_size: int) -> list[str]:
        """The groups of each text; ``spelled`` has each id with the mark that follows it."""
        a_codes, b_codes = self.a.copy(), self.b + 2 * a_size
        a_codes[self._a_last] += a_size
        b_codes[self._b_last] += b_size
        # A group's tokens of A stand before those of B, after all tokens of the groups before.
        a_group = np.searchsorted(self._a_last, np.arange(len(self.a)))
        b_group = np.searchsorted(self._b_last, np.arange(len(self.b)))
        b_before = np.concatenate(([0], self._b_last + 1))
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + b_before[a_group]] = a_codes
        codes[np.arange(len(self.b)) + (self._a_last + 1)[b_group]] = b_codes
        stops = (self._a_stops + self._b_stops).tolist()
        return ["".join(map(spelled.__getitem__, codes[i:j].tolist()))[:-1] for i, j in zip([0, *stops], stops, strict=False)]


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self._a, self._a_bytes = byte_level(a_path)
        self._b, self._b_bytes = byte_fallback(b_path)
        self._a_sizes = np.array([len(s) for s in self._a_bytes], np.int64)
        self._b_sizes = np.array([len(s) for s in self._b_bytes], np.int64)
        self.a_size, self.b_size = len(self._a_bytes), len(self._b_bytes)
        self.spelled = [f"{i}{mark}" for size, marks in ((self.a_size, ",|"), (self.b_size, ",;")) for mark in marks for i in range(size)]

    def __call__(self, bodies: list[bytes]) -> tuple[Aligned, np.ndarray, np.ndarray]:
        """Texts aligned, and tokens of A and of B in each: none in an empty text and in one whose bytes
        a tokenizer does not give back."""
        texts = [b.decode("utf-8") for b in bodies]
        a_lists: list[list[int]] = []
        b_lists: list[list[int]] = []
        for start, stop in _calls(texts):
            part = texts[start:stop]
            found = self._a.encode_batch_fast([" " + t for t in part], add_special_tokens=False)
            a_lists += (f.ids for f in found)
            b_lists += self._b.encode(part, num_threads=1)
        for i, (body, a, b) in enumerate(zip(bodies, a_lists, b_lists, strict=True)):
            whole = b" " + body if body else None
            if b"".join(map(self._a_bytes.__getitem__, a)) != whole or b"".join(map(self._b_bytes.__getitem__, b)) != whole:
                a_lists[i] = b_lists[i] = []
        (a, a_counts), (b, b_counts) = _flat(a_lists), _flat(b_lists)
        return Aligned(a, b, self._a_sizes, self._b_sizes, a_counts, b_counts), a_counts, b_counts


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts


_CHUNK = (
    "chunk long, text_sha array<binary>, copies array<long>, n_a array<long>, n_b array<long>, n_groups array<long>,"
    " n_links array<long>, groups_sha256 array<string>, n_pairs array<long>, codes binary, times binary, keys array<long>, weights array<long>"
)
_MEASURED = "text_sha binary, copies long, " + ", ".join(f"{m} long" for m in MEASURES) + ", groups_sha256 string"


def _aligned(a_path: str, b_path: str):
    def align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for chunk, rows in text_chunks(batches):
            bodies = utf8(rows.column("text"))
            copies = rows.column("copies").to_numpy()
            found, n_a, n_b = aligner(bodies)
            links, text_of = found.links()
            keys, codes = np.unique(links, return_inverse=True)
            n_links = np.bincount(text_of, minlength=len(bodies))
            # Each pair of a text once, with the times it is linked there.
            own, times = np.unique(text_of * max(1, len(keys)) + codes, return_counts=True)
            owner, codes = np.divmod(own, max(1, len(keys)))
            n_pairs = np.bincount(owner, minlength=len(bodies))
            weights = np.bincount(codes, copies[owner], len(keys)).astype(np.int64)
            spelled = found.groups(aligner.spelled, aligner.a_size, aligner.b_size)
            groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in spelled]
            shas = [hashlib.sha256(body).digest() for body in bodies]
            long = pa.list_(pa.int64())
            yield pa.record_batch(
                {
                    "chunk": pa.array([chunk], pa.int64()),
                    "text_sha": pa.array([shas], pa.list_(pa.binary())),
                    "copies": pa.array([copies], long),
                    "n_a": pa.array([n_a], long),
                    "n_b": pa.array([n_b], long),
                    "n_groups": pa.array([found.n_groups], long),
                    "n_links": pa.array([n_links], long),
                    "groups_sha256": pa.array([groups], pa.list_(pa.string())),
                    "n_pairs": pa.array([n_pairs], long),
                    "codes": pa.array([packed(codes)], pa.binary()),
                    "times": pa.array([packed(times)], pa.binary()),
                    "keys": pa.array([keys], long),
                    "weights": pa.array([weights], long),
                }
            )

    return align


def _measured(rows: pa.Table, found: pa.Table) -> pa.Table:
    """Measures of a chunk's texts from the corpus-wide counts of its pairs."""
    whole = rows.to_pylist()[0]
    n_pairs = np.array(whole["n_pairs"], np.int64)
    codes, times = (unpacked(whole[c], int(n_pairs.sum())) for c in ("codes", "times"))
    counts, best = found["n"].to_numpy(), found["best"].to_numpy()
    ends = np.cumsum(n_pairs)

    def by_text(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(values)))
        return sums[ends] - sums[ends - n_pairs]

    table = {
        "text_sha": pa.array(whole["text_sha"], pa.binary()),
        "copies": pa.array(whole["copies"], pa.int64()),
    }
    table |= {c: pa.array(whole[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")}
    table["n_best"] = pa.array(by_text(times * best[codes].astype(np.int64)), pa.int64())
    table["count_sum"] = pa.array(by_text(times * counts[codes]), pa.int64())
    table["groups_sha256"] = pa.array(whole["groups_sha256"], pa.string())
    return pa.table(table)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(key, n, best): documents that have an id pair linked, and whether its A id has none more often."""
    listed = chunks.select(F.explode(F.arrays_zip("keys", "weights")).alias("p"))
    counts = listed.groupBy(F.col("p.keys").alias("key")).agg(F.sum("p.weights").alias("n"))
    # One A id has at most as many pairs as the other vocabulary has ids.
    of_one = Window.partitionBy(F.shiftright("key", _SHIFT))
    return counts.select("key", "n", (F.col("n") == F.max("n").over(of_one)).alias("best"))


def align_texts(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """Measures by distinct text, and the pair table, as written tables.

    The first has text_sha (digest of the text), copies, the columns of ``MEASURES`` and
    groups_sha256; the second a_id, b_id, n (documents with the pair linked) and best.
    """
    present = docs.filter("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    chunks = spool(present.mapInArrow(_aligned(a_path, b_path), _CHUNK), "alignment-chunks")
    pairs = spool(pair_counts(chunks), "alignment-pairs")
    answers = entries(chunks).join(pairs, "key").select("chunk", "place", "n", "best")
    measures = spool(meet(chunks.drop("weights"), answers, _measured, _MEASURED), "alignment-measures")
    low = F.col("key").bitwiseAND((1 << _SHIFT) - 1)
    table = pairs.select(F.shiftright("key", _SHIFT).cast("int").alias("a_id"), low.cast("int").alias("b_id"), "n", "best")
    return measures, table


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Measures of every row of ``docs`` (doc_id, text): doc_id, ``MEASURES``, groups_sha256.

    A encodes a space and the text, B the text, to which it adds the space. ``a_path`` is a
    tokenizer file with a byte-level vocabulary, ``b_path`` a model with byte fallback. Strings
    of special tokens in a text are plain text. Null and empty texts, and those whose bytes one of the
    tokenizers does not give back, have no tokens: zeros and an empty string. A pair's count is
    the number of rows, copies included, that have it linked. A null doc_id stays null and repeated
    rows each come out and count. A text of any length is aligned as one. An empty table gives
    an empty result. Other columns are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    measures, _ = align_texts(docs, a_path, b_path)
    named = F.when(F.col("text") != "", F.unhex(F.sha2("text", 256)))
    rows = spool(docs.select("doc_id", named.alias("text_sha")), "alignment-rows")

    hot = F.col("copies") * HOT_SHARE >= rows.count()
    columns = [*MEASURES, "groups_sha256"]
    result = ["doc_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in MEASURES), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")]
    # Fewer than HOT_SHARE + 1 rows, by the condition.
    few = F.broadcast(measures.filter(hot).select("text_sha", *columns))
    many = measures.filter(~hot).select("text_sha", *columns)
    with_hot = rows.join(few, "text_sha").select(*result)
    rest = rows.filter("text_sha IS NOT NULL").join(few.select("text_sha"), "text_sha", "left_anti")
    with_cold = rest.join(many, "text_sha").select(*result)
    without = rows.filter("text_sha IS NULL")
    zeros = without.select("doc_id", *(F.lit(0).cast("long").alias(m) for m in MEASURES), F.lit("").alias("groups_sha256"))
    return with_hot.unionByName(with_cold).unionByName(zeros)
