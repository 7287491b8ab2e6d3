"""Toxicity by multiple-instance learning: documents carry labels, sentences carry scores.

A sentence's score is a logistic function of its distinct words and word beginnings. A
document is toxic if any of its sentences is, or by a small leak that stands for labels no
sentence explains: P = 1 - (1 - leak) * product(1 - score) (noisy-or). Training sees document
labels only; the likelihood of the noisy-or hands the blame to sentences, so the same
model then points at the offending ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm._exchange import give_back
from tidemill.llm._scratch import spool
from tidemill.llm._text import RangeHash, joined, mix, portions, runs, utf8

#: Labelled documents used for fitting, at most: those with the smallest hashes of doc_id.
TRAINING_ROWS = 5_000
#: Text bytes used for fitting, at most.
TRAINING_BYTES = 64 << 20
#: A word needs to be in so many of them to get a weight, and to differ between toxic and
#: other documents by so many standard deviations.
LEAST_DOCUMENTS = 6
LEAST_DEVIATIONS = 3.0
STEPS = 150
#: Bytes of the word beginnings that are features beside the word.
STEMS = (4, 5, 6)

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_END = np.zeros(256, bool)
_END[list(b".!?\n\r")] = True


@dataclass
class Sentences:
    """Distinct words of the sentences of some documents, flat; positions in code points."""

    documents: int
    owner: np.ndarray  # of each sentence: its document
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray  # 32-bit word hashes
    sentence: np.ndarray  # of each word: its sentence


def sentences(texts: list[bytes]) -> Sentences:
    """Cut texts at . ! ? and line ends; a sentence has at least one word."""
    buffer, bounds = joined(texts)
    starts, ends = runs(_WORD[buffer])
    owner = np.searchsorted(bounds, starts, side="right") - 1
    closed = np.concatenate(([0], np.cumsum(_END[buffer])))[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(owner) > 0) | (np.diff(closed) > 0)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1 if len(first) else first
    index = np.cumsum(new) - 1
    hashed = RangeHash(buffer, fold=True)
    keys, place = [hashed(starts, ends)], [index]
    for size in STEMS:  # a stem is told from a word of the same letters
        longer = np.flatnonzero(ends - starts > size)
        keys.append(mix(hashed(starts[longer], starts[longer] + size) + np.uint64(size)))
        place.append(index[longer])
    parts = [(i.astype(np.uint64) << np.uint64(32)) | (k >> np.uint64(32)) for i, k in zip(place, keys, strict=True)]
    pairs = np.unique(np.concatenate(parts))
    points = np.concatenate(([0], np.cumsum((buffer & 0xC0) != 0x80)))
    origin = points[bounds[owner[first]]]
    return Sentences(
        len(texts),
        owner[first],
        points[starts[first]] - origin,
        points[ends[last]] - origin,
        (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32),
        (pairs >> np.uint64(32)).astype(np.int64),
    )


@dataclass(frozen=True)
class ToxicityModel:
    words: np.ndarray  # ascending word hashes
    weights: np.ndarray
    bias: float
    leak: float

    def sentence_scores(self, found: Sentences) -> np.ndarray:
        logits = np.full(len(found.owner), self.bias)
        if len(self.words) and len(found.words):
            at = np.minimum(np.searchsorted(self.words, found.words), len(self.words) - 1)
            weight = np.where(self.words[at] == found.words, self.weights[at], 0.0)
            logits += np.bincount(found.sentence, weight, len(logits))
        return 1 / (1 + np.exp(-logits))

    def document_scores(self, found: Sentences, scores: np.ndarray) -> np.ndarray:
        clean = np.bincount(found.owner, np.log1p(-np.minimum(scores, 1 - 1e-12)), found.documents)
        return 1 - (1 - self.leak) * np.exp(clean)


def _adam(gradient, value, state, rate, step):
    mean, square = state
    mean += 0.1 * (gradient - mean)
    square += 0.001 * (gradient * gradient - square)
    return value - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)


def fit(found: Sentences, labels: np.ndarray, steps: int = STEPS, ridge: float = 1e-4, lasso: float = 1e-3) -> ToxicityModel:
    """Maximise the likelihood of document labels under the noisy-or; without rows, a model of leak 0.5."""
    n = found.documents
    if not n:
        return ToxicityModel(np.zeros(0, np.uint32), np.zeros(0), -8.0, 0.5)
    labels = labels.astype(float)
    words = _frequent(found, labels)
    if len(words):
        at = np.minimum(np.searchsorted(words, found.words), len(words) - 1)
        known = words[at] == found.words
        feature, sentence = at[known], found.sentence[known]
    else:
        feature = sentence = np.zeros(0, np.int64)
    return _descend(n, found.owner, words, feature, sentence, labels, steps, ridge, lasso)


def _frequent(found: Sentences, labels: np.ndarray) -> np.ndarray:
    """Ascending words in at least LEAST_DOCUMENTS documents that set toxic ones apart."""
    seen = found.words.astype(np.uint64)
    seen <<= np.uint64(32)
    if len(seen):
        seen |= found.owner[found.sentence].astype(np.uint64)
    seen = np.unique(seen)
    words, index, counts = np.unique((seen >> np.uint64(32)).astype(np.uint32), return_inverse=True, return_counts=True)
    toxic = np.bincount(index, labels[(seen & np.uint64(0xFFFFFFFF)).astype(np.int64)], len(words))
    share = labels.mean()
    deviation = np.abs(toxic - counts * share) / np.sqrt(np.maximum(counts * share * (1 - share), 1e-9))
    return words[(counts >= LEAST_DOCUMENTS) & (deviation >= LEAST_DEVIATIONS)]


def _descend(
    n: int, owner: np.ndarray, words: np.ndarray, feature: np.ndarray, sentence: np.ndarray, labels: np.ndarray, steps: int, ridge: float, lasso: float
) -> ToxicityModel:
    """Gradient steps over the sentences (``owner``: their documents) and their known words (``feature``: index in ``words``)."""
    weights, extra = np.zeros(len(words)), np.array([-6.0, -4.0])  # bias; log of the leak's rate
    states = [(np.zeros(len(words)), np.zeros(len(words))), (np.zeros(2), np.zeros(2))]
    for step in range(1, steps + 1):
        logits = extra[0] + np.bincount(sentence, weights[feature], len(owner))
        rate = np.exp(extra[1]) + np.bincount(owner, np.logaddexp(0, logits), n)
        pull = 1 - labels / np.maximum(-np.expm1(-rate), 1e-9)
        by_sentence = pull[owner] / (1 + np.exp(-logits))
        slope = np.bincount(feature, by_sentence[sentence], len(words)) / n + 2 * ridge * weights
        own = np.array([by_sentence.sum(), pull.sum() * np.exp(extra[1])]) / n
        speed = 0.1 if step < steps * 0.7 else 0.03
        weights = _adam(slope, weights, states[0], speed, step)
        weights = np.sign(weights) * np.maximum(np.abs(weights) - speed * lasso, 0)
        extra = _adam(own, extra, states[1], speed, step)
    used = np.abs(weights) > 1e-3
    leak = float(-np.expm1(-np.exp(extra[1])))
    return ToxicityModel(words[used], weights[used], float(extra[0]), leak)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of doc_id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, size: int = TRAINING_BYTES) -> ToxicityModel:
    """Fit on at most ``rows`` labelled documents outside the held-out fold, and on ``size`` bytes of text.

    The sample is bounded, so its ids are broadcast; Spark counts the documents of each word, and only
    the words fit keeps are collected with their sentences. Documents are
    taken in the order of a hash of their doc_id until the bytes are used up; a text is taken whole or not at
    all. Of several rows with one doc_id one counts, with the smallest text and the larger label. Rows without
    doc_id or label are not used.
    """
    sample = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    one_each = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    one_each = spool(one_each, "training")
    # At most ``rows`` rows of two numbers.
    up_to = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    fitting = one_each.select("doc_id", F.octet_length("text").cast("long").alias("bytes")).filter(F.col("bytes") <= size)
    fitting = fitting.select("doc_id", F.sum("bytes").over(up_to).alias("total")).filter(F.col("total") <= size).select("doc_id")
    chosen = one_each.join(F.broadcast(fitting), "doc_id").select("text", "toxic")

    documents, toxic_total = chosen.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not documents:
        return fit(Sentences(0, *([np.zeros(0, np.int64)] * 5)), np.zeros(0, np.uint8))

    def in_documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, toxic = utf8(batch["text"]), np.asarray(batch["toxic"].to_numpy(zero_copy_only=False), np.int64)
            for a, b in portions(texts):
                found = sentences(texts[a:b])
                seen = np.unique((found.words.astype(np.uint64) << np.uint64(32)) | found.owner[found.sentence].astype(np.uint64))
                owner = (seen & np.uint64(0xFFFFFFFF)).astype(np.int64)
                yield pa.record_batch([pa.array((seen >> np.uint64(32)).astype(np.int64)), pa.array(toxic[a:b][owner])], ["word", "toxic"])
        give_back()

    # The words of fit's filter, found by Spark: a word's documents and toxic ones among them, as fit counts them.
    share = toxic_total / documents
    expected = F.col("documents") * F.lit(share)
    deviation = F.abs(F.col("toxic") - expected) / F.sqrt(F.greatest(expected * F.lit(1 - share), F.lit(1e-9)))
    counted = chosen.mapInArrow(in_documents, "word long, toxic long").groupBy("word").agg(F.count(F.lit(1)).alias("documents"), F.sum("toxic").alias("toxic"))
    frequent = counted.filter((F.col("documents") >= LEAST_DOCUMENTS) & (deviation >= LEAST_DEVIATIONS)).select("word")
    words = np.sort(np.array([r.word for r in frequent.collect()], np.int64)).astype(np.uint32)
    known_words = chosen.sparkSession.sparkContext.broadcast(words)

    def described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, toxic = utf8(batch["text"]), batch["toxic"].to_pylist()
            for a, b in portions(texts):
                found = sentences(texts[a:b])
                words = known_words.value
                if len(words):
                    at = np.minimum(np.searchsorted(words, found.words), len(words) - 1)
                    known = words[at] == found.words
                    feature, sentence = at[known], found.sentence[known]
                else:
                    feature = sentence = np.zeros(0, np.int64)
                parts = (found.owner, feature, sentence)
                packed = [p.astype("<u4").tobytes() for p in parts]
                yield pa.record_batch([pa.array([x], pa.binary()) for x in (*packed, bytes(toxic[a:b]))], ["owner", "feature", "sentence", "toxic"])
        give_back()

    # Only sentences and their words that fit keeps reach the driver.
    parts = chosen.mapInArrow(described, "owner binary, feature binary, sentence binary, toxic binary").repartition(16)
    owner, feature, sentence, toxic = ([np.zeros(0, t)] for t in (np.uint32, np.uint32, np.uint32, np.uint8))
    documents = count = 0
    for part in parts.toLocalIterator(prefetchPartitions=False):
        read = [np.frombuffer(part[i], "<u4") for i in range(3)]
        owner.append(read[0] + np.uint32(documents))
        feature.append(read[1].copy())
        sentence.append(read[2] + np.uint32(count))
        toxic.append(np.frombuffer(part[3], np.uint8).copy())
        documents, count = documents + len(part[3]), count + len(read[0])
    labels = np.concatenate(toxic).astype(float)
    return _descend(documents, np.concatenate(owner), words, np.concatenate(feature), np.concatenate(sentence), labels, STEPS, 1e-4, 1e-3)


def score_documents(docs: DataFrame, model: ToxicityModel, sentence_threshold: float = 0.3) -> DataFrame:
    """doc_id, score and offending sentences of every row of ``docs`` (doc_id, text); no shuffle.

    ``offending`` has (start, end, score) in code points for sentences of at least
    ``sentence_threshold``. A null, empty or wordless text has no sentence and scores the
    leak. Whole texts are scored; other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch["text"])
            for a, b in portions(texts):
                found = sentences(texts[a:b])
                scores = shared.value.sentence_scores(found)
                spans: list[list[dict]] = [[] for _ in range(b - a)]
                for i in np.flatnonzero(scores >= sentence_threshold).tolist():
                    span = {"start": int(found.starts[i]), "end": int(found.ends[i]), "score": float(scores[i])}
                    spans[found.owner[i]].append(span)
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
                yield pa.record_batch(
                    {
                        "doc_id": batch["doc_id"].slice(a, b - a),
                        "score": pa.array(shared.value.document_scores(found, scores)),
                        "offending": pa.array(spans, kind),
                    }
                )
        give_back()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(scored, "doc_id long, score double, offending array<struct<start:long,end:long,score:double>>")


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns; no shuffle."""
    columns = [f"c{i}" for i in range(len(docs.columns))]
    inner = docs.toDF(*columns)
    schema = inner.schema
    inner = inner.withColumn("text", F.col(columns[docs.columns.index("text")]).cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch["text"])
            for a, b in portions(texts):
                found = sentences(texts[a:b])
                scores = shared.value.document_scores(found, shared.value.sentence_scores(found))
                yield batch.slice(a, b - a).drop_columns(["text"]).filter(pa.array(scores < threshold))
        give_back()

    return inner.mapInArrow(kept, schema).toDF(*docs.columns)
