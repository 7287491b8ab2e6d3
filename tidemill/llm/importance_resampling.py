"""Importance resampling towards a target distribution of hashed word n-grams.

Words are cut from UTF-8 bytes: a table of 256 bytes lower-cases A-Z and turns every
other ASCII byte that is no letter or digit into a space, and ``bytes.split`` does the rest. A
feature is a run of one to three words; ``zlib.crc32`` of a longer run continues from
that of the shorter one, so no run is ever put together. Each task adds up its features
by bucket, the sums of the tasks are added by Spark; with a fixed number of buckets these
tables have a fixed size, whatever the corpus.

A document's weight is the sum of its features' gains, the logarithm of the ratio of the
bucket's share in the target and in the corpus. Keyed Gumbel noise is added, so that taking
the highest scores is a draw without replacement in proportion to exp(weight). Ranks come
from a range-partitioned sort: each part numbers its rows, and starts after the parts before it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm._scratch import spool
from tidemill.llm._text import utf8

BUCKETS = 10_000
#: Words of the longest run.
LONGEST = 3
#: A gain or noise of 1 in natural logarithms counts so much.
SCALE = 1_000
SEED = 42
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
#: Documents drawn of a hundred that may be.
PERCENT = 5

_KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz")
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _KEPT else 32 for b in range(256)
)
#: Texts whose bytes are looked at together, bounded in rows; a batch's texts are slices, not copies.
_ROWS = 64


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def feature_hashes(words: list[bytes]) -> list[list[int]]:
    """CRC-32 of all runs of one word, of two, and so on, each list in text order."""
    hashes = list(map(crc32, words))
    found = [hashes]
    spaced = [b" " + w for w in words]
    for length in range(1, LONGEST):
        # A run without its last word ends one word earlier.
        hashes = list(map(crc32, spaced[length:], hashes))
        found.append(hashes)
    return found


def bucket_of(words: list[bytes], buckets: int) -> np.ndarray:
    hashes = [np.array(h, np.uint32) for h in feature_hashes(words)]
    return (np.concatenate(hashes) % np.uint32(buckets)).astype(np.int64)


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for start in range(0, len(batch), _ROWS):
            part = batch.slice(start, _ROWS)
            yield part, utf8(part.column("text"))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Features of all texts of a column ``text`` by bucket: (bucket, n), without empty buckets."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()
        for _, bodies in _texts(batches):
            for body in bodies:
                totals.update(bucket_of(words_of(body), buckets).tolist())
        yield pa.record_batch(
            {"bucket": pa.array(list(totals), pa.int32()), "n": pa.array(list(totals.values()), pa.int64())}
        )

    counted = texts.select(F.col("text").cast("string")).mapInArrow(count, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket. At most ``buckets`` rows of each side reach the driver."""
    sides = []
    for texts in (corpus, target):
        counts = np.zeros(buckets, np.int64)
        for row in bucket_counts(texts, buckets).collect():
            counts[row["bucket"]] = row["n"]
        sides.append(counts)
    s, t = sides
    total_s, total_t = int(s.sum()), int(t.sum())
    ratio = (t + 1.0) * (total_s + float(buckets)) / ((s + 1.0) * (total_t + float(buckets)))
    return np.floor(SCALE * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    buckets = len(gains)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, bodies in _texts(batches):
            n_words, n_features, weights = [], [], []
            for body in bodies:
                words = words_of(body)
                found = bucket_of(words, buckets)
                n_words.append(len(words))
                n_features.append(len(found))
                weights.append(int(gains[found].sum()))
            yield pa.record_batch(
                {
                    "doc_id": part.column("doc_id"),
                    "n_words": pa.array(n_words, pa.int64()),
                    "n_features": pa.array(n_features, pa.int64()),
                    "weight": pa.array(weights, pa.int64()),
                }
            )

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return columns.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long")


def _noise(seed: int):
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its score, and the ranks of those drawn.

    Returns doc_id, n_features, weight, score, rank. ``target`` has a column ``text``. Of the N
    rows with at least ``least_words`` words the floor(percent * N / 100) with the highest
    scores are drawn and ranked from 1; ties go to the smaller doc_id. A null or empty text has no
    words and weight 0. A null doc_id counts as empty in the noise and comes after all
    others in a tie; rows that repeat a doc_id are scored and drawn one by one, equal ones in no
    particular order. An empty table gives an empty result; an empty target gives gains all the
    same (t = T = 0). Other columns are not looked at.
    """
    gains = bucket_gains(docs, target, buckets)
    scored = weigh(docs, gains).withColumn("score", F.col("weight") + _noise(seed))
    # The number of a row in the written table tells rows apart that are alike in everything.
    scored = spool(scored.withColumn("row", F.monotonically_increasing_id()), "resampling-scores")
    candidates = scored.filter(F.col("n_words") >= least_words)
    drawn = candidates.count() * percent // 100

    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    # Written once: the parts of a range-partitioned sort depend on a sample.
    placed = spool(
        candidates.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
        .select("doc_id", "n_features", "weight", "score", F.shiftright("place", 33).alias("part"), F.col("place").bitwiseAND((1 << 33) - 1).alias("place")),
        "resampling-order",
    )
    # One row for each part, that is for each shuffle partition.
    before, starts = 0, []
    for row in placed.groupBy("part").count().orderBy("part").collect():
        starts.append((row["part"], before))
        before += row["count"]
    starts = docs.sparkSession.createDataFrame(starts, "part long, before long")
    rank = F.col("before") + F.col("place") + 1
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = placed.join(F.broadcast(starts), "part").select(*columns, F.when(rank <= drawn, rank).alias("rank"))
    short = scored.filter(F.col("n_words") < least_words)
    return ranked.unionByName(short.select(*columns, F.lit(None).cast("long").alias("rank")))
