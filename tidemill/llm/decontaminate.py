"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is contained in a document if at least ``threshold`` of its distinct word
shingles are among the document's. Jaccard similarity says little when a 40-word item
lies in a 20,000-word document, so sketches are made for containment:

* Items are partitioned by size (shingle count, in powers of two). The sketch of an item
  with q shingles is its q - ceil(threshold * q) + 1 smallest shingle hashes. A document
  that contains the item lacks fewer of its shingles than that, so it has at least one
  hash of the sketch: the search has no false negatives.
* Each partition has a hash bound, the largest hash of its sketches. A document's sketch
  for the partition is the set of its hashes up to the bound, so it grows with
  the document, and partitions of items too large for a document are left out.
* Items hit by a sketch are verified by the exact number of shared shingles.

Test items are the query set: they are read in blocks of bounded size, each broadcast
once to a scan of all documents. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm._exchange import give_back
from tidemill.llm._scratch import spool
from tidemill.llm._text import portions, shingle_hashes, utf8

WORDS = 5
THRESHOLD = 0.75
#: Text bytes of the items of one block; bounds what is broadcast at once.
BLOCK_BYTES = 16 << 20

Item = tuple[int | None, np.ndarray, int]


def _needed(shingles: int, threshold: float) -> int:
    return max(1, int(np.ceil(threshold * shingles - 1e-9)))


class _Partition:
    """Items of one size class: their sketches by hash, and the bound of these hashes."""

    def __init__(self, items: list[tuple[int, np.ndarray]], threshold: float):
        self.least = min(_needed(len(hashes), threshold) for _, hashes in items)
        sketches = [(n, hashes[: len(hashes) - _needed(len(hashes), threshold) + 1]) for n, hashes in items]
        hashes = np.concatenate([s for _, s in sketches])
        owners = np.concatenate([np.full(len(s), n) for n, s in sketches])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owners = hashes[order], owners[order]
        self.bound = self.hashes[-1]

    def hits(self, document: np.ndarray) -> set[int]:
        """Items of which ``document`` (ascending hashes) has a hash of the sketch."""
        sketch = document[: np.searchsorted(document, self.bound, side="right")]
        a = np.searchsorted(self.hashes, sketch, side="left")
        b = np.searchsorted(self.hashes, sketch, side="right")
        found: set[int] = set()
        for i in np.flatnonzero(b > a).tolist():
            found.update(self.owners[a[i] : b[i]].tolist())
        return found


class Block:
    """A bounded set of items, indexed for containment search."""

    def __init__(self, items: list[Item], threshold: float):
        self.items, self.threshold = items, threshold
        classes: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
        for n, (_, hashes, words) in enumerate(items):
            classes.setdefault((words, len(hashes).bit_length()), []).append((n, hashes))
        self._partitions: dict[int, list[_Partition]] = {}
        for (words, _), members in sorted(classes.items()):
            self._partitions.setdefault(words, []).append(_Partition(members, threshold))
        self.widths = sorted(self._partitions)

    def search(self, document: np.ndarray, words: int) -> Iterator[tuple[int, int]]:
        """(item, shared shingles) for items with shingles of ``words`` words."""
        for partition in self._partitions[words]:
            if len(document) < partition.least:
                continue
            for n in sorted(partition.hits(document)):
                hashes = self.items[n][1]
                at = np.searchsorted(document, hashes)
                shared = int((document[np.minimum(at, len(document) - 1)] == hashes).sum())
                if shared >= _needed(len(hashes), self.threshold):
                    yield n, shared


def _item(item_id: int | None, text: str | None, words: int) -> Item | None:
    raw = (text or "").encode()
    width = min(words, len(raw.split()))
    if not width:
        return None
    return item_id, np.unique(shingle_hashes([raw], width)[0]), width


def _blocks(benchmark: DataFrame, threshold: float, words: int, limit: int) -> Iterator[Block]:
    held: list[Item] = []
    size = 0
    for row in benchmark.select("item_id", F.col("text").cast("string")).toLocalIterator():
        item = _item(row[0], row[1], words)
        if item is None:
            continue
        if held and size + len(row[1]) > limit:
            yield Block(held, threshold)
            held, size = [], 0
        held.append(item)
        size += len(row[1])
    if held:
        yield Block(held, threshold)


def _per_width(texts: list[bytes], widths: list[int]) -> Iterator[list[np.ndarray]]:
    """For each text its ascending distinct shingle hashes, by shingle width."""
    for a, b in portions(texts):
        columns = [shingle_hashes(texts[a:b], w) for w in widths]
        for hashes in zip(*columns, strict=True):
            yield [np.unique(h) for h in hashes]


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every (document, item) pair with containment of at least ``threshold``.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are not looked
    at. Returns doc_id, item_id, item_shingles, shared_shingles. A-Z count as a-z; words are
    separated by white space. Items of fewer than ``words`` words are searched as their whole
    word sequence. Null and empty texts, and items without words, match
    nothing; repeated rows and items each give their own pairs; null ids are passed on.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, item_shingles long, shared_shingles long"

    def search(block: Block) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids, found = batch["doc_id"].to_pylist(), []
                for row, hashes in enumerate(_per_width(utf8(batch["text"]), index.widths)):
                    for words_of, document in zip(index.widths, hashes, strict=True):
                        if len(document):
                            found += [(ids[row], n, k) for n, k in index.search(document, words_of)]
                if found:
                    doc, item, count = zip(*found, strict=True)
                    yield pa.record_batch(
                        {
                            "doc_id": pa.array(doc, pa.int64()),
                            "item_id": pa.array([index.items[n][0] for n in item], pa.int64()),
                            "item_shingles": pa.array([len(index.items[n][1]) for n in item], pa.int64()),
                            "shared_shingles": pa.array(count, pa.int64()),
                        }
                    )
            give_back()

        return docs.mapInArrow(find, schema)

    waiting: DataFrame | None = None
    done: list[DataFrame] = []
    for block in _blocks(benchmark, threshold, words, block_bytes):
        if waiting is not None:
            done.append(spool(waiting, "leaks"))  # one block at a time is held by the driver
        waiting = search(block)
    if waiting is None:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, [*done, waiting])


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns.

    Texts decide, not ids, so rows with a null or repeated doc_id are judged one by one.
    """
    columns = [f"c{i}" for i in range(len(docs.columns))]
    text = F.col(columns[docs.columns.index("text")]).cast("string")
    current = docs.toDF(*columns)
    schema = current.schema

    def clean(block: Block, rows: DataFrame) -> DataFrame:
        shared = rows.sparkSession.sparkContext.broadcast(block)

        def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                flags = [
                    not any(len(d) and next(index.search(d, w), None) for w, d in zip(index.widths, hashes, strict=True))
                    for hashes in _per_width(utf8(batch["text"]), index.widths)
                ]
                yield batch.drop_columns(["text"]).filter(pa.array(flags, pa.bool_()))
            give_back()

        return rows.withColumn("text", text).mapInArrow(keep, schema)

    for n, block in enumerate(_blocks(benchmark, threshold, words, BLOCK_BYTES)):
        if n:
            current = spool(current, "clean")  # one block at a time is held by the driver
        current = clean(block, current)
    return current.toDF(*docs.columns)
