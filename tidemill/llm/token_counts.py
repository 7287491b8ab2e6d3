"""Token counts that follow edits, with a segment tree of pre-tokens per document.

The tokenizer cuts a text into pre-tokens and encodes each by itself. Where a
non-space is followed by a space or line end, a pre-token ends, whatever stands
around. A leaf of the tree is a run of pre-tokens between two such places; inner nodes hold the
sums of characters and tokens below them. An edit finds its leaves by
descending, takes in the neighbour if it touches a border (the boundary context), encodes
that region alone, and updates the sums on the way up.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-token pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of a leaf, at least; leaves that grow past eight times this are cut anew.
LEAF_CHARS = 256
_CUT = re.compile(r"(?<=\S)(?=[ \n])")


@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _leaves(text: str) -> list[str]:
    found, start = [], 0
    while start < len(text):
        cut = _CUT.search(text, start + LEAF_CHARS)
        end = cut.start() if cut else len(text)
        found.append(text[start:end])
        start = end
    return found


class TokenTree:
    """A document as leaves of text, and sums of their characters and tokens in heap order."""

    def __init__(self, text: str, encoder):
        self._encoder = encoder
        self.encoded_chars = 0
        self._build(_leaves(text))

    def _count(self, text: str) -> int:
        self.encoded_chars += len(text)
        return len(self._encoder.encode_ordinary(text))

    def _build(self, leaves: list[str], tokens: list[int] | None = None) -> None:
        self._width = 1 << max(0, len(leaves) - 1).bit_length()
        self.leaves = leaves + [""] * (self._width - len(leaves))
        tokens = [self._count(t) for t in leaves] if tokens is None else tokens
        padding = [0] * (self._width - len(leaves))
        self.chars = [0] * self._width + [len(t) for t in self.leaves]
        self.tokens = [0] * self._width + tokens + padding
        for node in range(self._width - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def _leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf that has the character, and where the leaf starts; the last one beyond the end."""
        node, start = 1, 0
        while node < self._width:
            node *= 2
            if position - start >= self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self._width, start

    def _set(self, changes: dict[int, str]) -> None:
        dirty = set()
        for leaf, text in changes.items():
            node = leaf + self._width
            self.leaves[leaf], self.chars[node] = text, len(text)
            self.tokens[node] = self._count(text) if text else 0
            dirty.add(node // 2)
        while dirty - {0}:
            for node in dirty - {0}:
                self._sum(node)
            dirty = {node // 2 for node in dirty if node > 1}

    def replace(self, start: int, stop: int, text: str) -> None:
        """Put ``text`` in place of the characters from start to stop, which are cut to the text."""
        start = min(max(start, 0), self.n_chars)
        stop = min(max(stop, start), self.n_chars)
        # One more character on either side: whoever has it may be tokenized otherwise now.
        first, at = self._leaf_at(max(0, start - 1))
        last, _ = self._leaf_at(stop)
        region = "".join(self.leaves[first : last + 1])
        changed = region[: start - at] + text + region[stop - at :]
        if len(changed) <= 8 * LEAF_CHARS * (last - first + 1):
            self._set({first: changed} | {leaf: "" for leaf in range(first + 1, last + 1) if self.leaves[leaf]})
            return
        # The region outgrew its leaves: cut it anew. Untouched leaves keep their counts.
        fresh = _leaves(changed)
        counted = [self._count(t) for t in fresh]
        old = self.tokens[self._width :]
        kept = [(t, n) for t, n in zip(self.leaves, old, strict=True) if t]
        before = sum(1 for t in self.leaves[:first] if t)
        after = sum(1 for t in self.leaves[last + 1 :] if t)
        pairs = kept[:before] + list(zip(fresh, counted, strict=True)) + (kept[-after:] if after else [])
        self._build([t for t, _ in pairs], [n for _, n in pairs])


def edited_counts(docs: DataFrame, ranks_file: str) -> DataFrame:
    """Token counts of every row of ``docs`` before and after its edits; no shuffle.

    ``docs`` has doc_id, text and ``edits``, an array of (start, stop, text) in code points, applied
    in order, each to the text that the ones before it left; ``ranks_file`` is a byte-pair rank file
    on the driver. Returns doc_id, tokens_before, tokens_after, chars_after, leaf_chars and leaf_tokens
    (the leaves of the tree after the edits) and reencoded_chars, the characters that
    the edits had encoded again. Null text counts as empty, null edits as none; positions outside
    a text are moved to its ends, a null position counts as 0 and null replacement as empty. Rows
    are independent; other columns are not looked at.
    """
    docs.sparkSession.sparkContext.addFile(ranks_file)
    name = ranks_file.rsplit("/", 1)[-1]

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(SparkFiles.get(name))
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part, rows = batch.slice(begin, 256), []
                for text, edits in zip(part["text"].to_pylist(), part["edits"].to_pylist(), strict=True):
                    tree = TokenTree(text or "", encoder)
                    before, tree.encoded_chars = tree.n_tokens, 0
                    for edit in edits or ():
                        if edit is not None:
                            tree.replace(edit["start"] or 0, edit["stop"] or 0, edit["text"] or "")
                    full = [n for n in range(tree._width, 2 * tree._width) if tree.chars[n]]
                    rows.append((before, tree.n_tokens, tree.n_chars, [tree.chars[n] for n in full], [tree.tokens[n] for n in full], tree.encoded_chars))
                columns = list(zip(*rows, strict=True))
                longs = pa.list_(pa.int64())
                kinds = [pa.int64(), pa.int64(), pa.int64(), longs, longs, pa.int64()]
                yield pa.record_batch([part["doc_id"], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], _NAMES)

    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        F.col("edits").cast("array<struct<start:long,stop:long,text:string>>"),
    )
    return rows.mapInArrow(counted, _SCHEMA)


_NAMES = ["doc_id", "tokens_before", "tokens_after", "chars_after", "leaf_chars", "leaf_tokens", "reencoded_chars"]
_SCHEMA = "doc_id long, tokens_before long, tokens_after long, chars_after long, leaf_chars array<long>, leaf_tokens array<long>, reencoded_chars long"

#: What sample edits put in.
INSERTS = ("", " ", " added words", "X", "\n\n", "'s", " 42nd", "é")


def with_sample_edits(docs: DataFrame, per_document: int = 4, seed: int = 7) -> DataFrame:
    """``docs`` (doc_id, text) with an ``edits`` column: deletions, insertions and replacements.

    They are drawn from hashes of doc_id, over the whole text.
    """
    length = F.char_length(F.coalesce(F.col("text").cast("string"), F.lit("")))

    def drawn(k: int, what: int):
        return F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed), F.lit(k), F.lit(what))

    edits = []
    for k in range(per_document):
        start = F.pmod(drawn(k, 0), length + 1)
        text = F.element_at(F.array(*map(F.lit, INSERTS)), (F.pmod(drawn(k, 2), F.lit(len(INSERTS))) + 1).cast("int"))
        edits.append(F.struct(start.alias("start"), (start + F.pmod(drawn(k, 1), F.lit(24))).alias("stop"), text.alias("text")))
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), F.array(*edits).alias("edits"))
