"""SentencePiece merge encoding with seeded merge-dropout, and decoding.

A text becomes its code points, spaces as U+2581 behind one added in front. An agenda
holds the adjacent pairs that the vocabulary can merge, best score first. Every candidate
that comes up is first put to a keyed hash of (seed, doc_id, unit of the text, number of
the candidate) and passed over with probability ``dropout``; else it is merged and its
new neighbours join the agenda. So each occurrence of a word is cut up in its own way,
and the same seed always cuts alike, on any partitioning.

No piece of the vocabulary crosses from a letter to a space, so the agenda of a text is
the union of the agendas of its units (spaces with the word behind them). The agendas of
a batch of texts advance together: each round takes the best candidate of every unit,
so the work is done on arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm._exchange import give_back
from tidemill.llm._text import mix

SPACE = "\u2581"
#: Code points whose agendas advance together; one longer text is a batch of its own.
BATCH_CHARS = 1 << 18
#: Longer units have an agenda of their own, a heap; rounds over all units suit short ones.
LONG_UNIT = 200
_NEVER = np.int64(1) << np.int64(62)
_SLOTS = 21
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Pairs:
    """(left piece, right piece) -> merged piece, as an open hash table for whole arrays."""

    def __init__(self, merged: dict[tuple[int, int], int]):
        self._keys = np.full(1 << _SLOTS, -1, np.int64)
        self._values = np.full(1 << _SLOTS, -1, np.int32)
        for (left, right), piece in merged.items():
            key = (left << 32) | right
            slot = int(self._slot(np.array([key]))[0])
            while self._keys[slot] >= 0:
                slot = (slot + 1) & ((1 << _SLOTS) - 1)
            self._keys[slot], self._values[slot] = key, piece

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _STEP) >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged piece of each pair, or -1."""
        keys = (left.astype(np.int64) << 32) | right
        slots = self._slot(keys)
        there = self._keys[slots]
        found = np.where(there == keys, self._values[slots], np.int32(-1))
        searching = np.flatnonzero((there != keys) & (there >= 0))
        while len(searching):
            slots[searching] = (slots[searching] + 1) & ((1 << _SLOTS) - 1)
            there = self._keys[slots[searching]]
            hit = there == keys[searching]
            found[searching[hit]] = self._values[slots[searching[hit]]]
            searching = searching[~hit & (there >= 0)]
        return found


class MergeDropout:
    """Encoder and decoder of one merge vocabulary (a SentencePiece BPE model with byte pieces).

    ``dropout`` is taken in 256ths; 0 gives the model's own segmentation.
    """

    def __init__(self, model: bytes, dropout: float, seed: int):
        from sentencepiece import SentencePieceProcessor

        if not 0 <= dropout < 1:
            raise ValueError("dropout must be at least 0 and below 1")
        pieces = SentencePieceProcessor(model_proto=model)
        count = pieces.get_piece_size()
        ids: dict[str, int] = {}
        self._bytes = np.zeros(256, np.int32)
        self._plain = np.empty(count, object)
        self._ranks = np.zeros(count, np.int64)
        for i in range(count):
            piece = pieces.id_to_piece(i)
            if pieces.is_byte(i):
                value = int(piece[3:5], 16)
                self._bytes[value] = i
                self._plain[i] = bytes([value])
            elif pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_unused(i):
                self._plain[i] = b""
            else:
                ids[piece] = i
                self._plain[i] = piece.replace(SPACE, " ").encode()
        # Ranks: position by falling score, so that they are small whole numbers.
        scored = sorted(ids.values(), key=lambda i: (-pieces.get_score(i), i))
        self._ranks[scored] = np.arange(len(scored))
        #: Piece of a single code point; -2 for those that are written as bytes.
        self._singles = np.full(0x110000, -2, np.int32)
        self._singles[:128] = self._bytes[:128]
        merged: dict[tuple[int, int], int] = {}
        for piece, i in ids.items():
            if len(piece) == 1:
                self._singles[ord(piece)] = i
            for cut in range(1, len(piece)):
                if piece[:cut] in ids and piece[cut:] in ids:
                    merged[ids[piece[:cut]], ids[piece[cut:]]] = i
        self._space = ids[SPACE]
        self._singles[ord(" ")] = self._space
        self._singles[ord(SPACE)] = -2  # a literal one is written as bytes, or it would come back as a space
        self._merged, self._pairs = merged, _Pairs(merged)
        self._limit = round(dropout * 256)
        self._seed = mix(np.array([seed & ((1 << 64) - 1)], np.uint64))

    def encode(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """Ids of each text; its key, the doc_id, goes into the hash. An empty text has none."""
        found: list[np.ndarray] = []
        start = size = 0
        for i, text in enumerate(texts):
            if i > start and size + len(text) > BATCH_CHARS:
                found += self._encode(texts[start:i], keys[start:i])
                start = i
                size = 0
            size += len(text) + 1
        return found + self._encode(texts[start:], keys[start:])

    def _encode(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        full = [i for i, t in enumerate(texts) if t]
        none = np.zeros(0, np.int32)
        if not full:
            return [none for _ in texts]
        points = np.frombuffer("".join(" " + texts[i] for i in full).encode("utf-32-le", "surrogatepass"), "<u4")
        lengths = np.array([len(texts[i]) + 1 for i in full])
        starts = np.cumsum(lengths) - lengths
        symbols = self._singles[points]
        unit = self._units(points, symbols, starts)
        first_unit = unit[starts]
        numbers = np.arange(unit[-1] + 1, dtype=np.uint64)
        per_text = np.diff(np.append(first_unit, len(numbers)))
        keyed = mix(self._seed ^ mix(np.array([keys[i] & ((1 << 64) - 1) for i in full], np.uint64)))
        numbers -= np.repeat(first_unit, per_text).astype(np.uint64)
        hashed = mix(np.repeat(keyed, per_text) + numbers * np.uint64(0xD1342543DE82EF95))
        self._merge(symbols, unit, hashed)
        alive = np.flatnonzero(symbols != -1)
        ids, edges = self._with_bytes(symbols[alive], points[alive], np.searchsorted(alive, np.append(starts, len(points))))
        out = [none for _ in texts]
        for n, i in enumerate(full):
            out[i] = ids[edges[n] : edges[n + 1]]
        return out

    def _units(self, points: np.ndarray, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Number of the unit of each code point."""
        space = symbols == self._space
        apart = (points == 10) | (points == ord(SPACE))
        new = apart.copy()
        new[1:] |= apart[:-1] | (space[1:] & ~space[:-1])
        new[starts] = True
        return np.cumsum(new) - 1

    def _merge(self, symbols: np.ndarray, unit: np.ndarray, hashed: np.ndarray) -> None:
        """Run all agendas; merged symbols end up at their first code point, -1 elsewhere."""
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        merged, order = np.full(n, -1, np.int32), np.full(n, _NEVER)

        def candidates(left: np.ndarray) -> None:
            """Put the pair that starts at each of these places on the agenda, or take it off."""
            right = after[left]
            inside = right < n
            inside[inside] = unit[right[inside]] == unit[left[inside]]
            piece = np.full(len(left), -1, np.int32)
            a, b = symbols[left[inside]], symbols[right[inside]]
            both = (a >= 0) & (b >= 0)
            pair = np.full(len(a), -1, np.int32)
            pair[both] = self._pairs(a[both], b[both])
            piece[inside] = pair
            merged[left] = piece
            order[left] = np.where(piece >= 0, (self._ranks[piece] << 32) | left, _NEVER)

        sizes = np.bincount(unit)
        for long in np.flatnonzero(sizes > LONG_UNIT).tolist():
            start = int(np.searchsorted(unit, long))
            self._merge_long(symbols[start : start + int(sizes[long])], hashed[long : long + 1])
        places = np.flatnonzero(sizes[unit] <= LONG_UNIT)
        if not len(places):
            return
        candidates(places)
        word, number = hashed, 0
        while True:
            head = np.ones(len(places), bool)
            units = unit[places]
            head[1:] = units[1:] != units[:-1]
            firsts = np.flatnonzero(head)
            best = np.minimum.reduceat(order[places], firsts)
            open_ = best < _NEVER
            if not open_.all():  # agendas that are empty are done
                places = places[np.repeat(open_, np.diff(np.append(firsts, len(places))))]
                best = best[open_]
            if not len(best):
                return
            chosen = best & np.int64(0xFFFFFFFF)
            if self._limit:
                if number % 8 == 0:
                    word = mix(hashed + np.uint64(number // 8 + 1))
                lane = (word[unit[chosen]] >> np.uint64(8 * (number % 8))) & np.uint64(0xFF)
                passed = lane < np.uint64(self._limit)
                order[chosen[passed]] = _NEVER
                chosen = chosen[~passed]
            number += 1
            gone = after[chosen]
            symbols[chosen] = merged[chosen]
            symbols[gone], order[gone] = -1, _NEVER
            follower = after[gone]
            after[chosen] = follower
            linked = follower < n
            before[follower[linked]] = chosen[linked]
            candidates(chosen)
            ahead = before[chosen]
            ahead = ahead[ahead >= 0]
            candidates(ahead)
            places = places[symbols[places] != -1]

    def _merge_long(self, symbols: np.ndarray, hashed: np.ndarray) -> None:
        """The agenda of one unit, as ``_merge`` runs it for many."""
        own, n = symbols.tolist(), len(symbols)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        agenda: list[tuple[int, int, int, int, int]] = []

        def candidate(left: int) -> tuple[int, int, int, int, int] | None:
            right = after[left]
            piece = self._merged.get((own[left], own[right])) if right < n else None
            return None if piece is None else (int(self._ranks[piece]), left, own[left], own[right], piece)

        agenda = [c for c in map(candidate, range(n)) if c]
        heapify(agenda)
        word = number = 0
        while agenda:
            _, left, a, b, piece = heappop(agenda)
            right = after[left]
            if own[left] != a or right >= n or own[right] != b:
                continue
            if self._limit and number % 8 == 0:
                word = int(mix(hashed + np.uint64(number // 8 + 1))[0])
            passed = (word >> 8 * (number % 8)) & 0xFF < self._limit
            number += 1
            if passed:
                continue
            own[left], own[right] = piece, -1
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            for place in (left, before[left]):
                new = candidate(place) if place >= 0 else None
                if new:
                    heappush(agenda, new)
        symbols[:] = own

    def _with_bytes(self, symbols: np.ndarray, points: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Write code points outside the vocabulary as their UTF-8 bytes."""
        unknown = np.flatnonzero(symbols == -2)
        if not len(unknown):
            return symbols, edges
        written = [chr(p).encode("utf-8", "surrogatepass") for p in points[unknown].tolist()]
        sizes = np.ones(len(symbols), np.int64)
        sizes[unknown] = [len(w) for w in written]
        at = np.concatenate(([0], np.cumsum(sizes)))
        ids = np.repeat(symbols, sizes)
        ids[ids == -2] = self._bytes[np.frombuffer(b"".join(written), np.uint8)]
        return ids, at[edges]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids that ``encode`` gave: its code points, whatever was merged."""
        return b"".join(self._plain[ids].tolist()).decode("utf-8", "replace")[1:]


@lru_cache(maxsize=2)
def _from_file(name: str, dropout: float, seed: int) -> MergeDropout:
    with open(SparkFiles.get(name), "rb") as file:
        return MergeDropout(file.read(), dropout, seed)


def encode_documents(docs: DataFrame, model_file: str, dropout: float = 0.1, seed: int = 1) -> DataFrame:
    """doc_id, ids array<int>, n_tokens, n_chars, decoded string, lossless for every row of ``docs``.

    ``model_file`` is a SentencePiece BPE model on the driver, sent to the workers by Spark.
    ``decoded`` is read back from the ids and ``lossless`` compares it with the text. Null
    counts as empty, and an empty text has no tokens. A null doc_id keys the
    hash like 0. Rows are independent of each other; equal rows get equal ids. Other
    columns are not looked at. No shuffle.
    """
    docs.sparkSession.sparkContext.addFile(model_file)
    name = model_file.rsplit("/", 1)[-1]

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _from_file(name, dropout, seed)
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                keys, texts = part["doc_id"].to_pylist(), [t or "" for t in part["text"].to_pylist()]
                ids = coder.encode(texts, [k or 0 for k in keys])
                decoded = [coder.decode(i) for i in ids]
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(i) for i in ids], out=offsets[1:])
                flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
                yield pa.record_batch(
                    {
                        "doc_id": part["doc_id"],
                        "ids": pa.ListArray.from_arrays(pa.array(offsets), flat),
                        "n_tokens": pa.array(np.diff(offsets).astype(np.int64)),
                        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                        "decoded": pa.array(decoded, pa.string()),
                        "lossless": pa.array([a == b for a, b in zip(decoded, texts, strict=True)]),
                    }
                )
        give_back()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, ids array<int>, n_tokens long, n_chars long, decoded string, lossless boolean"
    return rows.mapInArrow(encode, schema)


def ids_digest(ids: np.ndarray) -> str:
    """Hex SHA-256 of ids as little-endian 32-bit integers."""
    return hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest()
