"""Removal of repeated passages by a distributed merge sort of suffixes.

A byte goes if a 50-byte string that covers it also starts in a document with a smaller
doc_id. Sorting every suffix would sort every byte; instead each 50-byte window has one
anchor, the place of its smallest 16-byte hash (leftmost if tied). Equal windows have
their anchors at the same offset, so comparing the suffixes at anchors, with what stands before
them, compares all windows.

1. Chunks ask owners which anchor hashes other chunks have (``_exchange``). Only anchors
   that repeat take part in the sort.
2. Each chunk sorts its repeated anchors by their suffix (50 bytes, then the 34 bytes before
   it, read backwards), and sends the runs front-coded: length of the prefix shared with the entry
   before, and the rest. Equal entries of a chunk are sent once.
3. An owner merges its runs with a loser tree whose entries know how much they share with
   the last winner: longer shared prefixes win without looking, equal ones are compared from
   there on. The winner's number is its shared prefix with the winner before, and groups of equal anchors
   are read off these numbers.
4. Chunks get a mask per entry back: which windows of the anchor start in a smaller document.

An anchor with very many entries takes no part in 2 and 3. Its windows are keyed by digests of
their 50 bytes, so that they are settled by many tasks; equal windows still meet.

Documents are scanned three times, four times if there are such anchors, and never shuffled.
"""

from __future__ import annotations

import hashlib
import struct
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm._exchange import Met, chunks, decode_sorted, give_back, letters, owner_edges, owner_of, pin_splits, read_bits, with_answers
from tidemill.llm._scratch import spool
from tidemill.llm._text import RangeHash, joined, mix, portions, utf8

WIDTH = 50
GRAM = 16
_GRAMS = WIDTH - GRAM + 1
_LEFT = WIDTH - GRAM
#: Of an entry: suffix, bytes before it backwards, and how many of both lie in the document.
ENTRY = WIDTH + _LEFT + 2
#: Text bytes for which there is one owner.
BYTES_PER_OWNER = 4 << 20
_BLOCK = 1 << 20
#: Text bytes of a part of a chunk.
BATCH_BYTES = 1 << 18
_NO_ID = np.int64((1 << 63) - 1)
#: Part numbers of the answers of step 3 start here; those of step 1 are below.
_MASKS = 1 << 24
#: The part number of answers about windows of hot anchors.
_HOT = (1 << 31) - 1
#: An anchor with more entries is hot. Entries count once in a chunk.
HOT_ANCHOR = 20_000
#: Groups of more classes are compared by sorting windows, smaller ones pair by pair.
_PAIRWISE = 12


def minimizers(buffer: np.ndarray) -> np.ndarray:
    """Of each window of WIDTH bytes, by start, the place of its anchor."""
    count = max(0, len(buffer) - WIDTH + 1)
    found = np.empty(count, np.int64)
    places = np.uint64(2 * _BLOCK - 1)
    for start in range(0, count, _BLOCK):
        part = buffer[start : min(count, start + _BLOCK) + WIDTH - 1]
        keys = RangeHash(part).windows(GRAM)
        keys &= ~places
        keys |= np.arange(len(keys), dtype=np.uint64)
        for step in (1, 2, 4, 8, 16, _GRAMS - 32):
            keys = np.minimum(keys[:-step], keys[step:])
        found[start : start + len(keys)] = (keys & places).astype(np.int64) + start
    return found


class _Part:
    """Some documents of a chunk in one buffer, their anchors, and each anchor's windows."""

    def __init__(self, texts: list[bytes], ids: np.ndarray):
        self.buffer, self.bounds = joined(texts)
        ends = self.bounds[1:] - 1
        edge = np.zeros(len(self.buffer) + 1, np.int32)
        long = ends - self.bounds[:-1] >= WIDTH
        edge[self.bounds[:-1][long]] += 1
        edge[ends[long] - WIDTH + 1] -= 1
        windows = np.flatnonzero(np.cumsum(edge[: max(0, len(self.buffer) - WIDTH + 1)]))
        anchors = minimizers(self.buffer)[windows]
        new = np.ones(len(windows), bool)
        new[1:] = np.diff(anchors) != 0
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(windows))[: len(first)] - 1
        self.anchors = anchors[first]
        self.low = (self.anchors - windows[last]).astype(np.uint8)
        self.high = (self.anchors - windows[first]).astype(np.uint8)
        # Mixed again: anchors have small hashes, and owners have equal ranges.
        self.hashes = mix(RangeHash(self.buffer)(self.anchors, self.anchors + GRAM))
        self.owner = np.searchsorted(self.bounds, self.anchors, side="right") - 1
        self.ids = ids[self.owner]

    def contexts(self) -> np.ndarray:
        """Hashes of what the entries of the anchors are made of."""
        starts, ends = self.bounds[self.owner], self.bounds[self.owner + 1] - 1
        return RangeHash(self.buffer)(np.maximum(self.anchors - _LEFT, starts), np.minimum(self.anchors + WIDTH, ends))

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and documents of all windows of the chosen anchors."""
        counts = self.high[chosen].astype(np.int64) - self.low[chosen] + 1
        first = np.repeat(self.anchors[chosen] - self.high[chosen], counts)
        step = np.arange(len(first)) - np.repeat(np.cumsum(counts) - counts, counts)
        return first + step, np.repeat(self.ids[chosen], counts)

    def digests(self, starts: np.ndarray) -> np.ndarray:
        """16-byte digests of the windows that start there."""
        raw = self.buffer.tobytes()
        found = b"".join(hashlib.blake2b(raw[s : s + WIDTH], digest_size=16).digest() for s in starts.tolist())
        return np.frombuffer(found, "S16")

    def choose(self, chosen: np.ndarray) -> None:
        for name in ("anchors", "low", "high", "hashes", "owner", "ids"):
            setattr(self, name, getattr(self, name)[chosen])

    def entries(self) -> np.ndarray:
        a = self.anchors
        starts, ends = self.bounds[self.owner], self.bounds[self.owner + 1] - 1
        matrix = np.zeros((len(a), ENTRY), np.uint8)
        for i in range(WIDTH):
            at = np.minimum(a + i, len(self.buffer) - 1)
            matrix[:, i] = np.where(a + i < ends, self.buffer[at], 0)
        for i in range(_LEFT):
            at = a - 1 - i
            matrix[:, WIDTH + i] = np.where(at >= starts, self.buffer[np.maximum(at, 0)], 0)
        matrix[:, -2] = np.minimum(ends - a, WIDTH)
        matrix[:, -1] = np.minimum(a - starts, _LEFT) + 1  # never 0: a byte string keeps its length
        return matrix


def _parts(table: pa.Table) -> list[_Part]:
    texts = utf8(table["text"])
    ids = table["doc_id"].cast(pa.int64()).fill_null(int(_NO_ID)).to_numpy()
    return [_Part(texts[a:b], ids[a:b]) for a, b in portions(texts, BATCH_BYTES)]


def _counted(parts: list[_Part]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchor hashes of a chunk, and how many distinct entries each has."""
    hashes = np.concatenate([p.hashes for p in parts])
    distinct, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    several = np.flatnonzero(counts[inverse] > 1)
    contexts = np.concatenate([p.contexts() for p in parts])[several]
    _, first = np.unique(mix(contexts ^ mix(hashes[several])), return_index=True)
    entries = np.bincount(inverse[several[first]], minlength=len(distinct))
    return distinct, np.maximum(entries, 1)


def _with_list(code: bytes, *columns: np.ndarray) -> bytes:
    """``code`` and behind it 32-bit columns of equal length."""
    return code + b"".join(c.astype("<u4").tobytes() for c in columns) + struct.pack("<I", len(columns[0]))


def _read_list(code: bytes, columns: int) -> list[np.ndarray]:
    (n,) = struct.unpack_from("<I", code, len(code) - 4)
    start = len(code) - 4 - 4 * n * columns
    return [np.frombuffer(code, "<u4", n, start + 4 * n * i) for i in range(columns)]


def _anchor_letters(chunk: int, parts: list[_Part], owners: int) -> Iterator[tuple[int, int, bytes]]:
    """Anchor hashes for their owners, with the number of entries where it is not 1."""
    hashes, entries = _counted(parts)
    edges = owner_edges(hashes, owners)
    for owner, sender, code in letters(chunk, hashes, owners):
        own = entries[edges[owner] : edges[owner + 1]]
        more = np.flatnonzero(own > 1)
        yield owner, sender, _with_list(code, more, own[more])


def _shared_anchors(sent: DataFrame, limit: int) -> DataFrame:
    """Answers (chunk, part, answer, hot): a bit per hash, set if another chunk has it too; then
    the places of those with more than ``limit`` entries in all chunks."""

    def answer(table: pa.Table) -> pa.Table:
        codes = table["code"].to_pylist()
        sets = [decode_sorted(code) for code in codes]
        values, inverse, chunks_with = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        entries = chunks_with.copy()
        answers, hot, at = [], [], 0
        for own, code in zip(sets, codes, strict=True):
            place, count = _read_list(code, 2)
            np.add.at(entries, inverse[at : at + len(own)][place], count.astype(np.int64) - 1)
            at += len(own)
        at = 0
        for own in sets:
            index = inverse[at : at + len(own)]
            at += len(own)
            places = np.flatnonzero(entries[index] > limit)
            hot.append(len(places))
            answers.append(_with_list(struct.pack("<I", len(own)) + np.packbits(chunks_with[index] > 1).tobytes(), places))
        parts = table["owner"].cast(pa.int32())
        del sets, values, inverse, chunks_with, entries, codes
        give_back()
        return pa.table({"chunk": table["chunk"].cast(pa.int64()), "part": parts, "answer": pa.array(answers, pa.binary()), "hot": pa.array(hot, pa.int64())})

    return sent.groupBy("owner").applyInArrow(answer, "chunk long, part int, answer binary, hot long")


def _hot_flags(hashes: np.ndarray, owners: int, answers: dict[int, bytes]) -> np.ndarray:
    """Which of ascending distinct hashes are hot; ``read_bits`` has checked the answers."""
    edges = owner_edges(hashes, owners)
    flags = np.zeros(len(hashes), bool)
    for owner in np.flatnonzero(np.diff(edges)).tolist():
        flags[edges[owner] + _read_list(answers[owner], 1)[0].astype(np.int64)] = True
    return flags


class _Run:
    """The repeated anchors of a chunk: distinct entries in owner and suffix order.

    Windows of hot anchors are apart, as (starts, documents) of each part.
    """

    def __init__(self, parts: list[_Part], owners: int, answers: dict[int, bytes]):
        self.parts = parts
        hashes = np.concatenate([p.hashes for p in parts])
        documents = np.concatenate([p.ids for p in parts])
        distinct, inverse = np.unique(hashes, return_inverse=True)
        least, most = np.full(len(distinct), _NO_ID), np.full(len(distinct), np.int64(-1) << np.int64(62))
        np.minimum.at(least, inverse, documents)
        np.maximum.at(most, inverse, documents)
        repeated = read_bits(distinct, owners, answers) | (least < most)
        hot = _hot_flags(distinct, owners, answers)
        apart, repeated = (repeated & hot)[inverse], (repeated & ~hot)[inverse]
        self.hot: list[tuple[np.ndarray, np.ndarray]] = []
        at = 0
        for part in parts:
            n = len(part.anchors)
            self.hot.append(part.windows(apart[at : at + n]))
            part.choose(repeated[at : at + n])
            at += n
        whose = owner_of(np.concatenate([p.hashes for p in parts]), owners).astype(np.uint32)
        matrix = np.concatenate([p.entries() for p in parts])
        keyed = np.concatenate([whose.astype(">u4").view(np.uint8).reshape(-1, 4), matrix], axis=1)
        ids = np.concatenate([p.ids for p in parts])
        _, first, self.inverse = np.unique(
            np.ascontiguousarray(keyed).view(f"S{ENTRY + 4}").ravel(), return_index=True, return_inverse=True
        )
        self.ids = np.full(len(first), _NO_ID)
        np.minimum.at(self.ids, self.inverse, ids)
        self.matrix, self.whose = matrix[first], whose[first]
        self.low = np.concatenate([p.low for p in parts])[first]
        self.high = np.concatenate([p.high for p in parts])[first]
        self.edges = np.searchsorted(self.whose, np.arange(owners + 1, dtype=np.uint32))

    def letters(self, chunk: int, owners: int) -> Iterator[tuple[int, int, bytes]]:
        sent = False
        for owner in np.flatnonzero(np.diff(self.edges)).tolist():
            sent = True
            yield owner, chunk, self._coded(slice(self.edges[owner], self.edges[owner + 1]))
        if not sent:
            yield chunk % owners, chunk, self._coded(slice(0, 0))

    def _coded(self, part: slice) -> bytes:
        """Front-coded entries: shared prefix lengths, documents, windows, and the rest of each."""
        matrix = self.matrix[part]
        shared = np.zeros(len(matrix), np.uint8)
        if len(matrix) > 1:
            shared[1:] = (matrix[1:] != matrix[:-1]).argmax(axis=1)
        rest = matrix[np.arange(ENTRY) >= shared[:, None]]
        columns = (shared, self.low[part], self.high[part], self.ids[part].astype("<i8"), rest)
        return struct.pack("<I", len(matrix)) + b"".join(c.tobytes() for c in columns)


class _Stream:
    """A front-coded run, read one entry at a time."""

    def __init__(self, code: bytes):
        (self.n,) = struct.unpack_from("<I", code)
        n = self.n
        self.shared = code[4 : 4 + n]
        self.low, self.high = code[4 + n : 4 + 2 * n], code[4 + 2 * n : 4 + 3 * n]
        self.ids = array("q", code[4 + 3 * n : 4 + 11 * n])
        self.code, self._at = code, 4 + 11 * n
        self.next, self.entry = 0, b""
        self.masks = np.zeros(n, np.int64)

    def advance(self) -> int:
        """Go to the next entry; the prefix it shares with the one before, or -1 at the end."""
        if self.next == self.n:
            return -1
        shared = self.shared[self.next]
        end = self._at + ENTRY - shared
        self.entry = self.entry[:shared] + self.code[self._at : end]
        self._at = end
        self.next += 1
        return shared


def merged(streams: list[_Stream]) -> Iterator[tuple[int, _Stream, int]]:
    """Merge runs: (prefix shared with the entry before, stream, index in it) in order.

    The tree holds losers. Every entry on the way of the last winner knows the prefix it
    shares with that winner, so of two entries the one with the longer prefix is smaller,
    and only entries with equal prefixes are compared, from the end of the prefix.
    """
    width = 1 << max(0, len(streams) - 1).bit_length()
    entries: list[bytes] = [b""] * width
    shared = [-1] * width
    for i, stream in enumerate(streams):
        shared[i] = stream.advance()
        entries[i] = stream.entry
    loser = [0] * width

    def play(x: int, y: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix becomes the one it shares with the winner."""
        if shared[x] != shared[y]:
            return (x, y) if shared[x] > shared[y] else (y, x)
        known = shared[x]
        if known < 0:
            return x, y
        a, b = entries[x], entries[y]
        if a == b:
            shared[y] = ENTRY
            return x, y
        while a[known] == b[known]:
            known += 1
        if a[known] < b[known]:
            shared[y] = known
            return x, y
        shared[x] = known
        return y, x

    best = list(range(width))
    node = width
    while node > 1:
        node //= 2
        pairs = [play(best[2 * i], best[2 * i + 1]) for i in range(node)]
        best = [w for w, _ in pairs]
        loser[node : 2 * node] = [x for _, x in pairs]
    winner = best[0]
    while shared[winner] >= 0:
        stream = streams[winner]
        yield shared[winner], stream, stream.next - 1
        shared[winner] = stream.advance()
        entries[winner] = stream.entry
        node = (winner + width) // 2
        while node:
            other = loser[node]
            if shared[other] > shared[winner]:
                loser[node], winner = winner, other
            elif shared[other] == shared[winner]:
                winner, loser[node] = play(winner, other)
            node //= 2


class _Class:
    """Equal entries of all runs: their first document, their windows, and where they came from."""

    __slots__ = ("before", "entry", "id", "members", "windows")

    def __init__(self, entry: bytes, windows: int):
        self.entry, self.windows = entry, windows
        self.before = int.from_bytes(entry[WIDTH : WIDTH + _LEFT])
        self.id = int(_NO_ID)
        self.members: list[tuple[_Stream, int, int]] = []

    def answer(self, mask: int) -> None:
        """``mask``: windows that start in a document before this class's first."""
        for stream, index, document in self.members:
            stream.masks[index] = self.windows if document > self.id else mask


def _span(low: int, high: int) -> int:
    return (1 << (high + 1)) - (1 << low) if high >= low else 0


def _settle(group: list[_Class], shared: list[int]) -> None:
    """Answer all classes with one anchor; ``shared``: prefix with the class before, by class."""
    if len(group) == 1:
        group[0].answer(0)
    elif len(group) <= _PAIRWISE:
        masks = [0] * len(group)
        for i, a in enumerate(group):
            right = WIDTH
            for j in range(i + 1, len(group)):
                right = min(right, shared[j])
                b = group[j]
                if a.id == b.id:
                    continue
                left = _LEFT - ((a.before ^ b.before).bit_length() + 7) // 8
                both = _span(WIDTH - right, left) & a.windows & b.windows
                masks[i if b.id < a.id else j] |= both
        for a, mask in zip(group, masks, strict=True):
            a.answer(mask)
    else:
        for a, mask in zip(group, _by_window(group), strict=True):
            a.answer(mask)


def _by_window(group: list[_Class]) -> list[int]:
    entries = np.frombuffer(b"".join(c.entry for c in group), np.uint8).reshape(len(group), ENTRY)
    windows = np.array([c.windows for c in group], np.int64)
    ids = np.array([c.id for c in group], np.int64)
    masks = np.zeros(len(group), np.int64)
    for offset in range(_LEFT + 1):
        own = np.flatnonzero((windows >> offset) & 1)
        if len(own) < 2:
            continue
        text = np.concatenate([entries[own, : WIDTH - offset], entries[own, WIDTH : WIDTH + offset]], axis=1)
        hashed = hash_rows(text)
        order = np.lexsort((ids[own], hashed))
        head = np.ones(len(own), bool)
        # Rows with equal hashes are compared before they count as one window.
        head[1:] = (hashed[order[1:]] != hashed[order[:-1]]) | (text[order[1:]] != text[order[:-1]]).any(axis=1)
        least = ids[own][order][np.flatnonzero(head)][np.cumsum(head) - 1]
        masks[own[order]] |= (least < ids[own][order]).astype(np.int64) << offset
    return masks.tolist()


def hash_rows(rows: np.ndarray) -> np.ndarray:
    flat = np.ascontiguousarray(rows).ravel()
    starts = np.arange(len(rows)) * rows.shape[1]
    return RangeHash(flat)(starts, starts + rows.shape[1])


def _merge_runs(table: pa.Table) -> pa.Table:
    streams = [_Stream(code) for code in table["code"].to_pylist()]
    group: list[_Class] = []
    shared: list[int] = []
    for prefix, stream, index in merged(streams):
        if prefix < GRAM and group:
            _settle(group, shared)
            group, shared = [], []
        if prefix < ENTRY or not group:
            group.append(_Class(stream.entry, _span(stream.low[index], stream.high[index])))
            shared.append(prefix)
        known = group[-1]
        document = stream.ids[index]
        known.members.append((stream, index, document))
        if document < known.id:
            known.id = document
    if group:
        _settle(group, shared)
    answers = [struct.pack("<I", s.n) + s.masks.astype("<i8").tobytes() for s in streams]
    parts = [_MASKS + o for o in table["owner"].to_pylist()]
    del streams, group
    give_back()
    return pa.table({"chunk": table["chunk"].cast(pa.int64()), "part": pa.array(parts, pa.int32()), "answer": pa.array(answers, pa.binary())})


def _letter_batch(sent: Iterator[tuple[int, int, bytes]]) -> pa.RecordBatch:
    owner, chunk, code = zip(*sent, strict=True)
    return pa.record_batch({"owner": pa.array(owner, pa.int32()), "chunk": pa.array(chunk, pa.int64()), "code": pa.array(code, pa.binary())})


_LETTER = "owner int, chunk long, code binary"


def _window_batch(chunk: int, part: _Part, starts: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """Distinct windows of a part, with their first and last document."""
    windows, inverse = np.unique(part.digests(starts), return_inverse=True)
    least, most = np.full(len(windows), _NO_ID), np.full(len(windows), np.int64(-1) << np.int64(63))
    np.minimum.at(least, inverse, ids)
    np.maximum.at(most, inverse, ids)
    raw = windows.tobytes()
    keys = [raw[i : i + 16] for i in range(0, len(raw), 16)]
    return pa.record_batch({"window": pa.array(keys, pa.binary()), "chunk": pa.array([chunk] * len(keys), pa.int64()), "least": pa.array(least), "most": pa.array(most)})


_WINDOW = "window binary, chunk long, least long, most long"


def _settled_windows(windows: DataFrame) -> DataFrame:
    """Answers to chunks: windows that start in a document before one of the chunk's, and the first such document."""
    first = windows.groupBy("window").agg(F.min("least").alias("first"))
    late = windows.join(first, "window").filter("first < most").select("chunk", "window", "first").distinct()

    def answer(table: pa.Table) -> pa.Table:
        table = table.sort_by("window")
        code = struct.pack("<I", len(table)) + b"".join(table["window"].to_pylist()) + table["first"].to_numpy().astype("<i8").tobytes()
        chunk = table["chunk"].slice(0, 1).cast(pa.int64())
        return pa.table({"chunk": chunk, "part": pa.array([_HOT], pa.int32()), "answer": pa.array([code], pa.binary())})

    return late.groupBy("chunk").applyInArrow(answer, "chunk long, part int, answer binary")


def _gone_windows(part: _Part, starts: np.ndarray, ids: np.ndarray, answer: bytes | None) -> np.ndarray:
    """Of the windows of hot anchors the starts of those that a smaller document has."""
    if answer is None or not len(starts):
        return starts[:0]
    (n,) = struct.unpack_from("<I", answer)
    known, first = np.frombuffer(answer, "S16", n, 4), np.frombuffer(answer, "<i8", n, 4 + 16 * n)
    own = part.digests(starts)
    at = np.minimum(np.searchsorted(known, own), n - 1)
    return starts[(known[at] == own) & (first[at] < ids)]


def _covered(parts: list[_Part], run: _Run, answers: dict[int, bytes]) -> Iterator[tuple[_Part, np.ndarray]]:
    """Of each part the bytes that go."""
    masks = np.zeros(len(run.ids), np.int64)
    for owner in np.flatnonzero(np.diff(run.edges)).tolist():
        a, b = int(run.edges[owner]), int(run.edges[owner + 1])
        answer = answers.get(_MASKS + owner)
        if answer is None or struct.unpack_from("<I", answer)[0] != b - a:
            raise RuntimeError("the input changed between two scans: write it to a table first")
        masks[a:b] = np.frombuffer(answer, "<i8", offset=4)
    at = 0
    for part, hot in zip(parts, run.hot, strict=True):
        n = len(part.anchors)
        entry = run.inverse[at : at + n]
        at += n
        own = (np.int64(2) << part.high.astype(np.int64)) - (np.int64(1) << part.low.astype(np.int64))
        own = np.where(part.ids > run.ids[entry], own, masks[entry])
        edge = np.zeros(len(part.buffer) + 1, np.int32)
        for offset in range(_LEFT + 1):
            starts = part.anchors[((own >> offset) & 1).astype(bool)] - offset
            edge[starts] += 1  # an anchor has one window at an offset: no place comes twice
            edge[starts + WIDTH] -= 1
        starts = _gone_windows(part, *hot, answers.get(_HOT))
        edge[starts] += 1  # windows have one anchor each: no start comes twice
        edge[starts + WIDTH] -= 1
        yield part, np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, kept binary, n_bytes, n_removed, n_spans for every row of ``docs`` (doc_id, text).

    ``kept`` are the UTF-8 bytes of the text without those covered by a 50-byte string that also
    starts in a document with a smaller doc_id; strings are judged on the input. Null counts
    as empty. Texts below 50 bytes stay whole. Rows with the same doc_id
    are one document in this respect: they do not remove each other's strings. A null doc_id comes after
    all others and all null ones are alike. Other columns are not looked at.
    """
    pin_splits(docs)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    owners = int(size) // BYTES_PER_OWNER + 1

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, table in chunks(batches):
            yield _letter_batch(_anchor_letters(chunk, _parts(table), owners))

    def send(met: Iterable[Met]) -> Iterator[pa.RecordBatch]:
        for chunk, table, answers in met:
            yield _letter_batch(_Run(_parts(table), owners, answers).letters(chunk, owners))

    def send_windows(met: Iterable[Met]) -> Iterator[pa.RecordBatch]:
        for chunk, table, answers in met:
            parts = _parts(table)
            for part, hot in zip(parts, _Run(parts, owners, answers).hot, strict=True):
                if len(hot[0]):
                    yield _window_batch(chunk, part, *hot)

    def remove(met: Iterable[Met]) -> Iterator[pa.RecordBatch]:
        for _, table, answers in met:
            ids, row = table["doc_id"], 0
            parts = _parts(table)
            for part, gone in _covered(parts, _Run(parts, owners, answers), answers):
                kept, removed, spans = [], [], []
                for a, b in zip(part.bounds[:-1].tolist(), (part.bounds[1:] - 1).tolist(), strict=True):
                    flags = gone[a:b]
                    kept.append(part.buffer[a:b][~flags].tobytes())
                    removed.append(int(flags.sum()))
                    spans.append(int(flags[:1].sum()) + int((flags[1:] & ~flags[:-1]).sum()))
                n = len(kept)
                sizes = np.diff(part.bounds) - 1
                part_ids = ids.slice(row, n).combine_chunks().cast(pa.int64())
                row += n
                arrays = [part_ids, pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans))]
                yield pa.record_batch(arrays, ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    counted = spool(_shared_anchors(docs.mapInArrow(ask, _LETTER), HOT_ANCHOR), "anchors")
    repeated = counted.drop("hot")
    sent = with_answers(docs, repeated, send, _LETTER)
    masks = sent.groupBy("owner").applyInArrow(_merge_runs, "chunk long, part int, answer binary")
    answers = repeated.unionByName(masks)
    if counted.agg(F.sum("hot")).head()[0]:
        windows = spool(with_answers(docs, repeated, send_windows, _WINDOW), "windows")
        answers = answers.unionByName(_settled_windows(windows))
    return with_answers(
        docs, answers, remove, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long"
    )


