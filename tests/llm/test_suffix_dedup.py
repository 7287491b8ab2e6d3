from __future__ import annotations

import random
import struct

import numpy as np
import pyarrow as pa
import pytest

from tidemill.llm import suffix_dedup
from tidemill.llm.suffix_dedup import WIDTH, remove_repeats


def brute_force(rows):
    first: dict[bytes, float] = {}
    raw = [(float("inf") if i is None else i, (t or "").encode()) for i, t in rows]
    for doc, text in raw:
        for s in range(len(text) - WIDTH + 1):
            window = text[s : s + WIDTH]
            first[window] = min(doc, first.get(window, doc))
    found = []
    for (doc_id, _), (doc, text) in zip(rows, raw, strict=True):
        gone = bytearray(len(text))
        for s in range(len(text) - WIDTH + 1):
            if first[text[s : s + WIDTH]] < doc:
                gone[s : s + WIDTH] = b"\x01" * WIDTH
        spans = sum(1 for s in range(len(gone)) if gone[s] and not (s and gone[s - 1]))
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        found.append((doc_id, kept, len(text), sum(gone), spans))
    return sorted(found, key=str)


def collected(df):
    return sorted(((r[0], bytes(r[1]), *r[2:]) for r in df.collect()), key=str)


@pytest.mark.parametrize("pairwise", [12, 0])
def test_matches_brute_force(spark, documents, corpus, tmp_path, monkeypatch, pairwise):
    monkeypatch.setattr(suffix_dedup, "_PAIRWISE", pairwise)
    docs = documents([(*r, "x") for r in corpus], tmp_path / "docs", "doc_id long, text string, chunk string")
    assert collected(remove_repeats(docs)) == brute_force(corpus)


def test_repetitive_texts(spark, documents, tmp_path):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randint(40, 70))) * rnd.randint(1, 4) for _ in range(20)]
    texts += ["ab" * n for n in (20, 25, 26, 60)] + ["\x00" * n for n in (49, 50, 51, 120)]
    texts += [t[7:] + "tail" * 20 for t in texts[:10]]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    docs = documents(rows, tmp_path / "docs")
    assert collected(remove_repeats(docs)) == brute_force(rows)


@pytest.mark.parametrize("limit", [0, 3])
def test_hot_anchors_are_settled_by_window(documents, corpus, tmp_path, monkeypatch, limit):
    """Text around a frequent string of 16 bytes: no owner gets an entry for each occurrence."""
    monkeypatch.setattr(suffix_dedup, "HOT_ANCHOR", limit)
    rnd = random.Random(7)
    head = "https://example.org/"
    rows = [*corpus, *((100_000 + i, f"{rnd.random()} {head}{rnd.random()} {head}{i % 4}{'tail' * 20}") for i in range(60))]
    sent = []
    letters = suffix_dedup._Run.letters

    def counted(run, chunk, owners):
        _, entries = np.unique(run.matrix[:, : suffix_dedup.GRAM], axis=0, return_counts=True)
        sent.append(int(entries.max(initial=0)))
        return letters(run, chunk, owners)

    docs = documents(rows, tmp_path / "docs")
    assert collected(remove_repeats(docs)) == brute_force(rows)
    # The same again in this process: what a chunk of all rows would send.
    texts = pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": [t for _, t in rows]})
    parts = suffix_dedup._parts(texts)
    (_, _, code), = suffix_dedup._anchor_letters(0, parts, 1)
    hashes, entries = suffix_dedup._counted(parts)
    answer = suffix_dedup._with_list(struct.pack("<I", len(hashes)) + bytes(len(hashes) // 8 + 1), np.flatnonzero(entries > limit))
    assert (suffix_dedup._read_list(code, 2)[1] == entries[entries > 1]).all()
    list(counted(suffix_dedup._Run(parts, 1, {0: answer}), 0, 1))
    assert sent[0] <= limit


def test_empty_table(spark, documents, tmp_path):
    docs = documents([], tmp_path / "docs")
    assert remove_repeats(docs).collect() == []


def test_long_texts_have_the_same_anchors_in_any_block(monkeypatch):
    import numpy as np

    text = np.frombuffer(bytes(random.Random(2).choices(b"abcd ", k=5000)), np.uint8)
    whole = suffix_dedup.minimizers(text)
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 512)
    # Fewer places leave more hash bits, so only the choice among equal prefixes may differ.
    assert (suffix_dedup.minimizers(text) == whole).mean() > 0.999
