"""Resampling, alignment and word-table BPE against plain versions of the same definitions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
from collections import Counter
from zlib import crc32

import pytest

from llm.conftest import prose
from tidemill.llm.importance_resampling import resample
from tidemill.llm.queries import TOKENIZERS
from tidemill.llm.tokenizer_alignment import MEASURES, align_documents, align_texts
from tidemill.llm.word_table_bpe import encode_documents, encoded_digests

A, B, W = (f"{TOKENIZERS}/{name}" for name in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))

ODD = [
    "", None, " ", "\n\t", "a", "<|endoftext|>", "x<|startoftext|>y <|endoftext|>z", "<s> </s> <unk>", "under▁score",
    "null \x00 byte", "a\x1cb\x85c\xa0d　e", "é ́x Å ﬁ ΣΑΣ İstanbul", "日本語のテキスト。" * 30, "😀👩‍👩‍👧 ok",
    "don't WE'RE i'll 12345 $%&*()", "Z" * 5000, "  two  spaces  ", "\r\nwindows\r\nlines", " line ", "tab\tand\x0bvt\x0cff",
]


@pytest.fixture
def rows():
    rnd = random.Random(5)
    texts = [*ODD, *(prose(rnd, rnd.randint(1, 120)) for _ in range(30)), *["a hot text with <|endoftext|> in it"] * 60, prose(rnd, 9000)]
    rows = [(i, t, -1) for i, t in enumerate(texts)]
    rows += [(None, "a", 1), (None, None, 1), (3, "other text", 2), (3, "other text", 2)]
    rnd.shuffle(rows)
    return rows


#: Columns of the input that are named as the operators' own.
CLASHING = "doc_id long, text string, chunk long"


def same(found, expected):
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def plain_resampling(rows, target):
    def words(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    def buckets(text):
        found = words(text)
        return [crc32(" ".join(found[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(found) - n + 1)]

    s, t = Counter(), Counter()
    for row in rows:
        s.update(buckets(row[1]))
    for text in target:
        t.update(buckets(text))
    sums = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text, _ in rows:
        own = buckets(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (sums[0] + 10000) / ((s[b] + 1) * (sums[1] + 10000)))) for b in own)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    able = sorted((o for o in out if o[5] >= 20), key=lambda o: (-o[3], o[0] is None, o[0]))
    for i, o in enumerate(able[: len(able) * 5 // 100]):
        o[4] = i + 1
    return [tuple(o[:5]) for o in out]


def test_resampling_against_a_plain_version(spark, documents, rows, tmp_path):
    rnd = random.Random(3)
    rows = rows + [(1000 + i, prose(rnd, 25), 0) for i in range(150)]
    target = [prose(rnd, 30), None, "", "Sea1 stone2 ash"]
    docs = documents(rows, tmp_path / "d", CLASHING)
    items = spark.createDataFrame([(t,) for t in target], "text string")
    found = resample(docs, items)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    same(found.collect(), plain_resampling(rows, target))


def test_resampling_of_ties_and_without_rows(spark, documents, tmp_path):
    text = " ".join(f"word{i}" for i in range(20))
    docs = documents([(7, text, 0)] * 40 + [(None, text, 0)] * 20, tmp_path / "d", CLASHING)
    found = resample(docs, docs.limit(0), percent=50).collect()
    ranks = sorted(r["rank"] for r in found if r["rank"] is not None)
    assert ranks == list(range(1, 31)) and len(found) == 60
    assert resample(docs.limit(0), docs).collect() == []


def plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok, b_tok = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tok.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    aligned = []
    for doc_id, text, _ in rows:
        aligned.append(None)
        if not text:
            continue
        a = [(i, bytes(alphabet[c] for c in a_tok.id_to_token(i))) for i in a_tok.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in b_tok.encode(text):
            piece = b_tok.id_to_piece(i)
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            b.append((i, bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            continue

        def ranges(tokens):
            at, out = 0, []
            for i, piece in tokens:
                out.append((i, at, at + len(piece)))
                at += len(piece)
            return out

        a, b = ranges(a), ranges(b)
        links, j = [], 0
        for i, start, end in a:
            while b[j][2] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                links.append((i, b[k][0]))
                k += 1
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for high in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if s >= low and e <= high) for side in (a, b)))
            low = high
        aligned[-1] = (len(a), len(b), links, groups)
    counts = Counter()
    for found in aligned:
        counts.update(set(found[2]) if found else ())
    best = Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for (doc_id, *_), found in zip(rows, aligned, strict=True):
        if found is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, groups = found
        n_best = sum(counts[p] == best[p[0]] for p in links)
        total = sum(counts[p] for p in links)
        out.append((doc_id, n_a, n_b, len(groups), len(links), n_best, total, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out, counts


def test_alignment_against_a_plain_version(documents, rows, tmp_path):
    docs = documents(rows, tmp_path / "d", CLASHING)
    expected, counts = plain_alignment(rows)
    found = align_documents(docs, A, B)
    assert found.columns == ["doc_id", *MEASURES, "groups_sha256"]
    same(found.collect(), expected)
    assert any(row[1] == 0 and row[0] == ODD.index("under▁score") for row in expected)
    _, pairs = align_texts(docs, A, B)
    assert {(r["a_id"], r["b_id"]): r["n"] for r in pairs.collect()} == counts


def test_alignment_without_rows(documents, tmp_path):
    docs = documents([(1, "", 0), (2, None, 0)], tmp_path / "d", CLASHING)
    same(align_documents(docs, A, B).collect(), [(1, *[0] * 6, ""), (2, *[0] * 6, "")])
    assert align_documents(docs.limit(0), A, B).collect() == []


def test_word_table_against_the_library(documents, rows, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(W)
    docs = documents(rows, tmp_path / "d", CLASHING)
    expected, digests = [], []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, ids, decoded))
        packed = struct.pack(f"<{len(ids)}I", *ids)
        digests.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    same(encode_documents(docs, W).collect(), expected)
    same(encoded_digests(docs, W).collect(), digests)
    assert encoded_digests(docs.limit(0), W).collect() == []


def test_words_that_many_chunks_share(documents, tmp_path):
    """Chunks of a few rows give the same ids as one chunk."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(W)
    rnd = random.Random(8)
    rows = [(i, prose(rnd, 40)) for i in range(60)]
    docs = documents(rows, tmp_path / "d", files=20)
    same(encode_documents(docs, W).select("doc_id", "tokens").collect(), [(i, library.encode(t, add_special_tokens=False).ids) for i, t in rows])
