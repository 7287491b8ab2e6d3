"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import jaccard_join, toxicity
from tidemill.llm._exchange import chunks, decode_sorted, encode_sorted  # noqa: F401
from tidemill.llm.chat_format import format_turns, parse, read_back, render
from tidemill.llm.decontaminate import contained_items, without_leaks
from tidemill.llm.exact_dedup import exact_duplicates, keep_rows
from tidemill.llm.jaccard_join import components, jaccard_components
from tidemill.llm.pii import boost, find_personal_data
from tidemill.llm.pii import digest_columns as pii_columns
from tidemill.llm.secret_scan import digest_columns as secret_columns
from tidemill.llm.secret_scan import find_secrets
from tidemill.llm.sentencepiece_dropout import MergeDropout, encode_documents
from tidemill.llm.token_counts import INSERTS, TokenTree, edited_counts, encoding, with_sample_edits

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CLASHING = "doc_id long, text string, chunk string, token int, row string, n double"


def clashing(rows):
    return [(i, t, "x", 1, "y", 0.5) for i, t in rows]


@pytest.fixture
def docs(documents, corpus, tmp_path):
    return documents(clashing(corpus), tmp_path / "docs", CLASHING)


@pytest.fixture
def no_docs(documents, tmp_path):
    return documents([], tmp_path / "none", CLASHING)


# --- the code of exchanged hashes -------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_codes_read_back(n):
    rnd = np.random.default_rng(n)
    for top in (1 << 20, (1 << 64) - 1):
        values = np.unique(rnd.integers(0, top, n, dtype=np.uint64, endpoint=True))
        assert (decode_sorted(encode_sorted(values)) == values).all()
    edge = np.array([0, 1, (1 << 64) - 1], np.uint64)
    assert (decode_sorted(encode_sorted(edge)) == edge).all()


# --- 1: merges ----------------------------------------------------------------------------


def reference_merges(unit, ranks, ids, passes):
    """One agenda as a plain list: the best pair first, each candidate put to ``passes`` once."""
    pieces, refused, number = list(unit), set(), 0
    serial = list(range(len(unit)))
    fresh = len(unit)
    while True:
        found = [
            (ranks[a + b], serial[i], i)
            for i, (a, b) in enumerate(zip(pieces, pieces[1:], strict=False))
            if a + b in ranks and (serial[i], serial[i + 1]) not in refused
        ]
        if not found:
            return [ids.get(p, p) for p in pieces]
        _, _, i = min(found, key=lambda f: (f[0], sum(map(len, pieces[: f[2]]))))
        skipped = passes(number)
        number += 1
        if skipped:
            refused.add((serial[i], serial[i + 1]))
            continue
        pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
        serial[i : i + 2] = [fresh]
        fresh += 1


def test_without_dropout_it_is_the_models_own_segmentation(corpus):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECES)
    coder = MergeDropout(open(PIECES, "rb").read(), 0, 1)
    texts = [t for _, t in corpus if t] + ["日本 🎉\n\nx  y", "w" * 3000, " lead", "tail  "]
    for text, ids in zip(texts, coder.encode(texts, [0] * len(texts)), strict=True):
        assert ids.tolist() == model.encode(text)


def test_dropout_follows_the_keyed_hash():
    from sentencepiece import SentencePieceProcessor

    from tidemill.llm._text import mix

    model = SentencePieceProcessor(model_file=PIECES)
    coder = MergeDropout(open(PIECES, "rb").read(), 0.25, 9)
    pieces = {model.id_to_piece(i): i for i in range(259, model.get_piece_size())}
    ranks = {p: -model.get_score(i) for p, i in pieces.items()}
    words = ["internationalization", "segmentation", "the", "unbelievable"]
    (ids,) = coder.encode([" ".join(words)], [77])
    keyed = mix(coder._seed ^ mix(np.array([77], np.uint64)))
    expected = []
    for number, word in enumerate(words):
        hashed = mix(keyed + np.uint64(number) * np.uint64(0xD1342543DE82EF95))

        def passes(n, hashed=hashed):
            return (int(mix(hashed + np.uint64(n // 8 + 1))[0]) >> 8 * (n % 8)) & 0xFF < 64

        expected += reference_merges("▁" + word, ranks, pieces, passes)
    assert ids.tolist() == expected


def test_encoding_is_lossless_varied_and_repeatable(docs, corpus, no_docs):
    rows = encode_documents(docs, PIECES, dropout=0.3, seed=5)
    got = rows.collect()
    assert all(r.lossless for r in got) and len(got) == len(corpus)
    again = encode_documents(docs.repartition(7), PIECES, dropout=0.3, seed=5)
    assert rows.exceptAll(again).count() == 0
    other = encode_documents(docs, PIECES, dropout=0.3, seed=6)
    assert rows.select("ids").exceptAll(other.select("ids")).count() > 20
    assert encode_documents(no_docs, PIECES).collect() == []
    with pytest.raises(ValueError, match="dropout"):
        MergeDropout(b"", 1.0, 1)


def test_a_literal_space_mark_and_long_units_survive():
    coder = MergeDropout(open(PIECES, "rb").read(), 0.2, 1)
    texts = ["▁", "a▁ b", "", "ab" * 5000, "\x00\n\r", "é" * 300]
    assert [coder.decode(i) for i in coder.encode(texts, [0] * 6)] == texts


# --- 2: exact copies ---------------------------------------------------------------------


def test_exact_duplicates_against_brute_force(docs, corpus, no_docs):
    def body(text):
        return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")

    groups = defaultdict(list)
    for i, t in corpus:
        groups[body(t)].append(i)
    got = exact_duplicates(docs)
    rows = got.collect()
    expected = []
    for i, t in corpus:
        ids = [x for x in groups[body(t)] if x is not None]
        expected.append((i, min(ids) if ids else None, len(groups[body(t)]), hashlib.sha256(body(t).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str) == sorted(expected, key=str)
    kept = [r for r in rows if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    left = keep_rows(docs, got.filter("kept").select("row"))
    assert left.columns == docs.columns
    assert sorted(body(r.text) for r in left.collect()) == sorted(groups)
    assert exact_duplicates(no_docs).collect() == []


# --- 3: benchmark items ------------------------------------------------------------------


def contained(docs, items):
    def shingles(text, width):
        words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
        return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}

    found = []
    for item, text in items:
        width = min(5, len((text or "").encode().split()))
        if width:
            own = shingles(text, width)
            for doc, body in docs:
                n = len(own & shingles(body, width))
                if 4 * n >= 3 * len(own):
                    found.append((doc, item, len(own), n))
    return sorted(found, key=str)


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_contained_items_against_brute_force(spark, docs, corpus, no_docs, block):
    texts = [t for _, t in corpus if t and len(t.split()) > 20]
    items = [(n, " ".join(t.split()[3:18])) for n, t in enumerate(texts[::4])]
    items += [(90, "ONE"), (91, None), (92, ""), (93, "one"), (94, "stone1 river2"), (95, items[0][1] + " with some more words"), (None, items[1][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    pairs = [tuple(r) for r in contained_items(docs, benchmark, block_bytes=block).collect()]
    expected = contained(corpus, items)
    assert sorted(pairs, key=str) == expected and expected
    clean = sorted((r.text for r in without_leaks(docs, benchmark).collect()), key=str)
    dirty = {id(t): t for _, t in corpus if contained([(0, t)], items)}
    assert clean == sorted((t for _, t in corpus if id(t) not in dirty), key=str)
    assert contained_items(no_docs, benchmark).collect() == []
    assert contained_items(docs, benchmark.limit(0)).collect() == []
    assert without_leaks(docs, benchmark.limit(0)).count() == len(corpus)


# --- 4: token counts -----------------------------------------------------------------------


def test_trees_count_like_the_tokenizer():
    encoder, rnd = encoding(RANKS), random.Random(3)
    bits = ["ab", " ", "\n", "x1", "é", "'s", "!!", "  ", "word ", "\x1c", "\u2028"]
    for _ in range(150):
        text = "".join(rnd.choice(bits) for _ in range(rnd.choice([0, 3, 50, 900])))
        tree = TokenTree(text, encoder)
        for _ in range(rnd.randint(0, 8)):
            a = rnd.randint(0, len(text) + 3)
            b, put = a + rnd.randint(0, 30), rnd.choice([*INSERTS, "y z " * rnd.choice([1, 900])])
            tree.replace(a, b, put)
            text = text[:a] + put + text[b:]
            assert tree.text == text and tree.n_chars == len(text)
            assert tree.n_tokens == len(encoder.encode_ordinary(text))


def test_an_edit_encodes_its_region_only():
    tree = TokenTree("some words here. " * 4000, encoding(RANKS))
    tree.encoded_chars = 0
    tree.replace(30_000, 30_010, "other words")
    assert tree.encoded_chars < 1500


def test_edited_counts_of_a_table(docs, corpus, no_docs):
    edited = with_sample_edits(docs)
    encoder = encoding(RANKS)
    expected = []
    for row in edited.collect():
        text = row.text or ""
        before = len(encoder.encode_ordinary(text))
        for e in row.edits:
            text = text[: e.start] + e.text + text[e.stop :]
        expected.append((row.doc_id, before, len(encoder.encode_ordinary(text)), len(text)))
    got = edited_counts(edited, RANKS).collect()
    assert sorted((tuple(r[:4]) for r in got), key=str) == sorted(expected, key=str)
    assert all(sum(r.leaf_tokens) == r.tokens_after for r in got)
    assert edited_counts(with_sample_edits(no_docs), RANKS).collect() == []


# --- 5: similar documents ------------------------------------------------------------------


def linked(rows):
    sets = []
    for _, text in rows:
        words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=str), len(groups)


def test_jaccard_components_against_brute_force(docs, corpus, no_docs):
    expected, groups = linked(corpus)
    got = jaccard_components(docs)
    assert sorted((tuple(r[:3]) for r in got.collect()), key=str) == expected
    assert got.filter("kept").count() == groups
    assert jaccard_components(no_docs).collect() == []


def test_jaccard_chains_around_the_threshold(documents, tmp_path):
    """Sliding word windows: neighbours link, distant ones do not, copies and one-word texts too."""
    words = [f"w{i}" for i in range(400)]
    rows = [(1000 - i, " ".join(words[3 * i : 3 * i + 40])) for i in range(60)]
    rows += [(2000 + i, " ".join(words[10 * i : 10 * i + 40])) for i in range(30)]
    rows += [(3000 + i, " ".join(words[5 * (i % 9) : 5 * (i % 9) + 36 + i])) for i in range(40)]
    rows += [(1, "w1"), (2, "W1"), (3, "w1 w2"), (4, ""), (5, None)]
    random.Random(4).shuffle(rows)
    docs = documents(rows, tmp_path / "docs")
    assert sorted((tuple(r[:3]) for r in jaccard_components(docs).collect()), key=str) == linked(rows)[0]


def boilerplate(first, count, letter, shared, own):
    """Documents with the same ``shared`` words and then ``own`` words that only one document has."""
    head = " ".join(f"{letter}{i}" for i in range(shared))
    return [(i, head + " " + " ".join(f"x{i}_{k}" for k in range(own))) for i in range(first, first + count)]


def test_documents_with_the_same_boilerplate_are_not_paired(documents, tmp_path, monkeypatch):
    rows = boilerplate(0, 60, "w", 84, 20)  # 80 of 100 shingles: kept, and no two link
    rows += boilerplate(1000, 40, "v", 104, 10)  # 100 of 110: all link
    rows += boilerplate(2000, 30, "u", 84, 20)  # 80 of 100 again, but the boilerplate alone links with each
    rows.append((3000, " ".join(f"u{i}" for i in range(84))))
    random.Random(3).shuffle(rows)
    docs = documents(rows, tmp_path / "docs")
    asked = []
    verified = jaccard_join._verified

    def counted(groups, queries, *rest):
        asked.append(queries.count())
        return verified(groups, queries, *rest)

    monkeypatch.setattr(jaccard_join, "_verified", counted)
    assert sorted((tuple(r[:3]) for r in jaccard_components(docs).collect()), key=str) == linked(rows)[0]
    assert sum(asked) <= 10


@pytest.mark.parametrize("count", [100, 400])
def test_opened_groups_do_not_grow_with_classes_that_share_boilerplate(documents, tmp_path, monkeypatch, count):
    """Sets of many sizes, each with 80 shingles of a boilerplate: no two can link, and no group is opened."""
    rnd = random.Random(9)
    head = " ".join(f"w{i}" for i in range(84))
    rows = [(i, head + " " + " ".join(f"x{i}_{k}" for k in range(rnd.randint(20, 26)))) for i in range(count)]
    rows += [(1000 + i, head + " " + " ".join(f"y{i % 3}_{k}" for k in range(22))) for i in range(9)]
    docs = documents(rows, tmp_path / "docs")
    opened = []
    candidates = jaccard_join._open_candidates
    monkeypatch.setattr(jaccard_join, "_open_candidates", lambda *a: opened.append(found := candidates(*a)) or found)
    got = {r.doc_id: r.component_id for r in jaccard_components(docs).collect()}
    assert all(got[i] == i for i in range(count))
    assert all(got[1000 + i] == 1000 + i % 3 for i in range(9))
    assert sum(o.count() for o in opened) <= 10


def test_groups_of_unlinked_documents_and_hot_tokens(documents, tmp_path, monkeypatch):
    """Near copies of one boilerplate with several clusters, so that tokens and groups are dealt and opened."""
    monkeypatch.setattr(jaccard_join, "HOT_TOKEN", 5)
    monkeypatch.setattr(jaccard_join, "GROUP_SIZE", 4)
    rnd = random.Random(12)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(90)] = f"c{rnd.randint(0, 30)}"
        rows.append((i, " ".join(words + [f"own{i}_{k}" for k in range(rnd.randint(0, 12))])))
    docs = documents(rows, tmp_path / "docs")
    assert sorted((tuple(r[:3]) for r in jaccard_components(docs).collect()), key=str) == linked(rows)[0]


def test_components_of_a_long_path(spark):
    links = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    found = components(links.unionByName(spark.createDataFrame([(100, 101)], "a long, b long")))
    assert {r.component for r in found.collect()} <= {0, 100}
    assert found.count() == 60


# --- 6: toxicity ---------------------------------------------------------------------------


def test_toxicity_learns_words_and_finds_the_sentence(spark, documents, tmp_path, no_docs):
    rnd = random.Random(8)
    plain = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(600):
        sentences = [" ".join(rnd.choice(plain) for _ in range(6)) for _ in range(5)]
        bad = i % 5 == 0
        if bad:
            sentences[2] += " Rotten" + rnd.choice(["", "est", "ness"])
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(bad), 1))
    rows += [(9000, None), (9001, ""), (None, "rotten word1"), (9002, "...")]
    labels += [(None, 1, 1), (9000, None, 0), (0, 1, 1)]
    docs = documents(clashing(rows), tmp_path / "docs", CLASHING)
    table = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, table)
    scored = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert all((scored[i].score >= 0.3) == (i % 5 == 0) for i in range(600))
    texts = dict(rows)
    for i in range(0, 600, 5):
        assert [texts[i][s.start : s.end].lower().count("rotten") for s in scored[i].offending] == [1]
    assert scored[None].score >= 0.3 and max(scored[i].score for i in (9000, 9001, 9002)) < 0.3
    assert toxicity.without_toxic(docs, model).count() == 480 + 3
    assert toxicity.without_toxic(docs, model).columns == docs.columns
    assert toxicity.score_documents(no_docs, model).collect() == []
    nothing = toxicity.train(docs, table.limit(0))
    assert {r.score for r in toxicity.score_documents(docs, nothing).collect() if r.doc_id in (9000, 9001)} == {0.5}


def test_held_out_labels_are_not_learned(spark, docs):
    import zlib

    ids = spark.range(1000)
    held = {r.id for r in ids.filter(toxicity.held_out(F.col("id"))).collect()}
    assert held == {i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 == 2}


# --- 7 and 10: spans ------------------------------------------------------------------------

ASSIGN = re.compile(r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def joined_spans(spans, kinds):
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))


def secret_spans(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return spans + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


def ordinary(rnd):
    """Two long words that are no secrets, between different neighbours."""
    a, b, c = (f"w{rnd.randint(0, 999)}" for _ in range(3))
    return f"{a} internationalization_of_words {b} counterrevolutionary-movements {c}"


def test_secrets_against_plain_patterns(documents, corpus, tmp_path, no_docs):
    rnd = random.Random(6)

    def some(alphabet, n):
        return "".join(rnd.choice(alphabet) for _ in range(n))

    mixed = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    texts = [t for _, t in corpus]
    texts += [f"é🎉 Password = '{some(mixed, 20)}' and {some('0123456789abcdef', 30)}" for _ in range(60)]
    texts += [f"AKIA{some(mixed[26:], 16)} token:{some(mixed, 5)} token=token:{some(mixed, 8)} api_key\"=x" for _ in range(20)]
    texts += [ordinary(rnd) for _ in range(1500)]
    texts += ["AKIAAKIA" + "A" * 11, "a" * 23, "a" * 24, "secret=" + "x" * 100_000, "f" * 50_000, "token:" + " " * 20_000]
    hidden = some(mixed, 32)
    texts.append(f"look: {hidden} here")
    docs = documents(clashing(enumerate(texts)), tmp_path / "docs", CLASHING)
    for r in secret_columns(find_secrets(docs)).collect():
        spans = secret_spans(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(joined_spans(spans, ["assign", "access", "hex"]).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for _, k, _ in spans) for n in range(3)]
        if r.doc_id == len(texts) - 1:
            assert r.spans == f"markov:6:{6 + len(hidden)}"
        elif not spans:
            assert not r.n_markov
    assert find_secrets(no_docs).collect() == []


def test_secrets_of_letters_alone_are_found(documents, tmp_path):
    rnd = random.Random(16)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    some = lambda alphabet, n: "".join(rnd.choice(alphabet) for _ in range(n))
    texts = [f"password={some(letters + '0123456789', 24)}" for _ in range(200)]
    texts += [ordinary(rnd) for _ in range(1500)]
    texts += [f"order {some('0123456789', 18)}" for _ in range(300)]
    hidden = [some(letters, 24) for _ in range(20)]
    texts += [f"look: {h} here" for h in hidden]
    docs = documents(list(enumerate(texts)), tmp_path / "docs")
    added = {r.doc_id: r.spans for r in secret_columns(find_secrets(docs)).filter("n_markov > 0").collect()}
    assert added == {2000 + i: f"markov:6:{6 + len(h)}" for i, h in enumerate(hidden)}


@pytest.mark.parametrize("copies", [1, 2, 10])
def test_copies_do_not_vouch_for_a_secret(documents, tmp_path, copies):
    """Exact copies, and near copies in which a neighbour on one side changed."""
    rnd = random.Random(26)
    mixed = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    some = lambda n: "".join(rnd.choice(mixed) for _ in range(n))
    texts = [f"password={some(24)}" for _ in range(300)]
    texts += [ordinary(rnd) for _ in range(1500)]
    texts += ["AKIAAKIAAAAAAAAAAAA", "abcabcabcabcabcabcabcabc", "=" * 40, "-_" * 20]
    hidden = [some(24) for _ in range(40)]
    for h in hidden:
        texts += [f"this one: {h} was seen"] * (copies - copies // 3)
        texts += [f"this one: {h} was heard {i}" for i in range(copies // 3)]
    docs = documents(list(enumerate(texts)), tmp_path / "docs")
    added = {r.doc_id for r in find_secrets(docs).filter(F.size("added") > 0).collect()}
    planted = set(range(1804, len(texts)))
    assert len(added & planted) >= 0.9 * len(planted)
    assert not added - planted


PII = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def pii_spans(text):
    def luhn(digits):
        return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0

    found = []
    for kind, pattern in enumerate(PII):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = (
                True,
                kind == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                kind == 2 and 12 <= len(digits) <= 19 and luhn(digits),
                9 <= len(digits) <= 15,
            )
            if fits[kind]:
                found.append((m.start(), kind, m.end()))
    return found


ODD = [
    "a@b.c", "a@b..c@d.e", "x@a.b_c@d.e", "a@b@c.d", "..@a.b.", "1.2.3.4.5.6.7.8", "999.1.1.1 256.1.1.1 007.1.2.255",
    "4111 1111-1111 1111", "4111  1111 1111 1111", "\x01a@b.c\x01 1\x012345678901234567", "+1 (555) 123-4567, +12",
    "é@x.y 🎉 a@b.co", "1" * 50_000, "a." * 20_000 + "@b.c", "x@" + "a." * 20_000 + "b", "+" * 1000 + "1" + " " * 20_000,
    "1 " * 20_000, None, "", "a@b.c-", "-@-.-", "4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1 4111111111111111-",
]


def test_personal_data_against_plain_patterns(documents, tmp_path, no_docs):
    rnd = random.Random(2)
    texts = ODD + [f"mail me at u{i}@host{i}.org or call +44 20 7946 {rnd.randint(1000, 9999)}" for i in range(40)]
    texts += [f"version {i}.{i} has {rnd.randint(10**8, 10**9)} parts" for i in range(40)]
    docs = documents(clashing(enumerate(texts)), tmp_path / "docs", CLASHING)
    for r in pii_columns(find_personal_data(docs)).collect():
        spans = pii_spans(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(joined_spans(spans, ["email", "ip", "card", "phone"]).encode()).hexdigest(), texts[r.doc_id][:80]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in spans) for n in range(4)]
    assert find_personal_data(no_docs).collect() == []


def test_trees_add_what_no_pattern_matches(documents, tmp_path):
    """Spelled addresses and phone numbers without a plus come in; failed checks and plain numbers stay out."""
    rnd = random.Random(12)
    phone = lambda: f"+{rnd.randint(1, 99)} {rnd.randint(20, 999)} {rnd.randint(1000, 9999)} {rnd.randint(100, 999)}"
    texts = [f"write to u{i}@host{i}.org or {phone()} today" for i in range(200)]
    base = len(texts)
    texts += [f"reach u{i} (at) host{i}.org please" for i in range(40)]
    texts += [f"my phone ({rnd.randint(200, 999)}) {rnd.randint(100, 999)}-{rnd.randint(1000, 9999)} rings" for _ in range(40)]
    planted = len(texts)
    failing = []
    while len(failing) < 100:
        digits = "".join(rnd.choice("0123456789") for _ in range(16))
        if not pii_spans(digits):
            failing.append(f"number {digits} of the card")
    texts += failing
    texts += [f"it weighs {rnd.randint(10**8, 10**9)} parts, not 2024-05-0{i % 9} 1{i % 9} times" for i in range(100)]
    docs = documents(list(enumerate(texts)), tmp_path / "docs")
    added = {r.doc_id: r.added for r in find_personal_data(docs).filter(F.size("added") > 0).collect()}
    found = {i for i in added if base <= i < planted}
    assert len([i for i in found if i < base + 40]) >= 36 and len([i for i in found if i >= base + 40]) >= 36
    assert len(found) >= 0.95 * len(added)
    for i in found:
        (span,) = added[i]
        assert re.search(r"\(at\) host|\([0-9]{3}\) [0-9]{3}-", texts[i][span.start : span.end])


def test_boosting_separates_and_calibrates():
    zeros = (0,) * 8
    model = boost([((0, 3, *zeros), 100.0, 99.0), ((0, 1, *zeros), 200.0, 2.0), ((1, 3, *zeros), 50.0, 1.0)])
    assert model.raw((0, 3, *zeros)) > 2 > 0 > model.raw((0, 1, *zeros))
    chance = 1 / (1 + np.exp(-model.raw((1, 3, *zeros))))
    assert chance < model.thresholds[1] and model.thresholds[2] == float("inf")
    sure = 1 / (1 + np.exp(-model.raw((0, 3, *zeros))))
    assert sure >= model.thresholds[0] >= 0.5
    only = boost([((0,) * 10, 5.0, 5.0)])
    assert not only.trees and 1 / (1 + np.exp(-only.bias)) >= only.thresholds[0]
    assert set(boost([((0,) * 10, 5.0, 0.0)]).thresholds) == {float("inf")}


# --- 9: chats --------------------------------------------------------------------------------


def test_turns_read_back_whatever_they_say():
    rnd = random.Random(1)
    bits = ["\\", "### ", "### User:", "</turn>", " ", "\n", "a", ":", "<", "turn>", "#"]
    for _ in range(3000):
        turns = [(rnd.choice(["user", "assistant", "", "A b:\n", "é"]), "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9)))) for _ in range(3)]
        assert parse("".join(render(*t) for t in turns)) == turns


def test_conversations_of_a_table(spark):
    rows = [(1, 1, "assistant", "b</turn>"), (1, 0, "user", "a"), (1, 1, "assistant", "b</turn>"), (None, None, None, None), (2, 5, "assistant", None)]
    rows += [(3, i, "assistant", f"turn {i} ") for i in range(3000)]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in read_back(format_turns(turns.repartition(5))).collect()}
    digest = hashlib.sha256
    assert got[1].n_turns == 3 and got[1].loss_chars == 16
    assert got[1].turns_sha256 == digest(b"user\na\nassistant\nb</turn>\nassistant\nb</turn>\n").hexdigest()
    assert got[1].loss_sha256 == digest(b"b</turn>b</turn>").hexdigest()
    assert got[None].turns_sha256 == digest(b"\n\n").hexdigest() and got[None].loss_chars == 0
    assert got[2].n_turns == 1 and got[2].loss_sha256 == digest(b"").hexdigest()
    assert got[3].loss_sha256 == digest("".join(f"turn {i} " for i in range(3000)).encode()).hexdigest()
    assert read_back(format_turns(turns.limit(0))).collect() == []


def test_toxicity_training_sends_the_driver_only_kept_words(spark, monkeypatch):
    rnd = random.Random(3)
    plain = [f"w{i}" for i in range(400)]
    rows = [(i, ". ".join(" ".join(rnd.choice(plain) for _ in range(8)) for _ in range(4)) + (" vile." if i % 4 == 0 else ".")) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(800)], "doc_id long, toxic int")
    received = []
    DataFrame = type(docs)
    local_iterator = DataFrame.toLocalIterator

    def counted(self, *args, **kwargs):
        for row in local_iterator(self, *args, **kwargs):
            received.append(len(row[1]) // 4)
            yield row

    monkeypatch.setattr(DataFrame, "toLocalIterator", counted)
    model = toxicity.train(docs, table)
    learned = sorted(r for r in rows if zlib_crc(r[0]) % 4 != 2)
    found = toxicity.sentences([t.encode() for _, t in learned])
    labels = np.array([int(i % 4 == 0) for i, _ in learned], np.uint8)
    words = toxicity._frequent(found, labels.astype(float))
    assert 0 < len(words) and sum(received) == int(np.isin(found.words, words).sum()) < len(found.words)
    alone = toxicity.fit(found, labels)
    assert set(model.words.tolist()) == set(alone.words.tolist()) and model.words.tolist()
    assert np.allclose(np.sort(model.weights), np.sort(alone.weights), atol=1e-6)


def zlib_crc(doc_id: int) -> int:
    import zlib

    return zlib.crc32(str(doc_id).encode())
