"""Registered queries against their SQL statements, and contracts of those without."""

from __future__ import annotations

import random
import re

import duckdb
import pytest
from llm.conftest import prose
from llm.test_small_cases import linked
from pyspark.sql import functions as F

import corpus_pipeline
from tidemill.llm.oracles import oracle_statements
from tidemill.llm.queries import registered_queries
from tidemill.workspace import remove_run_folders

TABLES = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(oracle_statements()))
def test_query_matches_its_statement(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{TABLES}/{table}.parquet')")
    answer = connection.execute(oracle_statements()[name])
    columns = [d[0] for d in answer.description]
    result = registered_queries()[name](spark, TABLES)
    assert sorted(columns) == sorted(result.columns)
    rows = [tuple(r) for r in result.select(*columns).collect()]
    assert sorted(rows, key=str) == sorted(answer.fetchall(), key=str)
    assert rows


def test_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in registered_queries()]
    assert sorted(numbers) == list(range(1, 14))


COLUMNS = {
    "op1_sentencepiece": ["doc_id", "n_tokens", "n_chars", "ids_sha256", "decoded_sha256", "lossless"],
    "op2_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op4_token_counts": ["doc_id"],
    "op5_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op6_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op7_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex"],
    "op8_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op10_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone"],
    "op11_importance_resampling": ["doc_id", "n_features", "weight", "score", "rank"],
    "op12_tokenizer_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op13_word_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}
#: Other columns of the input that are named as columns of results.
EXTRA = "lang string, source string, n_chars long, row long, kept boolean, chunk long, score double"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Tables with copies, near copies, leaks, nulls and clashing columns; and the rows of the documents."""
    rnd = random.Random(31)
    item, short = prose(rnd, 20), "few words only"
    base = prose(rnd, 60).split()
    texts = [prose(rnd, rnd.randint(5, 80)) for _ in range(60)]
    texts += [" ".join(base)] * 6 + ["  ".join(base)] * 3
    for _ in range(8):
        near = list(base)
        near[rnd.randrange(60)] = "changed"
        texts.append(" ".join(near))
    texts += [f"{prose(rnd, 30)} {item} {prose(rnd, 30)}", f"so {short} here"]
    texts += [prose(rnd, 12) + ". Rotten word. " + prose(rnd, 12) for _ in range(12)]
    texts += ["", None, " ", "mail a@b.org", "token=abcdef123", prose(rnd, 3000)]
    docs = list(enumerate(texts))
    rnd.shuffle(docs)
    folder = tmp_path_factory.mktemp("tables")
    rows = [(i, t, "en", "web", None, i, False, -1, 0.5) for i, t in docs]
    spark.createDataFrame(rows, f"doc_id long, text string, {EXTRA}").repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int("Rotten" in (t or ""))) for i, t in docs]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, short), (3, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", None)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return str(folder), docs, [item, short]


@pytest.mark.parametrize("name", list(COLUMNS))
def test_queries_return_a_row_for_each_document(spark, tables, name):
    folder, docs, _ = tables
    result = registered_queries()[name](spark, folder)
    assert result.columns[: len(COLUMNS[name])] == COLUMNS[name]
    assert sorted(r.doc_id for r in result.select("doc_id").collect()) == sorted(i for i, _ in docs)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def words_of(text):
    return " " + " ".join(re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())) + " "


def leaks(text, items):
    for item in items:
        known = shingles(item)
        here = sum(words_of(" ".join(s)) in words_of(text) for s in known)
        if 100 * here >= 75 * len(known):
            return True
    return False


def test_pipeline_against_a_plain_version_of_each_stage(spark, tables):
    folder, rows, items = tables
    scores = {r.doc_id: r.predicted for r in registered_queries()["op6_toxicity"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    expected = [(i, t) for i, t in rows if not scores[i]]

    def first_of_each(rows):
        least = {}
        for i, t in rows:
            key = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
            least[key] = min(i, least.get(key, i))
        return [(i, t) for i, t in rows if i in least.values()]

    plain = [
        lambda rows: rows,
        first_of_each,
        lambda rows: [r for r in rows if r[0] in {c for _, _, c in linked(rows)[0]}],
        lambda rows: [(i, t) for i, t in rows if not leaks(t, items)],
    ]
    before = docs
    for (name, stage), step in zip(corpus_pipeline.STAGES, plain, strict=False):
        expected = step(expected)
        before = stage(spark, before, folder)
        place = f"{folder}/{name}"
        before.write.parquet(place)
        before = spark.read.parquet(place)
        assert before.columns == docs.columns, name
        assert sorted(((r.doc_id, r.text) for r in before.collect()), key=str) == sorted(expected, key=str), name
    assert len(expected) < len(rows) - 15
    result = corpus_pipeline.run(spark, folder)
    assert sorted(r.doc_id for r in result.collect()) == sorted(i for i, _ in expected)
    assert result.filter("NOT lossless").count() == 0
    assert remove_run_folders(spark) > 0


def test_pipeline_without_documents(spark, tables, tmp_path):
    folder, _, _ = tables
    for name in ("documents", "labels", "benchmark"):
        table = spark.read.parquet(f"{folder}/{name}.parquet")
        (table.filter(F.lit(False)) if name == "documents" else table).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
