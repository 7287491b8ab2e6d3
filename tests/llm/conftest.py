from __future__ import annotations

import random

import pytest

from tidemill.llm.queries import importable

WORDS = ["the", "of", "sea", "stone", "river", "Éa", "light", "ash", "no.", "far,", "x1", "日本"]


@pytest.fixture(autouse=True)
def _workers_find_the_package(spark):
    importable(spark)


@pytest.fixture
def documents(spark):
    """Build a documents table on disk, so that it can be scanned again in the same order."""

    def build(rows, folder, schema="doc_id long, text string", files=3):
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(str(folder))
        return spark.read.parquet(str(folder))

    return build


def prose(rnd: random.Random, words: int) -> str:
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 40)) for _ in range(words))


@pytest.fixture
def corpus():
    """Texts with exact and near copies, shared passages, edge cases; doc_id repeated and null."""
    rnd = random.Random(11)
    passage = prose(rnd, 30)
    base = prose(rnd, 60)
    texts = [prose(rnd, rnd.randint(1, 90)) for _ in range(40)]
    texts += [base] * 12
    for _ in range(25):
        words = base.split()
        for _ in range(rnd.randint(1, 3)):
            words[rnd.randrange(len(words))] = "changed" + str(rnd.randint(0, 9))
        texts.append(" ".join(words))
    texts += [prose(rnd, rnd.randint(0, 9)) + " " + passage + " " + prose(rnd, rnd.randint(0, 9)) for _ in range(25)]
    texts += ["", None, " ", "one", "one", "a\x00b", passage[:50], passage[:49], "z" * 300, "z" * 300, passage + passage]
    texts += [prose(rnd, 4000)]
    rows = list(enumerate(texts))
    rows += [(None, base), (None, base), (3, texts[3]), (3, "other text with the same id"), (None, None)]
    rnd.shuffle(rows)
    return rows
