import math
import random
import re
from collections import Counter

import pytest

from orbweave.llm import lexical
from orbweave.llm.queries import op13_lexical_search
from .conftest import DATA

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs if i is not None]
    held = [(i, c) for i, c in held if c]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, ts in asked.items():
        scored = []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if score > 0:
                scored.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    chance = random.Random(5)
    words = [w + s for w in ("alpha", "Beta", "ñandú", "z9", "x", "de", "The") for s in ("", "s", "_t", "-u", "É")]
    docs = [(chance.randint(0, 250), " ".join(chance.choices(words, k=chance.randint(0, 30)))) for _ in range(400)]
    docs += [(1000 + i, "the same text in many copies de") for i in range(40)] + [(None, "alpha"), (7, None), (8, ""), (9, "- ! ?"), (2000, "alpha beta " * 20000)]
    items = [(i, " ".join(chance.choices(words, k=chance.randint(1, 8)))) for i in range(30)]
    items += [(3, "the same copies"), (100, None), (101, ""), (None, "alpha"), (102, "nowhere")]
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"owners": 1}, {"owners": 7, "bundle": 4}, {"bundle": 3, "vocabulary": 40}])
def test_equals_brute_force(spark, corpus, sizes, monkeypatch):
    docs, items = corpus
    if sizes:
        monkeypatch.setattr(lexical, "BLOCK_DOCS", 50)  # many blocks, so that accumulators are dropped
    form = "doc_id long, text string, item long, score int, block string"
    rows = spark.createDataFrame([(*r, None, 1, "x") for r in docs], form).repartition(3)
    asked = spark.createDataFrame([(*r, "y", 2, None) for r in items], "item_id long, text string, rank string, term int, bundle string")
    assert found(lexical.rank(rows, asked, **sizes)) == brute(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "alpha")], "doc_id long, text string")
    items = spark.createDataFrame([("a", "alpha")], "item_id string, text string")
    assert [r["item_id"] for r in lexical.rank(docs, items).collect()] == ["a"]  # one document: w = floor(1000 ln(4/3))
    assert lexical.rank(docs.limit(0), items).collect() == []
    assert lexical.rank(docs, items.limit(0)).collect() == []
    assert lexical.rank(spark.createDataFrame([(1, None), (None, "alpha")], docs.schema), items).collect() == []


def test_query_on_given_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert found(op13_lexical_search(spark, DATA)) == brute(docs, items)
