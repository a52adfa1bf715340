import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orbweave.llm import neardup
from orbweave.llm.tokens import blocks


@pytest.fixture(scope="module")
def groups(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(2000)]
    rows = []
    for g in range(25):
        base = [rng.choice(words) for _ in range(rng.randrange(3, 160))]
        for v in range(1 + (g % 5) * 4 if g else 60):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 20)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy) if v % 3 else " ".join(copy).upper() + "\n"))
    rng.shuffle(rows)
    return rows


def brute(rows, idf):
    """Connected parts of all pairs at the threshold, by least doc_id."""
    texts = [t for _, t in rows]
    codes = []
    for b in blocks(pa.array(texts, pa.string())):
        s = neardup.Shingles(b, idf)
        codes += [s.code[s.first[i]:s.first[i + 1]] for i in range(b.hi - b.lo)]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if top(i) != top(j) and neardup.weighted_jaccard(codes[i], codes[j]) >= neardup.THRESHOLD:
                label[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(d, least.get(top(i), d))
    return {d: least[top(i)] for i, (d, _) in enumerate(rows)}


def test_classes_equal_brute_force(spark, groups):
    docs = spark.createDataFrame(groups, "doc_id long, text string")
    want = brute(groups, neardup.word_idf(docs))
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs).collect()}
    wrong = [d for d in want if want[d] != got[d]]
    # Bands may miss a pair at the threshold (about 2 in 10,000); nothing may be joined that isn't linked.
    assert len(wrong) <= 2 and all(want[d] == want[got[d]] for d in got)
    kept = {r["doc_id"] for r in neardup.keep_one(docs).collect()}
    assert kept == set(got.values())


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, neardup.word_idf(docs))
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs).collect()}
    assert sum(want[d] != got[d] for d in want) <= 1


def test_samples_estimate_the_weighted_similarity():
    rng = random.Random(7)
    base = [f"w{i}" for i in range(400)]
    near = list(base)
    for at in rng.sample(range(400), 8):
        near[at] = f"x{at}"
    (b,) = blocks(pa.array([" ".join(base), " ".join(near)]))
    hits, j = [], None
    for seed in range(30):
        idf = np.random.default_rng(seed).uniform(1, 10, neardup.DF_CELLS).astype(np.float32)
        s = neardup.Shingles(b, idf)
        keys = neardup.band_keys(s, 2)
        hits.append((keys[0] == keys[1]).mean())
        j = neardup.weighted_jaccard(s.code[s.first[0]:s.first[1]], s.code[s.first[1]:s.first[2]])
        assert 0.7 < j < 0.95
    assert abs(np.mean(hits) - 0.83 ** neardup.ROWS) < 0.12


def test_weighted_jaccard_equals_dictionaries():
    code = lambda d: np.array(sorted((h << 8) | w for h, w in d.items()), np.uint64)
    a, b = {1: 4, 5: 8, 9: 0}, {5: 4, 9: 12, 11: 4}
    w = lambda d, h: 2 ** (d[h] / neardup.LEVEL_STEP) if h in d else 0.0
    keys = a.keys() | b.keys()
    want = sum(min(w(a, h), w(b, h)) for h in keys) / sum(max(w(a, h), w(b, h)) for h in keys)
    assert neardup.weighted_jaccard(code(a), code(b)) == pytest.approx(want)


def test_odd_rows(spark, odd_docs, no_docs, make_docs):
    got = sorted(map(str, ((r["doc_id"], r["class_id"]) for r in neardup.classes(odd_docs).collect())))
    assert got == sorted(map(str, [(1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (None, None), (5, 5), (6, 6), (7, 6)]))
    kept = neardup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, [1, 4, None, 5, 6]))
    assert neardup.classes(no_docs).count() == 0 and neardup.keep_one(no_docs).count() == 0
    one = make_docs([(1, "alpha beta"), (1, "gamma delta"), (2, "gamma delta")])
    assert {r["class_id"] for r in neardup.classes(one).collect()} == {1} and neardup.keep_one(one).count() == 1


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in neardup.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_hot_buckets_are_dealt_and_nothing_is_lost(spark, groups, monkeypatch):
    """Small limits deal nearly every bucket; the classes stay those of one place a bucket."""
    docs = spark.createDataFrame(groups, "doc_id long, text string")
    want = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs).collect()}
    monkeypatch.setattr(neardup.bucket_members, "__defaults__", (3,))
    monkeypatch.setattr(neardup.across, "__defaults__", (2,))
    assert {r["doc_id"]: r["class_id"] for r in neardup.classes(docs).collect()} == want


def test_members_of_buckets(spark):
    rows = [(m, 0, 7) for m in range(1000)] + [(m, 1, m // 2) for m in range(100)] + [(5, 2, 1)]
    got = neardup.bucket_members(spark.createDataFrame(rows, "m long, band int, key long"), 100).collect()
    assert sorted((r["m"], r["band"], r["key"]) for r in got) == sorted(rows[:-1])
    hot = [r for r in got if r["band"] == 0]
    assert {r["salts"] for r in hot} == {10} and {r["salt"] for r in hot} == set(range(10))
    assert {(r["salts"], r["salt"]) for r in got if r["band"] == 1} == {(1, 0)}


@pytest.mark.parametrize("sub_block", [1, 7, 1000])
def test_each_pair_across_labels_meets_once(spark, sub_block):
    rng = random.Random(3)
    rows = [(band, 9, m % 2, 2, m, rng.randrange(4)) for band in range(2) for m in range(40)]
    frame = spark.createDataFrame(rows, "band int, key long, salt int, salts int, m long, label long")
    got = sorted(tuple(r) for r in neardup.across(frame, ("m", "label"), F.lit(True), sub_block).collect())
    assert got == sorted({(min(x[4], y[4]), max(x[4], y[4])) for x in rows for y in rows if x[0] == y[0] and x[5] != y[5]})
