import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orbweave.llm import toxicity
from orbweave.llm.tokens import blocks


@pytest.fixture(scope="module")
def trained(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        text = list(rng.choice(words, 40))
        bad = i % 5 == 0
        for _ in range(1 + i % 3 if bad else 0):
            text[int(rng.integers(40))] = str(rng.choice(["scumbag", "Vermin!", "scumlord"]))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict(rows)


def test_held_out_toxic_documents_are_found(spark, trained):
    docs, labels, _ = trained
    model = toxicity.train(docs, labels.where("doc_id % 2 = 0"))
    found = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    wrong = [i for i, r in found.items() if i % 2 and r["toxic"] != (i % 5 == 0)]
    assert len(wrong) <= 3
    assert all(0 <= r["severity"] <= toxicity.GRADES for r in found.values())
    one, three = (np.mean([r["severity"] for i, r in found.items() if i % 5 == 0 and i % 3 == k]) for k in (0, 2))
    assert three > one
    assert list(np.diff(model.thresholds) > 0) == [True] * (toxicity.GRADES - 1)


def test_scores_equal_a_sum_word_by_word(spark, trained):
    docs, labels, texts = trained
    model = toxicity.train(docs, labels)
    weight = dict(zip(model.features.tolist(), model.weights, strict=True))
    for r in toxicity.score(docs, model).where("doc_id % 37 = 0").collect():
        (b,) = blocks(pa.array([texts[r["doc_id"]]]), sep=toxicity._SEP)
        eta = sum(weight.get(x, 0.0) for h, _ in toxicity.block_features(b) for x in h.tolist())
        over = [1 / (1 + np.exp(t - eta)) for t in model.thresholds]
        assert r["severity"] == pytest.approx(sum(over)) and r["grade"] == sum(p >= 0.5 for p in over)


def test_odd_rows(spark, trained, odd_docs, no_docs):
    docs, labels, _ = trained
    model = toxicity.train(docs, labels)
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and not any(r["toxic"] for r in rows)
    assert toxicity.score(no_docs, model).count() == 0
    kept = toxicity.drop_toxic(odd_docs, model)
    assert kept.schema == odd_docs.schema and kept.count() == odd_docs.count()
    nothing = toxicity.train(odd_docs, labels.limit(0))
    assert {r["severity"] for r in toxicity.score(odd_docs, nothing).collect()} == {0.0}
    assert toxicity.drop_toxic(odd_docs, nothing).count() == odd_docs.count()


def test_drop_equals_score(spark, trained):
    docs, labels, _ = trained
    model = toxicity.train(docs, labels)
    kept = {r["doc_id"] for r in toxicity.drop_toxic(docs, model).collect()}
    assert kept == {r["doc_id"] for r in toxicity.score(docs, model).where("not toxic").collect()}
    assert kept == {i for i in range(600) if i % 5}


def test_labels_with_nulls_and_repeats(spark, trained):
    docs, labels, _ = trained
    more = labels.unionByName(labels).unionByName(spark.createDataFrame([(None, 1, 1), (3, None, None)], labels.schema))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, more)
    assert a.features.tolist() == b.features.tolist() and np.allclose(a.weights, b.weights)


def test_repeated_labelled_rows_are_one(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    again = docs.unionByName(docs.join(labels.where("toxic > 0").limit(5).select("doc_id"), "doc_id", "left_semi").select(*docs.columns).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("n"))
    a, b = toxicity.train(docs, labels), toxicity.train(again, labels)
    assert len(a.features) and all(np.array_equal(x, y) for x, y in zip(vars(a).values(), vars(b).values(), strict=True))
