import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from orbweave.llm import quality
from orbweave.llm.common import table


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    labels = table(spark, d, "labels")
    rows = quality.held_out_scores(table(spark, d, "documents"), labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 80
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def plain_statistics(text):
    """The numbers of a text, counted one by one."""
    data = text.encode()
    words = [w for w in re.split(rb"[ \t\n\v\f\r]+", data) if w]
    low, lines = [w.lower() for w in words], [x.lower() for x in data.split(b"\n") if x]
    def kind(c):
        if c >= 128:
            return "wide"
        c = chr(c)
        return ("upper" if "A" <= c <= "Z" else "lower" if "a" <= c <= "z" else "digit" if "0" <= c <= "9" else "space" if c in "\t\v\f\r " else "newline" if c == "\n"
                else "stop" if c in ".,;:?'\"-()" else "symbol")
    kinds, size, per = Counter(map(kind, data)), [len(w) for w in words], max(len(words), 1)
    mean = sum(size) / per
    runs = {k: [tuple(low[i:i + k]) for i in range(len(low) - k + 1)] for k in (2, 4)}
    share = lambda test: sum(map(test, words)) / per
    return {
        "log_chars": math.log1p(len(data)), "log_words": math.log1p(len(words)), **{k: kinds[k] / max(len(data), 1) for k in ("upper", "lower", "digit", "space", "newline", "stop", "symbol", "wide")},
        "word_length": mean, "word_length_sd": math.sqrt(max(sum(n * n for n in size) / per - mean * mean, 0)), "longest_word": math.log1p(max(size, default=0)),
        "capital_words": share(lambda w: kind(w[0]) == "upper"), "upper_words": share(lambda w: len(w) > 1 and kind(w[0]) == "upper" and all(kind(c) != "lower" for c in w)),
        "symbol_ends": share(lambda w: kind(w[-1]) == "symbol"), "stop_ends": share(lambda w: kind(w[-1]) == "stop"), "one_byte_words": share(lambda w: len(w) == 1),
        "distinct_words": len(set(low)) / per, "top_word": max(Counter(low).values(), default=0) / per, "same_neighbours": sum(a == b for a, b in zip(low, low[1:])) / per,
        "distinct_pairs": len(set(runs[2])) / max(len(runs[2]), 1), "distinct_runs": len(set(runs[4])) / max(len(runs[4]), 1),
        "log_lines": math.log1p(len(lines)), "distinct_lines": len(set(lines)) / max(len(lines), 1), "line_words": math.log1p(len(words) / max(len(lines), 1)),
    }


def test_statistics_equal_plain_counts():
    import random

    rng = random.Random(2)
    texts = ["", None, " \n\t", "one", "A", "a b a b a b a b", "é ÄÖ x\n\nX\nx", "word " * 5_000]
    texts += ["".join(rng.choice("aAbB zZ019.,#$\n\té\u4e2d\U0001f600\x00\x1f ") for _ in range(rng.randrange(200))) for _ in range(300)]
    got = quality._features(pa.array(texts, pa.string()))
    want = [list(plain_statistics(t or "")[f] for f in quality.FEATURES) for t in texts]
    assert got.shape == (len(texts), len(quality.FEATURES)) and np.allclose(got, want, atol=1e-9)


def test_repeated_labelled_rows_are_one(spark, make_docs):
    once = [(i, ("good words here " if i % 2 else "BAD!! BAD!! ") * (5 + i % 3)) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    a, b = quality.train(make_docs(once), labels), quality.train(make_docs(once + once[:7] * 200), labels)
    assert all(np.array_equal(getattr(a, f), getattr(b, f)) for f in ("feature", "cut", "leaf", "start"))


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(0)
    x = rng.random((500, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    forest = quality.grow(x, y, trees=30)
    assert ((forest.score(x) >= 0.5) == y).mean() > 0.95

    def walk(row):
        total = forest.start
        for f, c, leaf in zip(forest.feature, forest.cut, forest.leaf, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > c[node] else 1)
            total += leaf[node - len(f)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose([walk(r) for r in x[:60]], forest.score(x[:60]))


def test_held_out_labels_are_not_learnt(spark, make_docs):
    docs = make_docs([(i, ("good words here " if i % 2 else "BAD!! BAD!! ") * 5) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    from pyspark.sql import functions as F

    from orbweave.llm.common import crc_fold

    other = labels.withColumn("quality", F.when(crc_fold(F.col("doc_id"), 3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r["doc_id"]: r["score"] for r in quality.held_out_scores(docs, x).collect()} for x in (labels, other))
    assert a == b and all((s >= 0.5) == i % 2 for i, s in a.items())


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(6, 1), (4, 0), (None, 1), (2, None)], "doc_id long, quality int")
    rows = quality.held_out_scores(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]
    empty = {r["score"] for r in rows if r["doc_id"] in (1, 2)}
    assert len(empty) == 1
    assert all(r["score"] == pytest.approx(0.5) for r in quality.held_out_scores(odd_docs, labels.limit(0)).collect())
    assert quality.held_out_scores(no_docs, labels).count() == 0
