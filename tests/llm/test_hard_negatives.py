import numpy as np
import pytest
from pyspark.sql import functions as F

from orbweave.llm import hard_negatives
from orbweave.llm.queries import op12_hard_negatives
from .conftest import DATA


def whole(v):
    return [max(1 - 2**63, min(2**63 - 1, int(np.floor(256 * np.float64(x))))) for x in v]


def brute(rows, every=10, k=5):
    """What the docstring says, pair by pair; ``rows``: (vec_id, label, vector)."""
    rows = [(i, y, whole(v)) for i, y, v in rows if i is not None and y is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a in sorted({i for i, *_ in rows if i % every == 0}):
        label, vector = min((y, v) for i, y, v in rows if i == a)
        scored = sorted((-max(1 - 2**63, min(2**63 - 1, sum(x * y for x, y in zip(vector, v)))), i, y) for i, y, v in rows
                        if i != a and len(v) == len(vector))
        for ps, p in [(-s, i) for s, i, y in scored if y == label][:k]:
            fit = [(-s, i) for s, i, y in scored if y != label and 80 * ps <= 100 * -s <= 100 * ps][:k]
            out += [(a, p, r + 1, i, ps, s) for r, (s, i) in enumerate(fit)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 63, 33), (65, 17, 129), (64, 64, 64), (130, 70, 3), (3, 200, 300)])
@pytest.mark.parametrize("leaf", [1, 4, 32])
def test_strassen_equals_plain_product(shape, leaf):
    m, k, n = shape
    rng = np.random.default_rng(m * k + n)
    a, b = rng.integers(-2**40, 2**40, (m, k)), rng.integers(-2**40, 2**40, (k, n))
    if leaf == 1 and m * k * n > 20_000:
        a, b = a[:9, :9], b[:9, :9]
    assert (hard_negatives.strassen(a, b, leaf) == a @ b).all()  # both modulo 2**64


@pytest.mark.parametrize("tile,block", [(4096, 1024), (37, 5)])
def test_equals_brute_force_with_ties(spark, tile, block):
    rng = np.random.default_rng(4)
    rows = [(i, int(rng.integers(0, 3)), [float(np.float32(x)) for x in (rng.normal(size=5) if i % 4 else np.ones(5))]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    assert found(hard_negatives.mine(df, F.col("vec_id") % 10 == 0, tile=tile, block=block)) == brute(rows)


def test_odd_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 2.0]), (0, 1, [1.0, 2.0]), (10, 2, [0.5, -1.0]), (10, 1, [0.5, 1.0]), (1, 1, [nan, 1.0]), (2, 1, [inf, 0.0]), (3, 1, [None, 1.0]),
            (4, 1, None), (5, 1, []), (None, 1, [1.0, 1.0]), (6, None, [1.0, 1.0]), (20, 1, [1.0, 1.0, 1.0]), (11, 1, [1.0, 1.9]), (12, 2, [1.0, 1.8]),
            *[(13, 2, [1.0, 1.85])] * 9, *[(14, 1, [0.9, 1.9])] * 3, (15, 2, [-1.0, -1.0]), (16, 1, [1e30, -1e30]), (17, 2, [1e17, 1e17]), (30, 1, [1e18, 1e16])]
    form = "vec_id long, label int, embedding array<double>, copies string, tile int, v string, score int, place int"
    df = spark.createDataFrame([(*r, None, 3, "x", 4, None) for r in rows], form)
    for tile in (4096, 3):
        assert found(hard_negatives.mine(df, F.col("vec_id") % 10 == 0, tile=tile)) == brute(rows)
    assert found(hard_negatives.mine(df.limit(0), F.col("vec_id") % 10 == 0)) == []


def test_query_on_given_vectors(spark):
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    rows = [(i, (y + 1) % 10 if y is not None and i % 7 == 0 else y, v) for i, y, v in rows]
    assert found(op12_hard_negatives(spark, DATA)) == brute(rows, every=100)
