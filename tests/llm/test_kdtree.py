import numpy as np
import pytest
from pyspark.sql import functions as F

from orbweave.llm import kdtree
from orbweave.llm.queries import op3_kdtree_topk


def brute(rows, k, every=20):
    whole = [(i, np.floor(64 * np.array(v, float))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q in {i for i, _ in whole if i % every == 0}:
        mine = next(v for i, v in whole if i == q)
        best = sorted((-int(mine @ v), i) for i, v in whole if i != q and len(v) == len(mine))[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return out


def found(df):
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("shard,block", [(8192, 8192), (40, 7)])
def test_equals_brute_force_with_ties(spark, shard, block):
    rng = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in (rng.normal(size=6) if i % 3 else np.ones(6))]) for i in range(400)]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    single = [(i, [float(np.float32(x)) for x in v]) for i, v in vectors]
    got = kdtree.top_k(rows, F.col("vec_id") % 20 == 0, 5, shard=shard, block=block)
    assert found(got) == brute(single, 5)


def test_odd_rows(spark):
    form = "vec_id long, embedding array<double>, rank int, score string, shard int, v string"
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 2.0]), (20, [0.5, -1.0]), (1, [nan, 1.0]), (2, [inf, 0.0]), (3, [None, 1.0]), (4, None), (5, []), (None, [1.0, 1.0]),
               (6, [1.0, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (40, [1.0, 1.0, 1.0]), (8, [-0.0078125, 0.3])]
    rows = spark.createDataFrame([(i, v, 1, None, 2, "x") for i, v in vectors], form)
    got = found(kdtree.top_k(rows, F.col("vec_id") % 20 == 0, 20))
    assert {(q, i, s) for q, _, i, s in got} == {(q, i, s) for q, _, i, s in brute(vectors, 20)}
    assert not any(q == 40 for q, *_ in got)
    assert found(kdtree.top_k(rows.limit(0), F.col("vec_id") % 20 == 0, 20)) == set()


@pytest.mark.parametrize("shard", [8192, 60])
def test_large_components(spark, shard):
    rng = np.random.default_rng(7)
    vectors = [[float(x) for x in rng.integers(-9, 9, 64)] for _ in range(300)]
    for at, scale in ((0, 2048.0), (7, 2048.0), (20, 5e6), (31, 2e7), (45, 1e12), (60, 3e11), (61, 1e17), (62, -1e17), (63, 1e300), (80, 1e300)):
        vectors[at] = [x * scale for x in vectors[at]]
    rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    whole = [[max(-2**63, min(2**63, int(np.floor(64 * x)))) for x in v] for v in vectors]
    want = set()
    for q in range(0, 300, 20):
        score = lambda c: max(1 - 2**63, min(2**63 - 1, sum(x * y for x, y in zip(whole[q], whole[c]))))  # noqa: E731, B023
        best = sorted((-score(c), c) for c in range(300) if c != q)[:20]
        want |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(best)}
    assert found(kdtree.top_k(rows, F.col("vec_id") % 20 == 0, 20, shard=shard)) == want


def test_query_on_a_whole_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    assert found(op3_kdtree_topk(spark, d)) == brute(rows, 20)


def test_query_equals_its_sql(spark):
    import duckdb

    from orbweave.llm.queries import ORACLES

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{d}/embeddings.parquet')")
    assert found(op3_kdtree_topk(spark, d)) == set(con.sql(ORACLES["op3_kdtree_topk"]).fetchall())


def test_boxes_bound_their_points():
    rng = np.random.default_rng(3)
    points, queries = np.floor(rng.normal(size=(500, 4)) * 20), np.floor(rng.normal(size=(30, 4)) * 20)
    tree = kdtree.Tree(points, np.arange(500), 16)
    for node, rows in tree.points.items():
        assert (tree.bounds(queries, np.full(30, node)) >= (queries @ rows.T).max(1)).all()
    assert sorted(np.concatenate(list(tree.rows.values())).tolist()) == list(range(500))
    for node, halves in enumerate(tree.halves):
        if halves[0] >= 0:  # a box holds its halves' boxes
            assert (tree.low[halves] >= tree.low[node]).all() and (tree.high[halves] <= tree.high[node]).all()
            assert tree.first[node] == tree.first[halves].min()


def test_best_first_leaves_far_boxes_closed():
    """Clusters far apart: a query opens the leaves near it, not all."""
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.integers(-5, 5, (200, 8)) + 1000 * rng.choice([-1, 1], 8) for _ in range(20)]).astype(float)
    tree = kdtree.Tree(points, np.arange(len(points)), 32)
    opened = []
    tree.points = type("Seen", (dict,), {"__getitem__": lambda self, node: opened.append(node) or dict.__getitem__(self, node)})(tree.points)
    query = points[:1]
    _, row, score = tree.search(query, np.array([0]), np.array([kdtree.NONE]), 5)
    want = sorted((-int(query[0] @ p), i) for i, p in enumerate(points) if i)[:5]
    assert sorted(zip((-score).tolist(), row.tolist())) == want
    assert len(opened) < len(tree.rows) / 2


def test_one_id_with_more_rows_than_a_shard(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in rng.integers(-3, 3, 4)]) for i in range(60)]
    vectors += [(7, [2.0, 2.0, 2.0, 2.0])] * 90 + [(7, [float(x) for x in rng.integers(-3, 3, 4)]) for _ in range(40)]
    vectors += [(20, vectors[20][1])] * 50  # a query's own id
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = kdtree.top_k(rows, F.col("vec_id") % 20 == 0, 5, shard=30, block=2)
    assert {(r["query_id"], r["rank"]) for r in got.collect()} == {(q, n) for q in (0, 20, 40) for n in range(1, 6)}
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()) == sorted(brute(vectors, 5))
