"""Steps whose cost must follow their input: what is stored when, how rows are dealt, which rows are shuffled."""

import datetime
import os
import time

from pyspark.sql import functions as F

from orbweave.operators import algorithms as alg
from orbweave.operators import pattern
from orbweave.operators.frontier import both_ways, unordered
from orbweave.session import ROWS_PER_PARTITION, checkpoint_dir, shuffles_of, spread_shuffles
from orbweave.sources import etl
from orbweave.sources.fixture import fixture_edges, store_graph, store_on_demand

EDGES = [(1, "a", 1, 2), (2, "a", 2, 1), (3, "b", 1, 2), (4, "a", 3, 3), (5, "a", 2, 3)]


def _graph(make_graph):
    return make_graph([(i, ["Officer"], {}) for i in range(1, 5)], EDGES)


def test_tables_are_written_when_first_read(make_graph, tmp_path):
    g = _graph(make_graph)
    lazy, whole = store_on_demand(g, str(tmp_path / "lazy"), 2, 4), store_graph(g, str(tmp_path / "whole"), 2, 4)
    assert not os.path.exists(tmp_path / "lazy")
    assert lazy.nodes.count() == 4 and sorted(os.listdir(tmp_path / "lazy")) == ["nodes"]
    assert sorted(lazy.edges.collect()) == sorted(whole.edges.collect())
    assert sorted(os.listdir(tmp_path / "lazy")) == ["edges", "nodes"]
    assert sorted(lazy.layout.by_dst.collect()) == sorted(whole.layout.by_dst.collect())
    assert sorted(r["id"] for r in lazy.incident(3).collect()) == [4, 5]


def test_storing_samples_no_ranges(spark, make_graph, tmp_path):
    # Ranges would be sampled by running the whole derivation of the edges once more.
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def passed(i):
        seen.add(1)
        return i

    g = _graph(make_graph)
    edges = g.edges.withColumn("id", passed.asNondeterministic()("id"))
    lazy = store_on_demand(type(g)(g.nodes, edges), str(tmp_path / "g"), 2, 4)
    assert lazy.edges.count() == len(EDGES) and seen.value == len(EDGES)


def test_each_pair_is_grouped_once(spark, make_graph):
    g = _graph(make_graph)
    want = {(1, 2), (2, 1), (3, 3), (2, 3), (3, 2)}
    assert sorted(tuple(r) for r in pattern.undirected_adjacency(g).collect()) == sorted(want)
    weights = {(r["src"], r["dst"]): r["w"] for r in alg.weighted_undirected(g.edges).collect()}
    assert weights == {(1, 2): 3.0, (2, 1): 3.0, (3, 3): 2.0, (2, 3): 1.0, (3, 2): 1.0}
    odd = spark.createDataFrame([(None, 5), (5, None), (None, None), (None, None)], "src long, dst long")
    assert unordered(odd).distinct().count() == 2
    both = both_ways(unordered(odd).distinct(), "u", "v").collect()
    assert sorted(map(str, map(tuple, both))) == ["(5, None)", "(None, 5)", "(None, None)"]


def test_fixture_edges_shuffle_lineitem_once(spark, tmp_path):
    day = datetime.datetime(1995, 1, 2)
    items = [(7, 3, 1, "R", "O", day), (7, 3, 2, "A", "F", day), (7, 2, 5, None, "O", day), (8, 9, 4, "N", "O", None), (None, 1, 1, "N", "O", day)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string, l_shipdate timestamp") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(7, 6), (7, 4), (1, 1)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(0, 1)], "c_custkey long, c_nationkey int").write.parquet(str(tmp_path / "customer.parquet"))
    edges = fixture_edges(spark, str(tmp_path)).filter(F.col("type").endswith("_of"))
    got = sorted((r["type"], r["id"] and r["id"] % 2**60, r["src"] % 10**15, r["dst"] % 10**15, r["props"]) for r in edges.collect() if r["id"])
    at, on = 7 * 4096, {"start_date": "1995-01-02"}
    assert got == [("intermediary_of", at, 5, 2, {"status": "O"} | on), ("intermediary_of", at + 1, 1, 3, {"link": "A", "status": "F"} | on),
                   ("intermediary_of", 8 * 4096, 4, 9, {"link": "N", "status": "O"}),
                   ("officer_of", at, 4, 2, {"status": "O"} | on), ("officer_of", at + 1, 4, 3, {"link": "A", "status": "F"} | on)]
    assert edges.filter(F.col("id").isNull()).count() == 1  # an item without an order number has no officer
    plan = fixture_edges(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet [l_orderkey") == 1


def test_partitions_follow_the_rows(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert spread_shuffles(spark, 10) == int(before)
        assert spread_shuffles(spark, 40 * ROWS_PER_PARTITION + 1) == 41
        assert spark.conf.get("spark.sql.shuffle.partitions") == "41"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_pagerank_joins_a_row_for_each_source(spark, monkeypatch):
    links = [(0, i) for i in range(1, 9)] + [(i, 0) for i in range(1, 5)] + [(1, 2), (1, 2), (3, 3)]
    nodes = spark.range(10).select("id")
    edges = spark.createDataFrame(links, "src long, dst long")
    kept, cut = [], alg.cut_lineage
    monkeypatch.setattr(alg, "cut_lineage", lambda df: kept.append(cut(df)) or kept[-1])
    got = {r["id"]: r["score"] for r in alg.pagerank(nodes, edges, 7, edges_per_salt=3).collect()}
    lists = next(df for df in kept if dict(df.dtypes).get("dst") == "array<bigint>")
    assert lists.groupBy("src").count().filter("count > 1").count() == 1  # the hub's targets are dealt to several lists
    assert lists.filter("src > 0").count() == 4 and lists.select(F.explode("dst")).count() == 14
    score = dict.fromkeys(range(10), 0.15)
    for _ in range(7):
        score = {v: 0.15 + 0.85 * sum(score[s] / sum(a == s for a, _ in links) for s, d in links if d == v) for v in score}
    assert got.keys() == score.keys() and all(abs(got[v] - score[v]) < 1e-12 for v in score)


def test_mirror_tables_are_written_when_first_read(make_graph, tmp_path):
    g = store_on_demand(_graph(make_graph), str(tmp_path / "graph"), 2, 4)
    m = etl.store_mirror(etl.mirror(g), str(tmp_path / "mirror"))
    assert m.officers.count() == 4
    assert os.listdir(tmp_path / "mirror") == ["officers"] and os.listdir(tmp_path / "graph") == ["nodes"]
    assert {r["table_name"]: r["rows"] for r in etl.load_report(m).collect()} == {
        "officers": 4, "entities": 0, "intermediaries": 0, "addresses": 0, "relationships": 5, "nodes_total": 4}


def _moved(links, ids, parity):
    """One half-pass of local moving from singletons by brute force, and the modularity after it."""
    w = {}
    for a, b in links + [(b, a) for a, b in links]:
        w[a, b] = w.get((a, b), 0) + 1
    k = {v: sum(x for (a, _), x in w.items() if a == v) for v in ids}
    m = sum(k.values()) / 2
    community = {v: v for v in ids}
    for half in parity:
        new = dict(community)
        for v in ids:
            if (v % 1_000_003 * 7_919) % 1_009 % 2 != half:
                continue
            own, gain = community[v], {}
            for c in {own} | {community[b] for (a, b) in w if a == v and b != v}:
                into = sum(x for (a, b), x in w.items() if a == v and b != v and community[b] == c)
                gain[c] = into / m - k[v] * (sum(k[u] for u in ids if community[u] == c) - (k[v] if c == own else 0)) / (2.0 * m * m)
            best = min(gain, key=lambda c: (-gain[c], c))
            new[v] = best if gain[best] > gain[own] + 1e-12 else own
        community = new
    tot = {c: sum(k[v] for v in ids if community[v] == c) for c in set(community.values())}
    return community, sum(x for (a, b), x in w.items() if community[a] == community[b]) / (2 * m) - sum(t * t for t in tot.values()) / (4 * m * m)


def test_a_pass_of_salted_hubs_equals_brute_force(spark, monkeypatch):
    links = [(0, i) for i in range(1, 30)] + [(i, i + 1) for i in range(1, 20)] + [(3, 3), (4, 5), (4, 5), (31, 32)]
    edges, nodes = spark.createDataFrame(links, "src long, dst long"), spark.range(34).select("id")
    want, q = _moved(links, range(34), (0, 1))
    for per_salt in (4, 10_000):
        level = alg.lay_out(alg.weighted_undirected(edges), per_salt)
        assert (level.hubs is not None) == (per_salt == 4) and level.lists.agg(F.max(F.size("dst"))).first()[0] <= 4 * per_salt
        assert level.m2 == 2.0 * len(links)
        for rows in (0, alg.BROADCAST_ROWS):  # states that are dealt, and broadcast
            monkeypatch.setattr(alg, "BROADCAST_ROWS", rows)
            done, found = alg.local_pass(level, alg.singletons(nodes, level), 0, 34)
            assert {r["id"]: r["community"] for r in done.collect()} == want and abs(found - q) < 1e-12


def test_louvain_shuffles_follow_its_own_links(spark, monkeypatch):
    # A session's partitions are for whole tables: 64 of them on a few links would make 64 x 64 blocks a shuffle.
    before = spark.conf.get("spark.sql.shuffle.partitions")
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6), (6, 4)], "src long, dst long")
    seen, plan = [], alg._local_moving
    monkeypatch.setattr(alg, "_local_moving", lambda *a: seen.append(spark.conf.get("spark.sql.shuffle.partitions")) or plan(*a))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        found = {r["id"]: r["community"] for r in alg.louvain(spark.range(1, 7).select("id"), edges).collect()}
        assert alg.lay_out(alg.weighted_undirected(edges)).lists.rdd.getNumPartitions() == 1
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4} and set(seen) == {"1"}


def test_joined_partitions_stay_small(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {n: spark.conf.get(n) for n in (name, "spark.sql.shuffle.partitions")}
    try:
        for given, kept in (("64MB", "16m"), ("67108864b", "16m"), ("1g", "16m"), ("16k", "16k"), ("8MB", "8MB")):
            spark.conf.set(name, given)
            spread_shuffles(spark, 10)
            assert spark.conf.get(name) == kept
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def _shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(",")
    return {b for b in blocks.split(",") if b.startswith("shuffle_")}


def _left(spark, before):
    """Shuffle files that are there and were not before; they are deleted in the background."""
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    return _shuffle_files(spark) - before


def _kept(spark):
    return set(os.listdir(checkpoint_dir(spark).removeprefix("file:")))


def test_pagerank_leaves_its_lists_and_last_ranks(spark):
    # Twenty iterations' shuffle files, links and ranks at once fill the disks.
    links = [(0, i) for i in range(1, 9)] + [(i, 0) for i in range(1, 5)]
    edges, kept, files = spark.createDataFrame(links, "src long, dst long"), _kept(spark), _shuffle_files(spark)
    ranks = alg.pagerank(spark.range(10).select("id"), edges, 6)
    assert _left(spark, files) == set()
    assert len(_kept(spark) - kept) <= 3  # lists, degrees, ranks
    score = dict.fromkeys(range(10), 0.15)
    for _ in range(6):
        score = {v: 0.15 + 0.85 * sum(score[s] / sum(a == s for a, _ in links) for s, d in links if d == v) for v in score}
    got = {r["id"]: r["score"] for r in ranks.collect()}
    assert got.keys() == score.keys() and all(abs(got[v] - score[v]) < 1e-12 for v in score)


def test_lists_stay_where_they_are(spark, monkeypatch):
    kept, cut = [], alg.cut_lineage
    monkeypatch.setattr(alg, "cut_lineage", lambda df: kept.append(cut(df)) or kept[-1])
    edges = spark.createDataFrame([(i, j) for i in range(30) for j in range(i)], "src long, dst long")
    monkeypatch.setattr(alg, "LINKS_PER_PARTITION", 200)  # three partitions
    alg.pagerank(spark.range(30).select("id"), edges, 1)
    lists = next(df for df in kept if dict(df.dtypes).get("dst") == "array<bigint>")
    with shuffles_of(spark, lists.rdd.getNumPartitions()):
        assert "Exchange" not in lists.groupBy("src", "salt").count()._jdf.queryExecution().executedPlan().toString()


def test_a_large_pass_shuffles_its_links_once(spark, monkeypatch):
    monkeypatch.setattr(alg, "BROADCAST_ROWS", 0)
    edges = spark.createDataFrame([(i, j) for i in range(30) for j in range(i)], "src long, dst long")
    nodes = spark.range(30).select("id")
    level = alg.lay_out(alg.weighted_undirected(edges))
    state = alg.cut_lineage(alg.singletons(nodes, level))
    with shuffles_of(spark, level.partitions):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = level.send(state, ["community"], None)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1  # of the state
    kept, files = _kept(spark), _shuffle_files(spark)
    done, _ = alg.local_pass(level, state, 0, 30)
    assert _left(spark, files) == set()
    assert len(_kept(spark) - kept) == 1  # the new state
    assert {r["id"]: r["community"] for r in done.collect()} == _moved([(i, j) for i in range(30) for j in range(i)], range(30), (0, 1))[0]


def test_storing_leaves_no_shuffle_files(spark, make_graph, tmp_path):
    files = _shuffle_files(spark)
    lazy = store_on_demand(_graph(make_graph), str(tmp_path / "g"), 2, 4)
    assert lazy.edges.count() == len(EDGES) and lazy.nodes.count() == 4
    left = _left(spark, files)
    assert len({b.split("_")[1] for b in left}) <= 2  # the counts', at most
