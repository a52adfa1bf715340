"""Stored layouts, unique-edge chains, batch neighbourhoods and two-sided paths against brute force."""

import random
from collections import defaultdict

import pytest

from orbweave.operators import frontier, paths, pattern, search
from orbweave.sources import etl
from orbweave.sources.fixture import read_graph, store_graph


def _random(make_graph, n=30, m=70, seed=3):
    rnd = random.Random(seed)
    edges = [(1000 + k, rnd.choice(["a", "b"]), rnd.randrange(n), rnd.randrange(n)) for k in range(m)]
    return make_graph([(i, ["Officer"], {"name": f"n {i % 3}"}) for i in range(n)], edges), edges


@pytest.fixture(scope="module")
def stored(make_graph, tmp_path_factory):
    g, edges = _random(make_graph)
    return store_graph(g, str(tmp_path_factory.mktemp("graph")), 3, 8), edges


def _chains(edges, root, steps):
    """End nodes of the paths that take no edge twice."""
    at = [(root, ())]
    for kind, direction, _ in steps:
        at = [(far, (*taken, i)) for node, taken in at for i, t, s, d in edges if kind in (None, t) and i not in taken
              for near, far in {"out": [(s, d)], "in": [(d, s)], "both": [(s, d), (d, s)]}[direction] if near == node]
    return {node for node, _ in at}


@pytest.mark.parametrize("steps", [
    [(None, "both", None)] * 3, [("a", "out", None), ("a", "in", None), ("a", "out", None)],
    [("a", "both", None), (None, "both", None), ("b", "both", None), ("a", "both", None)], [(None, "out", None)] * 4])
def test_chains_take_no_edge_twice(stored, steps):
    g, edges = stored
    for root in (0, 7, 13):
        got = {r["node"] for r in pattern.match_chain(g, root, steps, edge_unique=True).collect()}
        assert got == _chains(edges, root, steps)


def test_hub_star_needs_two_edges(make_graph):
    # One edge can't go out and come back; a parallel one can.
    g = make_graph([(i, ["Officer"], {}) for i in range(4)], [(1, "a", 0, 1), (2, "a", 0, 2), (3, "a", 0, 2)])
    back = [("a", "out", None), ("a", "in", None)]
    assert [r["node"] for r in pattern.match_chain(g, 0, back, edge_unique=True).collect()] == [0]
    assert pattern.match_chain(g, 0, [("a", "out", None), ("a", "in", None), ("a", "out", None)], edge_unique=True).count() == 1


def test_batch_neighbourhoods(spark, stored):
    g, edges = stored
    roots = spark.createDataFrame([(i,) for i in (0, 1, 5, 9, 99)], "root long")
    for limit in (5, 500):
        want = []
        for root in (0, 1, 5, 9):
            near = sorted({(i, t, s, d) for i, t, s, d in edges if root in (s, d)})[:limit]
            want += [(root, i, t, s, d, d if s == root else s) for i, t, s, d in near]
        assert sorted(tuple(r) for r in pattern.neighborhood_batch(g, roots, limit).collect()) == sorted(want)


def test_least_shortest_paths(stored):
    g, edges = stored
    near = defaultdict(set)
    for _, _, s, d in edges:
        near[s].add(d)
        near[d].add(s)
    for source, target in ((0, 9), (3, 21), (5, 5), (2, 28)):
        at, seen = [(source,)], {source}
        while at and not any(p[-1] == target for p in at):
            at = [(*p, v) for p in at for v in near[p[-1]] if v not in seen]
            seen |= {p[-1] for p in at}
        want = min((p for p in at if p[-1] == target), default=None)
        got = paths.shortest_path(g, source, target, 10).collect()
        assert [tuple(r["path"]) for r in got] == ([want] if want else [])
        if want:
            steps = sorted(paths.path_edges(g, paths.shortest_path(g, source, target, 10)).collect())
            assert [r["edge_id"] for r in steps] == [min(i for i, _, s, d in edges if {s, d} == {a, b}) for a, b in zip(want, want[1:])]
    assert paths.shortest_path(g, 0, 999).count() == 0


def test_scans_read_the_frontiers_buckets_only(stored):
    g, _ = stored
    assert g.layout.buckets == 8
    at, _ = frontier.measured(g, frontier.known(g, [4]).frame)
    assert len(at.buckets) == 1
    plan = frontier.expand(g, at, "both")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(bucket") == 2
    assert sorted(r["id"] for r in g.incident(4).collect()) == sorted({i for i, _, s, d in stored[1] if 4 in (s, d)})


def test_layout_survives_storage_and_empty_graphs(spark, make_graph, tmp_path):
    g = make_graph([(1, ["Officer"], {})], [])
    store_graph(g, str(tmp_path / "g"), 2, 4)
    again = read_graph(spark, str(tmp_path / "g"))
    assert again.edges.count() == 0 and again.layout.buckets == 4
    assert [r["id"] for r in paths.khop_nodes(again, 1, 3).collect()] == [1]
    assert paths.shortest_path_length(again, 1, 2).count() == 0


def test_stored_token_index(stored, tmp_path):
    g, _ = stored
    names = etl.all_nodes(etl.mirror(g))
    index = search.store_token_index(names, str(tmp_path / "tokens"), 16)
    for q, hits in (("N, 2!", 10), ("n", 30), ("n 7", 0), ("", 0), ("2", 10)):
        assert search.token_search(index, q).count() == search.token_search(search.token_index(names), q).count() == hits
    plan = search.token_search(index, "n 2")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") >= 2 and "PartitionFilters: []" not in plan
