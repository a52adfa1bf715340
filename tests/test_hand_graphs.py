"""Tiny hand graphs, one per semantic rule (see FIXTURES.md section 6)."""

import pytest
from pyspark.sql import functions as F

from orbweave.operators import algorithms as alg
from orbweave.operators import paths, pattern

OF, IM = "officer_of", "intermediary_of"


def _officer(i):
    return (i, ["Officer"], {"name": f"O{i}"})


def _entity(i):
    return (i, ["Entity"], {"name": f"E{i}"})


def _ids(df, col):
    return sorted(r[col] for r in df.collect())


@pytest.fixture(scope="module")
def pattern_graph(make_graph):
    # A=1, B=2, C=3 officers; E1=11, E2=12; I=21
    nodes = [_officer(1), _officer(2), _officer(3), _entity(11), _entity(12),
             (21, ["Intermediary"], {"name": "I"})]
    edges = [(101, OF, 1, 11), (102, OF, 2, 11), (103, IM, 21, 11), (104, IM, 21, 12),
             (105, OF, 3, 12)]
    return make_graph(nodes, edges)


def test_co_officers_pattern_form_excludes_reused_edge(pattern_graph):
    ids = pattern.co_officer_ids(pattern_graph, 1, OF, IM, edge_unique=True)
    assert _ids(ids, "other") == [3]


def test_co_officers_sql_form_keeps_same_entity(pattern_graph):
    ids = pattern.co_officer_ids(pattern_graph, 1, OF, IM, edge_unique=False)
    assert _ids(ids, "other") == [2, 3]


def test_co_officers_parallel_edge_allows_return(make_graph, pattern_graph):
    g = make_graph(
        [_officer(1), _officer(2), _officer(3), _entity(11), _entity(12),
         (21, ["Intermediary"], {"name": "I"})],
        [(101, OF, 1, 11), (102, OF, 2, 11), (103, IM, 21, 11), (104, IM, 21, 12),
         (105, OF, 3, 12), (106, IM, 21, 11)])
    assert _ids(pattern.co_officer_ids(g, 1, OF, IM, True), "other") == [2, 3]


def test_edge_type_identifier_check(pattern_graph):
    with pytest.raises(ValueError):
        pattern.co_officer_ids(pattern_graph, 1, "officer of", IM)


def _plain(make_graph, n, edges):
    return make_graph([(i, ["Officer"], {}) for i in range(1, n + 1)],
                      [(100 + k, "connected_to", s, d) for k, (s, d) in enumerate(edges)])


def test_shortest_path_tie_takes_smallest_array(make_graph):
    g = _plain(make_graph, 4, [(1, 2), (2, 4), (1, 3), (3, 4)])
    row = paths.shortest_path(g, 1, 4, 6).first()
    assert row["path"] == [1, 2, 4] and row["length"] == 2


def test_shortest_path_undirected_and_directed(make_graph):
    g = _plain(make_graph, 3, [(1, 2), (3, 2)])
    assert paths.shortest_path(g, 1, 3, 6).first()["path"] == [1, 2, 3]
    assert paths.shortest_path(g, 1, 3, 6, directed=True).count() == 0


def test_shortest_path_bound(make_graph):
    g = _plain(make_graph, 8, [(i, i + 1) for i in range(1, 8)])
    assert paths.shortest_path_length(g, 1, 8, 6).count() == 0
    assert paths.shortest_path_length(g, 1, 8, 10).first()["length"] == 7


def test_shortest_path_same_end(make_graph):
    g = _plain(make_graph, 2, [(1, 2)])
    row = paths.shortest_path(g, 1, 1, 6).first()
    assert row["length"] == 0 and row["path"] == [1]


def test_path_edges_pick_smallest_edge_id(make_graph):
    g = _plain(make_graph, 2, [(1, 2), (2, 1)])  # edge ids 100 and 101
    sp = paths.shortest_path(g, 1, 2, 3)
    assert [r["edge_id"] for r in paths.path_edges(g, sp).collect()] == [100]


def _scores(nodes, edges):
    return {r["id"]: round(r["score"], 6) for r in alg.pagerank(nodes, edges).collect()}


def test_pagerank_cycle(make_graph):
    g = _plain(make_graph, 3, [(1, 2), (2, 3), (3, 1)])
    s = _scores(*alg.project_graph(g))
    assert all(abs(v - (1 - 0.85 ** 21)) < 1e-6 for v in s.values())


def test_pagerank_pair(make_graph):
    g = _plain(make_graph, 2, [(1, 2)])
    assert _scores(*alg.project_graph(g)) == {1: 0.15, 2: 0.2775}


def test_pagerank_dangling_and_parallel(make_graph):
    g = _plain(make_graph, 3, [(1, 2), (1, 2), (1, 3)])
    s = _scores(*alg.project_graph(g))
    assert s[2] == pytest.approx(0.235) and s[3] == pytest.approx(0.1925)


def test_neighborhood_self_loop(make_graph):
    g = _plain(make_graph, 2, [(1, 1), (1, 2)])
    assert _ids(pattern.neighborhood_nodes(g, 1), "id") == [1, 2]
    assert pattern.neighborhood_edges(g, 1).count() == 2


def test_neighborhood_isolated(make_graph):
    g = make_graph([(9, ["Officer"], {})], [])
    assert pattern.neighborhood_nodes(g, 9).count() == 0
    assert _ids(pattern.neighborhood_nodes(g, 9, keep_isolated=True), "id") == [9]


def test_khop_induced_edges(make_graph):
    g = _plain(make_graph, 5, [(1, 2), (2, 3), (3, 4), (4, 5), (1, 3)])
    ids = paths.khop_nodes(g, 1, 2)
    assert _ids(ids, "id") == [1, 2, 3, 4]
    assert _ids(paths.induced_edges(g, ids), "id") == [100, 101, 102, 104]


def test_louvain_two_cliques(make_graph):
    a = [(i, j) for i in range(1, 5) for j in range(i + 1, 5)]
    b = [(i, j) for i in range(5, 9) for j in range(i + 1, 9)]
    g = _plain(make_graph, 8, a + b + [(4, 5)])
    nodes, edges = alg.project_graph(g)
    comm = alg.louvain(nodes, edges)
    groups = {}
    for r in comm.collect():
        groups.setdefault(r["community"], set()).add(r["id"])
    assert sorted(map(sorted, groups.values())) == [[1, 2, 3, 4], [5, 6, 7, 8]]
    q = alg.modularity(alg.weighted_undirected(edges), comm).first()["modularity"]
    assert round(q, 6) == 0.423077


def test_modularity_singletons_not_above_found(make_graph):
    g = _plain(make_graph, 4, [(1, 2), (2, 3), (3, 4), (4, 1)])
    nodes, edges = alg.project_graph(g)
    w = alg.weighted_undirected(edges)
    single = alg.modularity(w, nodes.select("id", F.col("id").alias("community"))).first()[0]
    found = alg.modularity(w, alg.louvain(nodes, edges)).first()[0]
    assert found >= single


def test_pagerank_salted_hub_equals_plain(make_graph):
    # node 1 is a hub with 24 out-edges; four targets a salt split it into six
    star = [(1, j) for j in range(2, 26)] + [(j, j + 1) for j in range(2, 25)] + [(25, 1)]
    g = _plain(make_graph, 25, star)
    nodes, edges = alg.project_graph(g)
    plain = _scores(nodes, edges)
    salted = {r["id"]: round(r["score"], 6) for r in alg.pagerank(nodes, edges, edges_per_salt=4).collect()}
    assert salted == plain


def test_top_scores_order_before_rounding(spark, make_graph):
    g = _plain(make_graph, 3, [(1, 2)])
    scores = spark.createDataFrame([(1, 0.1500001), (2, 0.1500004), (3, 0.15)], "id long, score double")
    assert [(r["id"], r["score"]) for r in alg.top_scores(scores, g, 2).collect()] == [(2, 0.15), (1, 0.15)]
