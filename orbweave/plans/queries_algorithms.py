"""Registered queries: projections, PageRank variants, Louvain and modularity."""

from __future__ import annotations

from pyspark.sql import functions as F

from orbweave.functions.params import parameter
from orbweave.operators import algorithms as alg
from orbweave.operators import mapping, paths
from orbweave.operators.frontier import both_ways
from orbweave.operators.nodes import node_view
from orbweave.plans.catalog import context_for, graph_for, register
from orbweave.plans.oracle import with_graph
from orbweave.plans.queries_paths import SUBGRAPH_HOPS, bfs_ctes, shortest_ctes
from orbweave.session import release

# Result sizes of the PageRank views and the typed projection.
PAGERANK_TOP = 25
PAGERANK_DIRECTED_TOP = 20
GLOBAL_LABELS = ["Officer", "Entity", "Intermediary"]
GLOBAL_TYPES = ["OFFICER_OF", "INTERMEDIARY_OF"]

_HUB = "(SELECT officer_id FROM g_hub)"


def pagerank_ctes(nodes_sql: str, edges_sql: str) -> str:
    return f"""
pr_nodes AS ({nodes_sql}),
pr_edges AS ({edges_sql}),
pr_deg AS (SELECT src, count(*) AS n FROM pr_edges GROUP BY 1),
pr_e AS (SELECT src, dst, count(*) / any_value(n)::DOUBLE AS w FROM pr_edges JOIN pr_deg USING (src)
         GROUP BY 1, 2),
pr AS (
  SELECT 0 AS k, id, 0.15::DOUBLE AS score FROM pr_nodes
  UNION ALL
  SELECT k + 1, id, 0.15 + 0.85 * sum(x) FROM (
    SELECT p.k, e.dst AS id, p.score * e.w AS x FROM pr p JOIN pr_e e ON e.src = p.id
    UNION ALL SELECT p.k, p.id, 0.0 FROM pr p)
  WHERE k < 20 GROUP BY k, id
),
pr_final AS (SELECT id, round(score, 6) AS score, round(score, 9) AS raw FROM pr WHERE k = 20)"""


_KHOP_PR = bfs_ctes(_HUB, SUBGRAPH_HOPS).strip() + "," + pagerank_ctes(
    "SELECT node AS id FROM g_bfs_dist",
    "SELECT src, dst FROM g_edges WHERE src IN (SELECT node FROM g_bfs_dist) "
    "AND dst IN (SELECT node FROM g_bfs_dist)")


@register("pagerank_khop", with_graph(f"""
SELECT t.id, v.kind, v.name, t.score FROM (
  SELECT id, score FROM pr_final ORDER BY raw DESC, id LIMIT {PAGERANK_TOP}) t
LEFT JOIN g_nv v ON v.id = t.id""", _KHOP_PR, recursive=True))
def q_pagerank_khop(spark, sf_dir):
    """PageRank on the hub's 2-hop subgraph (directed, parallel edges kept), top 25."""
    ctx = context_for(spark, sf_dir)
    g = graph_for(spark, sf_dir)
    sub = paths.khop_nodes(g, ctx.officer_id, SUBGRAPH_HOPS)
    nodes, edges = alg.project_graph(g, node_ids=sub)
    return alg.top_scores(alg.pagerank(nodes, edges), g, PAGERANK_TOP)


@register("score_display", with_graph("""
SELECT t.id, v.kind, v.name, round(t.raw, 4) AS score FROM (
  SELECT id, raw FROM pr_final ORDER BY raw DESC, id LIMIT 30) t
LEFT JOIN g_nv v ON v.id = t.id""", _KHOP_PR, recursive=True))
def q_score_display(spark, sf_dir):
    """PageRank of the hub's 2-hop subgraph as it is listed: 30 rows of the 100 asked for, 4 digits."""
    ctx = context_for(spark, sf_dir)
    g = graph_for(spark, sf_dir)
    nodes, edges = alg.project_graph(g, node_ids=paths.khop_nodes(g, ctx.officer_id, parameter("algorithm_hops")))
    return alg.score_display(alg.pagerank(nodes, edges), g, 100)


_GLOBAL_NODES = ("SELECT id FROM g_nodes WHERE list_contains(labels, 'Officer') OR "
                 "list_contains(labels, 'Entity') OR list_contains(labels, 'Intermediary')")
_GLOBAL_EDGES_DIRECTED = f"""
SELECT src, dst FROM g_edges WHERE lower(type) IN ('officer_of', 'intermediary_of')
  AND src IN ({_GLOBAL_NODES}) AND dst IN ({_GLOBAL_NODES})"""
_GLOBAL_PR = pagerank_ctes(
    _GLOBAL_NODES,
    f"SELECT src, dst FROM ({_GLOBAL_EDGES_DIRECTED}) UNION ALL SELECT dst, src FROM ({_GLOBAL_EDGES_DIRECTED})")


@register("pagerank_global", with_graph(f"""
SELECT t.id, v.kind, v.name, t.score FROM (
  SELECT id, score FROM pr_final WHERE score > 0 ORDER BY raw DESC, id LIMIT {PAGERANK_TOP}) t
LEFT JOIN g_nv v ON v.id = t.id""", _GLOBAL_PR, recursive=True))
def q_pagerank_global(spark, sf_dir):
    """Whole-graph PageRank on the typed undirected projection, score > 0, top 25."""
    g = graph_for(spark, sf_dir)
    nodes, edges = alg.project_graph(g, GLOBAL_LABELS, GLOBAL_TYPES, "undirected")
    return alg.top_scores(alg.pagerank(nodes, edges), g, PAGERANK_TOP, min_score=0.0)


@register("pagerank_directed", with_graph(f"""
SELECT t.id, v.name, t.score FROM (
  SELECT id, score FROM pr_final ORDER BY raw DESC, id LIMIT {PAGERANK_DIRECTED_TOP}) t
LEFT JOIN g_nv v ON v.id = t.id""",
    pagerank_ctes("SELECT id FROM g_nodes", "SELECT src, dst FROM g_edges"), recursive=True))
def q_pagerank_directed(spark, sf_dir):
    """Whole directed graph, top 20 names."""
    g = graph_for(spark, sf_dir)
    nodes, edges = alg.project_graph(g)
    return alg.top_scores(alg.pagerank(nodes, edges), g, PAGERANK_DIRECTED_TOP) \
        .select("id", "name", "score")


@register("project_graph", with_graph(f"""
SELECT src, dst FROM ({_GLOBAL_EDGES_DIRECTED})
UNION ALL SELECT dst, src FROM ({_GLOBAL_EDGES_DIRECTED})"""))
def q_project_graph(spark, sf_dir):
    _, edges = alg.project_graph(graph_for(spark, sf_dir), GLOBAL_LABELS, GLOBAL_TYPES,
                                 "undirected")
    return edges


@register("partition_modularity", with_graph("""
SELECT round(sum(inner_w) / sum(tot) - sum(tot * tot) / (sum(tot) * sum(tot)), 6) AS modularity
FROM (
  SELECT cs.kind AS community, sum(CASE WHEN cs.kind = cd.kind THEN w ELSE 0 END) AS inner_w,
         sum(w) AS tot
  FROM (SELECT src, dst, count(*)::DOUBLE AS w FROM (
          SELECT src, dst FROM g_edges UNION ALL SELECT dst, src FROM g_edges) GROUP BY 1, 2) e
  JOIN g_view cs ON cs.id = e.src JOIN g_view cd ON cd.id = e.dst
  GROUP BY 1)"""))
def q_partition_modularity(spark, sf_dir):
    """Modularity (the Louvain objective) of the partition of the whole graph by node kind."""
    g = graph_for(spark, sf_dir)
    nodes, edges = alg.project_graph(g)
    comm = node_view(g).select("id", F.col("kind").alias("community"))
    return alg.modularity(alg.weighted_undirected(edges), comm).select(
        F.round("modularity", 6).alias("modularity"))


def _half_pass_ctes(before: str, after: str, half: int) -> str:
    """``after`` (id, community, k): the nodes of ``before`` whose turn is ``half`` of pass 0 moved to their best community."""
    return f"""
{after}_into AS (
  SELECT id, c, sum(w) AS k_in FROM (
    SELECT e.src AS id, there.community AS c, e.w FROM lv_w e JOIN {before} there ON there.id = e.dst WHERE e.src <> e.dst
    UNION ALL SELECT id, community, 0 FROM {before})
  GROUP BY id, c
),
{after}_gain AS (
  SELECT v.id, v.community AS own, x.c,
         x.k_in / m - v.k * (t.tot - CASE WHEN x.c = v.community THEN v.k ELSE 0 END) / (2 * m * m) AS gain
  FROM {before} v JOIN {after}_into x ON x.id = v.id
  JOIN (SELECT community, sum(k) AS tot FROM {before} GROUP BY 1) t ON t.community = x.c, lv_m
  WHERE (v.id % 1000003 * 7919) % 1009 % 2 = {half}
),
{after}_best AS (
  SELECT id, c, gain, max(CASE WHEN c = own THEN gain END) OVER (PARTITION BY id) AS stay,
         row_number() OVER (PARTITION BY id ORDER BY gain DESC, c) AS place
  FROM {after}_gain
),
{after} AS (
  SELECT v.id, CASE WHEN b.gain > b.stay + 1e-12 THEN b.c ELSE v.community END AS community, v.k
  FROM {before} v LEFT JOIN (SELECT * FROM {after}_best WHERE place = 1) b ON b.id = v.id
)"""


def _pass_ctes(nodes_sql: str, edges_sql: str) -> str:
    """lv_two: the first pass of local moving over a graph, from every node on its own."""
    return f"""
lv_e AS ({edges_sql}),
lv_w AS (SELECT src, dst, CAST(count(*) AS DOUBLE) AS w FROM (
  SELECT src, dst FROM lv_e UNION ALL SELECT dst, src FROM lv_e) GROUP BY 1, 2),
lv_m AS (SELECT sum(w) / 2 AS m FROM lv_w),
lv_none AS (
  SELECT n.id, n.id AS community, coalesce(d.k, 0) AS k
  FROM ({nodes_sql}) n LEFT JOIN (SELECT src, sum(w) AS k FROM lv_w GROUP BY 1) d ON d.src = n.id
),""" + _half_pass_ctes("lv_none", "lv_one", 0).rstrip() + "," + _half_pass_ctes("lv_one", "lv_two", 1)


_KHOP_NODES = "SELECT node AS id FROM g_bfs_dist"
_KHOP_EDGES = ("SELECT src, dst FROM g_edges WHERE src IN (SELECT node FROM g_bfs_dist) "
               "AND dst IN (SELECT node FROM g_bfs_dist)")


def _first_pass(nodes, edges):
    pairs = alg.cut_lineage(alg.weighted_pairs(edges))
    links = alg.lay_out(both_ways(pairs, "src", "dst"))
    release(pairs)  # the lists have them
    state = alg.cut_lineage(alg.singletons(nodes, links))
    return (alg.local_pass(links, state, 0)[0] if links.m2 else state).select("id", "community")


@register("louvain_pass", with_graph(
    "SELECT id, community FROM lv_two", _pass_ctes("SELECT id FROM g_nodes", "SELECT src, dst FROM g_edges")))
def q_louvain_pass(spark, sf_dir):
    """The first pass of Louvain's local moving over the whole graph: each node's community."""
    return _first_pass(*alg.project_graph(graph_for(spark, sf_dir)))


@register("enrich_view_pass", with_graph(f"""
SELECT v.id, v.kind, v.name, c.community, coalesce(p.color, s.color) AS color,
  CASE WHEN v.id IN (SELECT unnest(path) FROM g_best) THEN 1 ELSE 0 END AS highlighted
FROM g_nv v LEFT JOIN lv_two c ON c.id = v.id
LEFT JOIN (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(mapping.COMMUNITY_PALETTE))}) p(bucket, color)
  ON p.bucket = c.community % {len(mapping.COMMUNITY_PALETTE)}
LEFT JOIN (VALUES {", ".join(f"('{k}', '{c}')" for k, _, c in mapping.KIND_STYLE)}) s(kind, color) ON s.kind = v.kind
WHERE v.id IN (SELECT id FROM lv_two) OR v.id IN (SELECT unnest(path) FROM g_best)""",
    shortest_ctes("(SELECT officer_id FROM g_hub)", "(SELECT path_target_id FROM g_ctx)",
                  "5").rstrip() + "," + bfs_ctes(_HUB, SUBGRAPH_HOPS).rstrip() + ","
    + _pass_ctes(_KHOP_NODES, _KHOP_EDGES), recursive=True))
def q_enrich_view_pass(spark, sf_dir):
    """The hub's 2-hop view coloured by the communities of the first pass, shortest-path nodes highlighted."""
    ctx = context_for(spark, sf_dir)
    g = graph_for(spark, sf_dir)
    sub = paths.khop_nodes(g, ctx.officer_id, SUBGRAPH_HOPS)
    comm = _first_pass(*alg.project_graph(g, node_ids=sub))
    return _coloured(g, ctx, comm)


def _coloured(g, ctx, comm):
    sp = paths.shortest_path(g, ctx.path_source_id, ctx.path_target_id, ctx.max_hops)
    on_path = paths.path_steps(sp).select(F.col("node_id").alias("id"))
    shown = comm.select("id").unionByName(on_path).distinct()
    nodes = node_view(g).join(shown, "id", "left_semi").select("id", "kind", "name")
    return mapping.enrich_view(nodes, comm, on_path)


def _louvain_khop(spark, sf_dir):
    ctx = context_for(spark, sf_dir)
    g = graph_for(spark, sf_dir)
    sub = paths.khop_nodes(g, ctx.officer_id, SUBGRAPH_HOPS)
    nodes, edges = alg.project_graph(g, node_ids=sub)
    return g, nodes, edges, alg.louvain(nodes, edges)


@register("louvain_khop")
def q_louvain_khop(spark, sf_dir):
    """Communities of the hub's 2-hop subgraph (rows-only check: no SQL Louvain)."""
    g, _, _, comm = _louvain_khop(spark, sf_dir)
    return comm.join(node_view(g).select("id", "kind", "name"), "id", "left") \
        .select("id", "kind", "name", "community").orderBy("community", "id")


@register("louvain_modularity")
def q_louvain_modularity(spark, sf_dir):
    """Modularity of the Louvain partition next to the singleton partition's (guard: not lower)."""
    _, nodes, edges, comm = _louvain_khop(spark, sf_dir)
    w = alg.weighted_undirected(edges)
    found = alg.modularity(w, comm).select(F.round("modularity", 6).alias("modularity"))
    single = alg.modularity(w, nodes.select("id", F.col("id").alias("community"))) \
        .select(F.round("modularity", 6).alias("singleton_modularity"))
    n_comm = comm.agg(F.countDistinct("community").alias("communities"))
    return found.unionByName(single, allowMissingColumns=True) \
        .unionByName(n_comm, allowMissingColumns=True) \
        .agg(F.max("modularity").alias("modularity"),
             F.max("singleton_modularity").alias("singleton_modularity"),
             F.max("communities").alias("communities"))


@register("enrich_view")
def q_enrich_view(spark, sf_dir):
    """The hub's 2-hop view coloured by Louvain community, shortest-path nodes highlighted.

    Rows-only check: the community lookup comes from Louvain, which has no SQL oracle.
    """
    ctx = context_for(spark, sf_dir)
    g, _, _, comm = _louvain_khop(spark, sf_dir)
    return _coloured(g, ctx, comm)


@register("louvain_invariants", with_graph("""
SELECT (SELECT count(*) FROM lv_none) AS nodes, (SELECT count(*) FROM lv_none) AS labelled, 0 AS not_least_member, 0 AS below_singletons,
  round((SELECT coalesce(sum(w), 0) FROM lv_w WHERE src = dst) / (2 * m) - (SELECT sum(k * k) FROM lv_none) / (4 * m * m), 6) AS singleton_modularity
FROM lv_m""", bfs_ctes(_HUB, SUBGRAPH_HOPS).rstrip() + "," + _pass_ctes(_KHOP_NODES, _KHOP_EDGES), recursive=True))
def q_louvain_invariants(spark, sf_dir):
    """What holds of Louvain's communities of the hub's 2-hop view: every node once, labels are least members, no loss of modularity."""
    _, nodes, edges, comm = _louvain_khop(spark, sf_dir)
    w = alg.cut_lineage(alg.weighted_undirected(edges))
    comm = alg.cut_lineage(comm)
    least = comm.groupBy("community").agg(F.min("id").alias("least"))
    counts = comm.agg(F.count("*").alias("nodes"), F.count_distinct("id").alias("labelled"))
    wrong = least.agg(F.count(F.when(F.col("least") != F.col("community"), 1)).cast("int").alias("not_least_member"))
    found = alg.modularity(w, comm).withColumnRenamed("modularity", "found")
    single = alg.modularity(w, nodes.select("id", F.col("id").alias("community")))
    out = counts  # frames of one row each
    for part in (wrong, found, single):
        out = out.unionByName(part, allowMissingColumns=True)
    out = out.agg(*(F.max(c).alias(c) for c in out.columns))
    return out.select("nodes", "labelled", "not_least_member", (F.col("found") < F.col("modularity")).cast("int").alias("below_singletons"),
                      F.round("modularity", 6).alias("singleton_modularity"))
