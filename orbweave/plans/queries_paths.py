"""Registered queries: neighbourhoods, k-hop subgraphs, BFS and shortest paths.

Oracles use DuckDB recursive CTEs: set-semantics BFS for distances, and for
shortest paths the least node of each step among those on one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from orbweave.operators import mapping, paths, pattern
from orbweave.operators.nodes import node_view
from orbweave.plans.catalog import context_for, graph_for, loaded_mirror_for, register
from orbweave.plans.oracle import with_graph
from orbweave.operators.search import resolve_name

# Hops of the subgraph/algorithm queries, neighbourhood edge cap,
# and the depth range of the sweep.
SUBGRAPH_HOPS = 2
NEIGHBORHOOD_LIMIT = 80
SWEEP_MIN, SWEEP_MAX = 2, 6

_HUB = "(SELECT officer_id FROM g_hub)"
_TARGET = "(SELECT path_target_id FROM g_ctx)"
_HOPS = "5"  # the context's max_hops


def bfs_ctes(source: str, max_depth: int | str, name: str = "g_bfs") -> str:
    return f"""
{name} AS (
  SELECT {source} AS node, 0 AS depth
  UNION
  SELECT a.v, b.depth + 1 FROM {name} b JOIN g_adj a ON a.u = b.node WHERE b.depth < {max_depth}
),
{name}_dist AS (SELECT node, min(depth) AS depth FROM {name} GROUP BY node)"""


def shortest_ctes(source: str, target: str, hops: str, directed: bool = False) -> str:
    """g_best (source, target, length, path) and g_pairs (pos, a, b) of the smallest shortest path.

    Distances from both ends by set-semantics BFS; a node lies on a shortest
    path if they add up to its length, and the smallest path takes the least
    such node at each step.
    """
    out = "SELECT src AS u, dst AS v FROM g_edges" if directed else "SELECT u, v FROM g_adj"
    return f"""
g_step AS ({out}),
g_fwd AS (
  SELECT {source} AS node, 0 AS depth
  UNION
  SELECT a.v, b.depth + 1 FROM g_fwd b JOIN g_step a ON a.u = b.node WHERE b.depth < {hops}
),
g_bwd AS (
  SELECT {target} AS node, 0 AS depth
  UNION
  SELECT a.u, b.depth + 1 FROM g_bwd b JOIN g_step a ON a.v = b.node WHERE b.depth < {hops}
),
g_length AS (SELECT min(depth) AS n FROM g_fwd WHERE node = {target}),
g_on AS (
  SELECT f.node, f.depth FROM (SELECT node, min(depth) AS depth FROM g_fwd GROUP BY node) f
  JOIN (SELECT node, min(depth) AS depth FROM g_bwd GROUP BY node) t ON t.node = f.node
  WHERE f.depth + t.depth = (SELECT n FROM g_length)
),
g_least AS (
  SELECT node, depth FROM g_on WHERE depth = 0
  UNION ALL
  SELECT min(o.node), l.depth + 1 FROM g_least l JOIN g_step a ON a.u = l.node
  JOIN g_on o ON o.node = a.v AND o.depth = l.depth + 1 GROUP BY l.depth
),
g_best AS (
  SELECT {source} AS source, {target} AS target, CAST(max(depth) AS INTEGER) AS length, list(node ORDER BY depth) AS path
  FROM g_least HAVING count(*) > 0
),
g_pairs AS (
  SELECT i - 1 AS pos, path[i] AS a, path[i + 1] AS b
  FROM g_best, (SELECT unnest(range(1, len((SELECT path FROM g_best)))) AS i)
)"""


def _ctx(spark, sf_dir):
    return context_for(spark, sf_dir), graph_for(spark, sf_dir)


# -- neighbourhoods ---------------------------------------------------------------

_NE = f"""
g_ne AS (SELECT id, type, src, dst FROM g_edges WHERE src = {_HUB} OR dst = {_HUB}
         ORDER BY id LIMIT {NEIGHBORHOOD_LIMIT})"""


@register("neighborhood_edges", with_graph("SELECT * FROM g_ne", _NE))
def q_neighborhood_edges(spark, sf_dir):
    ctx, g = _ctx(spark, sf_dir)
    return pattern.neighborhood_edges(g, ctx.officer_id, NEIGHBORHOOD_LIMIT)


@register("neighborhood_nodes", with_graph(f"""
SELECT id, kind, name FROM g_nv WHERE id IN (
  SELECT CASE WHEN src = {_HUB} THEN dst ELSE src END FROM g_ne
  UNION SELECT {_HUB} FROM g_ne)""", _NE))
def q_neighborhood_nodes(spark, sf_dir):
    ctx, g = _ctx(spark, sf_dir)
    return pattern.neighborhood_nodes(g, ctx.officer_id, NEIGHBORHOOD_LIMIT)


_ISOLATED = """
g_isolated AS (SELECT min(id) AS id FROM g_nodes
  WHERE id NOT IN (SELECT src FROM g_edges) AND id NOT IN (SELECT dst FROM g_edges))"""


def _isolated_root(g):
    lonely = g.nodes.select("id").join(g.edges.select(F.col("src").alias("id")), "id", "left_anti") \
        .join(g.edges.select(F.col("dst").alias("id")), "id", "left_anti")
    return lonely.agg(F.min("id").alias("id")).first()["id"]


@register("neighborhood_isolated", with_graph(
    "SELECT id, kind, name FROM g_nv WHERE id = (SELECT id FROM g_isolated)", _ISOLATED))
def q_neighborhood_isolated(spark, sf_dir):
    """An isolated node keeps itself only with ``keep_isolated`` (the default drops it)."""
    g = graph_for(spark, sf_dir)
    return pattern.neighborhood_nodes(g, _isolated_root(g), NEIGHBORHOOD_LIMIT, keep_isolated=True)


@register("neighborhood_default", with_graph(f"""
SELECT 'hub' AS root, id FROM g_nv WHERE id IN (
  SELECT CASE WHEN src = {_HUB} THEN dst ELSE src END FROM g_ne UNION SELECT {_HUB} FROM g_ne)
UNION ALL SELECT 'isolated', id FROM g_nv WHERE id = (SELECT id FROM g_isolated) AND false""",
    _NE.rstrip() + "," + _ISOLATED))
def q_neighborhood_default(spark, sf_dir):
    """The default form for the hub and an isolated node: the limit is the parameter's, and the latter has no row."""
    ctx, g = _ctx(spark, sf_dir)
    parts = [pattern.neighborhood_nodes(g, root).select(F.lit(name).alias("root"), "id")
             for name, root in (("hub", ctx.officer_id), ("isolated", _isolated_root(g)))]
    return parts[0].unionByName(parts[1])


@register("neighborhood_batch", with_graph(f"""
SELECT root, id, type, src, dst, neighbor FROM (
  SELECT o.node_id AS root, e.id, e.type, e.src, e.dst, e.far AS neighbor,
         row_number() OVER (PARTITION BY o.node_id ORDER BY e.id) AS nth
  FROM g_officers o JOIN (
    SELECT *, src AS near, dst AS far FROM g_edges
    UNION ALL SELECT *, dst, src FROM g_edges WHERE src <> dst) e ON e.near = o.node_id)
WHERE nth <= {NEIGHBORHOOD_LIMIT}"""))
def q_neighborhood_batch(spark, sf_dir):
    """The limited neighbourhood of every officer at once."""
    g = graph_for(spark, sf_dir)
    officers = g.nodes.filter(F.array_contains("labels", "Officer")).select(F.col("id").alias("root"))
    return pattern.neighborhood_batch(g, officers)


@register("collect_neighbors", with_graph(f"""
SELECT {_HUB} AS id,
  array_to_string(list_sort(list_distinct(list(CASE WHEN src = {_HUB} THEN dst ELSE src END))), ',') AS neighbors,
  array_to_string(list_sort(list_distinct(list(id))), ',') AS edge_ids
FROM g_ne""", _NE))
def q_collect_neighbors(spark, sf_dir):
    ctx, g = _ctx(spark, sf_dir)
    c = pattern.collect_neighbors(g, ctx.officer_id, NEIGHBORHOOD_LIMIT)
    return c.select("id", F.array_join(F.col("neighbors").cast("array<string>"), ",").alias("neighbors"),
                    F.array_join(F.col("edge_ids").cast("array<string>"), ",").alias("edge_ids"))


@register("unwind_edges", with_graph(f"""
SELECT {_HUB} AS id, CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS pos, id AS edge_id
FROM g_ne""", _NE))
def q_unwind_edges(spark, sf_dir):
    from orbweave.operators.stats import unwind_edges
    ctx, g = _ctx(spark, sf_dir)
    return unwind_edges(g, ctx.officer_id, NEIGHBORHOOD_LIMIT)


@register("undirected_adjacency", with_graph("SELECT u, v FROM g_adj"))
def q_undirected_adjacency(spark, sf_dir):
    return pattern.undirected_adjacency(graph_for(spark, sf_dir))


_OF = "type = (SELECT type FROM g_of_type)"
_IM = "type = (SELECT type FROM g_im_type)"


@register("match_chain", with_graph(f"""
SELECT {_HUB} AS root, id AS node FROM g_nodes
WHERE list_contains(labels, 'Officer') AND id IN (
  SELECT src FROM g_edges WHERE {_OF} AND dst IN (
    SELECT dst FROM g_edges WHERE {_IM} AND src IN (
      SELECT src FROM g_edges WHERE {_IM} AND dst IN (
        SELECT dst FROM g_edges WHERE {_OF} AND src = {_HUB}
          AND dst IN (SELECT id FROM g_nodes WHERE list_contains(labels, 'Entity'))))))"""))
def q_match_chain(spark, sf_dir):
    """The co-officer chain written as generic steps (no uniqueness, root included)."""
    ctx, g = _ctx(spark, sf_dir)
    steps = [(ctx.officer_of_type, "out", "Entity"), (ctx.intermediary_of_type, "in", None),
             (ctx.intermediary_of_type, "out", None), (ctx.officer_of_type, "in", "Officer")]
    return pattern.match_chain(g, ctx.officer_id, steps)


@register("match_chain_unique", with_graph(f"SELECT {_HUB} AS root, other AS node FROM g_co"))
def q_match_chain_unique(spark, sf_dir):
    """The co-officer pattern as generic steps with unique edges; another officer than the root."""
    ctx, g = _ctx(spark, sf_dir)
    steps = [(ctx.officer_of_type, "out", None), (ctx.intermediary_of_type, "in", None),
             (ctx.intermediary_of_type, "out", None), (ctx.officer_of_type, "in", "Officer")]
    return pattern.match_chain(g, ctx.officer_id, steps, edge_unique=True).filter(F.col("node") != F.col("root"))


# -- k-hop subgraph ------------------------------------------------------------------

@register("khop_nodes", with_graph("SELECT node AS id, depth FROM g_bfs_dist",
                                   bfs_ctes(_HUB, SUBGRAPH_HOPS), recursive=True))
def q_khop_nodes(spark, sf_dir):
    ctx, g = _ctx(spark, sf_dir)
    return paths.khop_nodes(g, ctx.officer_id, SUBGRAPH_HOPS)


@register("khop_edges", with_graph("""
SELECT id, type, src, dst FROM g_edges
WHERE src IN (SELECT node FROM g_bfs_dist) AND dst IN (SELECT node FROM g_bfs_dist)""",
    bfs_ctes(_HUB, SUBGRAPH_HOPS), recursive=True))
def q_khop_edges(spark, sf_dir):
    ctx, g = _ctx(spark, sf_dir)
    return paths.induced_edges(g, paths.khop_nodes(g, ctx.officer_id, SUBGRAPH_HOPS))


@register("closed_neighborhood", with_graph(f"""
SELECT DISTINCT id FROM (
  SELECT src AS id FROM g_edges WHERE (src = {_HUB} OR dst = {_HUB})
    AND src IN (SELECT node FROM g_bfs_dist) AND dst IN (SELECT node FROM g_bfs_dist)
  UNION ALL
  SELECT dst FROM g_edges WHERE (src = {_HUB} OR dst = {_HUB})
    AND src IN (SELECT node FROM g_bfs_dist) AND dst IN (SELECT node FROM g_bfs_dist)
  UNION ALL SELECT {_HUB})""", bfs_ctes(_HUB, SUBGRAPH_HOPS), recursive=True))
def q_closed_neighborhood(spark, sf_dir):
    """Inside the displayed 2-hop subgraph: the hub and the nodes adjacent to it."""
    ctx, g = _ctx(spark, sf_dir)
    sub = paths.khop_subgraph(g, ctx.officer_id, SUBGRAPH_HOPS)
    return pattern.closed_neighborhood(sub.nodes, sub.edges, ctx.officer_id)


# -- BFS, shortest paths ------------------------------------------------------------

_SHORTEST = shortest_ctes(_HUB, _TARGET, _HOPS)


def _shortest(spark, sf_dir):
    ctx, g = _ctx(spark, sf_dir)
    return ctx, g, paths.shortest_path(g, ctx.path_source_id, ctx.path_target_id, ctx.max_hops)


@register("shortest_path_nodes", with_graph("""
SELECT p.pos, p.node_id, v.kind, v.name FROM (
  SELECT CAST(generate_subscripts(path, 1) - 1 AS INTEGER) AS pos, unnest(path) AS node_id FROM g_best) p
LEFT JOIN g_nv v ON v.id = p.node_id""", _SHORTEST, recursive=True))
def q_shortest_path_nodes(spark, sf_dir):
    _, g, sp = _shortest(spark, sf_dir)
    return paths.path_nodes(g, sp)


@register("shortest_path_edges", with_graph("""
SELECT CAST(b.pos AS INTEGER) AS pos, b.edge_id, e.type, e.src, e.dst FROM (
  SELECT p.pos, min(e.id) AS edge_id FROM g_pairs p
  JOIN g_edges e ON (e.src = p.a AND e.dst = p.b) OR (e.src = p.b AND e.dst = p.a)
  GROUP BY p.pos) b JOIN g_edges e ON e.id = b.edge_id""", _SHORTEST, recursive=True))
def q_shortest_path_edges(spark, sf_dir):
    _, g, sp = _shortest(spark, sf_dir)
    return paths.path_edges(g, sp)


@register("shortest_path_length", with_graph(
    "SELECT source, target, length FROM g_best", _SHORTEST, recursive=True))
def q_shortest_path_length(spark, sf_dir):
    ctx, g = _ctx(spark, sf_dir)
    return paths.shortest_path_length(g, ctx.path_source_id, ctx.path_target_id, ctx.max_hops)


@register("path_steps", with_graph("""
SELECT CAST(generate_subscripts(path, 1) - 1 AS INTEGER) AS pos, unnest(path) AS node_id FROM g_best""",
    _SHORTEST, recursive=True))
def q_path_steps(spark, sf_dir):
    _, _, sp = _shortest(spark, sf_dir)
    return paths.path_steps(sp)


@register("simple_paths", with_graph("""
SELECT target, length, array_to_string(path, ',') AS path FROM g_best""", _SHORTEST, recursive=True))
def q_simple_paths(spark, sf_dir):
    ctx, g = _ctx(spark, sf_dir)
    return paths.first_hit(g, ctx.path_source_id, ctx.path_target_id, ctx.max_hops)


# The edge types and the depth of the walk that lists all simple paths.
WALK_TYPES = ("connected_to", "REGISTERED_ADDRESS")
WALK_DEPTH = 3


@register("simple_path_walk", with_graph(f"""
SELECT node, depth, array_to_string(path, ',') AS path FROM g_walk""", f"""
g_walk_step AS (
  SELECT src AS u, dst AS v FROM g_edges WHERE type IN {WALK_TYPES}
  UNION SELECT dst, src FROM g_edges WHERE type IN {WALK_TYPES}
),
g_walk AS (
  SELECT {_HUB} AS node, 0 AS depth, [{_HUB}] AS path
  UNION ALL
  SELECT s.v, w.depth + 1, list_append(w.path, s.v) FROM g_walk w JOIN g_walk_step s ON s.u = w.node
  WHERE w.depth < {WALK_DEPTH} AND NOT list_contains(w.path, s.v)
)""", recursive=True))
def q_simple_path_walk(spark, sf_dir):
    """Every simple path of at most three connections and registered addresses from the hub."""
    ctx, g = _ctx(spark, sf_dir)
    near = g.edges.filter(F.col("type").isin(*WALK_TYPES))
    walk = paths.recursive_walk(g.nodes, near, ctx.officer_id, WALK_DEPTH)
    return walk.select("node", "depth", F.array_join(F.col("path").cast("array<string>"), ",").alias("path"))


_NAME_OF_HUB = "(SELECT min(node_id) FROM g_officers WHERE name = (SELECT name FROM g_officers WHERE node_id = (SELECT officer_id FROM g_hub)))"
_NAME_OF_TARGET = "(SELECT min(node_id) FROM g_officers WHERE name = (SELECT name FROM g_officers WHERE node_id = (SELECT path_target_id FROM g_ctx)))"


def _ids_by_name(spark, sf_dir, target=None):
    ctx = context_for(spark, sf_dir)
    officers = loaded_mirror_for(spark, sf_dir).officers
    def name_of(i):
        return officers.filter(F.col("node_id") == i).select("name").first()["name"]
    src = resolve_name(officers, name_of(ctx.path_source_id)).first()["node_id"]
    dst = resolve_name(officers, name_of(target or ctx.path_target_id)).first()["node_id"]
    return ctx, src, dst


@register("shortest_path_by_name", with_graph("""
SELECT source, target, length, array_to_string(path, ',') AS path FROM g_best""",
    shortest_ctes(_NAME_OF_HUB, _NAME_OF_TARGET, _HOPS), recursive=True))
def q_shortest_path_by_name(spark, sf_dir):
    ctx, src, dst = _ids_by_name(spark, sf_dir)
    sp = paths.shortest_path(graph_for(spark, sf_dir), src, dst, ctx.max_hops)
    return sp.select("source", "target", "length",
                     F.array_join(F.col("path").cast("array<string>"), ",").alias("path"))


# Three connected_to steps away from the hub.
_AWAY = _HUB
for _ in range(3):
    _AWAY = f"(SELECT min(dst) FROM g_edges WHERE type = 'connected_to' AND src = {_AWAY})"
_DIRECTED_TARGET = _NAME_OF_TARGET.replace("(SELECT path_target_id FROM g_ctx)", _AWAY)


@register("simple_paths_directed", with_graph("""
SELECT target, length, array_to_string(path, ',') AS path FROM g_best""",
    shortest_ctes(_NAME_OF_HUB, _DIRECTED_TARGET, _HOPS, directed=True), recursive=True))
def q_simple_paths_directed(spark, sf_dir):
    """Along edge directions, between two names: the hub and the officer three steps away."""
    ctx, g = _ctx(spark, sf_dir)
    away = pattern.match_chain(g, ctx.officer_id, [("connected_to", "out", None)] * 3)
    _, src, dst = _ids_by_name(spark, sf_dir, away.agg(F.min("node")).first()[0])
    return paths.first_hit(g, src, dst, ctx.max_hops, directed=True)


@register("depth_sweep", with_graph(f"""
SELECT h.max_hops,
  CAST(coalesce(max(CASE WHEN d.node = {_TARGET} THEN 1 END), 0) AS INTEGER) AS found,
  CAST(min(CASE WHEN d.node = {_TARGET} THEN d.depth END) AS INTEGER) AS length,
  count(CASE WHEN d.depth = h.max_hops THEN 1 END) AS frontier,
  count(d.node) AS reached
FROM (SELECT CAST(range AS INTEGER) AS max_hops FROM range({SWEEP_MIN}, {SWEEP_MAX + 1})) h
LEFT JOIN g_bfs_dist d ON d.depth <= h.max_hops
GROUP BY h.max_hops""", bfs_ctes(_HUB, SWEEP_MAX), recursive=True))
def q_depth_sweep(spark, sf_dir):
    ctx, g = _ctx(spark, sf_dir)
    return paths.depth_sweep(g, ctx.path_source_id, ctx.path_target_id, SWEEP_MIN, SWEEP_MAX)


@register("path_highlight", with_graph(f"""
SELECT v.id, v.kind, v.name, CAST(NULL AS BIGINT) AS community,
  s.color, CASE WHEN v.id IN (SELECT unnest(path) FROM g_best) THEN 1 ELSE 0 END AS highlighted
FROM g_nv v LEFT JOIN (VALUES {", ".join(f"('{k}', '{c}')" for k, _, c in mapping.KIND_STYLE)}) s(kind, color)
  ON s.kind = v.kind
WHERE v.id IN (SELECT node FROM g_bfs_dist) OR v.id IN (SELECT unnest(path) FROM g_best)""",
    _SHORTEST.rstrip() + "," + bfs_ctes(_HUB, SUBGRAPH_HOPS), recursive=True))
def q_path_highlight(spark, sf_dir):
    """The hub's 2-hop view plus the path, path members flagged for highlighting."""
    ctx, g, sp = _shortest(spark, sf_dir)
    on_path = paths.path_steps(sp).select(F.col("node_id").alias("id"))
    shown = paths.khop_nodes(g, ctx.officer_id, SUBGRAPH_HOPS).select("id") \
        .unionByName(on_path).distinct()
    nodes = node_view(g).join(shown, "id", "left_semi").select("id", "kind", "name")
    return mapping.enrich_view(nodes, None, on_path)
