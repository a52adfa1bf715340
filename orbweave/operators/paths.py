"""Breadth-first search, shortest paths and k-hop subgraphs as DataFrame loops.

One level = frontier ⋈ the edges of its buckets -> distinct -> anti-join against
already visited nodes. The loop runs on the driver only as control: each level
is a Spark job whose single returned value is a small summary row (count,
buckets, where it meets). Each level is written by a reliable checkpoint, whose
files Spark removes once no frame refers to them: nothing stays cached.

Undirected BFS uses the fact that a neighbour of a node at depth d-1 has depth
d-2, d-1 or d, so the anti-join only needs the last two levels, not the whole
visited set. A shortest path is found from both ends without carrying paths:
the nodes on shortest paths follow from the levels, and the least path takes the
least of them at each step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbweave.functions.params import clamp
from orbweave.model import Graph
from orbweave.operators.frontier import Frontier, expand, known, measured, of_roots
from orbweave.operators.nodes import attach_nodes
from orbweave.session import cut_lineage

MAX_HOPS_LIMIT = 10


def _level(graph: Graph, at: Frontier, direction: str, seen: list[DataFrame], keys: list[str]) -> DataFrame:
    """The nodes one step from the frontier that are in none of ``seen``, written."""
    step = expand(graph, at, direction).select(*keys[:-1], F.col("next").alias("node")).distinct()
    for level in seen:
        step = step.join(level.select(*keys), keys, "left_anti")
    return cut_lineage(step)


def bfs(graph: Graph, roots, max_depth: int, directed: bool = False) -> DataFrame:
    """Levels of a BFS from each root: (root, node, depth).

    Stops at ``max_depth`` (clamped to 0..``MAX_HOPS_LIMIT``) or at an empty frontier.
    """
    max_depth = clamp(max_depth, 0, MAX_HOPS_LIMIT)
    at = of_roots(graph, roots)
    levels = [at.frame.select("root", "node")]
    for d in range(1, max_depth + 1):
        step = _level(graph, at, "out" if directed else "both", levels if directed else levels[-2:], ["root", "node"])
        levels.append(step)
        if d < max_depth:
            at, _ = measured(graph, step)
            if not at.rows:
                break
    out = levels[0].withColumn("depth", F.lit(0))
    for d, level in enumerate(levels[1:], 1):
        out = out.unionByName(level.withColumn("depth", F.lit(d)))
    return out


# -- distances and subgraphs ----------------------------------------------------

def khop_nodes(graph: Graph, root: int, hops: int = 2) -> DataFrame:
    """Nodes within ``hops`` undirected steps of ``root``: (id, depth)."""
    return bfs(graph, root, hops).select(F.col("node").alias("id"), "depth")


def induced_edges(graph: Graph, node_ids: DataFrame, carry: tuple[str, ...] = ("type",)) -> DataFrame:
    """All edges whose two ends are in ``node_ids`` (parallel edges kept): id, src, dst and ``carry``.

    Reads the edges of the nodes' buckets; both ends are joined with the nodes, which are broadcast if few.
    """
    at, _ = measured(graph, node_ids.select(F.col("id").alias("node")).distinct())
    out = expand(graph, at, "out", carry=("id", *carry))
    return out.join(Frontier(at.frame.withColumnRenamed("node", "next"), at.rows).hinted(), "next", "left_semi") \
        .select(F.col("edge_id").alias("id"), *carry, F.col("node").alias("src"), F.col("next").alias("dst"))


def khop_subgraph(graph: Graph, root: int, hops: int = 2) -> Graph:
    """The k-hop neighbourhood as a graph: reached nodes + induced edges."""
    ids = khop_nodes(graph, root, hops)
    nodes = graph.nodes.join(ids.select("id"), "id", "left_semi")
    return Graph(nodes, induced_edges(graph, ids, ("type", "props")).select(*graph.edges.columns))


# -- shortest paths ----------------------------------------------------------------

@dataclass
class _Meeting:
    """Levels from both ends up to where they meet; ``length`` is None if they don't."""
    levels: dict[str, list[Frontier]]
    length: int | None


def _meet(graph: Graph, source: int, target: int, max_hops: int, directed: bool) -> _Meeting:
    """Two-sided BFS: each step expands the smaller of the two frontiers (the target's side backwards if directed).

    On a graph with hubs the frontiers grow to about b^(d/2) instead of b^d.
    Each level is one job returning its size, its buckets and where it meets
    the other side.
    """
    spark = graph.spark

    def start(i: int) -> Frontier:
        one = known(graph, [i])
        return Frontier(spark.range(1).select(F.lit(i).cast("long").alias("node")), 1, one.buckets)

    levels = {"s": [start(source)], "t": [start(target)]}
    while len(levels["s"]) + len(levels["t"]) - 2 < max_hops:
        side, other = ("s", "t") if levels["s"][-1].rows <= levels["t"][-1].rows else ("t", "s")
        direction = {"s": "out", "t": "in"}[side] if directed else "both"
        seen = [level.frame for level in (levels[side] if directed else levels[side][-2:])]
        step = _level(graph, levels[side][-1], direction, seen, ["node"])
        # Sides that have not met before can only meet at the other side's last level.
        last = levels[other][-1]
        marked = step.join(Frontier(last.frame.select("node", F.lit(1).alias("met")), last.rows).hinted(), "node", "left")
        at, row = measured(graph, marked, F.max("met").alias("met"))
        levels[side].append(Frontier(step, at.rows, at.buckets))
        if row["met"]:
            return _Meeting(levels, len(levels["s"]) + len(levels["t"]) - 2)
        if not at.rows:
            break
    return _Meeting(levels, None)


def _ends(graph: Graph, source: int, target: int) -> set[int]:
    return {r["id"] for r in graph.nodes.filter(F.col("id").isin([source, target])).select("id").distinct().collect()}


def _least_path(graph: Graph, source: int, target: int, meeting: _Meeting, directed: bool) -> list[int]:
    """The least shortest path by node ids, step by step; at most ``MAX_HOPS_LIMIT`` + 1 ids reach the driver.

    A node at the target's side is on a shortest path by its distance alone. At
    the source's side those are found backwards from where the sides meet.
    """
    s, t = meeting.levels["s"], meeting.levels["t"]
    middle = len(s) - 1
    forward, backward = ("out", "in") if directed else ("both", "both")
    on = {middle: cut_lineage(s[-1].frame.select("node").join(t[-1].frame.select("node"), "node", "left_semi"))}
    for step in range(middle - 1, 0, -1):
        at, _ = measured(graph, on[step + 1])
        before = expand(graph, at, backward).select(F.col("next").alias("node")).distinct()
        on[step] = cut_lineage(s[step].frame.select("node").join(before, "node", "left_semi"))
    path = [source]
    for step in range(1, meeting.length):
        allowed = on[step] if step <= middle else t[meeting.length - step].frame.select("node")
        reached = expand(graph, known(graph, path[-1:]), forward).select(F.col("next").alias("node"))
        path.append(reached.join(allowed, "node", "left_semi").agg(F.min("node")).first()[0])
    return [*path, target]


def shortest_path(graph: Graph, source: int, target: int, max_hops: int = 6,
                  directed: bool = False) -> DataFrame:
    """The smallest (by node-id array) shortest path: one row (source, target, length, path) or none."""
    source, target, max_hops = int(source), int(target), clamp(max_hops, 0, MAX_HOPS_LIMIT)
    found, rows = _ends(graph, source, target), []
    if source == target and found:
        rows = [(source, target, 0, [source])]
    elif len(found) == 2:
        meeting = _meet(graph, source, target, max_hops, directed)
        if meeting.length is not None:
            rows = [(source, target, meeting.length, _least_path(graph, source, target, meeting, directed))]
    return graph.spark.createDataFrame(rows, "source long, target long, length int, path array<long>")


def shortest_path_length(graph: Graph, source: int, target: int, max_hops: int = 6,
                         directed: bool = False) -> DataFrame:
    """Length of a shortest path (0..max_hops) as one row (source, target, length), or none."""
    source, target, max_hops = int(source), int(target), clamp(max_hops, 0, MAX_HOPS_LIMIT)
    found, rows = _ends(graph, source, target), []
    if source == target and found:
        rows = [(source, target, 0)]
    elif len(found) == 2:
        length = _meet(graph, source, target, max_hops, directed).length
        rows = [] if length is None else [(source, target, length)]
    return graph.spark.createDataFrame(rows, "source long, target long, length int")


def path_steps(path_df: DataFrame) -> DataFrame:
    """Path array -> (pos, node_id) rows."""
    return path_df.select(F.posexplode("path").alias("pos", "node_id"))


def path_nodes(graph: Graph, path_df: DataFrame) -> DataFrame:
    return attach_nodes(path_steps(path_df), graph, "node_id")


def path_edges(graph: Graph, path_df: DataFrame, directed: bool = False) -> DataFrame:
    """Edges of a path: for each consecutive pair the smallest edge id joining them (of the edges of the path's buckets)."""
    pairs = path_df.select(F.posexplode(F.arrays_zip(
        F.slice("path", 1, F.size("path") - 1).alias("a"),
        F.slice("path", 2, F.size("path") - 1).alias("b"))).alias("pos", "p")) \
        .select("pos", F.col("p.a").alias("node"), F.col("p.b").alias("b"))
    at, _ = measured(graph, pairs)
    carry = ("id", "type")
    hits = expand(graph, at, "out", carry=carry).select("*", F.col("node").alias("src"), F.col("next").alias("dst"))
    if not directed:
        hits = hits.unionByName(expand(graph, at, "in", carry=carry).select("*", F.col("next").alias("src"), F.col("node").alias("dst")))
    best = hits.filter(F.col("next") == F.col("b")).groupBy("pos").agg(F.min(F.struct("edge_id", "type", "src", "dst")).alias("e"))
    return best.select("pos", "e.*")


def depth_sweep(graph: Graph, source: int, target: int | None, min_hops: int = 2,
                max_hops: int = 6) -> DataFrame:
    """One BFS, summarised per maximum depth: found, length, frontier size, nodes reached.

    The per-depth summary has at most ``MAX_HOPS_LIMIT + 1`` rows, so the
    cumulative window over it is a bounded single-partition step.
    """
    from pyspark.sql import Window
    levels = bfs(graph, source, max_hops)
    per_depth = levels.groupBy("depth").agg(
        F.count(F.lit(1)).alias("frontier"),
        F.max((F.col("node") == F.lit(target)).cast("int")).alias("hit"))
    depths = graph.spark.range(0, max_hops + 1).select(F.col("id").cast("int").alias("depth"))
    full = depths.join(per_depth, "depth", "left").select(
        "depth", F.coalesce("frontier", F.lit(0)).cast("long").alias("frontier"),
        F.coalesce("hit", F.lit(0)).alias("hit"))
    w = Window.orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = full.select(
        F.col("depth").alias("max_hops"),
        F.max("hit").over(w).alias("found"),
        F.min(F.when(F.col("hit") == 1, F.col("depth"))).over(w).alias("length"),
        "frontier",
        F.sum("frontier").over(w).cast("long").alias("reached"))
    return cum.filter(F.col("max_hops") >= min_hops)


def recursive_walk(nodes: DataFrame, edges: DataFrame, source: int, max_depth: int, directed: bool = False) -> DataFrame:
    """All simple paths from ``source`` up to ``max_depth`` steps: (node, depth, path), by Spark's recursive SQL.

    Written as the walk reads: a recursive member that expands each path by a
    lateral subquery over its last node's neighbours and prunes visited nodes by
    the path array. It lists every path, not every node, so it is meant for a
    small neighbourhood; Spark bounds levels and rows
    (``spark.sql.cteRecursionLevelLimit``, ``spark.sql.cteRecursionRowLimit``).
    """
    max_depth = clamp(max_depth, 0, MAX_HOPS_LIMIT)
    step = edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))
    if not directed:
        step = step.unionByName(edges.select(F.col("dst").alias("u"), F.col("src").alias("v")))
    # Read from storage by each level of the recursion, so not derived again.
    return nodes.sparkSession.sql("""
        WITH RECURSIVE walk(node, depth, path) AS (
          SELECT id, 0, array(id) FROM {nodes} WHERE id = :source
          UNION ALL
          SELECT n.v, w.depth + 1, array_append(w.path, n.v)
          FROM walk w, LATERAL (SELECT s.v FROM {steps} s WHERE s.u = w.node) n
          WHERE w.depth < :most AND NOT array_contains(w.path, n.v))
        SELECT node, depth, path FROM walk""",
        args={"source": source, "most": max_depth}, nodes=nodes.select("id"), steps=cut_lineage(step.distinct()))


def first_hit(graph: Graph, source: int, target: int, max_depth: int,
              directed: bool = False) -> DataFrame:
    """The walk's answer: smallest depth reaching ``target`` and its smallest path.

    The minimal-depth simple paths are exactly the shortest paths, so no path
    enumeration is needed.
    """
    sp = shortest_path(graph, source, target, max_depth, directed)
    return sp.select("target", "length", F.array_join(F.col("path").cast("array<string>"), ",")
                     .alias("path"))
