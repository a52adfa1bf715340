"""Pattern matching, expands and neighbourhoods as joins over the edge frame.

Every hop keeps a *distinct set* of (root, node) keys, so intermediate sizes are
bounded by the edge count and not by the number of paths; chains with unique
edges carry, beside it, a bounded number of edge ids that can still matter. Hops
read the edges of the frontier's buckets only (``operators.frontier``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbweave.functions.params import parameter
from orbweave.functions.text import IDENTIFIER
from orbweave.model import Graph
from orbweave.operators.frontier import both_ways, edges_of, expand, known, measured, of_roots, unordered
from orbweave.operators.nodes import (attach_nodes, edge_frame, keep_labelled, node_view,
                                      with_label)
from orbweave.session import cut_lineage


def check_edge_type(edge_type: str | Column) -> str | Column:
    """Edge-type identifier check used before a type is put into a pattern (a column, as a scalar subquery, is data)."""
    if isinstance(edge_type, Column):
        return edge_type
    if not isinstance(edge_type, str) or not re.fullmatch(IDENTIFIER, edge_type):
        raise ValueError(f"{edge_type!r} can't be an edge type")
    return edge_type


# -- D1 / D2 -----------------------------------------------------------------

def entities_controlled(graph: Graph, officer_id: int, limit: int | None = None) -> DataFrame:
    """Entities at the end of any outgoing edge of one officer; one row per edge."""
    out = edges_of(graph, known(graph, [officer_id]), "src").filter(F.col("src") == officer_id).select(
        F.col("id").alias("edge_id"), F.col("dst").alias("entity_id"))
    out = keep_labelled(out, graph, "entity_id", "Entity")
    out = attach_nodes(out, graph, "entity_id", ("name",))
    return out.orderBy("edge_id").limit(limit) if limit else out


def entities_by_owner_name(officers: DataFrame, relationships: DataFrame, entities: DataFrame,
                           owner_name: str, rel_type: str = "officer_of",
                           case_sensitive: bool = True) -> DataFrame:
    """Relational form: officers ⋈ relationships(type) ⋈ entities, officer chosen by name."""
    name_match = (F.col("name") == owner_name) if case_sensitive else \
        (F.lower("name") == owner_name.lower())
    o = officers.filter(name_match).select(F.col("node_id").alias("start_id"))
    r = relationships.filter(F.col("rel_type") == rel_type).select("start_id", "end_id")
    e = entities.select(F.col("node_id").alias("end_id"), F.col("name").alias("entity_name"))
    return o.join(r, "start_id").join(e, "end_id").select(
        F.col("start_id").alias("officer_id"), F.col("end_id").alias("entity_id"), "entity_name")


# -- D3 / D4 -----------------------------------------------------------------

def co_officer_ids(graph: Graph, roots, officer_of_type: str | Column, intermediary_of_type: str | Column,
                   edge_unique: bool = True) -> DataFrame:
    """(root, other) pairs: root -of-> e1 <-im- i -im-> e2 <-of- other, other an Officer != root.

    ``edge_unique=True`` is the graph-pattern form (the two intermediary edges
    must differ); ``False`` is the 4-join SQL form. The pattern form is exact
    without carrying edge ids: an edge i->e2 may close the pattern unless e2 is
    one of root's entities *and* i has a single edge into them (that edge
    would have to be used twice).
    """
    check_edge_type(officer_of_type)
    check_edge_type(intermediary_of_type)
    at = of_roots(graph, roots)
    e1 = cut_lineage(expand(graph, at, "out", officer_of_type).select("root", F.col("next").alias("node")).distinct())
    at, _ = measured(graph, e1)
    # i with the number of its edges into root's entities (parallel edges count)
    i_set = cut_lineage(expand(graph, at, "in", intermediary_of_type).groupBy("root", F.col("next").alias("node"))
                        .agg(F.count(F.lit(1)).alias("c_i")))
    at, _ = measured(graph, i_set)
    r3 = expand(graph, at, "out", intermediary_of_type).select("root", "c_i", F.col("next").alias("node"))
    if edge_unique:
        in_e1 = e1.select("root", "node", F.lit(True).alias("in_e1"))
        r3 = r3.join(in_e1, ["root", "node"], "left").filter(
            F.col("in_e1").isNull() | (F.col("c_i") >= 2))
    e2 = cut_lineage(r3.select("root", "node").distinct())
    at, _ = measured(graph, e2)
    others = expand(graph, at, "in", officer_of_type).select("root", F.col("next").alias("other")) \
        .distinct().filter(F.col("other") != F.col("root"))
    return keep_labelled(others, graph, "other", "Officer")


def co_officers(graph: Graph, officer_id: int, officer_of_type: str, intermediary_of_type: str,
                edge_unique: bool = True, limit: int | None = None) -> DataFrame:
    """Pattern form: distinct co-officers (id, name) of one officer."""
    ids = co_officer_ids(graph, officer_id, officer_of_type, intermediary_of_type, edge_unique)
    out = attach_nodes(ids.select(F.col("other").alias("officer_id")), graph, "officer_id",
                       ("name",))
    return out.orderBy("officer_id").limit(limit) if limit else out


def co_officers_sql(officers: DataFrame, relationships: DataFrame, officer_id: int,
                    officer_of_type: str = "officer_of",
                    intermediary_of_type: str = "intermediary_of",
                    limit: int | None = None) -> DataFrame:
    """SQL form over the mirror: DISTINCT names of other officers (no edge uniqueness)."""
    r = relationships.select("rel_type", "start_id", "end_id")
    of = r.filter(F.col("rel_type") == officer_of_type)
    im = r.filter(F.col("rel_type") == intermediary_of_type)
    e1 = of.filter(F.col("start_id") == officer_id).select(F.col("end_id").alias("e")).distinct()
    i = im.join(e1, im.end_id == e1.e, "left_semi").select(F.col("start_id").alias("i")).distinct()
    e2 = im.join(i, im.start_id == i.i, "left_semi").select(F.col("end_id").alias("e")).distinct()
    other = of.join(e2, of.end_id == e2.e, "left_semi").select(
        F.col("start_id").alias("node_id")).distinct()
    names = officers.filter(F.col("node_id") != officer_id).join(other, "node_id", "left_semi") \
        .select("name").distinct()
    return names.orderBy("name").limit(limit) if limit else names


def path_witness(graph: Graph, officer: int | DataFrame, officer_of_type: str | Column,
                 intermediary_of_type: str | Column) -> DataFrame:
    """One officer reachable by the co-officer pattern from one (an id or a frame ``root``): the smallest id (0 or 1 row)."""
    ids = co_officer_ids(graph, officer, officer_of_type, intermediary_of_type, True)
    return ids.agg(F.min("other").alias("witness_id")).filter(F.col("witness_id").isNotNull())


# -- D5: generic chain --------------------------------------------------------

def _may_meet(a: str | None, b: str | None) -> bool:
    """Whether steps of these edge types may take the same edge."""
    return a is None or b is None or a == b


def _representatives(frame: DataFrame, column: str, times: int) -> DataFrame:
    """For equal other columns, the ``times`` + 1 least values of ``column``.

    Enough if at most ``times`` later edges must differ from it: of so many
    values one is left. Each half of a hub's edges is cut before the whole is.
    """
    others = [c for c in frame.columns if c != column]
    if times == 1:
        both = frame.groupBy(*others).agg(F.min(column).alias("__least"), F.max(column).alias("__most"))
        return both.select(*others, F.explode(F.array_distinct(F.array("__least", "__most"))).alias(column))
    return first_of(frame.distinct(), others, [column], times + 1, F.col(column))


def match_chain(graph: Graph, roots, steps, distinct_between: bool = True, edge_unique: bool = False) -> DataFrame:
    """Follow a fixed chain of steps from each root; returns (root, node) at the end.

    ``steps`` is a list of ``(edge_type or None, direction, label or None)`` with
    direction ``"out"``, ``"in"`` or ``"both"``. Each step is one join with the
    edges of the frontier's buckets; the frontier is de-duplicated between steps,
    so hub fan-out is paid once per (root, node) and not once per path.

    ``edge_unique``: no edge may be taken twice by one path, as in a graph
    pattern. A taken edge's id is carried only while a later step may meet it (one
    of its type, or of any), and for equal other columns only one id more is
    carried than there are such steps. The result is then distinct.
    """
    for edge_type, direction, _ in steps:
        if edge_type is not None:
            check_edge_type(edge_type)
        if direction not in ("out", "in", "both"):
            raise ValueError(f"unknown direction {direction!r}")
    at = of_roots(graph, roots)
    frontier = at.frame
    carried: dict[int, str] = {}  # step -> column of the edge it took
    for i, (edge_type, direction, label) in enumerate(steps):
        if i:
            at, _ = measured(graph, cut_lineage(frontier))
        frontier = expand(graph, at, direction, edge_type, carry=("id",) if edge_unique else ())
        for step, column in carried.items():
            if _may_meet(steps[step][0], edge_type):
                frontier = frontier.filter(F.col("edge_id") != F.col(column))
        later = {step: sum(_may_meet(steps[step][0], t) for t, _, _ in steps[i + 1:]) for step in [*carried, i]} if edge_unique else {}
        carried = {step: f"__edge{step}" for step, n in later.items() if n}
        taken = [F.col("edge_id" if step == i else column).alias(column) for step, column in carried.items()]
        frontier = frontier.select("root", F.col("next").alias("node"), *taken)
        if label is not None:
            frontier = frontier.join(with_label(graph, label).withColumnRenamed("id", "node"),
                                     "node", "left_semi").select(*frontier.columns)
        if edge_unique or distinct_between:
            frontier = frontier.distinct()
        for step, column in carried.items():
            frontier = _representatives(frontier, column, later[step])
    return frontier.select("root", "node")


def first_of(rows: DataFrame, keys: list[str], order: list, k: int, spread, salts: int = 32) -> DataFrame:
    """The first ``k`` rows of each key by ``order``, in two stages: ``k`` of each key's ``salts`` parts by hash of
    ``spread``, then ``k`` of what is left. No task ranks all rows of a hot key."""
    part = F.pmod(F.xxhash64(spread), F.lit(salts))
    out = rows.withColumn("__part", part)
    for by in ([*keys, "__part"], keys):
        nth = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        out = out.withColumn("__nth", nth).filter(F.col("__nth") <= k).drop("__nth")
    return out.drop("__part")


# -- D6 .. D9, D13 -------------------------------------------------------------

def undirected_adjacency(graph: Graph, with_edge_ids: bool = False) -> DataFrame:
    """(u, v) for every edge in both directions; distinct unless edge ids are kept."""
    e = edge_frame(graph)
    if with_edge_ids:
        cols_f = [F.col("src").alias("u"), F.col("dst").alias("v"), F.col("id").alias("edge_id")]
        cols_b = [F.col("dst").alias("u"), F.col("src").alias("v"), F.col("id").alias("edge_id")]
        return e.select(*cols_f).unionByName(e.select(*cols_b))
    return both_ways(unordered(e).distinct(), "u", "v")


def neighborhood_edges(graph: Graph, root: int, limit: int | None = None) -> DataFrame:
    """Incident edges of ``root`` (either direction), the first ``limit`` by id (the parameter ``neighborhood_limit``)."""
    e = graph.incident(root).select("id", "type", "src", "dst")
    return e.orderBy("id").limit(parameter("neighborhood_limit", limit))


def neighborhood_batch(graph: Graph, roots: DataFrame, limit: int | None = None) -> DataFrame:
    """``neighborhood_edges`` of every ``root`` of a frame: (root, id, type, src, dst, neighbor).

    Each root keeps its first ``limit`` edges by id, in two stages, so that a hub's
    edges are cut in parts by hash before any task ranks them together.
    """
    at, carry = of_roots(graph, roots), ("id", "type")
    out = expand(graph, at, "out", carry=carry) \
        .select("root", "edge_id", "type", F.col("node").alias("src"), F.col("next").alias("dst"), F.col("next").alias("neighbor"))
    back = expand(graph, at, "in", carry=carry).filter(F.col("next") != F.col("node")) \
        .select("root", "edge_id", "type", F.col("next").alias("src"), F.col("node").alias("dst"), F.col("next").alias("neighbor"))
    first = first_of(out.unionByName(back), ["root"], ["edge_id"], parameter("neighborhood_limit", limit), F.col("edge_id"))
    return first.withColumnRenamed("edge_id", "id")


def neighborhood_nodes(graph: Graph, root: int, limit: int | None = None,
                       keep_isolated: bool = False) -> DataFrame:
    """Root plus the far ends of the (limited) incident edges, de-duplicated by id.

    As in the reference, a root without edges yields no rows unless
    ``keep_isolated``.
    """
    e = neighborhood_edges(graph, root, limit)
    ids = e.select(F.when(F.col("src") == root, F.col("dst")).otherwise(F.col("src")).alias("id"))
    has_edge = e.select(F.lit(root).cast("long").alias("id")).distinct()
    ids = ids.unionByName(has_edge).distinct()
    if keep_isolated:
        ids = ids.unionByName(graph.nodes.filter(F.col("id") == root).select("id")).distinct()
    return attach_nodes(ids, graph, "id", how="inner")


def closed_neighborhood(nodes: DataFrame, edges: DataFrame, focus: int) -> DataFrame:
    """Within a displayed graph: the focus node, adjacent nodes, and the edges joining them to it."""
    e = edges.filter((F.col("src") == focus) | (F.col("dst") == focus))
    ids = e.select(F.col("src").alias("id")).unionByName(e.select(F.col("dst").alias("id"))) \
        .unionByName(nodes.filter(F.col("id") == focus).select("id")).distinct()
    return ids


def collect_neighbors(graph: Graph, root: int, limit: int | None = None) -> DataFrame:
    """One row: the root with sorted distinct neighbour ids and edge ids of its limited star.

    The lists are bounded by ``limit`` (the neighbourhood's edge cap), so no
    hub can push an unbounded group into one task.
    """
    e = neighborhood_edges(graph, root, limit)
    far = F.when(F.col("src") == root, F.col("dst")).otherwise(F.col("src"))
    return e.groupBy(F.lit(root).cast("long").alias("id")).agg(
        F.array_sort(F.collect_set(far)).alias("neighbors"),
        F.array_sort(F.collect_set("id")).alias("edge_ids"))
