"""Expanding a set of nodes along the edges that the set needs.

A frontier is a frame of rows with a ``node``, measured by one small job: how
many rows, and in which buckets of the edge layout their nodes lie (at most as
many numbers as there are buckets). With that, a hop reads the edges of those
buckets only (a partition filter on the scan), and the frontier is broadcast if
it has at most ``BROADCAST_ROWS`` rows of a few whole numbers each; a larger one
is joined by a shuffle, which AQE splits where a hub skews it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbweave.model import Graph, bucket_of
from orbweave.session import cut_lineage

#: Rows up to which a frontier is broadcast: a few MB of ids.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Frontier:
    frame: DataFrame  # node, and other columns
    rows: int
    buckets: list | None = None  # of its nodes: numbers or constant expressions; None without a layout

    def hinted(self) -> DataFrame:
        return F.broadcast(self.frame) if self.rows <= BROADCAST_ROWS else self.frame


def known(graph: Graph, ids: list[int]) -> Frontier:
    """The frontier of some given ids (``root`` = ``node``) that are in the graph; asks for no job."""
    frame = graph.nodes.filter(F.col("id").isin(ids)).select(F.col("id").alias("root"), F.col("id").alias("node"))
    buckets = None if graph.layout is None else [bucket_of(F.lit(i).cast("long"), graph.layout.buckets) for i in ids]
    return Frontier(frame, len(ids), buckets)


def measured(graph: Graph, frame: DataFrame, *more: Column) -> tuple[Frontier, dict]:
    """``frame`` as a frontier, and the values of further aggregates over it, by one job."""
    found = [F.collect_set(bucket_of(F.col("node"), graph.layout.buckets)).alias("__buckets")] if graph.layout is not None else []
    row = frame.agg(F.count(F.lit(1)).alias("__rows"), *found, *more).first().asDict()
    return Frontier(frame, row.pop("__rows"), sorted(row.pop("__buckets")) if found else None), row


def of_roots(graph: Graph, roots) -> Frontier:
    """(root, node) for an id, a list of ids or a frame with ``root``."""
    if isinstance(roots, DataFrame):
        frame = roots.select(F.col("root").cast("long").alias("root")).distinct()
        return measured(graph, cut_lineage(frame.withColumn("node", F.col("root"))))[0]
    return known(graph, [int(roots)] if isinstance(roots, int) else [int(r) for r in roots])


def edges_of(graph: Graph, at: Frontier, end: str) -> DataFrame:
    """The edges that may have their ``end`` (src or dst) in the frontier: those of its buckets."""
    if graph.layout is None:
        by_dst = graph.edges_by_dst if graph.edges_by_dst is not None else graph.edges
        return graph.edges if end == "src" else by_dst
    edges = graph.layout.by_src if end == "src" else graph.layout.by_dst
    if at.buckets is not None and len(at.buckets) < graph.layout.buckets:
        edges = edges.filter(F.col("bucket").isin(at.buckets))
    return edges.drop("bucket")


def expand(graph: Graph, at: Frontier, direction: str = "both", edge_type: str | Column | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """The frontier's rows with ``next``, the far end of each edge, and the edge columns ``carry`` (the id as ``edge_id``).

    ``direction``: ``out``, ``in`` or ``both`` (there a self-loop counts twice).
    """
    def side(near: str, far: str) -> DataFrame:
        edges = edges_of(graph, at, near)
        if edge_type is not None:
            edges = edges.filter(F.col("type") == edge_type)
        columns = [F.col("id").alias("edge_id") if c == "id" else F.col(c) for c in carry]
        return at.hinted().join(edges.select(F.col(near).alias("node"), F.col(far).alias("next"), *columns), "node")

    sides = {"out": [("src", "dst")], "in": [("dst", "src")], "both": [("src", "dst"), ("dst", "src")]}[direction]
    out = side(*sides[0])
    return out.unionByName(side(*sides[1])) if len(sides) > 1 else out


def unordered(edges: DataFrame) -> DataFrame:
    """(a, b) for each edge: its ends, the lesser first (a missing end last). Edges of both directions meet
    in one row, so what is grouped by their ends shuffles each edge once."""
    swap = F.col("src").isNull() | (F.col("dst") < F.col("src"))
    return edges.select(F.when(swap, F.col("dst")).otherwise(F.col("src")).alias("a"),
                        F.when(swap, F.col("src")).otherwise(F.col("dst")).alias("b"))


def both_ways(pairs: DataFrame, near: str, far: str) -> DataFrame:
    """Each row of ``unordered`` ends (and other columns) once from either end; a pair of equal ends is one row."""
    way = F.struct(F.col("a").alias("u"), F.col("b").alias("v"))
    back = F.struct(F.col("b").alias("u"), F.col("a").alias("v"))
    ways = F.when(F.col("a").eqNullSafe(F.col("b")), F.array(way)).otherwise(F.array(way, back))
    others = [c for c in pairs.columns if c not in ("a", "b")]
    return pairs.select(F.explode(ways).alias("__way"), *others).select(
        F.col("__way.u").alias(near), F.col("__way.v").alias(far), *others)
