"""Graph statistics, hub discovery and timing summaries (all single-pass aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbweave.functions.text import first_label, name_fragment
from orbweave.model import Graph
from orbweave.operators.nodes import attach_nodes, node_view, with_label


def stats_nodes(graph: Graph) -> DataFrame:
    """Node count per *first stored* label."""
    return graph.nodes.groupBy(first_label("labels").alias("label")).agg(
        F.count(F.lit(1)).alias("total"))


def stats_edges(graph: Graph) -> DataFrame:
    return graph.edges.groupBy("type").agg(F.count(F.lit(1)).alias("total"))


def stats_totals(graph: Graph) -> DataFrame:
    """Groups and grand total in one pass: ``rollup`` adds the NULL-group total row."""
    n = graph.nodes.select(F.lit("nodes").alias("family"), first_label("labels").alias("grp"))
    e = graph.edges.select(F.lit("edges").alias("family"), F.col("type").alias("grp"))
    return n.unionByName(e).rollup("family", "grp").agg(F.count(F.lit(1)).alias("total")) \
        .filter(F.col("family").isNotNull())


def stats_top4(graph: Graph) -> DataFrame:
    """The first four node groups by size (ties by label)."""
    return stats_nodes(graph).orderBy(F.desc("total"), F.asc_nulls_last("label")).limit(4)


def _typed_edges(graph: Graph, src_label: str, dst_label: str) -> DataFrame:
    e = graph.edges.select("src", "dst", "type")
    e = e.join(with_label(graph, src_label).withColumnRenamed("id", "src"), "src", "left_semi")
    return e.join(with_label(graph, dst_label).withColumnRenamed("id", "dst"), "dst", "left_semi")


def dominant_edge_type(graph: Graph, src_label: str, dst_label: str) -> DataFrame:
    """The most frequent edge type between two labels (ties by type): one row."""
    counts = _typed_edges(graph, src_label, dst_label).groupBy("type").agg(
        F.count(F.lit(1)).alias("edges"))
    return counts.orderBy(F.desc("edges"), "type").limit(1)


def officer_degree(graph: Graph) -> DataFrame:
    """Edges from each Officer to Entities (edges, not distinct entities)."""
    return _typed_edges(graph, "Officer", "Entity").groupBy(F.col("src").alias("officer_id")) \
        .agg(F.count(F.lit(1)).alias("degree"))


def hub_officer(graph: Graph) -> DataFrame:
    """The officer with most edges to entities; ties go to the smallest id. One row."""
    top = officer_degree(graph).orderBy(F.desc("degree"), "officer_id").limit(1)
    return attach_nodes(top, graph, "officer_id", ("name",))


def name_fragments(graph: Graph, label: str = "Officer") -> DataFrame:
    """Search fragment derived from each node name (first token of 4+ chars, else 6 chars)."""
    nv = node_view(graph).filter(F.array_contains("labels", label))
    return nv.select("id", "name", name_fragment(F.col("name")).alias("fragment"))


def unwind_edges(graph: Graph, root: int, limit: int = 80) -> DataFrame:
    """List -> rows: the collected edge ids of a neighbourhood back to one row each."""
    from orbweave.operators.pattern import collect_neighbors
    c = collect_neighbors(graph, root, limit)
    return c.select("id", F.posexplode("edge_ids").alias("pos", "edge_id"))


# -- timing summaries (E13, E14) ------------------------------------------------

def bench_median(runs: DataFrame) -> DataFrame:
    """Exact median of repeated timings per (query, engine); NULL ms = did not finish."""
    return runs.filter(F.col("ms").isNotNull()).groupBy("query", "engine").agg(
        F.median("ms").alias("median_ms"), F.count(F.lit(1)).alias("runs"))


def bench_winner(medians: DataFrame, left: str, right: str) -> DataFrame:
    """Per query: the engine with the smaller median and the speed ratio (1 decimal).

    A missing side loses; both missing -> no winner.
    """
    m = medians.groupBy("query").agg(
        F.max(F.when(F.col("engine") == left, F.col("median_ms"))).alias("left_ms"),
        F.max(F.when(F.col("engine") == right, F.col("median_ms"))).alias("right_ms"))
    l_ms, r_ms = F.col("left_ms"), F.col("right_ms")
    left_wins = r_ms.isNull() | (l_ms.isNotNull() & (l_ms <= r_ms))
    winner = F.when(l_ms.isNull() & r_ms.isNull(), F.lit(None).cast("string")) \
        .when(left_wins, F.lit(left)).otherwise(F.lit(right))
    ratio = F.when(l_ms.isNull() | r_ms.isNull(), F.lit(None).cast("double")) \
        .when(left_wins, F.round(r_ms / l_ms, 1)).otherwise(F.round(l_ms / r_ms, 1))
    return m.select("query", "left_ms", "right_ms", winner.alias("winner"), ratio.alias("ratio"))
