"""Node/edge views shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbweave.functions.text import display_name, kind_from_labels
from orbweave.model import Graph


def node_view(graph: Graph) -> DataFrame:
    """id, kind (priority rule), name (name -> address -> "<kind> #<id>"), labels."""
    kind = kind_from_labels("labels")
    return graph.nodes.select(
        "id", kind.alias("kind"), display_name(kind, F.col("id")).alias("name"), "labels")


def with_label(graph: Graph, label: str) -> DataFrame:
    """Ids of nodes carrying ``label`` (any position in the label list)."""
    return graph.nodes.filter(F.array_contains("labels", label)).select("id")


def edge_frame(graph: Graph, edge_type: str | None = None) -> DataFrame:
    e = graph.edges.select("id", "type", "src", "dst")
    return e if edge_type is None else e.filter(F.col("type") == edge_type)


def attach_nodes(df: DataFrame, graph: Graph, on: str, cols=("kind", "name"),
                 how: str = "left") -> DataFrame:
    """Join node display fields onto ``df`` by the id column ``on``."""
    nv = node_view(graph).select(F.col("id").alias(on), *cols)
    return df.join(nv, on, how)


def keep_labelled(df: DataFrame, graph: Graph, on: str, label: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` node carries ``label``."""
    return df.join(with_label(graph, label).withColumnRenamed("id", on), on, "left_semi")
