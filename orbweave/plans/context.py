"""Run-time sample context: the parameters the query set is asked with.

Edge types, the hub officer, its name fragment and a path target are derived
from the graph by Spark aggregations, as one frame of one row.
Ties are broken by the smallest value so query and oracle agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbweave.functions.text import name_fragment
from orbweave.model import Graph
from orbweave.operators.pattern import path_witness
from orbweave.operators.stats import dominant_edge_type, hub_officer
from orbweave.session import cut_lineage

# Fixed value: default maximum path depth of the benchmark runs.
DEFAULT_MAX_HOPS = 5


@dataclass(frozen=True)
class Context:
    name_fragment: str | None
    officer_name: str | None
    officer_id: int
    officer_of_type: str
    intermediary_of_type: str
    path_source_id: int
    path_target_id: int | None
    max_hops: int


def sample_context(graph: Graph, max_hops: int = DEFAULT_MAX_HOPS) -> DataFrame:
    """The context as a frame of one row (none, if no officer has an edge to an entity).

    The hub's row with the other parts as scalar subqueries over frames of at most
    one row each; what several of them read is written once.
    """
    officer_of = cut_lineage(dominant_edge_type(graph, "Officer", "Entity").select("type"))
    intermediary_of = cut_lineage(dominant_edge_type(graph, "Intermediary", "Entity").select("type"))
    hub = cut_lineage(hub_officer(graph))
    witness = path_witness(graph, hub.select(F.col("officer_id").alias("root")), officer_of.scalar(), intermediary_of.scalar())
    name = F.coalesce("name", F.lit(""))
    return hub.select(
        name_fragment(name).alias("name_fragment"), name.alias("officer_name"), "officer_id",
        officer_of.scalar().alias("officer_of_type"), intermediary_of.scalar().alias("intermediary_of_type"),
        F.col("officer_id").alias("path_source_id"), witness.scalar().alias("path_target_id"),
        F.lit(max_hops).alias("max_hops"))


def resolve_context(graph: Graph, max_hops: int = DEFAULT_MAX_HOPS) -> Context:
    """The context's one row as parameters of the queries."""
    row = sample_context(graph, max_hops).first()
    if row is None or row["officer_of_type"] is None or row["intermediary_of_type"] is None:
        raise ValueError("no Officer/Intermediary -> Entity edges in the graph")
    return Context(**row.asDict())
