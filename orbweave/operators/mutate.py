"""Batches of node/edge changes applied to the graph frames.

Each operator takes the current frames and a change batch and returns new
frames plus what happened to every request; nothing is updated in place.
All work is set-based (semi/anti/outer joins keyed by id or (src, dst, type)),
so a batch of any size is one distributed job, and hot keys are handled by
AQE's skew-join splitting. New ids are ``max(id) + 1 + request_id``: unique,
repeatable, and free of any global row numbering; null, negative and repeated
request ids are rejected.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbweave.functions.text import prop
from orbweave.model import Graph
from orbweave.sources.quality import validate_edge_merges, validate_node_creates, validate_patches

DEFAULT_SOURCE_ID = "batch-import"


@dataclass(frozen=True)
class Applied:
    graph: Graph
    results: DataFrame   # per request: what happened
    rejected: DataFrame  # requests refused, with a reason


def _edges(graph: Graph, change) -> tuple[DataFrame, DataFrame | None]:
    """``change`` applied to the edges and, if there is one, to their copy by target."""
    return change(graph.edges), None if graph.edges_by_dst is None else change(graph.edges_by_dst)


def _next_id_base(df: DataFrame) -> F.Column:
    """max(id) + 1 as a scalar subquery (evaluated once, no driver round trip)."""
    return df.select(F.coalesce(F.max("id"), F.lit(0)) + F.lit(1)).scalar()


def _stamp(at: str | datetime) -> F.Column:
    """A change's time as a timestamp (NULL for text that is none)."""
    return F.try_to_timestamp(F.lit(at)) if isinstance(at, str) else F.lit(at).cast("timestamp")


def _stamp_text(at: str | datetime) -> F.Column:
    """What the property holds: text as given, a time in ISO form; ``stamp`` reads it."""
    return F.lit(at) if isinstance(at, str) else F.date_format(F.lit(at).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssXXX")


def stamp(key: str) -> F.Column:
    """A node's or edge's stamp (``created_at``, ``updated_at``) as a timestamp; NULL if it has none."""
    return F.try_to_timestamp(prop(key))


def create_nodes(graph: Graph, batch: DataFrame, created_at: str | datetime,
                 source_id: str = DEFAULT_SOURCE_ID) -> Applied:
    """batch: request_id, kind, name, country, jurisdiction, note."""
    valid, rejected = validate_node_creates(batch)
    base = _next_id_base(graph.nodes)
    props = F.map_filter(F.create_map(
        F.lit("name"), F.col("name"), F.lit("countries"), F.col("country"),
        F.lit("jurisdiction_description"), F.col("jurisdiction"), F.lit("note"), F.col("note"),
        F.lit("sourceID"), F.lit(source_id), F.lit("created_at"), _stamp_text(created_at)),
        lambda k, v: v.isNotNull())
    created = valid.select((base + F.col("request_id")).alias("id"),
                           F.array(F.col("kind")).alias("labels"), props.alias("props"),
                           "request_id")
    new_nodes = graph.nodes.unionByName(created.drop("request_id"))
    results = created.select("request_id", "id", F.lit("created").alias("status"), _stamp(created_at).alias("created_at"))
    return Applied(Graph(new_nodes, graph.edges, graph.edges_by_dst, graph.layout), results, rejected)


def patch_nodes(graph: Graph, patches: DataFrame, updated_at: str | datetime) -> Applied:
    """patches (long form): id, key, value (text or VARIANT), seq. NULL value removes the key; per
    (id, key) the highest ``seq`` wins; ``updated_at`` is set on patched nodes.
    Rows that ``validate_patches`` refuses and patches for unknown ids are rejected (id, key, reason)."""
    valid, refused = validate_patches(patches)
    last = valid.groupBy("id", "key").agg(
        F.max_by("value", F.struct("seq", "value")).alias("value"))
    per_node = last.groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("patch"))
    known = per_node.join(graph.nodes.select("id"), "id", "left_semi")
    missing = per_node.join(graph.nodes.select("id"), "id", "left_anti").select(
        "id", F.lit(None).cast("string").alias("key"), F.lit("node not found").alias("reason"))
    rejected = refused.select("id", "key", "reason").unionByName(missing)
    stamp = F.create_map(F.lit("updated_at"), _stamp_text(updated_at))
    touched = F.array_union(F.map_keys("patch"), F.array(F.lit("updated_at")))
    merged = F.map_concat(
        F.map_filter("props", lambda k, v: ~F.array_contains(touched, k)),
        F.map_filter("patch", lambda k, v: v.isNotNull() & (k != "updated_at")),  # the stamp wins
        stamp)
    nodes = graph.nodes.join(known, "id", "left").select(
        "id", "labels", F.when(F.col("patch").isNull(), F.col("props")).otherwise(merged)
        .alias("props"))
    results = known.select("id", F.lit("patched").alias("status"), _stamp(updated_at).alias("updated_at"))
    return Applied(Graph(nodes, graph.edges, graph.edges_by_dst, graph.layout), results, rejected)


def detach_delete_nodes(graph: Graph, ids: DataFrame) -> Applied:
    """Remove nodes and every incident edge. Unknown ids are a no-op."""
    gone = ids.select("id").distinct()
    nodes = graph.nodes.join(gone, "id", "left_anti")
    edges = _edges(graph, lambda e: e.join(gone.withColumnRenamed("id", "src"), "src", "left_anti")
                   .join(gone.withColumnRenamed("id", "dst"), "dst", "left_anti").select(*e.columns))
    results = gone.join(graph.nodes.select("id"), "id", "left_semi") \
        .select("id", F.lit("deleted").alias("status"))
    empty = gone.select("id", F.lit(None).cast("string").alias("reason")).filter(F.lit(False))
    return Applied(Graph(nodes, *edges), results, empty)


def merge_edges(graph: Graph, batch: DataFrame, created_at: str | datetime,
                source_id: str = DEFAULT_SOURCE_ID) -> Applied:
    """batch: request_id, src, dst, type. Idempotent on (src, dst, type) — types are
    compared in lower case, the canonical form; stamps only on creation."""
    valid, rejected = validate_edge_merges(batch)
    valid = valid.withColumn("type", F.lower("type"))
    node_ids = graph.nodes.select("id")
    ok = valid.join(node_ids.withColumnRenamed("id", "src"), "src", "left_semi") \
        .join(node_ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    missing = valid.join(ok.select("request_id"), "request_id", "left_anti") \
        .withColumn("reason", F.lit("endpoint not found"))
    rejected = rejected.unionByName(missing)
    # first request per key wins; later duplicates resolve to the same edge
    key = ["src", "dst", "type"]
    first = ok.groupBy(*key).agg(F.min("request_id").alias("first_request"))
    # only edges between the batch's own ends are looked at
    existing = graph.edges.select(F.col("id").alias("edge_id"), "src", "dst",
                                  F.lower("type").alias("type")) \
        .join(first.select("src", "dst").distinct(), ["src", "dst"], "left_semi")
    existing = existing.groupBy(*key).agg(F.min("edge_id").alias("edge_id"))
    resolved = first.join(existing, key, "left")
    base = _next_id_base(graph.edges)
    resolved = resolved.select(
        *key, "first_request",
        F.coalesce("edge_id", base + F.col("first_request")).alias("edge_id"),
        F.col("edge_id").isNull().alias("is_new"))
    props = F.create_map(F.lit("created_at"), _stamp_text(created_at), F.lit("sourceID"), F.lit(source_id))
    created = resolved.filter("is_new").select(
        F.col("edge_id").alias("id"), "type", "src", "dst", props.alias("props"))
    edges = _edges(graph, lambda e: e.unionByName(created))
    results = ok.join(resolved, key).select(
        "request_id", "edge_id",
        F.when(F.col("is_new") & (F.col("request_id") == F.col("first_request")), "created")
        .otherwise("matched").alias("status"))
    return Applied(Graph(graph.nodes, *edges), results, rejected)


def delete_edges(graph: Graph, ids: DataFrame) -> Applied:
    gone = ids.select("id").distinct()
    edges = _edges(graph, lambda e: e.join(gone, "id", "left_anti"))
    results = gone.join(graph.edges.select("id"), "id", "left_semi") \
        .select("id", F.lit("deleted").alias("status"))
    empty = gone.select("id", F.lit(None).cast("string").alias("reason")).filter(F.lit(False))
    return Applied(Graph(graph.nodes, *edges), results, empty)
