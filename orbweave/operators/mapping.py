"""Projections and display mappings (pure column expressions and small lookups)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbweave.functions.text import display_name, edge_caption, kind_from_labels, prop
from orbweave.model import Graph

# Detail-view keys with their captions, in display order.
DETAIL_KEYS = [
    ("name", "Nome"),
    ("address", "Endereço"),
    ("country", "País"),
    ("countries", "Países"),
    ("jurisdiction", "Jurisdição"),
    ("jurisdiction_description", "Jurisdição (desc.)"),
    ("company_type", "Tipo de empresa"),
    ("incorporation_date", "Data de constituição"),
    ("inactivation_date", "Data de inativação"),
    ("struck_off_date", "Data de baixa"),
    ("status", "Status"),
    ("service_provider", "Provedor"),
    ("sourceID", "Fonte (vazamento)"),
    ("note", "Nota"),
]

# Kind -> (caption, colour).
KIND_STYLE = [
    ("Officer", "Pessoa", "#f59e0b"),
    ("Entity", "Empresa offshore", "#f43f5e"),
    ("Intermediary", "Intermediário", "#0ea5e9"),
    ("Address", "Endereço", "#a855f7"),
    ("Other", "Outro", "#71717a"),
]

# Community colour palette, indexed by community modulo its size.
COMMUNITY_PALETTE = [
    "#f59e0b", "#0ea5e9", "#a855f7", "#10b981",
    "#ec4899", "#eab308", "#06b6d4", "#8b5cf6",
    "#f97316", "#22c55e", "#3b82f6", "#ef4444",
]


def node_kind(graph: Graph) -> DataFrame:
    return graph.nodes.select("id", kind_from_labels("labels").alias("kind"))


def map_nodes(graph: Graph) -> DataFrame:
    """Typed node view: id, kind, name, country, jurisdiction, status, sourceID."""
    kind = kind_from_labels("labels")
    return graph.nodes.select(
        "id", kind.alias("kind"), display_name(kind, F.col("id")).alias("name"),
        F.coalesce(prop("countries"), prop("country")).alias("country"),
        prop("jurisdiction_description").alias("jurisdiction"), prop("status").alias("status"),
        prop("sourceID").alias("sourceID"))


def map_edges(graph: Graph) -> DataFrame:
    """Typed edge view: 'r'||id, type, source, target, link, start_date, end_date."""
    return graph.edges.select(
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("id"), "type",
        F.col("src").alias("source"), F.col("dst").alias("target"),
        prop("link").alias("link"), prop("start_date").alias("start_date"),
        prop("end_date").alias("end_date"))


def node_detail(graph: Graph, ids: DataFrame | None = None) -> DataFrame:
    """Long form of the detail keys: (id, pos, key, caption, value); null/empty values dropped."""
    nodes = graph.nodes if ids is None else graph.nodes.join(ids.select("id"), "id", "left_semi")
    entries = F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(k).alias("key"), F.lit(c).alias("caption"),
                 prop(k).alias("value"))
        for i, (k, c) in enumerate(DETAIL_KEYS)])
    return nodes.select("id", F.inline(entries)).filter(
        F.col("value").isNotNull() & (F.col("value") != ""))


def kind_styles(spark) -> DataFrame:
    """The five-row kind dimension (caption, colour)."""
    return spark.createDataFrame(KIND_STYLE, "kind string, caption string, color string")


def kind_caption(graph: Graph) -> DataFrame:
    """Per node: caption and colour of its kind (broadcast join on the 5-row dimension)."""
    return node_kind(graph).join(F.broadcast(kind_styles(graph.spark)), "kind", "left")


def edge_captions(graph: Graph) -> DataFrame:
    return graph.edges.select("id", "type", edge_caption("type").alias("caption"))


def dedupe_edges(*edge_frames: DataFrame) -> DataFrame:
    """Union of displayed edge lists, one row per id (rows with one id are equal)."""
    out = edge_frames[0]
    for e in edge_frames[1:]:
        out = out.unionByName(e)
    return out.dropDuplicates(["id"])


def enrich_view(nodes: DataFrame, communities: DataFrame | None = None,
                highlight: DataFrame | None = None) -> DataFrame:
    """Display fields: colour from community (palette modulo 12) else kind; highlight flag.

    ``nodes`` has (id, kind, name); ``communities`` (id, community);
    ``highlight`` (id). Both are joined as flags/lookups, never collected.
    """
    spark = nodes.sparkSession
    palette = spark.createDataFrame(list(enumerate(COMMUNITY_PALETTE)), "bucket int, pcolor string")
    out = nodes
    if communities is not None:
        out = out.join(communities.select("id", "community"), "id", "left")
    else:
        out = out.withColumn("community", F.lit(None).cast("long"))
    out = out.withColumn("bucket", F.pmod(F.col("community"), F.lit(len(COMMUNITY_PALETTE))).cast("int"))
    out = out.join(F.broadcast(palette), "bucket", "left") \
        .join(F.broadcast(kind_styles(spark).select("kind", "color")), "kind", "left")
    if highlight is not None:
        flags = highlight.select("id").distinct().withColumn("hl", F.lit(1))
        out = out.join(flags, "id", "left")
    else:
        out = out.withColumn("hl", F.lit(None).cast("int"))
    return out.select("id", "kind", "name", "community",
                      F.coalesce("pcolor", "color").alias("color"),
                      F.coalesce("hl", F.lit(0)).alias("highlighted"))
