"""Data model: a property graph held as two DataFrames.

nodes: id LONG, labels ARRAY<STRING>, props MAP<STRING,STRING>
edges: id LONG, type STRING, src LONG, dst LONG, props MAP<STRING,STRING>

Everything is a plain DataFrame so Catalyst sees through every operator; there
is no graph catalog, no index structure and no nested payload.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("labels", T.ArrayType(T.StringType(), False), False),
    T.StructField("props", T.MapType(T.StringType(), T.StringType(), True), False),
])

EDGE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("src", T.LongType(), False),
    T.StructField("dst", T.LongType(), False),
    T.StructField("props", T.MapType(T.StringType(), T.StringType(), True), False),
])

# Property keys, in the order the detail view lists them.
NODE_PROP_KEYS = [
    "name", "address", "country", "country_codes", "countries", "original_name", "former_name",
    "jurisdiction", "jurisdiction_description", "company_type", "incorporation_date",
    "inactivation_date", "struck_off_date", "status", "service_provider", "sourceID",
    "valid_until", "note", "created_at", "updated_at",
]
EDGE_PROP_KEYS = ["link", "status", "start_date", "end_date", "sourceID", "created_at"]


def bucket_of(node: Column, buckets: int) -> Column:
    """The bucket of a node id in a layout of so many buckets."""
    return F.pmod(F.xxhash64(node), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Layout:
    """The edges stored twice, in folders by the bucket of ``src`` and of ``dst`` (column ``bucket``).

    A scan that names its buckets reads those folders only.
    """
    by_src: DataFrame
    by_dst: DataFrame
    buckets: int


@dataclass(frozen=True)
class Graph:
    nodes: DataFrame
    edges: DataFrame
    # Optional second copy of ``edges`` laid out by ``dst`` (same rows). When
    # present, lookups by target prune row groups instead of scanning.
    edges_by_dst: DataFrame | None = None
    # Optional: both copies with their buckets, for scans of some nodes' edges.
    layout: Layout | None = None

    def persist(self) -> "Graph":
        lvl = StorageLevel.MEMORY_AND_DISK
        by_dst = None if self.edges_by_dst is None else self.edges_by_dst.persist(lvl)
        return Graph(self.nodes.persist(lvl), self.edges.persist(lvl), by_dst, self.layout)

    def unpersist(self) -> None:
        self.nodes.unpersist()
        self.edges.unpersist()
        if self.edges_by_dst is not None:
            self.edges_by_dst.unpersist()

    def incident(self, node_id: int) -> DataFrame:
        """Edges touching ``node_id`` in either direction (a self-loop once).

        Written as two point filters, ``src = x`` on the edges by source and
        ``dst = x`` on the copy by target, so each side is pruned by bucket and
        by parquet min/max statistics; equals ``filter(src = x OR dst = x)``.
        """
        out_e, in_e = self.edges, self.edges_by_dst if self.edges_by_dst is not None else self.edges
        if self.layout is not None:
            here = F.col("bucket") == bucket_of(F.lit(node_id).cast("long"), self.layout.buckets)
            out_e, in_e = (e.filter(here).drop("bucket") for e in (self.layout.by_src, self.layout.by_dst))
        return out_e.filter(F.col("src") == node_id).unionByName(
            in_e.filter((F.col("dst") == node_id) & (F.col("src") != node_id)))

    @property
    def spark(self):
        return self.nodes.sparkSession
