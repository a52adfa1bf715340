"""Graph -> relational mirror (four node tables, one edge table, one union view).

Four filtered projections of the node frame, each a scan of its own. Dirty values are normalised with JVM-side
regex expressions. Nothing here collects rows to the driver.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbweave.functions.text import norm_text, prop
from orbweave.model import Graph
from orbweave.session import checkpoint_dir

# The label -> table mapping of the mirror, in load order.
LABEL_TABLES = {"Officer": "officers", "Entity": "entities",
                "Intermediary": "intermediaries", "Address": "addresses"}


@dataclass(frozen=True)
class Mirror:
    officers: DataFrame
    entities: DataFrame
    intermediaries: DataFrame
    addresses: DataFrame
    relationships: DataFrame
    quarantine: DataFrame  # address rows whose NOT NULL address is missing

    def tables(self) -> dict[str, DataFrame]:
        return {"officers": self.officers, "entities": self.entities,
                "intermediaries": self.intermediaries, "addresses": self.addresses,
                "relationships": self.relationships}


def _p(key: str):
    return norm_text(prop(key))


def _default_name(label: str):
    return F.concat(F.lit(f"{label} #"), F.col("id").cast("string"))


def _country():
    # raw coalesce first, then normalise: an empty country_codes hides country
    return norm_text(F.coalesce(prop("country_codes"), prop("country")))


def scan_nodes(graph: Graph, label: str) -> DataFrame:
    """All nodes carrying ``label`` (paging by id cursor is not needed on Spark)."""
    return graph.nodes.filter(F.array_contains("labels", label)).select("id", "props")


def etl_officers(graph: Graph) -> DataFrame:
    return scan_nodes(graph, "Officer").select(
        F.col("id").alias("node_id"),
        F.coalesce(_p("name"), _default_name("Officer")).alias("name"),
        _country().alias("country"), _p("countries").alias("countries"),
        _p("sourceID").alias("sourceID"), _p("valid_until").alias("valid_until"),
        _p("note").alias("note"))


def etl_entities(graph: Graph) -> DataFrame:
    null_date = F.lit(None).cast("date")
    return scan_nodes(graph, "Entity").select(
        F.col("id").alias("node_id"),
        F.coalesce(_p("name"), _default_name("Entity")).alias("name"),
        _p("original_name").alias("original_name"), _p("former_name").alias("former_name"),
        _p("jurisdiction").alias("jurisdiction"),
        _p("jurisdiction_description").alias("jurisdiction_desc"),
        _p("company_type").alias("company_type"), _p("address").alias("address"),
        # source date formats vary; the mirror leaves the three dates NULL
        null_date.alias("incorporation_date"), null_date.alias("inactivation_date"),
        null_date.alias("struck_off_date"),
        _p("status").alias("status"), _p("service_provider").alias("service_provider"),
        _p("sourceID").alias("sourceID"), _p("valid_until").alias("valid_until"),
        _p("note").alias("note"))


def etl_intermediaries(graph: Graph) -> DataFrame:
    return scan_nodes(graph, "Intermediary").select(
        F.col("id").alias("node_id"),
        F.coalesce(_p("name"), _default_name("Intermediary")).alias("name"),
        _country().alias("country"), _p("countries").alias("countries"),
        _p("status").alias("status"), _p("sourceID").alias("sourceID"),
        _p("valid_until").alias("valid_until"), _p("note").alias("note"))


def _address_rows(graph: Graph) -> DataFrame:
    return scan_nodes(graph, "Address").select(
        F.col("id").alias("node_id"),
        norm_text(F.coalesce(prop("address"), prop("name"))).alias("address"),
        _p("name").alias("name"), _country().alias("country"),
        _p("countries").alias("countries"), _p("sourceID").alias("sourceID"),
        _p("valid_until").alias("valid_until"), _p("note").alias("note"))


def etl_addresses(graph: Graph) -> DataFrame:
    return _address_rows(graph).filter(F.col("address").isNotNull())


def etl_quarantine(graph: Graph) -> DataFrame:
    """Address rows that would violate NOT NULL address; kept aside, the load goes on."""
    return _address_rows(graph).filter(F.col("address").isNull())


def etl_edges(graph: Graph) -> DataFrame:
    """Edge projection: type lower-cased, link/status/sourceID normalised, dates NULL."""
    null_date = F.lit(None).cast("date")
    return graph.edges.select(
        F.col("id"), F.lower("type").alias("rel_type"),
        F.col("src").alias("start_id"), F.col("dst").alias("end_id"),
        _p("link").alias("link"), _p("status").alias("status"),
        null_date.alias("start_date"), null_date.alias("end_date"),
        _p("sourceID").alias("sourceID"))


def mirror(graph: Graph) -> Mirror:
    return LazyMirror(graph)


def all_nodes(m: Mirror) -> DataFrame:
    """Unified node view: (node_id, name, kind); addresses use the address as name."""
    return (m.officers.select("node_id", "name", F.lit("Officer").alias("kind"))
            .unionByName(m.entities.select("node_id", "name", F.lit("Entity").alias("kind")))
            .unionByName(m.intermediaries.select("node_id", "name",
                                                 F.lit("Intermediary").alias("kind")))
            .unionByName(m.addresses.select("node_id", F.col("address").alias("name"),
                                            F.lit("Address").alias("kind"))))


def normalize_props(graph: Graph) -> DataFrame:
    """Long form of every node property with its normalised value (blank -> NULL)."""
    return graph.nodes.select("id", F.explode("props").alias("key", "raw")).select(
        "id", "key", norm_text(F.col("raw")).alias("value"))


def first_rows(batch: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """The first row of each key by ``order_col`` (ties, or without one, by all columns); rows without a key go.

    An aggregation, so copies of a hot key are reduced before they are shuffled.
    """
    order = [order_col] if order_col is not None else []
    order += sorted(c for c in batch.columns if c != order_col)
    one = batch.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(
        F.min_by(F.struct(*batch.columns), F.struct(*order)).alias("__row"))
    return one.select("__row.*")


def insert_or_ignore(target: DataFrame, batch: DataFrame, key: str,
                     order_col: str | None = None) -> DataFrame:
    """Rows of ``batch`` a keyed insert would add: first row per key, keys absent from target.

    Returns only the rows to append; ``KeyedTable.append`` writes them. The first
    row per key follows ``order_col`` (a batch sequence), ties all columns.
    """
    return first_rows(batch, key, order_col).join(target.select(key), key, "left_anti").select(*batch.columns)


@dataclass(frozen=True)
class KeyedTable:
    """A stored table with a unique key that batches are appended to, each once.

    A batch is written to ``data/batch=<id>`` (over what a run that died left
    there) and then published by a row in ``manifest/batch=<id>``. Only published
    batches are read, and a published batch is not written again: repeating an
    append, whole or after a failure, adds nothing.
    """
    spark: SparkSession
    path: str
    schema: T.StructType
    key: str

    def published(self) -> list[str]:
        """Ids of the published batches: one for each append, from the manifest's folders."""
        try:
            done = self.spark.read.schema("rows long, batch string").parquet(f"{self.path}/manifest")
        except AnalysisException:  # nothing published yet
            return []
        return sorted(r["batch"] for r in done.select("batch").collect())

    def read(self, batches: list[str] | None = None) -> DataFrame:
        """The rows of the published batches (or of some), without the batch."""
        have = [b for b in self.published() if batches is None or b in batches]
        if not have:
            return self.spark.createDataFrame([], self.schema)
        stored = T.StructType([*self.schema.fields, T.StructField("batch", T.StringType())])
        return self.spark.read.schema(stored).parquet(f"{self.path}/data").filter(F.col("batch").isin(have)).drop("batch")

    def append(self, batch: DataFrame, batch_id: str, order_col: str | None = None) -> bool:
        """Insert-or-ignore ``batch``; False if that batch is published already."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
            raise ValueError(f"{batch_id!r} can't be a batch id")
        if batch_id in self.published():
            return False
        rows = insert_or_ignore(self.read(), batch, self.key, order_col).select(*self.schema.names)
        rows.write.mode("overwrite").parquet(f"{self.path}/data/batch={batch_id}")
        written = self.spark.read.schema(self.schema).parquet(f"{self.path}/data/batch={batch_id}")
        written.agg(F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{self.path}/manifest/batch={batch_id}")
        return True


def load_capped(graph: Graph, per_label: int, edge_cap: int) -> Mirror:
    """The mirror restricted to the first ``per_label`` nodes per label and ``edge_cap`` edges, in id order."""
    def cap(df, col):
        return df.orderBy(col).limit(per_label)
    m = mirror(graph)
    return Mirror(cap(m.officers, "node_id"), cap(m.entities, "node_id"),
                  cap(m.intermediaries, "node_id"), cap(m.addresses, "node_id"),
                  m.relationships.orderBy("id").limit(edge_cap), m.quarantine)


def load_report(m: Mirror) -> DataFrame:
    """Rows per mirror table and the total of the node tables: each table is counted once, the total added from the counts."""
    counts = reduce(DataFrame.unionByName, (
        df.select(F.count(F.lit(1)).alias("rows")).select(
            F.array(F.lit(name), *([] if name == "relationships" else [F.lit("nodes_total")])).alias("names"), "rows")
        for name, df in m.tables().items()))
    return counts.select(F.explode("names").alias("table_name"), "rows").groupBy("table_name").agg(F.sum("rows").alias("rows"))


def _write_relationships(df: DataFrame, path: str) -> None:
    """One folder per type, sorted by source: filters prune folders, then row groups. Rebalanced by type, so that
    AQE gives a type as many tasks and files as its share of the rows asks for."""
    order = ["rel_type", "start_id", "end_id"]
    df.hint("rebalance", F.col("rel_type")).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("rel_type").parquet(path)


def _write_table(name: str, df: DataFrame, path: str) -> DataFrame:
    """Write one mirror table under ``path`` and return the frame reading it."""
    spark = df.sparkSession
    if name == "relationships":
        _write_relationships(df, f"{path}/{name}")
    else:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        order = ["address" if name == "addresses" else "name", "node_id"]
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/{name}")
    return spark.read.schema(df.schema).parquet(f"{path}/{name}")


class _MirrorOnDemand(Mirror):
    """A stored mirror whose tables are each written, whole, when first read."""

    def __init__(self, m: Mirror, path: str):
        self.__dict__.update(_of=m, _path=path)

    def _table(self, name: str) -> DataFrame:
        return _write_table(name, getattr(self._of, name), self._path)

    officers = cached_property(lambda self: self._table("officers"))
    entities = cached_property(lambda self: self._table("entities"))
    intermediaries = cached_property(lambda self: self._table("intermediaries"))
    addresses = cached_property(lambda self: self._table("addresses"))
    relationships = cached_property(lambda self: self._table("relationships"))
    quarantine = cached_property(lambda self: self._of.quarantine)


class LazyMirror(Mirror):
    """The projection of a graph, table by table: none is planned, and no edge asked for, before it is read."""

    def __init__(self, graph: Graph):
        self.__dict__.update(_graph=graph)

    officers = cached_property(lambda self: etl_officers(self._graph))
    entities = cached_property(lambda self: etl_entities(self._graph))
    intermediaries = cached_property(lambda self: etl_intermediaries(self._graph))
    addresses = cached_property(lambda self: etl_addresses(self._graph))
    relationships = cached_property(lambda self: etl_edges(self._graph))
    quarantine = cached_property(lambda self: etl_quarantine(self._graph))


def store_mirror(m: Mirror, path: str) -> Mirror:
    """The five mirror tables as parquet under ``path``: frames reading them, each table written when first read.

    Node tables are sorted by what is looked up in them, the name (an address's
    text), relationships by type and source.
    """
    return _MirrorOnDemand(m, path)


def _has_rows(spark, path: str) -> bool:
    try:
        return not spark.read.parquet(path).isEmpty()
    except AnalysisException:  # no such folder, or no file in it yet
        return False


def load_graph(m: Mirror, path: str | None = None, truncate: bool = False) -> DataFrame:
    """Write the mirror as parquet tables and return the report read back from storage.

    Guard: refuses when ``relationships`` at ``path`` has rows, unless ``truncate``.
    It is written last, so a load that died on the way can be run again, under
    the same ``path``: node tables are keyed tables (the first row per id stays),
    each load writes one batch of them in a folder of its own and names that
    folder in ``loads`` at the end. The default location is a fresh folder under
    the cluster's checkpoint directory (shared storage).
    """
    spark = m.officers.sparkSession
    if path is not None and not truncate and _has_rows(spark, f"{path}/relationships"):
        raise RuntimeError(f"{path} already holds a loaded graph")
    if path is None:
        path = f"{checkpoint_dir(spark).rstrip('/')}/mirror-{uuid.uuid4().hex}"
    load, frames = uuid.uuid4().hex, {}
    for name, df in m.tables().items():
        if name == "relationships":
            _write_relationships(df, f"{path}/{name}")
            frames[name] = spark.read.schema(df.schema).parquet(f"{path}/{name}")
        else:
            table = KeyedTable(spark, f"{path}/{name}/{load}", df.schema, "node_id")
            table.append(df, "load")
            frames[name] = table.read()
    spark.range(1).select(F.lit(load).alias("load")).write.mode("overwrite").parquet(f"{path}/loads")
    return load_report(Mirror(**frames, quarantine=m.quarantine))
