"""Property graph derived from the driver's TPC-H-style tables.

customer -> Officer, part -> Entity, supplier -> Intermediary, nation -> Address,
region -> Other (isolated). Edges come from lineitem/orders (officer_of,
intermediary_of) and customer (registered_address, connected_to). The same
definition is written in DuckDB SQL in ``orbweave.plans.oracle`` so every query
can be checked against an independent engine.

Every lineitem row takes part: each distinct (order, part) pair gives one
officer_of and one intermediary_of edge; every customer gives a
registered_address and a connected_to edge. Every table is read with an
explicit column list, so parquet scans only read what the graph needs.

Ids are a kind in front of the table's key: 10**15 for each node kind, 2**60
for each edge family, an order's parts numbered in the lowest 12 bits.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbweave.model import EDGE_SCHEMA, Graph, Layout, bucket_of
from orbweave.session import shuffles_freed

# Id offsets per node kind and per edge family.
OFFICER_BASE = 1 * 10**15
ENTITY_BASE = 2 * 10**15
INTERMEDIARY_BASE = 3 * 10**15
ADDRESS_BASE = 4 * 10**15
OTHER_BASE = 5 * 10**15
OFFICER_OF_BASE = 1 * 2**60
INTERMEDIARY_OF_BASE = 2 * 2**60
REGISTERED_BASE = 3 * 2**60
CONNECTED_BASE = 4 * 2**60
PARTS_PER_ORDER = 4096


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def rows_of(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the largest tables the graph is derived from, by the files' own counts."""
    return sum(read_table(spark, sf_dir, name).count() for name in ("lineitem", "customer"))


def _pairs(**values) -> F.Column:
    """A string map from keyword columns."""
    pairs = []
    for key, col in values.items():
        pairs += [F.lit(key), col.cast("string")]
    return F.create_map(*pairs)


def _props(**values) -> F.Column:
    """A string map from keyword columns, dropping keys whose value is NULL (absent)."""
    return F.map_filter(_pairs(**values), lambda k, v: v.isNotNull())


def fixture_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey",
                          "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    supplier = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")

    k = F.col("c_custkey")
    officers = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        (F.lit(OFFICER_BASE) + k).alias("id"),
        F.when(k % 50 == 0, F.array(F.lit("Intermediary"), F.lit("Officer")))
         .otherwise(F.array(F.lit("Officer"))).alias("labels"),
        _props(
            # deliberately dirty values for the normalisation rules
            name=F.when(k % 11 == 0, F.lit("  "))
                  .when(k % 11 == 1, F.concat(F.lit("\t"), F.col("c_name"), F.lit(" ")))
                  .otherwise(F.col("c_name")),
            country_codes=F.when(k % 5 == 0, F.lit(""))
                           .when(k % 5 == 1, F.lit(None).cast("string"))
                           .otherwise(F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))),
            country=F.col("n_name"),
            countries=F.col("n_name"),
            note=F.col("c_mktsegment"),
            sourceID=F.concat(F.lit("Source "), (k % 3).cast("string")),
        ).alias("props"),
    )
    entities = part.select(
        (F.lit(ENTITY_BASE) + F.col("p_partkey")).alias("id"),
        F.array(F.lit("Entity")).alias("labels"),
        _props(name=F.col("p_name"), jurisdiction=F.col("p_brand"),
               jurisdiction_description=F.col("p_type"),
               status=F.when(F.col("p_size") >= 25, "Active").otherwise("Defaulted")).alias("props"),
    )
    intermediaries = supplier.select(
        (F.lit(INTERMEDIARY_BASE) + F.col("s_suppkey")).alias("id"),
        F.array(F.lit("Intermediary")).alias("labels"),
        _props(name=F.col("s_name")).alias("props"),
    )
    addresses = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name").select(
        (F.lit(ADDRESS_BASE) + F.col("n_nationkey")).alias("id"),
        F.array(F.lit("Address")).alias("labels"),
        # some are blank: they go to quarantine, and edges to them dangle in the mirror
        _props(address=F.when(F.col("n_nationkey") % 7 == 3, F.lit(" \t")).otherwise(F.col("n_name"))).alias("props"),
    )
    others = region.select(
        (F.lit(OTHER_BASE) + F.col("r_regionkey")).alias("id"),
        F.array(F.lit("Other")).alias("labels"),
        _props(name=F.col("r_name")).alias("props"),
    )
    return (officers.unionByName(entities).unionByName(intermediaries)
            .unionByName(addresses).unionByName(others))


def fixture_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                          "l_returnflag", "l_linestatus", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer", "c_custkey")

    # One shuffle of lineitem: the grouping, the window and the join all follow its partitioning by l_orderkey.
    pairs = lineitem.repartition("l_orderkey").groupBy("l_orderkey", "l_partkey").agg(
        F.min("l_suppkey").alias("supp"), F.min("l_returnflag").alias("link"), F.min("l_linestatus").alias("status"),
        F.min("l_shipdate").cast("date").alias("start_date"))
    nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_partkey")) - 1
    buyers = orders.groupBy("o_orderkey").agg(F.min("o_custkey").alias("cust"))
    numbered = pairs.withColumn("nth", nth).join(buyers, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    present = F.col("link").isNotNull() & F.col("status").isNotNull() & F.col("start_date").isNotNull()

    def end(base, edge_type, node_base, key):
        """One of a pair's two edges: its id, type and source."""
        return F.struct((F.lit(base) + F.col("l_orderkey") * F.lit(PARTS_PER_ORDER) + F.col("nth")).alias("id"),
                        F.lit(edge_type).alias("type"), (F.lit(node_base) + F.col(key)).alias("src"))

    officer = end(OFFICER_OF_BASE, "officer_of", OFFICER_BASE, "cust")
    intermediary = end(INTERMEDIARY_OF_BASE, "intermediary_of", INTERMEDIARY_BASE, "supp")
    values = {"link": F.col("link"), "status": F.col("status"), "start_date": F.col("start_date")}
    # Only a pair whose order exists has an officer. A map without absent values needs no filter.
    traded = numbered.select(
        (F.lit(ENTITY_BASE) + F.col("l_partkey")).alias("dst"),
        F.when(present, _pairs(**values)).otherwise(_props(**values)).alias("props"),
        F.explode(F.when(F.col("o_orderkey").isNotNull(), F.array(officer, intermediary))
                  .otherwise(F.array(intermediary))).alias("edge")) \
        .select("edge.id", "edge.type", "edge.src", "dst", "props")
    no_props = F.create_map().cast("map<string,string>")
    # Raw type in upper case: the ETL's lower-casing rule has something to do.
    registered = _registered(spark, sf_dir, no_props)
    n_customers = customer.select(F.count(F.lit(1))).scalar()
    connected = customer.select(
        (F.lit(CONNECTED_BASE) + F.col("c_custkey")).alias("id"),
        F.lit("connected_to").alias("type"),
        (F.lit(OFFICER_BASE) + F.col("c_custkey")).alias("src"),
        (F.lit(OFFICER_BASE) + (F.col("c_custkey") * 7 + 4) % n_customers).alias("dst"),
        no_props.alias("props"),
    )
    return traded.unionByName(registered).unionByName(connected)


def _registered(spark: SparkSession, sf_dir: str, no_props: F.Column) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    return customer.select(
        (F.lit(REGISTERED_BASE) + F.col("c_custkey")).alias("id"),
        F.lit("REGISTERED_ADDRESS").alias("type"),
        (F.lit(OFFICER_BASE) + F.col("c_custkey")).alias("src"),
        (F.lit(ADDRESS_BASE) + F.col("c_nationkey")).alias("dst"),
        no_props.alias("props"),
    )


def fixture_graph(spark: SparkSession, sf_dir: str) -> Graph:
    return Graph(fixture_nodes(spark, sf_dir), fixture_edges(spark, sf_dir))


#: Given to the reader, as a graph without edges has no file to take it from.
STORED_EDGES = T.StructType([*EDGE_SCHEMA.fields, T.StructField("bucket", T.IntegerType())])


def store_graph(graph: Graph, path: str, partitions: int | None = None, buckets: int | None = None) -> Graph:
    """Write the graph as parquet tables and return frames reading them back.

    Nodes are range-partitioned and sorted by ``id``. Edges are written twice, in
    folders by the bucket of ``src`` and of ``dst`` (``buckets``: four for each
    partition), sorted by that end: a scan of some nodes' edges reads their
    buckets only, and min/max statistics skip row groups within. Rows are rebalanced
    by bucket: AQE cuts what is more than a task's share (its advisory size) in
    parts, so a hub's edges, though in one bucket, are sorted and written by as
    many tasks as they ask for, without a pass over all rows to sample ranges.
    """
    spark = graph.spark
    n, buckets = _sizes(spark, partitions, buckets)
    _write_nodes(graph.nodes, path, n)
    _write_edges(graph.edges, path, "src", buckets)
    # the second layout is written from the stored copy: no second derivation
    _write_edges(_stored_edges(spark, path, "src").drop("bucket"), path, "dst", buckets)
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{path}/layout")
    return read_graph(spark, path)


def _sizes(spark: SparkSession, partitions: int | None, buckets: int | None) -> tuple[int, int]:
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return n, buckets or 4 * n


def _write_nodes(nodes: DataFrame, path: str, partitions: int) -> None:
    with shuffles_freed(nodes.sparkSession):
        nodes.repartitionByRange(partitions, "id").sortWithinPartitions("id").write.mode("overwrite").parquet(f"{path}/nodes")


#: Folder of the edges by the end that their bucket comes from, and the other end.
LAYOUTS = {"src": ("edges", "dst"), "dst": ("edges_by_dst", "src")}


def _write_edges(edges: DataFrame, path: str, near: str, buckets: int) -> None:
    name, far = LAYOUTS[near]
    dealt = edges.withColumn("bucket", bucket_of(F.col(near), buckets)).hint("rebalance", F.col("bucket"))
    with shuffles_freed(edges.sparkSession):
        dealt.sortWithinPartitions("bucket", near, far).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{name}")


def _stored_edges(spark: SparkSession, path: str, near: str) -> DataFrame:
    return spark.read.schema(STORED_EDGES).parquet(f"{path}/{LAYOUTS[near][0]}")


class _LayoutOnDemand(Layout):
    """Both edge layouts, each written when it is first read."""

    def __init__(self, edges: DataFrame, path: str, buckets: int):
        self.__dict__.update(_edges=edges, _path=path, buckets=buckets)

    @cached_property
    def by_src(self) -> DataFrame:
        _write_edges(self._edges, self._path, "src", self.buckets)
        return _stored_edges(self._edges.sparkSession, self._path, "src")

    @cached_property
    def by_dst(self) -> DataFrame:
        _write_edges(self.by_src.drop("bucket"), self._path, "dst", self.buckets)
        return _stored_edges(self._edges.sparkSession, self._path, "dst")


class _GraphOnDemand(Graph):
    """A graph whose nodes and layouts are each written, whole, when first read."""

    def __init__(self, graph: Graph, path: str, partitions: int | None, buckets: int | None):
        n, buckets = _sizes(graph.spark, partitions, buckets)
        self.__dict__.update(_nodes=graph.nodes, _path=path, _partitions=n, layout=_LayoutOnDemand(graph.edges, path, buckets))

    @cached_property
    def nodes(self) -> DataFrame:
        _write_nodes(self._nodes, self._path, self._partitions)
        return self.spark.read.parquet(f"{self._path}/nodes")

    @cached_property
    def edges(self) -> DataFrame:
        return self.layout.by_src.drop("bucket")

    @cached_property
    def edges_by_dst(self) -> DataFrame:
        return self.layout.by_dst.drop("bucket")

    @property
    def spark(self) -> SparkSession:
        return self._nodes.sparkSession


def store_on_demand(graph: Graph, path: str, partitions: int | None = None, buckets: int | None = None) -> Graph:
    """The tables of ``store_graph``, each written when a query first reads it: a query that
    reads no edges against their direction, or none at all, doesn't wait for them."""
    return _GraphOnDemand(graph, path, partitions, buckets)


def read_graph(spark: SparkSession, path: str) -> Graph:
    """The graph that ``store_graph`` wrote to ``path``."""
    by_src, by_dst = (_stored_edges(spark, path, near) for near in LAYOUTS)
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    return Graph(spark.read.parquet(f"{path}/nodes"), by_src.drop("bucket"), by_dst.drop("bucket"), Layout(by_src, by_dst, buckets))
