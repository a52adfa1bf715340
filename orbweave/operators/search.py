"""Attribute search and lookups.

Substring predicates stay JVM-side (``contains`` / ``ilike`` on lower-cased
columns). The token index is a stored table of postings (token, node), in
folders by the token's bucket: a search reads its tokens' folders and joins
their postings, the rarest token's first.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbweave.functions.params import parameter
from orbweave.functions.text import kind_from_labels, prop
from orbweave.model import Graph
from orbweave.operators.frontier import BROADCAST_ROWS
from orbweave.operators.nodes import attach_nodes, node_view

# Kinds searched by the multi-kind search, in branch order,
# and the tokenizer split pattern (anything that is not a letter or digit).
SEARCH_KINDS = ["Officer", "Entity", "Intermediary"]
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
MIN_QUERY_CHARS = 2

HIT_COLUMNS = ["id", "kind", "name", "country", "jurisdiction"]


def _ordered_limit(df: DataFrame, limit: int | None, *order) -> DataFrame:
    return df.orderBy(*order).limit(limit) if limit else df


def search_contains(graph: Graph, q: str, label: str = "Officer", case_sensitive: bool = False,
                    limit: int | None = None) -> DataFrame:
    """Nodes with ``label`` whose raw name contains ``q`` literally (no wildcards)."""
    name = prop("name")
    pred = name.contains(q) if case_sensitive else F.lower(name).contains(q.lower())
    out = graph.nodes.filter(F.array_contains("labels", label) & pred).select(
        "id", name.alias("name"))
    return _ordered_limit(out, limit, "id")


def search_ilike(table: DataFrame, q: str, limit: int | None = None,
                 id_col: str = "node_id") -> DataFrame:
    """Relational form: ``name ILIKE '%q%'`` (``%``, ``_`` and ``\\`` in q act as patterns)."""
    out = table.filter(F.col("name").ilike(f"%{q}%")).select(id_col, "name")
    return _ordered_limit(out, limit, id_col)


def clean_query(q: str | None) -> str | None:
    """The search guard: trimmed query, or None when shorter than two characters."""
    import re
    t = re.sub(r"^[\s﻿]+|[\s﻿]+$", "", q or "")
    return t if len(t) >= MIN_QUERY_CHARS else None


def search_page(graph: Graph, q: str | None, limit: int | None = None) -> DataFrame:
    """The first hits of the multi-kind search, by kind and id: as many as the parameter ``search_limit`` allows."""
    return search_nodes(graph, q, parameter("search_limit", limit))


def search_nodes(graph: Graph, q: str | None, limit: int | None = None) -> DataFrame:
    """Multi-kind search: one row per (node, matching searched label), kind = that label.

    One scan of the node table; the searched labels a node carries are
    exploded, which equals the UNION ALL of one branch per label.
    """
    cleaned = clean_query(q)
    nv = node_view(graph)
    if cleaned is None:
        empty = nv.select(F.col("id"), F.col("kind"), F.col("name"),
                          F.lit(None).cast("string").alias("country"),
                          F.lit(None).cast("string").alias("jurisdiction")).filter(F.lit(False))
        return empty
    kinds = F.array(*[F.lit(k) for k in SEARCH_KINDS])
    raw_name = prop("name")
    # a hit has a non-null name, so its display name is the raw name: one scan, no join
    hits = graph.nodes.filter(F.lower(raw_name).contains(cleaned.lower())).select(
        "id", F.explode(F.array_intersect(kinds, F.col("labels"))).alias("kind"),
        raw_name.alias("name"),
        F.coalesce(prop("countries"), prop("country")).alias("country"),
        prop("jurisdiction_description").alias("jurisdiction"))
    return _ordered_limit(hits, limit, "kind", "id")


def lookup_ids(graph: Graph, ids) -> DataFrame:
    """Nodes by id: a literal list is pushed into the scan; a frame of ids is semi-joined."""
    if isinstance(ids, DataFrame):
        return attach_nodes(ids.select(F.col(ids.columns[0]).alias("id")).distinct(), graph,
                            "id", how="inner")
    return node_view(graph).select("id", "kind", "name").filter(
        F.col("id").isin([int(i) for i in ids]))


def lookup_name(table: DataFrame, name: str, id_col: str = "node_id") -> DataFrame:
    return table.filter(F.col("name") == name).select(id_col, "name")


def resolve_name(table: DataFrame, name: str, id_col: str = "node_id") -> DataFrame:
    """Name -> a single id (the smallest among equal names): zero or one row."""
    return table.filter(F.col("name") == name).agg(F.min(id_col).alias("node_id")) \
        .filter(F.col("node_id").isNotNull())


def name_tokens(name: Column) -> Column:
    """Distinct lower-case tokens of a name: runs of letters and digits."""
    return F.filter(F.array_distinct(F.split(F.lower(name), TOKEN_SPLIT)), lambda t: t != "")


def token_index(all_nodes: DataFrame) -> DataFrame:
    """Inverted index (token, node_id, kind) over names of the searchable kinds."""
    return all_nodes.filter(F.col("kind").isin(SEARCH_KINDS)).select(
        F.explode(name_tokens(F.col("name"))).alias("token"), "node_id", "kind")


def query_tokens(spark: SparkSession, q: str) -> list[str]:
    """The tokens of a query, by the expression that makes the index."""
    return sorted(spark.range(1).select(name_tokens(F.lit(q)).alias("t")).first()["t"])


@dataclass(frozen=True)
class TokenIndex:
    """A stored token index: ``postings`` (token, node_id, kind) and ``counts`` (token, nodes), both by ``bucket``."""
    postings: DataFrame
    counts: DataFrame
    buckets: int

    def of(self, table: DataFrame, tokens: list[str]) -> DataFrame:
        """The rows of some tokens, read from their buckets."""
        if not self.buckets:  # not stored
            return table.filter(F.col("token").isin(tokens))
        here = [_token_bucket(F.lit(t), self.buckets) for t in tokens]
        return table.filter(F.col("bucket").isin(here) & F.col("token").isin(tokens))


def _token_bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def store_token_index(all_nodes: DataFrame, path: str, buckets: int | None = None) -> TokenIndex:
    """Write the token index of ``all_nodes`` to ``path``: folders by the token's bucket, sorted by token.

    Rows are dealt by ranges of (bucket, token, node), so a token that a third of
    all names hold is written, and later read, by as many tasks as that asks for.
    """
    spark = all_nodes.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or 4 * n
    order = ["bucket", "token", "node_id"]
    token_index(all_nodes).distinct().withColumn("bucket", _token_bucket(F.col("token"), buckets)) \
        .repartitionByRange(n, *order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    kept = spark.read.schema("token string, node_id long, kind string, bucket int").parquet(f"{path}/postings")
    kept.groupBy("bucket", "token").agg(F.count(F.lit(1)).alias("nodes")) \
        .repartitionByRange(n, "bucket", "token").sortWithinPartitions("bucket", "token").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/counts")
    return TokenIndex(kept, spark.read.schema("token string, nodes long, bucket int").parquet(f"{path}/counts"), buckets)


def token_search(index: TokenIndex | DataFrame, q: str) -> DataFrame:
    """Nodes whose name holds every token of ``q``: (node_id, kind, matched). ``index``: stored, or the frame of ``token_index``.

    Reads the buckets of the query's tokens only. The tokens' stored counts (a
    row for each token of the query) say which postings to start from; those are
    broadcast if they are few, so a common token's postings are not shuffled.
    """
    if isinstance(index, DataFrame):
        index = TokenIndex(index, index.groupBy("token").agg(F.count(F.lit(1)).alias("nodes")), 0)
    spark = index.postings.sparkSession
    tokens = query_tokens(spark, q)
    counts = {r["token"]: r["nodes"] for r in index.of(index.counts, tokens).collect()} if tokens else {}
    if not tokens or len(counts) < len(tokens):
        return index.postings.select("node_id", "kind", F.lit(len(tokens)).cast("long").alias("matched")).filter(F.lit(False))
    order = sorted(tokens, key=lambda t: (counts[t], t))
    postings = [index.of(index.postings, [t]).select("node_id", "kind") for t in order]
    if counts[order[0]] <= BROADCAST_ROWS:
        postings[0] = F.broadcast(postings[0])
    # No list is longer than the first from then on: the rows found so far are the side to send.
    found = reduce(lambda rare, more: rare.join(more, ["node_id", "kind"]), postings)
    return found.withColumn("matched", F.lit(len(tokens)).cast("long"))


def country_counts(graph: Graph) -> DataFrame:
    """Nodes per (country, kind), country = countries, else country."""
    c = graph.nodes.select(F.coalesce(prop("countries"), prop("country")).alias("country"),
                           kind_from_labels("labels").alias("kind"))
    return c.groupBy("country", "kind").agg(F.count(F.lit(1)).alias("nodes"))


__all__ = ["search_contains", "search_ilike", "search_nodes", "clean_query", "lookup_ids",
           "lookup_name", "resolve_name", "token_index", "store_token_index", "token_search", "search_page",
           "country_counts"]
