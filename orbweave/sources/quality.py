"""Constraint checks on the mirror and validation of change batches.

The report is one row per rule with its violation count, from one reading of the
nodes and two groupings of the edges. Batch validation splits a batch into ``valid`` and ``rejected`` (with a reason)
frames instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbweave.functions.text import EDGE_TYPE_PATTERN, KIND_PRIORITY, norm_text, prop
from orbweave.model import Graph
from orbweave.session import cut_lineage
from orbweave.sources.etl import LABEL_TABLES


def quality_report(graph: Graph) -> DataFrame:
    """Constraint violations of the mirror of ``graph``: one row (rule, violations) a rule.

    The nodes are read once, as (table, id, missing): a node for each table that
    it goes to. One grouping by (table, id) gives all key and NOT NULL rules of
    the four tables, one grouping of the edges by id those of the relationships,
    and one grouping of edge ends and table ids by node the dangling ends. Copies
    and hubs are counted before they are shuffled.
    """
    labels = F.array(*[F.lit(k) for k in LABEL_TABLES])
    name, address = norm_text(prop("name")), norm_text(F.coalesce(prop("address"), prop("name")))
    rows = cut_lineage(graph.nodes.select(
        "id", F.array_intersect(F.array_distinct("labels"), labels).alias("tables"), address.isNull().alias("no_address"),
        F.coalesce(name, F.col("id").cast("string")).isNull().alias("no_name")))
    placed = rows.select("id", F.explode("tables").alias("label"), "no_address", "no_name").withColumn(
        "missing", F.when(F.col("label") == "Address", F.col("no_address")).otherwise(F.col("no_name")))
    # A row without an address is kept aside, so it is no row of its table.
    kept = placed.filter((F.col("label") != "Address") | ~F.col("missing"))

    def of(label: str) -> F.Column:
        return F.col("label") == label

    def number(condition: F.Column, times: F.Column | None = None) -> F.Column:
        return F.coalesce(F.sum(F.when(condition, F.lit(1) if times is None else times)), F.lit(0)).cast("long")

    by_key = placed.groupBy("label", "id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("missing").cast("int")).alias("missing"))
    in_table = F.when(of("Address"), F.col("n") - F.col("missing")).otherwise(F.col("n"))
    rules = {f"{table}.pk_duplicate": number(of(label) & (in_table > 1)) for label, table in LABEL_TABLES.items()}
    rules |= {f"{LABEL_TABLES[label]}.name_null": number(of(label), F.col("missing")) for label in ("Officer", "Entity", "Intermediary")}
    rules["addresses.address_null_quarantined"] = number(of("Address"), F.col("missing"))
    nodes = by_key.agg(*(c.alias(r) for r, c in rules.items()))
    tables = rows.agg(number(F.size("tables") == 0).alias("nodes.in_no_table"), number(F.size("tables") > 1).alias("nodes.in_several_tables"))

    edges = graph.edges.select("id", "type", "src", "dst")
    count = F.count(F.lit(1))
    by_id = edges.groupBy("id").agg(count.alias("n"), *(F.sum(F.col(c).isNull().cast("int")).alias(f"no_{c}") for c in ("type", "src", "dst")))
    links = by_id.agg(number(F.col("n") > 1).alias("relationships.pk_duplicate"), *(
        F.coalesce(F.sum(f"no_{c}"), F.lit(0)).cast("long").alias(f"relationships.{rule}_null")
        for c, rule in (("type", "rel_type"), ("src", "start"), ("dst", "end"))))
    # Every end and every id of a table, counted by node: ends of a node that no table has dangle.
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("node"), F.lit(1).alias("start"), F.lit(0).alias("end"), F.lit(0).alias("known")),
        F.struct(F.col("dst").alias("node"), F.lit(0).alias("start"), F.lit(1).alias("end"), F.lit(0).alias("known")))).alias("e")).select("e.*")
    ids = kept.select(F.col("id").alias("node"), F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(1).alias("known"))
    by_node = ends.unionByName(ids).groupBy("node").agg(F.sum("start").alias("start"), F.sum("end").alias("end"), F.max("known").alias("known"))
    dangling = by_node.filter((F.col("known") == 0) | F.col("node").isNull()).agg(
        *(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"relationships.dangling_{c}") for c in ("start", "end")))

    def long(frame: DataFrame) -> DataFrame:
        return frame.unpivot([], [F.col(f"`{c}`") for c in frame.columns], "rule", "violations")

    return long(nodes).unionByName(long(tables)).unionByName(long(links)).unionByName(long(dangling))


def _request_reason(batch: DataFrame) -> tuple[DataFrame, F.Column]:
    """The batch with a mark on repeated request ids, and why a request's id can't be used (NULL if it can)."""
    again = batch.groupBy("request_id").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
    marked = batch.join(again, "request_id", "left")
    return marked, F.when(F.col("request_id").isNull() | (F.col("request_id") < 0), F.lit("request id not valid")) \
        .when(F.col("__n").isNotNull(), F.lit("request id repeated"))


def _split(batch: DataFrame, marked: DataFrame, reason: F.Column) -> tuple[DataFrame, DataFrame]:
    tagged = marked.select(*batch.columns, reason.alias("reason"))
    return (tagged.filter(F.col("reason").isNull()).drop("reason"),
            tagged.filter(F.col("reason").isNotNull()))


def validate_node_creates(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Create requests: usable request id, kind in the closed enum, non-empty name. Returns (valid, rejected)."""
    marked, reason = _request_reason(batch)
    reason = F.coalesce(reason, F.when(~F.col("kind").isin(KIND_PRIORITY) | F.col("kind").isNull(), F.lit("kind not allowed"))
                        .when(F.col("name").isNull() | (F.length("name") < 1), F.lit("name required")))
    return _split(batch, marked, reason)


def validate_edge_merges(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge requests: usable request id, both endpoints given, type an identifier. Returns (valid, rejected)."""
    marked, reason = _request_reason(batch)
    reason = F.coalesce(reason, F.when(F.col("src").isNull() | F.col("dst").isNull(), F.lit("endpoint required"))
                        .when(F.col("type").isNull() | ~F.col("type").rlike(EDGE_TYPE_PATTERN), F.lit("type must be an identifier")))
    return _split(batch, marked, reason)


def validate_patches(patches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Patch rows (id, key, value, seq): an id, a key, and a value that is a string, a number or null.

    ``value`` is text, or a VARIANT, whose type is looked at. Returns (valid, with
    the value as text; rejected, with the reason and the value as JSON).
    """
    value, kind = F.col("value"), patches.schema["value"].dataType
    text = value.cast("string")
    wrong, shown = F.lit(False), text
    if isinstance(kind, T.VariantType):
        none = value.isNull() | F.is_variant_null(value)
        name = F.schema_of_variant(value)
        # The types a property may have. Decimals are written with their precision.
        simple = name.isin("STRING", "BIGINT", "DOUBLE", "FLOAT") | name.startswith("DECIMAL(")
        wrong, shown = ~none & ~simple, F.to_json(value)
        text = F.when(~none & simple, F.try_variant_get(value, "$", "string"))
    reason = (F.when(F.col("id").isNull(), F.lit("id required"))
              .when(F.col("key").isNull() | (F.length("key") < 1), F.lit("key required"))
              .when(wrong, F.lit("value must be string, number or null")))
    rest = [c for c in patches.columns if c != "value"]
    tagged = patches.select(*rest, text.alias("value"), shown.alias("__shown"), reason.alias("reason"))
    return (tagged.filter(F.col("reason").isNull()).select(*patches.columns),
            tagged.filter(F.col("reason").isNotNull()).select(*rest, F.col("__shown").alias("value"), "reason"))
