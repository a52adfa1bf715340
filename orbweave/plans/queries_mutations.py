"""Registered queries: change batches derived from the driver tables, applied to the graph.

Batches are built from whole tables (every supplier, every customer, every
part that matches a data predicate), so their size grows with the data.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from orbweave.functions.text import prop
from orbweave.operators import mutate
from orbweave.plans.catalog import graph_for, register
from orbweave.plans.oracle import with_graph
from orbweave.sources.fixture import (ADDRESS_BASE, CONNECTED_BASE, ENTITY_BASE,
                                      INTERMEDIARY_BASE, OFFICER_BASE, read_table)
from orbweave.sources.quality import validate_edge_merges, validate_node_creates, validate_patches

# Stamps of the change batches (passed in for repeatable results)
# and the request-id offset separating supplier requests from customer ones.
STAMP = "2026-01-01T00:00:00Z"
SUPPLIER_REQUEST_BASE = 1_000_000_000_000
REPEATED_REQUEST = 2_000_000_000_000
ORPHAN_OFFSET = 100_000_000_000_000
MISSING_ADDRESS_OFFSET = 100_000_000_000_000


# -- batches ------------------------------------------------------------------------

def create_batch(spark, sf_dir):
    """One request a supplier; some repeat another's id, some have a negative one."""
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    one = s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        F.when(F.col("s_nationkey") == 1, -F.col("s_suppkey") - 1)
        .when(F.col("s_nationkey") == 2, F.lit(REPEATED_REQUEST)).otherwise(F.col("s_suppkey")).alias("request_id"),
        F.when(F.col("s_acctbal") < 0, "Company").otherwise("Entity").alias("kind"),
        F.concat("s_name", F.lit(" Holdings")).alias("name"), F.col("n_name").alias("country"),
        F.lit(None).cast("string").alias("jurisdiction"),
        F.lit("created from supplier").alias("note"))
    return one


_CREATE_BATCH_SQL = f"""
g_cb AS (
  SELECT *, CASE WHEN request_id < 0 THEN 'request id not valid'
                 WHEN count(*) OVER (PARTITION BY request_id) > 1 THEN 'request id repeated'
                 WHEN kind NOT IN ('Officer', 'Entity', 'Intermediary', 'Address') THEN 'kind not allowed'
                 WHEN name IS NULL OR length(name) < 1 THEN 'name required' END AS reason
  FROM (SELECT CASE s_nationkey WHEN 1 THEN -s_suppkey - 1 WHEN 2 THEN {REPEATED_REQUEST} ELSE s_suppkey END AS request_id,
               CASE WHEN s_acctbal < 0 THEN 'Company' ELSE 'Entity' END AS kind,
               s_name || ' Holdings' AS name, n_name AS country
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)
)"""


def patch_batch(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_size")
    eid = F.lit(ENTITY_BASE) + F.col("p_partkey")

    def rows(cond, id_col, key, value, seq):
        return p.filter(cond).select(id_col.alias("id"), F.lit(key).cast("string").alias("key"),
                                     F.lit(value).cast("string").alias("value"),
                                     F.lit(seq).alias("seq"))
    return (rows(F.col("p_size") < 25, eid, "status", "Dissolved", 1)
            .unionByName(rows(F.col("p_size") < 10, eid, "jurisdiction", None, 2))
            .unionByName(rows(F.col("p_size") < 5, eid, "status", "Struck off", 3))
            .unionByName(rows(F.col("p_size") < 3, eid, "updated_at", "1999-01-01T00:00:00Z", 4))
            .unionByName(rows(F.col("p_size") == 11, eid, None, "no key", 1))
            .unionByName(rows(F.col("p_size") >= 49, eid + F.lit(ORPHAN_OFFSET), "note",
                              "orphan patch", 1)))


_PATCH_BATCH_SQL = f"""
g_pb AS (
  SELECT {ENTITY_BASE} + p_partkey AS id, 'status' AS key, 'Dissolved' AS value, 1 AS seq FROM part WHERE p_size < 25
  UNION ALL SELECT {ENTITY_BASE} + p_partkey, 'jurisdiction', NULL, 2 FROM part WHERE p_size < 10
  UNION ALL SELECT {ENTITY_BASE} + p_partkey, 'status', 'Struck off', 3 FROM part WHERE p_size < 5
  UNION ALL SELECT {ENTITY_BASE} + p_partkey, 'updated_at', '1999-01-01T00:00:00Z', 4 FROM part WHERE p_size < 3
  UNION ALL SELECT {ENTITY_BASE} + p_partkey, NULL, 'no key', 1 FROM part WHERE p_size = 11
  UNION ALL SELECT {ENTITY_BASE + ORPHAN_OFFSET} + p_partkey, 'note', 'orphan patch', 1 FROM part WHERE p_size >= 49
),
g_pl AS (
  SELECT id, key, value FROM (
    SELECT *, row_number() OVER (PARTITION BY id, key ORDER BY seq DESC) AS rn FROM g_pb WHERE key IS NOT NULL) WHERE rn = 1
)"""


def delete_node_batch(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    return c.filter(F.col("c_mktsegment") == "BUILDING").select(
        (F.lit(OFFICER_BASE) + F.col("c_custkey")).alias("id"))


_DELETED_SQL = f"(SELECT {OFFICER_BASE} + c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"


def merge_batch(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey", "s_acctbal")
    # customers in debt move to the next nation's address: a new edge
    nation = F.when(F.col("c_acctbal") < 0, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))
    cust = c.select(F.col("c_custkey").alias("request_id"),
                    (F.lit(OFFICER_BASE) + F.col("c_custkey")).alias("src"),
                    (F.lit(ADDRESS_BASE) + nation).alias("dst"),
                    F.lit("registered_address").alias("type"))
    supp = s.select((F.lit(SUPPLIER_REQUEST_BASE) + F.col("s_suppkey")).alias("request_id"),
                    (F.lit(INTERMEDIARY_BASE) + F.col("s_suppkey")).alias("src"),
                    (F.lit(ADDRESS_BASE + MISSING_ADDRESS_OFFSET) + F.col("s_nationkey")).alias("dst"),
                    F.when(F.col("s_acctbal") < 0, "registered address")
                    .when(F.col("s_nationkey") == 0, "registered_address\n")
                    .otherwise("registered_address").alias("type"))
    return cust.unionByName(supp)


_MERGE_BATCH_SQL = f"""
g_mb AS (
  SELECT c_custkey AS request_id, {OFFICER_BASE} + c_custkey AS src, {ADDRESS_BASE} + CASE WHEN c_acctbal < 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS dst,
         'registered_address' AS type FROM customer
  UNION ALL
  SELECT {SUPPLIER_REQUEST_BASE} + s_suppkey, {INTERMEDIARY_BASE} + s_suppkey,
         {ADDRESS_BASE + MISSING_ADDRESS_OFFSET} + s_nationkey,
         CASE WHEN s_acctbal < 0 THEN 'registered address' WHEN s_nationkey = 0 THEN 'registered_address' || chr(10)
              ELSE 'registered_address' END FROM supplier
),
g_mv AS (SELECT request_id, src, dst, lower(type) AS type FROM g_mb
         WHERE regexp_full_match(type, '[A-Za-z_][A-Za-z0-9_]*')),
g_mok AS (SELECT * FROM g_mv WHERE src IN (SELECT id FROM g_nodes) AND dst IN (SELECT id FROM g_nodes)),
g_mex AS (SELECT src, dst, lower(type) AS type, min(id) AS edge_id FROM g_edges GROUP BY 1, 2, 3),
g_mfirst AS (SELECT src, dst, type, min(request_id) AS first_request FROM g_mok GROUP BY 1, 2, 3),
g_mres AS (
  SELECT f.src, f.dst, f.type, f.first_request,
         coalesce(x.edge_id, (SELECT max(id) + 1 FROM g_edges) + f.first_request) AS edge_id,
         x.edge_id IS NULL AS is_new
  FROM g_mfirst f LEFT JOIN g_mex x ON x.src = f.src AND x.dst = f.dst AND x.type = f.type
)"""


def delete_edge_batch(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_acctbal")
    return c.filter(F.col("c_acctbal") < 0).select(
        (F.lit(CONNECTED_BASE) + F.col("c_custkey")).alias("id"))


# -- queries ---------------------------------------------------------------------------

@register("validate_nodes", with_graph(
    "SELECT request_id, reason FROM g_cb WHERE reason IS NOT NULL", _CREATE_BATCH_SQL))
def q_validate_nodes(spark, sf_dir):
    _, rejected = validate_node_creates(create_batch(spark, sf_dir))
    return rejected.select("request_id", "reason")


@register("create_nodes", with_graph("""
SELECT request_id, CASE WHEN reason IS NULL THEN (SELECT max(id) + 1 FROM g_nodes) + request_id END AS id,
       kind, name, coalesce(reason, 'created') AS status
FROM g_cb""", _CREATE_BATCH_SQL))
def q_create_nodes(spark, sf_dir):
    g = graph_for(spark, sf_dir)
    applied = mutate.create_nodes(g, create_batch(spark, sf_dir), STAMP)
    made = applied.graph.nodes.join(applied.results.select("id", "request_id", "status"), "id") \
        .select("request_id", "id", F.get("labels", 0).alias("kind"), prop("name").alias("name"),
                "status")
    refused = applied.rejected.select("request_id", F.lit(None).cast("long").alias("id"), "kind",
                                      "name", F.col("reason").alias("status"))
    return made.unionByName(refused)


@register("patch_nodes", with_graph(f"""
SELECT n.id,
  CASE WHEN EXISTS (SELECT 1 FROM g_pl p WHERE p.id = n.id AND p.key = 'status')
       THEN (SELECT value FROM g_pl p WHERE p.id = n.id AND p.key = 'status') ELSE n.status END AS status,
  CASE WHEN EXISTS (SELECT 1 FROM g_pl p WHERE p.id = n.id AND p.key = 'jurisdiction')
       THEN (SELECT value FROM g_pl p WHERE p.id = n.id AND p.key = 'jurisdiction') ELSE n.jurisdiction END AS jurisdiction,
  CASE WHEN n.id IN (SELECT id FROM g_pl) THEN '{STAMP}' END AS updated_at,
  CASE WHEN n.id IN (SELECT id FROM g_pl) THEN 'patched' ELSE 'unchanged' END AS result
FROM g_nodes n WHERE list_contains(n.labels, 'Entity')
UNION ALL
SELECT DISTINCT id, NULL, NULL, NULL, 'node not found' FROM g_pl WHERE id NOT IN (SELECT id FROM g_nodes)
UNION ALL
SELECT id, NULL, NULL, NULL, 'key required' FROM g_pb WHERE key IS NULL""",
    _PATCH_BATCH_SQL))
def q_patch_nodes(spark, sf_dir):
    g = graph_for(spark, sf_dir)
    applied = mutate.patch_nodes(g, patch_batch(spark, sf_dir), STAMP)
    ent = applied.graph.nodes.filter(F.array_contains("labels", "Entity")).select(
        "id", prop("status").alias("status"), prop("jurisdiction").alias("jurisdiction"),
        prop("updated_at").alias("updated_at"),
        F.when(prop("updated_at").isNotNull(), "patched").otherwise("unchanged").alias("result"))
    refused = applied.rejected.select(
        "id", F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("string").alias("jurisdiction"),
        F.lit(None).cast("string").alias("updated_at"), F.col("reason").alias("result"))
    return ent.unionByName(refused)


#: JSON values of the patches that ``validate_patches`` looks at, by the part's size modulo 8.
PATCH_VALUES = ['"Dissolved"', "12", "0.5", "null", "true", '{"k": 1}', "[1, 2]", None]


@register("validate_patches", with_graph(f"""
SELECT id, key, value, reason FROM (
  SELECT CASE p_size % 10 WHEN 0 THEN NULL ELSE {ENTITY_BASE} + p_partkey END AS id,
         CASE p_size % 10 WHEN 1 THEN NULL WHEN 2 THEN '' ELSE 'status' END AS key,
         (CASE p_size % 8 {" ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(PATCH_VALUES) if v is not None)} END) AS json,
         CASE WHEN json IS NULL OR json = 'null' THEN NULL ELSE replace(json, ' ', '') END AS shown,
         CASE WHEN id IS NULL THEN 'id required' WHEN key IS NULL OR key = '' THEN 'key required'
              WHEN p_size % 8 IN (4, 5, 6) THEN 'value must be string, number or null' END AS reason,
         CASE WHEN reason IS NULL THEN trim(shown, '"') ELSE coalesce(shown, json) END AS value
  FROM part)"""))
def q_validate_patches(spark, sf_dir):
    """Typed patches of every part: those that can be used with their value as text, the others with the reason."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_size")
    value = F.get(F.array(*(F.lit(v) for v in PATCH_VALUES)), F.col("p_size") % len(PATCH_VALUES))
    last = F.col("p_size") % 10
    batch = p.select(F.when(last != 0, F.lit(ENTITY_BASE) + F.col("p_partkey")).alias("id"),
                     F.when(last == 2, "").when(last != 1, "status").alias("key"), F.parse_json(value).alias("value"), F.lit(1).alias("seq"))
    valid, rejected = validate_patches(batch)
    return valid.withColumn("reason", F.lit(None).cast("string")).unionByName(rejected).select("id", "key", "value", "reason")


@register("node_stamps", with_graph(f"""
SELECT n.id, CASE WHEN n.id IN (SELECT id FROM g_pl) THEN TIMESTAMP '2026-01-01 00:00:00' END AS updated_at
FROM g_nodes n WHERE list_contains(n.labels, 'Entity')""", _PATCH_BATCH_SQL))
def q_node_stamps(spark, sf_dir):
    """When each entity was patched, as a time."""
    applied = mutate.patch_nodes(graph_for(spark, sf_dir), patch_batch(spark, sf_dir), datetime(2026, 1, 1, tzinfo=timezone.utc))
    return applied.graph.nodes.filter(F.array_contains("labels", "Entity")).select("id", mutate.stamp("updated_at").cast("timestamp_ntz").alias("updated_at"))


@register("detach_delete_nodes", with_graph(f"SELECT id FROM g_nodes WHERE id NOT IN {_DELETED_SQL}"))
def q_detach_delete_nodes(spark, sf_dir):
    applied = mutate.detach_delete_nodes(graph_for(spark, sf_dir), delete_node_batch(spark, sf_dir))
    return applied.graph.nodes.select("id")


@register("detach_delete_edges", with_graph(f"""
SELECT id, src, dst FROM g_edges WHERE src NOT IN {_DELETED_SQL} AND dst NOT IN {_DELETED_SQL}"""))
def q_detach_delete_edges(spark, sf_dir):
    applied = mutate.detach_delete_nodes(graph_for(spark, sf_dir), delete_node_batch(spark, sf_dir))
    return applied.graph.edges.select("id", "src", "dst")


@register("validate_edges", with_graph("""
SELECT request_id, 'type must be an identifier' AS reason FROM g_mb
WHERE NOT regexp_full_match(type, '[A-Za-z_][A-Za-z0-9_]*')""", _MERGE_BATCH_SQL))
def q_validate_edges(spark, sf_dir):
    _, rejected = validate_edge_merges(merge_batch(spark, sf_dir))
    return rejected.select("request_id", "reason")


@register("merge_edges", with_graph("""
SELECT o.request_id, r.edge_id,
       CASE WHEN r.is_new AND o.request_id = r.first_request THEN 'created' ELSE 'matched' END AS status
FROM g_mok o JOIN g_mres r ON r.src = o.src AND r.dst = o.dst AND r.type = o.type
UNION ALL
SELECT request_id, NULL, 'type must be an identifier' FROM g_mb
WHERE NOT regexp_full_match(type, '[A-Za-z_][A-Za-z0-9_]*')
UNION ALL
SELECT request_id, NULL, 'endpoint not found' FROM g_mv WHERE request_id NOT IN (SELECT request_id FROM g_mok)""",
    _MERGE_BATCH_SQL))
def q_merge_edges(spark, sf_dir):
    applied = mutate.merge_edges(graph_for(spark, sf_dir), merge_batch(spark, sf_dir), STAMP)
    refused = applied.rejected.select("request_id", F.lit(None).cast("long").alias("edge_id"),
                                      F.col("reason").alias("status"))
    return applied.results.unionByName(refused)


@register("delete_edges", with_graph(f"""
SELECT id FROM g_edges WHERE id NOT IN (
  SELECT {CONNECTED_BASE} + c_custkey FROM customer WHERE c_acctbal < 0)"""))
def q_delete_edges(spark, sf_dir):
    applied = mutate.delete_edges(graph_for(spark, sf_dir), delete_edge_batch(spark, sf_dir))
    return applied.graph.edges.select("id")
