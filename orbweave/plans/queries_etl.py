"""Registered queries: scans, ETL mirror, quality, search and display mappings."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbweave.functions.text import prop
from orbweave.operators import mapping, pattern, search
from orbweave.plans.catalog import (context_for, graph_for, loaded_mirror_for, mirror_for,
                                    register, token_index_for)
from orbweave.plans.oracle import norm, with_graph
from orbweave.session import checkpoint_dir
from orbweave.sources import etl, quality

# Fixed value: the literal term of the multi-kind search query.
SEARCH_TERM = "er#0000001"
SHORT_TERM = " a "


# -- scans and ETL ----------------------------------------------------------------

@register("scan_nodes", with_graph(
    "SELECT id, name FROM g_nodes WHERE list_contains(labels, 'Officer')"))
def q_scan_nodes(spark, sf_dir):
    return etl.scan_nodes(graph_for(spark, sf_dir), "Officer").select(
        "id", prop("name").alias("name"))


@register("scan_edges", with_graph(
    "SELECT id, type, src, dst, link, status, start_date FROM g_edges"))
def q_scan_edges(spark, sf_dir):
    return graph_for(spark, sf_dir).edges.select(
        "id", "type", "src", "dst", prop("link").alias("link"), prop("status").alias("status"),
        prop("start_date").alias("start_date"))


@register("normalize_props", with_graph(f"""
SELECT id, key, {norm('raw')} AS value FROM (
  UNPIVOT g_nodes ON name, address, country_codes, country, countries, jurisdiction,
  jurisdiction_description, status, note, sourceID INTO NAME key VALUE raw)"""))
def q_normalize_props(spark, sf_dir):
    return etl.normalize_props(graph_for(spark, sf_dir))


@register("etl_officers", with_graph("SELECT * FROM g_officers"))
def q_etl_officers(spark, sf_dir):
    return mirror_for(spark, sf_dir).officers


@register("etl_entities", with_graph("SELECT * FROM g_entities"))
def q_etl_entities(spark, sf_dir):
    return mirror_for(spark, sf_dir).entities


@register("etl_intermediaries", with_graph("SELECT * FROM g_intermediaries"))
def q_etl_intermediaries(spark, sf_dir):
    return mirror_for(spark, sf_dir).intermediaries


@register("etl_addresses", with_graph("SELECT * FROM g_addresses"))
def q_etl_addresses(spark, sf_dir):
    return mirror_for(spark, sf_dir).addresses


@register("etl_edges", with_graph("SELECT * FROM g_relationships"))
def q_etl_edges(spark, sf_dir):
    return mirror_for(spark, sf_dir).relationships


@register("all_nodes", with_graph("SELECT * FROM g_all_nodes"))
def q_all_nodes(spark, sf_dir):
    return etl.all_nodes(mirror_for(spark, sf_dir))


_REPORT_SQL = """
SELECT 'officers' AS table_name, count(*) AS rows FROM {p}officers
UNION ALL SELECT 'entities', count(*) FROM {p}entities
UNION ALL SELECT 'intermediaries', count(*) FROM {p}intermediaries
UNION ALL SELECT 'addresses', count(*) FROM {p}addresses
UNION ALL SELECT 'relationships', count(*) FROM {p}relationships
UNION ALL SELECT 'nodes_total', (SELECT count(*) FROM {p}officers) + (SELECT count(*) FROM {p}entities)
  + (SELECT count(*) FROM {p}intermediaries) + (SELECT count(*) FROM {p}addresses)"""


@register("load_report", with_graph(_REPORT_SQL.format(p="g_")))
def q_load_report(spark, sf_dir):
    return etl.load_report(mirror_for(spark, sf_dir))


@register("load_graph", with_graph(_REPORT_SQL.format(p="g_")))
def q_load_graph(spark, sf_dir):
    """Write the mirror to shared storage and report what was read back."""
    return etl.load_graph(mirror_for(spark, sf_dir))


# Per-label and edge caps of the capped-load query.
CAP_PER_LABEL = 100
CAP_EDGES = 500


@register("load_capped", with_graph(f"""
SELECT * FROM (SELECT 'officers' AS table_name, node_id FROM g_officers ORDER BY node_id LIMIT {CAP_PER_LABEL})
UNION ALL SELECT * FROM (SELECT 'entities', node_id FROM g_entities ORDER BY node_id LIMIT {CAP_PER_LABEL})
UNION ALL SELECT * FROM (SELECT 'intermediaries', node_id FROM g_intermediaries ORDER BY node_id LIMIT {CAP_PER_LABEL})
UNION ALL SELECT * FROM (SELECT 'addresses', node_id FROM g_addresses ORDER BY node_id LIMIT {CAP_PER_LABEL})
UNION ALL SELECT * FROM (SELECT 'relationships', id FROM g_relationships ORDER BY id LIMIT {CAP_EDGES})"""))
def q_load_capped(spark, sf_dir):
    m = etl.load_capped(graph_for(spark, sf_dir), CAP_PER_LABEL, CAP_EDGES)
    parts = [df.select(F.lit(name).alias("table_name"),
                       F.col("id" if name == "relationships" else "node_id").alias("node_id"))
             for name, df in m.tables().items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("insert_or_ignore", with_graph("""
SELECT node_id, name, 'intermediaries' AS batch FROM g_intermediaries
WHERE node_id NOT IN (SELECT node_id FROM g_officers)
UNION ALL SELECT node_id, name, 'officers' FROM g_officers"""))
def q_insert_or_ignore(spark, sf_dir):
    """Officers, then intermediaries appended to a stored table: only keys it lacks stay, and appending them again,
    as the same batch or as another, adds nothing."""
    m = mirror_for(spark, sf_dir)
    officers, others = m.officers.select("node_id", "name"), m.intermediaries.select("node_id", "name")
    table = etl.KeyedTable(spark, f"{checkpoint_dir(spark).rstrip('/')}/keyed-{uuid.uuid4().hex}", officers.schema, "node_id")
    for batch, rows in (("officers", officers), ("intermediaries", others), ("intermediaries", others), ("again", others)):
        table.append(rows, batch)
    return reduce(DataFrame.unionByName, (table.read([b]).withColumn("batch", F.lit(b)) for b in table.published()))


_QUALITY_SQL = """
SELECT 'officers.pk_duplicate' AS rule, (SELECT count(*) FROM (SELECT node_id FROM g_officers GROUP BY 1 HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'entities.pk_duplicate', (SELECT count(*) FROM (SELECT node_id FROM g_entities GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'intermediaries.pk_duplicate', (SELECT count(*) FROM (SELECT node_id FROM g_intermediaries GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'addresses.pk_duplicate', (SELECT count(*) FROM (SELECT node_id FROM g_addresses GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'relationships.pk_duplicate', (SELECT count(*) FROM (SELECT id FROM g_relationships GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'officers.name_null', (SELECT count(*) FROM g_officers WHERE name IS NULL)
UNION ALL SELECT 'entities.name_null', (SELECT count(*) FROM g_entities WHERE name IS NULL)
UNION ALL SELECT 'intermediaries.name_null', (SELECT count(*) FROM g_intermediaries WHERE name IS NULL)
UNION ALL SELECT 'addresses.address_null_quarantined', (SELECT count(*) FROM g_address_rows WHERE address IS NULL)
UNION ALL SELECT 'relationships.rel_type_null', (SELECT count(*) FROM g_relationships WHERE rel_type IS NULL)
UNION ALL SELECT 'relationships.start_null', (SELECT count(*) FROM g_relationships WHERE start_id IS NULL)
UNION ALL SELECT 'relationships.end_null', (SELECT count(*) FROM g_relationships WHERE end_id IS NULL)
UNION ALL SELECT 'relationships.dangling_start', (SELECT count(*) FROM g_relationships WHERE start_id NOT IN (SELECT node_id FROM g_all_nodes))
UNION ALL SELECT 'relationships.dangling_end', (SELECT count(*) FROM g_relationships WHERE end_id NOT IN (SELECT node_id FROM g_all_nodes))
UNION ALL SELECT 'nodes.in_no_table', (SELECT count(*) FROM g_nodes WHERE len(list_intersect(labels, ['Officer', 'Entity', 'Intermediary', 'Address'])) = 0)
UNION ALL SELECT 'nodes.in_several_tables', (SELECT count(*) FROM g_nodes WHERE len(list_intersect(labels, ['Officer', 'Entity', 'Intermediary', 'Address'])) > 1)"""


@register("quality_report", with_graph(_QUALITY_SQL))
def q_quality_report(spark, sf_dir):
    return quality.quality_report(graph_for(spark, sf_dir))


# -- search -------------------------------------------------------------------------

@register("search_contains", with_graph("""
SELECT id, name FROM g_nodes WHERE list_contains(labels, 'Officer')
  AND contains(lower(name), lower((SELECT name_fragment FROM g_ctx)))"""))
def q_search_contains(spark, sf_dir):
    ctx = context_for(spark, sf_dir)
    return search.search_contains(graph_for(spark, sf_dir), ctx.name_fragment)


@register("search_contains_cs", with_graph("""
SELECT id, name FROM g_nodes WHERE list_contains(labels, 'Officer')
  AND contains(name, (SELECT name_fragment FROM g_ctx))"""))
def q_search_contains_cs(spark, sf_dir):
    ctx = context_for(spark, sf_dir)
    return search.search_contains(graph_for(spark, sf_dir), ctx.name_fragment,
                                  case_sensitive=True)


@register("search_ilike", with_graph("""
SELECT node_id, name FROM g_officers
WHERE name ILIKE '%' || replace((SELECT name_fragment FROM g_ctx), '#', '_') || '%'"""))
def q_search_ilike(spark, sf_dir):
    """The fragment with '#' turned into '_' — which ILIKE treats as a one-character wildcard."""
    ctx = context_for(spark, sf_dir)
    return search.search_ilike(loaded_mirror_for(spark, sf_dir).officers,
                               ctx.name_fragment.replace("#", "_"))


@register("search_nodes", with_graph(f"""
SELECT n.id, k.kind, v.name, coalesce(n.countries, n.country) AS country,
       n.jurisdiction_description AS jurisdiction
FROM g_nodes n JOIN g_nv v ON v.id = n.id
JOIN (VALUES ('Officer'), ('Entity'), ('Intermediary')) k(kind) ON list_contains(n.labels, k.kind)
WHERE contains(lower(n.name), lower('{SEARCH_TERM}'))"""))
def q_search_nodes(spark, sf_dir):
    return search.search_nodes(graph_for(spark, sf_dir), SEARCH_TERM)


@register("search_short_query", with_graph(f"""
SELECT '{SHORT_TERM}' AS term, CAST(0 AS BIGINT) AS hits
UNION ALL
SELECT '{SEARCH_TERM}', count(*) FROM g_nodes n
JOIN (VALUES ('Officer'), ('Entity'), ('Intermediary')) k(kind) ON list_contains(n.labels, k.kind)
WHERE contains(lower(n.name), lower('{SEARCH_TERM}'))"""))
def q_search_short_query(spark, sf_dir):
    """Hits of a term below the guard's length (none, though names hold it) beside those of a longer one."""
    g = graph_for(spark, sf_dir)
    counts = [search.search_nodes(g, t).agg(F.count(F.lit(1)).alias("hits")).select(F.lit(t).alias("term"), "hits")
              for t in (SHORT_TERM, SEARCH_TERM)]
    return counts[0].unionByName(counts[1])


@register("lookup_ids", with_graph("""
SELECT id, kind, name FROM g_nv
WHERE id IN (SELECT officer_id FROM g_ctx UNION ALL SELECT path_target_id FROM g_ctx)"""))
def q_lookup_ids(spark, sf_dir):
    ctx = context_for(spark, sf_dir)
    ids = [i for i in (ctx.officer_id, ctx.path_target_id) if i is not None]
    return search.lookup_ids(graph_for(spark, sf_dir), ids)


def _hub_table_name(spark, sf_dir):
    ctx = context_for(spark, sf_dir)
    m = loaded_mirror_for(spark, sf_dir)
    return m.officers.filter(F.col("node_id") == ctx.officer_id).select("name").first()["name"]


_HUB_NAME = "(SELECT name FROM g_officers WHERE node_id = (SELECT officer_id FROM g_hub))"


@register("lookup_name", with_graph(f"SELECT node_id, name FROM g_officers WHERE name = {_HUB_NAME}"))
def q_lookup_name(spark, sf_dir):
    return search.lookup_name(loaded_mirror_for(spark, sf_dir).officers, _hub_table_name(spark, sf_dir))


@register("resolve_name", with_graph(f"""
SELECT min(node_id) AS node_id FROM g_officers WHERE name = {_HUB_NAME}
HAVING min(node_id) IS NOT NULL"""))
def q_resolve_name(spark, sf_dir):
    return search.resolve_name(loaded_mirror_for(spark, sf_dir).officers, _hub_table_name(spark, sf_dir))


_TOKENS_SQL = r"""
g_tokens AS (
  SELECT DISTINCT token, node_id, kind FROM (
    SELECT unnest(string_split_regex(lower(name), '[^\p{L}\p{N}]+')) AS token, node_id, kind
    FROM g_all_nodes WHERE kind IN ('Officer', 'Entity', 'Intermediary'))
  WHERE token <> '')"""


@register("token_index", with_graph("SELECT token, node_id, kind FROM g_tokens", _TOKENS_SQL))
def q_token_index(spark, sf_dir):
    return token_index_for(spark, sf_dir).postings.select("token", "node_id", "kind")


@register("token_search", with_graph(rf"""
SELECT node_id, kind, count(DISTINCT token) AS matched FROM g_tokens
WHERE token IN (SELECT unnest(string_split_regex(lower({_HUB_NAME}), '[^\p{{L}}\p{{N}}]+')))
GROUP BY node_id, kind
HAVING count(DISTINCT token) = (SELECT count(DISTINCT t) FROM (
  SELECT unnest(string_split_regex(lower({_HUB_NAME}), '[^\p{{L}}\p{{N}}]+')) AS t) WHERE t <> '')""",
    _TOKENS_SQL))
def q_token_search(spark, sf_dir):
    return search.token_search(token_index_for(spark, sf_dir), _hub_table_name(spark, sf_dir))


_TWO_WORDS = "(SELECT name FROM g_entities WHERE node_id = (SELECT min(node_id) FROM g_entities))"


@register("token_search_words", with_graph(rf"""
SELECT node_id, kind, count(*) AS matched FROM g_tokens
WHERE token IN (SELECT unnest(string_split_regex(lower({_TWO_WORDS}), '[^\p{{L}}\p{{N}}]+')))
GROUP BY node_id, kind
HAVING count(*) = (SELECT count(DISTINCT t) FROM (
  SELECT unnest(string_split_regex(lower({_TWO_WORDS}), '[^\p{{L}}\p{{N}}]+')) AS t) WHERE t <> '')""",
    _TOKENS_SQL))
def q_token_search_words(spark, sf_dir):
    """All names that hold the words of the first entity's name: two common tokens, many hits."""
    entities = loaded_mirror_for(spark, sf_dir).entities
    words = entities.agg(F.min_by("name", "node_id")).first()[0]
    return search.token_search(token_index_for(spark, sf_dir), words)


@register("search_page", with_graph(f"""
SELECT n.id, k.kind, n.name, coalesce(n.countries, n.country) AS country, n.jurisdiction_description AS jurisdiction
FROM g_nodes n JOIN (VALUES ('Officer'), ('Entity'), ('Intermediary')) k(kind) ON list_contains(n.labels, k.kind)
WHERE contains(lower(n.name), 'er') ORDER BY k.kind, n.id LIMIT 100"""))
def q_search_page(spark, sf_dir):
    """The first hits of a common fragment; the limit asked for is beyond the most a search gives."""
    return search.search_page(graph_for(spark, sf_dir), " eR ", 1_000)


@register("country_counts", with_graph("""
SELECT coalesce(countries, country) AS country, kind, count(*) AS nodes FROM g_view GROUP BY 1, 2"""))
def q_country_counts(spark, sf_dir):
    return search.country_counts(graph_for(spark, sf_dir))


# -- display mappings ----------------------------------------------------------------

@register("node_kind", with_graph("SELECT id, kind FROM g_view"))
def q_node_kind(spark, sf_dir):
    return mapping.node_kind(graph_for(spark, sf_dir))


@register("map_nodes", with_graph("""
SELECT v.id, v.kind, v.name, coalesce(n.countries, n.country) AS country,
       n.jurisdiction_description AS jurisdiction, n.status, n.sourceID
FROM g_nv v JOIN g_nodes n ON n.id = v.id"""))
def q_map_nodes(spark, sf_dir):
    return mapping.map_nodes(graph_for(spark, sf_dir))


@register("map_edges", with_graph("""
SELECT 'r' || CAST(id AS VARCHAR) AS id, type, src AS source, dst AS target, link, start_date,
       CAST(NULL AS VARCHAR) AS end_date FROM g_edges"""))
def q_map_edges(spark, sf_dir):
    return mapping.map_edges(graph_for(spark, sf_dir))


def _detail_sql() -> str:
    present = {"name", "address", "country", "countries", "jurisdiction",
               "jurisdiction_description", "status", "sourceID", "note"}
    items = []
    for i, (k, c) in enumerate(mapping.DETAIL_KEYS):
        val = k if k in present else "CAST(NULL AS VARCHAR)"
        items.append(f"struct_pack(pos := {i}, key := '{k}', caption := '{c}', value := {val})")
    return f"""
SELECT id, pos, key, caption, value FROM (
  SELECT id, unnest([{', '.join(items)}], recursive := true) FROM g_nodes)
WHERE value IS NOT NULL AND value <> ''"""


@register("node_detail", with_graph(_detail_sql()))
def q_node_detail(spark, sf_dir):
    return mapping.node_detail(graph_for(spark, sf_dir))


def _kind_values() -> str:
    return ", ".join(f"('{k}', '{c}', '{col}')" for k, c, col in mapping.KIND_STYLE)


@register("kind_caption", with_graph(f"""
SELECT v.kind, v.id, s.caption, s.color FROM g_view v
LEFT JOIN (VALUES {_kind_values()}) s(kind, caption, color) ON s.kind = v.kind"""))
def q_kind_caption(spark, sf_dir):
    return mapping.kind_caption(graph_for(spark, sf_dir))


@register("edge_caption", with_graph(
    "SELECT id, type, replace(type, '_', ' ') AS caption FROM g_edges"))
def q_edge_caption(spark, sf_dir):
    return mapping.edge_captions(graph_for(spark, sf_dir))


@register("dedupe_edges", with_graph("""
SELECT DISTINCT id, type, src, dst FROM (
  SELECT * FROM (SELECT id, type, src, dst FROM g_edges
    WHERE src = (SELECT officer_id FROM g_hub) OR dst = (SELECT officer_id FROM g_hub) ORDER BY id LIMIT 80)
  UNION ALL
  SELECT * FROM (SELECT id, type, src, dst FROM g_edges
    WHERE src = (SELECT path_target_id FROM g_ctx) OR dst = (SELECT path_target_id FROM g_ctx) ORDER BY id LIMIT 80))"""))
def q_dedupe_edges(spark, sf_dir):
    """Two displayed neighbourhoods (hub and path target) merged: each edge once."""
    ctx = context_for(spark, sf_dir)
    g = graph_for(spark, sf_dir)
    return mapping.dedupe_edges(pattern.neighborhood_edges(g, ctx.officer_id, 80),
                                pattern.neighborhood_edges(g, ctx.path_target_id, 80))
