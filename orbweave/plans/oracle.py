"""Independent DuckDB definitions of the fixture graph, its mirror and its context.

Each oracle query is ``WITH <these CTEs> SELECT ...`` over the driver's
pre-registered table views. The Spark side is built with the DataFrame API in
``orbweave.sources``; only the *definitions* agree, no code is shared.
"""

from __future__ import annotations

import re

# Whitespace class (RE2 needs \x0b added; its \s lacks vertical tab).
WS = r"[\s\p{Z}\x{FEFF}\x0b]"


def norm(x: str) -> str:
    return f"NULLIF(regexp_replace(CAST({x} AS VARCHAR), '^{WS}+|{WS}+$', '', 'g'), '')"


def fragment(x: str) -> str:
    return (f"coalesce(list_filter(string_split_regex({x}, '{WS}+'), lambda t: length(t) >= 4)[1], "
            f"substr({x}, 1, 6))")


_NODE_COLS = ("name, address, country_codes, country, countries, jurisdiction, "
              "jurisdiction_description, status, note, sourceID")

GRAPH_CTES = f"""
g_nodes AS (
  SELECT 1000000000000000 + c_custkey AS id,
         CASE WHEN c_custkey % 50 = 0 THEN ['Intermediary', 'Officer'] ELSE ['Officer'] END AS labels,
         CASE WHEN c_custkey % 11 = 0 THEN '  '
              WHEN c_custkey % 11 = 1 THEN chr(9) || c_name || ' ' ELSE c_name END AS name,
         CAST(NULL AS VARCHAR) AS address,
         CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 = 1 THEN NULL
              ELSE 'N' || CAST(c_nationkey AS VARCHAR) END AS country_codes,
         n_name AS country, n_name AS countries,
         CAST(NULL AS VARCHAR) AS jurisdiction, CAST(NULL AS VARCHAR) AS jurisdiction_description,
         CAST(NULL AS VARCHAR) AS status, c_mktsegment AS note,
         'Source ' || CAST(c_custkey % 3 AS VARCHAR) AS sourceID
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT 2000000000000000 + p_partkey, ['Entity'], p_name, NULL, NULL, NULL, NULL, p_brand, p_type,
         CASE WHEN p_size >= 25 THEN 'Active' ELSE 'Defaulted' END, NULL, NULL FROM part
  UNION ALL
  SELECT 3000000000000000 + s_suppkey, ['Intermediary'], s_name, NULL, NULL, NULL, NULL, NULL, NULL,
         NULL, NULL, NULL FROM supplier
  UNION ALL
  SELECT 4000000000000000 + n_nationkey, ['Address'], NULL, CASE WHEN n_nationkey % 7 = 3 THEN ' ' || chr(9) ELSE n_name END, NULL, NULL, NULL, NULL, NULL,
         NULL, NULL, NULL FROM nation
  UNION ALL
  SELECT 5000000000000000 + r_regionkey, ['Other'], r_name, NULL, NULL, NULL, NULL, NULL, NULL,
         NULL, NULL, NULL FROM region
),
g_pairs_of AS (
  SELECT l_orderkey, l_partkey, min(o_custkey) AS cust, min(l_suppkey) AS supp,
         min(l_returnflag) AS link, min(l_linestatus) AS status,
         CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR) AS start_date
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, l_partkey
),
g_numbered AS (
  SELECT *, l_orderkey * 4096 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) - 1 AS k FROM g_pairs_of
),
g_edges AS (
  SELECT {1 * 2**60} + k AS id, 'officer_of' AS type,
         1000000000000000 + cust AS src, 2000000000000000 + l_partkey AS dst, link, status, start_date
  FROM g_numbered WHERE cust IS NOT NULL
  UNION ALL
  SELECT {2 * 2**60} + k, 'intermediary_of', 3000000000000000 + supp, 2000000000000000 + l_partkey, link, status, start_date
  FROM g_numbered
  UNION ALL
  SELECT {3 * 2**60} + c_custkey, 'REGISTERED_ADDRESS', 1000000000000000 + c_custkey,
         4000000000000000 + c_nationkey, NULL, NULL, NULL
  FROM customer
  UNION ALL
  SELECT {4 * 2**60} + c_custkey, 'connected_to', 1000000000000000 + c_custkey,
         1000000000000000 + (c_custkey * 7 + 4) % (SELECT count(*) FROM customer), NULL, NULL, NULL
  FROM customer
),
g_view AS (
  SELECT id, labels,
         CASE WHEN list_contains(labels, 'Officer') THEN 'Officer'
              WHEN list_contains(labels, 'Entity') THEN 'Entity'
              WHEN list_contains(labels, 'Intermediary') THEN 'Intermediary'
              WHEN list_contains(labels, 'Address') THEN 'Address' ELSE 'Other' END AS kind,
         {_NODE_COLS}
  FROM g_nodes
),
g_nv AS (
  SELECT id, kind, coalesce(name, address, kind || ' #' || CAST(id AS VARCHAR)) AS name, labels
  FROM g_view
),
g_officers AS (
  SELECT id AS node_id, coalesce({norm('name')}, 'Officer #' || CAST(id AS VARCHAR)) AS name,
         {norm('coalesce(country_codes, country)')} AS country, {norm('countries')} AS countries,
         {norm('sourceID')} AS sourceID, CAST(NULL AS VARCHAR) AS valid_until,
         {norm('note')} AS note
  FROM g_nodes WHERE list_contains(labels, 'Officer')
),
g_entities AS (
  SELECT id AS node_id, coalesce({norm('name')}, 'Entity #' || CAST(id AS VARCHAR)) AS name,
         CAST(NULL AS VARCHAR) AS original_name, CAST(NULL AS VARCHAR) AS former_name,
         {norm('jurisdiction')} AS jurisdiction, {norm('jurisdiction_description')} AS jurisdiction_desc,
         CAST(NULL AS VARCHAR) AS company_type, {norm('address')} AS address,
         CAST(NULL AS DATE) AS incorporation_date, CAST(NULL AS DATE) AS inactivation_date,
         CAST(NULL AS DATE) AS struck_off_date, {norm('status')} AS status,
         CAST(NULL AS VARCHAR) AS service_provider, {norm('sourceID')} AS sourceID,
         CAST(NULL AS VARCHAR) AS valid_until, {norm('note')} AS note
  FROM g_nodes WHERE list_contains(labels, 'Entity')
),
g_intermediaries AS (
  SELECT id AS node_id, coalesce({norm('name')}, 'Intermediary #' || CAST(id AS VARCHAR)) AS name,
         {norm('coalesce(country_codes, country)')} AS country, {norm('countries')} AS countries,
         {norm('status')} AS status, {norm('sourceID')} AS sourceID,
         CAST(NULL AS VARCHAR) AS valid_until, {norm('note')} AS note
  FROM g_nodes WHERE list_contains(labels, 'Intermediary')
),
g_address_rows AS (
  SELECT id AS node_id, {norm('coalesce(address, name)')} AS address, {norm('name')} AS name,
         {norm('coalesce(country_codes, country)')} AS country, {norm('countries')} AS countries,
         {norm('sourceID')} AS sourceID, CAST(NULL AS VARCHAR) AS valid_until,
         {norm('note')} AS note
  FROM g_nodes WHERE list_contains(labels, 'Address')
),
g_addresses AS (SELECT * FROM g_address_rows WHERE address IS NOT NULL),
g_relationships AS (
  SELECT id, lower(type) AS rel_type, src AS start_id, dst AS end_id, {norm('link')} AS link,
         {norm('status')} AS status, CAST(NULL AS DATE) AS start_date,
         CAST(NULL AS DATE) AS end_date, CAST(NULL AS VARCHAR) AS sourceID
  FROM g_edges
),
g_all_nodes AS (
  SELECT node_id, name, 'Officer' AS kind FROM g_officers
  UNION ALL SELECT node_id, name, 'Entity' FROM g_entities
  UNION ALL SELECT node_id, name, 'Intermediary' FROM g_intermediaries
  UNION ALL SELECT node_id, address, 'Address' FROM g_addresses
),
g_oe AS (
  SELECT e.* FROM g_edges e JOIN g_nodes a ON a.id = e.src JOIN g_nodes b ON b.id = e.dst
  WHERE list_contains(a.labels, 'Officer') AND list_contains(b.labels, 'Entity')
),
g_ie AS (
  SELECT e.* FROM g_edges e JOIN g_nodes a ON a.id = e.src JOIN g_nodes b ON b.id = e.dst
  WHERE list_contains(a.labels, 'Intermediary') AND list_contains(b.labels, 'Entity')
),
g_of_type AS (SELECT type FROM g_oe GROUP BY type ORDER BY count(*) DESC, type LIMIT 1),
g_im_type AS (SELECT type FROM g_ie GROUP BY type ORDER BY count(*) DESC, type LIMIT 1),
g_hub AS (
  SELECT d.officer_id, d.degree, v.name FROM (
    SELECT src AS officer_id, count(*) AS degree FROM g_oe GROUP BY src
    ORDER BY degree DESC, officer_id LIMIT 1) d JOIN g_nv v ON v.id = d.officer_id
),
g_h1 AS (  -- the hub's entities
  SELECT DISTINCT dst AS e FROM g_edges
  WHERE src = (SELECT officer_id FROM g_hub) AND type = (SELECT type FROM g_of_type)
),
g_hi AS (  -- intermediaries of those entities, with their number of edges into them
  SELECT src AS i, count(*) AS c FROM g_edges
  WHERE type = (SELECT type FROM g_im_type) AND dst IN (SELECT e FROM g_h1) GROUP BY src
),
g_h2 AS (  -- entities of those intermediaries by another edge
  SELECT DISTINCT x.dst AS e FROM g_edges x JOIN g_hi ON g_hi.i = x.src
  WHERE x.type = (SELECT type FROM g_im_type) AND (g_hi.c >= 2 OR x.dst NOT IN (SELECT e FROM g_h1))
),
g_co AS (
  SELECT DISTINCT src AS other FROM g_edges
  WHERE type = (SELECT type FROM g_of_type) AND dst IN (SELECT e FROM g_h2)
    AND src <> (SELECT officer_id FROM g_hub)
    AND src IN (SELECT id FROM g_nodes WHERE list_contains(labels, 'Officer'))
),
g_ctx AS (
  SELECT {fragment('h.name')} AS name_fragment, h.name AS officer_name,
         h.officer_id, (SELECT type FROM g_of_type) AS officer_of_type,
         (SELECT type FROM g_im_type) AS intermediary_of_type,
         h.officer_id AS path_source_id, (SELECT min(other) FROM g_co) AS path_target_id,
         5 AS max_hops
  FROM g_hub h
),
g_adj AS (
  SELECT src AS u, dst AS v FROM g_edges UNION SELECT dst, src FROM g_edges
)
"""


def _ctes(text: str) -> dict[str, str]:
    """name -> "name AS (...)" of a list of CTEs."""
    starts = [(m.start(), m[1]) for m in re.finditer(r"^(\w+) AS \(", text, re.M)]
    ends = [at for at, _ in starts[1:]] + [len(text)]
    return {name: text[at:end].strip().rstrip(",") for (at, name), end in zip(starts, ends, strict=True)}


_GRAPH = _ctes(GRAPH_CTES)


def with_graph(select_sql: str, extra_ctes: str = "", recursive: bool = False) -> str:
    """Prefix ``select_sql`` with the graph CTEs it needs (and optional extra CTEs)."""
    text = f"{select_sql}\n{extra_ctes}"
    need: set[str] = set()
    todo = [n for n in _GRAPH if re.search(rf"\b{n}\b", text)]
    while todo:
        name = todo.pop()
        if name not in need:
            need.add(name)
            todo += [n for n in _GRAPH if re.search(rf"\b{n}\b", _GRAPH[name].split(" AS (", 1)[1])]
    head = "WITH RECURSIVE" if recursive else "WITH"
    parts = [cte for name, cte in _GRAPH.items() if name in need] + ([extra_ctes.strip()] if extra_ctes.strip() else [])
    return f"{head}\n" + ",\n".join(parts) + f"\n{select_sql.strip()}" if parts else select_sql.strip()
