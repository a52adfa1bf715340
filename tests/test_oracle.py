"""queries() against oracle_sql() on the smallest scale factor (DuckDB as the oracle)."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
# A representative slice per operator family; tools/check_oracle.py runs every key.
KEYS = ["co_officers", "co_officers_sql", "sample_context", "stats_totals", "etl_officers",
        "etl_edges", "quality_report", "search_nodes", "token_search", "node_detail",
        "khop_edges", "shortest_path_edges", "depth_sweep", "pagerank_directed", "louvain_pass", "enrich_view_pass",
        "merge_edges", "patch_nodes", "create_nodes", "validate_edges", "simple_paths_directed", "match_chain"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_callable_and_most_have_oracles():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in q if k != "pipeline" and not re.match(r"op\d+_", k)}  # the others have tests of their own
    assert own - set(o) == {"louvain_khop", "louvain_modularity", "enrich_view"}


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["officer_id", "name"]
    assert df.count() > 0
