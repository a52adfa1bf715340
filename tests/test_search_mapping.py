"""Search semantics, display mappings and statistics rules on tiny graphs."""

import pytest
from pyspark.sql import functions as F

from orbweave.operators import mapping, search, stats
from orbweave.sources import etl


@pytest.fixture(scope="module")
def g(make_graph):
    nodes = [
        (1, ["Officer"], {"name": "Anna a%b Lima", "country": "BR"}),
        (2, ["Officer"], {"name": "Anna aXb Lima"}),
        (3, ["Intermediary", "Officer"], {"name": "Bank Anna", "countries": "PT",
                                          "jurisdiction_description": "Panama"}),
        (4, ["Entity"], {"name": "Ann Co", "status": ""}),
        (5, ["Address"], {"address": "Main St"}),
    ]
    return make_graph(nodes, [(10, "officer_of", 1, 4)])


def _ids(df, col="id"):
    return sorted(r[col] for r in df.collect())


def test_contains_is_literal_but_ilike_is_a_pattern(g):
    assert _ids(search.search_contains(g, "A%B")) == [1]
    officers = etl.etl_officers(g)
    assert _ids(search.search_ilike(officers, "a%b"), "node_id") == [1, 2]


def test_multi_kind_search_repeats_two_label_nodes(g):
    hits = [(r["id"], r["kind"]) for r in search.search_nodes(g, "anna").collect()]
    assert sorted(hits) == [(1, "Officer"), (2, "Officer"), (3, "Intermediary"), (3, "Officer")]
    row = [r for r in search.search_nodes(g, "bank").collect()][0]
    assert row["country"] == "PT" and row["jurisdiction"] == "Panama"


def test_short_query_returns_empty_frame_with_schema(g):
    out = search.search_nodes(g, "  a ")
    assert out.count() == 0 and out.columns == ["id", "kind", "name", "country", "jurisdiction"]


def test_first_label_statistics_differ_from_kind_priority(g):
    labels = {r["label"]: r["total"] for r in stats.stats_nodes(g).collect()}
    assert labels == {"Officer": 2, "Intermediary": 1, "Entity": 1, "Address": 1}
    kinds = {r["id"]: r["kind"] for r in mapping.node_kind(g).collect()}
    assert kinds[3] == "Officer"


def test_name_fragment_rule(spark):
    from orbweave.functions.text import name_fragment
    df = spark.createDataFrame([("Al Bo Carla",), ("ab cd ef",), ("  ",)], "n string")
    got = [r[0] for r in df.select(name_fragment(F.col("n"))).collect()]
    assert got == ["Carla", "ab cd ", "  "]


def test_node_detail_drops_empty_and_keeps_order(g):
    rows = mapping.node_detail(g).filter("id = 4").orderBy("pos").collect()
    assert [r["key"] for r in rows] == ["name"]  # empty status dropped
    rows = mapping.node_detail(g).filter("id = 3").orderBy("pos").collect()
    assert [r["key"] for r in rows] == ["name", "countries", "jurisdiction_description"]


def test_token_search_needs_every_token(g):
    index = search.token_index(etl.all_nodes(etl.mirror(g)))
    assert _ids(search.token_search(index, "anna lima"), "node_id") == [1, 2]
    assert _ids(search.token_search(index, "Lima, Anna!"), "node_id") == [1, 2]
    assert _ids(search.token_search(index, "bank"), "node_id") == [3, 3]


def test_address_name_falls_back_to_address(g):
    names = {r["id"]: r["name"] for r in mapping.map_nodes(g).collect()}
    assert names[5] == "Main St"
