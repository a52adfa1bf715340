"""Normalisation rules of the mirror and the change-batch operators."""

import pytest
from pyspark.sql import functions as F

from orbweave.operators import mutate
from orbweave.sources import etl, quality


@pytest.fixture(scope="module")
def dirty(make_graph):
    nodes = [
        (1, ["Officer"], {"name": "  "}),
        (2, ["Officer"], {"name": "\tx ", "country_codes": "", "country": "BR"}),
        (3, ["Intermediary", "Officer"], {"name": "Both", "country": "PT"}),
        (4, ["Unknown"], {"name": "odd"}),
        (5, ["Address"], {}),
        (6, ["Address"], {"name": "﻿Street 1 "}),
    ]
    edges = [(10, "OFFICER_OF", 1, 4), (11, "connected_to", 2, 3)]
    return make_graph(nodes, edges)


def test_officer_defaults_and_trimming(dirty):
    rows = {r["node_id"]: r for r in etl.etl_officers(dirty).collect()}
    assert rows[1]["name"] == "Officer #1"
    assert rows[2]["name"] == "x"
    assert rows[2]["country"] is None  # empty country_codes hides country
    assert rows[3]["country"] == "PT"


def test_two_labels_two_tables_and_quarantine(dirty):
    m = etl.mirror(dirty)
    assert m.intermediaries.filter("node_id = 3").count() == 1
    assert m.officers.filter("node_id = 3").count() == 1
    assert [r["node_id"] for r in m.quarantine.collect()] == [5]
    assert [r["address"] for r in m.addresses.collect()] == ["Street 1"]


def test_edge_type_lowercase_and_dangling_report(dirty):
    m = etl.mirror(dirty)
    assert sorted(r["rel_type"] for r in m.relationships.collect()) == ["connected_to", "officer_of"]
    report = {r["rule"]: r["violations"] for r in quality.quality_report(dirty).collect()}
    assert report["relationships.dangling_end"] == 1      # node 4 has no table
    assert report["nodes.in_no_table"] == 1
    assert report["nodes.in_several_tables"] == 1
    assert report["addresses.address_null_quarantined"] == 1


def test_insert_or_ignore_first_row_per_key(spark):
    target = spark.createDataFrame([(1, "a")], "node_id long, name string")
    batch = spark.createDataFrame([(1, "x", 1), (2, "late", 2), (2, "early", 1)],
                                  "node_id long, name string, seq int")
    out = etl.insert_or_ignore(target, batch, "node_id", order_col="seq").collect()
    assert [(r["node_id"], r["name"]) for r in out] == [(2, "early")]


def test_merge_twice_equals_once(make_graph, spark):
    g = make_graph([(1, ["Officer"], {}), (2, ["Entity"], {})], [])
    batch = spark.createDataFrame([(0, 1, 2, "OFFICER_OF"), (1, 1, 2, "officer_of"),
                                   (2, 1, 99, "officer_of"), (3, 1, 2, "bad type")],
                                  "request_id long, src long, dst long, type string")
    once = mutate.merge_edges(g, batch, "t0")
    twice = mutate.merge_edges(once.graph, batch, "t1")
    assert once.graph.edges.count() == 1 and twice.graph.edges.count() == 1
    status = {r["request_id"]: r["status"] for r in once.results.collect()}
    assert status == {0: "created", 1: "matched"}
    reasons = {r["request_id"]: r["reason"] for r in once.rejected.collect()}
    assert reasons == {2: "endpoint not found", 3: "type must be an identifier"}


def test_patch_null_removes_and_last_wins(make_graph, spark):
    g = make_graph([(1, ["Entity"], {"status": "Active", "note": "n"})], [])
    patches = spark.createDataFrame(
        [(1, "note", None, 1), (1, "status", "A", 1), (1, "status", "B", 2), (7, "x", "y", 1)],
        "id long, key string, value string, seq int")
    out = mutate.patch_nodes(g, patches, "t")
    props = out.graph.nodes.first()["props"]
    assert props == {"status": "B", "updated_at": "t"}
    assert [r["id"] for r in out.rejected.collect()] == [7]


def test_detach_delete_leaves_no_dangling(make_graph, spark):
    g = make_graph([(i, ["Officer"], {}) for i in (1, 2, 3)],
                   [(10, "connected_to", 1, 2), (11, "connected_to", 3, 1), (12, "connected_to", 2, 3)])
    out = mutate.detach_delete_nodes(g, spark.createDataFrame([(1,), (42,)], "id long"))
    assert [r["id"] for r in out.graph.edges.collect()] == [12]
    assert sorted(r["id"] for r in out.graph.nodes.collect()) == [2, 3]


def test_create_validation(make_graph, spark):
    g = make_graph([(5, ["Officer"], {})], [])
    batch = spark.createDataFrame([(1, "Entity", "Acme", None, None, None),
                                   (2, "Company", "Bad", None, None, None),
                                   (3, "Officer", "", None, None, None)],
                                  "request_id long, kind string, name string, country string, "
                                  "jurisdiction string, note string")
    out = mutate.create_nodes(g, batch, "t")
    assert [(r["request_id"], r["id"]) for r in out.results.collect()] == [(1, 7)]
    assert {r["request_id"]: r["reason"] for r in out.rejected.collect()} == {
        2: "kind not allowed", 3: "name required"}


def test_keyed_table_appends_each_batch_once(spark, tmp_path):
    form = "node_id long, name string"
    table = etl.KeyedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], form).schema, "node_id")
    first = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "x", 1), (2, "w", 1), (None, "no key", 1)], f"{form}, seq int")
    assert table.read().count() == 0
    assert table.append(first, "one", "seq") and not table.append(first, "one", "seq")
    # a run that died after its data, before it was published: not read, and written over
    spark.createDataFrame([(9, "left")], form).write.parquet(f"{table.path}/data/batch=two")
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "a"), (2, "w")]
    assert table.append(spark.createDataFrame([(2, "late"), (3, "y")], form), "two")
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "a"), (2, "w"), (3, "y")]
    assert [r["node_id"] for r in table.read(["two"]).collect()] == [3]
    with pytest.raises(ValueError):
        table.append(first, "a/b")


def test_patch_rows_that_cant_be_used(make_graph, spark):
    g = make_graph([(1, ["Entity"], {"status": "Active", "note": "n"})], [])
    form = "id long, key string, json string, seq int"
    rows = [(1, None, '"x"', 1), (1, "", '"x"', 1), (None, "note", '"x"', 1), (1, "a", "true", 1), (1, "b", '{"k": 1}', 1), (1, "c", "[1]", 1),
            (1, "note", "null", 1), (1, "status", '"B"', 1), (1, "size", "12", 1), (1, "share", "0.25", 1), (1, "none", None, 1), (7, "x", '"y"', 1)]
    patches = spark.createDataFrame(rows, form).select("id", "key", F.parse_json("json").alias("value"), "seq")
    out = mutate.patch_nodes(g, patches, "2026-01-01T00:00:00Z")
    assert out.graph.nodes.first()["props"] == {"status": "B", "size": "12", "share": "0.25", "updated_at": "2026-01-01T00:00:00Z"}
    wrong = "value must be string, number or null"
    assert sorted(((r["id"], r["key"], r["reason"]) for r in out.rejected.collect()), key=str) == sorted([
        (1, None, "key required"), (1, "", "key required"), (None, "note", "id required"), (1, "a", wrong), (1, "b", wrong), (1, "c", wrong),
        (7, None, "node not found")], key=str)
    assert mutate.patch_nodes(g, patches.limit(0), "t").graph.nodes.first()["props"] == {"status": "Active", "note": "n"}


def test_stamps_are_times(make_graph, spark):
    from datetime import datetime, timezone
    g = make_graph([(1, ["Entity"], {"created_at": "not a time"}), (2, ["Entity"], {})], [])
    at = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    out = mutate.patch_nodes(g, spark.createDataFrame([(1, "note", "x", 1)], "id long, key string, value string, seq int"), at)
    seen = out.graph.nodes.select("id", mutate.stamp("updated_at").alias("at"), mutate.stamp("created_at").alias("no")).orderBy("id")
    assert [(r["id"], r["at"] and r["at"].astimezone(timezone.utc), r["no"]) for r in seen.collect()] == [(1, at, None), (2, None, None)]
    assert dict(out.results.dtypes)["updated_at"] == "timestamp"
