"""Parameter clamps, request checks and timing summaries."""

import pytest

from orbweave.functions.params import parameter
from orbweave.operators import mutate, pattern
from orbweave.operators.stats import bench_median, bench_winner
from orbweave.sources.quality import validate_edge_merges


@pytest.mark.parametrize("name,value,want", [
    ("search_limit", None, 25), ("search_limit", 0, 1), ("search_limit", 1000, 100), ("neighborhood_limit", 1, 5),
    ("neighborhood_limit", "81", 81), ("path_hops", 99, 10), ("path_hops", "x", 6), ("algorithm_hops", 9, 4), ("pagerank_limit", -3, 1)])
def test_parameters_are_clamped(name, value, want):
    assert parameter(name, value) == want


def test_types_with_a_newline_are_refused(spark):
    with pytest.raises(ValueError):
        pattern.check_edge_type("officer_of\n")
    batch = spark.createDataFrame([(1, 1, 2, "officer_of\n"), (2, 1, 2, "officer_of"), (3, 1, 2, None), (4, None, 2, "x")],
                                  "request_id long, src long, dst long, type string")
    valid, refused = validate_edge_merges(batch)
    assert [r["request_id"] for r in valid.collect()] == [2]
    assert {r["request_id"]: r["reason"] for r in refused.collect()} == {
        1: "type must be an identifier", 3: "type must be an identifier", 4: "endpoint required"}


def test_request_ids_give_no_id_twice(spark, make_graph):
    g = make_graph([(1, ["Officer"], {"name": "a"})], [])
    batch = spark.createDataFrame([(i, "Officer", f"n{k}", None, None, None) for k, i in enumerate([-5, -5, None, 7, 7, 8])],
                                  "request_id long, kind string, name string, country string, jurisdiction string, note string")
    done = mutate.create_nodes(g, batch, "now")
    assert [r["id"] for r in done.results.collect()] == [10]
    assert sorted(r["reason"] for r in done.rejected.collect()) == ["request id not valid"] * 3 + ["request id repeated"] * 2
    assert sorted(r["id"] for r in done.graph.nodes.collect()) == [1, 10]


def test_patch_of_the_stamp_keeps_the_stamp(spark, make_graph):
    g = make_graph([(1, ["Entity"], {"name": "a", "updated_at": "old"})], [])
    patches = spark.createDataFrame([(1, "updated_at", "mine", 1), (1, "status", "x", 2)], "id long, key string, value string, seq int")
    (node,) = mutate.patch_nodes(g, patches, "now").graph.nodes.collect()
    assert node["props"] == {"name": "a", "status": "x", "updated_at": "now"}


def test_median_and_winner(spark):
    log = spark.createDataFrame([("q", "a", r, ms) for r, ms in enumerate([3.0, 1.0, 2.0, None])] + [("q", "b", 0, 4.0)],
                                "query string, engine string, run int, ms double")
    middle = {r["engine"]: r for r in bench_median(log).collect()}
    assert set(middle) == {"a", "b"}
    (won,) = bench_winner(bench_median(log), "a", "b").collect()
    assert won["query"] == "q" and won["winner"] is not None
