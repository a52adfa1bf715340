"""Edge merges arriving as a file stream are applied per micro-batch, exactly once."""

import tempfile

from orbweave.streaming.changes import apply_change_stream, read_current, write_version


def test_merge_stream_applies_each_batch_once(spark, make_graph):
    g = make_graph([(1, ["Officer"], {}), (2, ["Entity"], {}), (3, ["Entity"], {})], [])
    root = tempfile.mkdtemp(prefix="orbweave-stream-", dir="/tmp")
    store, inbox, ckpt = f"{root}/graph", f"{root}/inbox", f"{root}/ckpt"
    write_version(g, store, 0)
    schema = "request_id long, src long, dst long, type string"
    spark.createDataFrame([(0, 1, 2, "officer_of"), (1, 1, 2, "OFFICER_OF")], schema) \
        .write.mode("append").parquet(inbox)
    q = apply_change_stream(spark.readStream.schema(schema).parquet(inbox), store,
                            "merge_edges", ckpt)
    q.awaitTermination(120)
    assert read_current(spark, store).edges.count() == 1
    spark.createDataFrame([(2, 1, 3, "officer_of"), (3, 1, 2, "officer_of"), (4, 1, 9, "officer_of")], schema) \
        .write.mode("append").parquet(inbox)
    q = apply_change_stream(spark.readStream.schema(schema).parquet(inbox), store,
                            "merge_edges", ckpt)
    q.awaitTermination(120)
    now = read_current(spark, store)
    assert now.edges_by_dst.count() == 2
    assert [r["reason"] for r in spark.read.parquet(f"{store}/v2/rejected").collect()] == ["endpoint not found"]
    edges = now.edges
    assert sorted((r["src"], r["dst"]) for r in edges.collect()) == [(1, 2), (1, 3)]
