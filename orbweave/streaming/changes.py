"""Change batches arriving as a stream, applied with ``foreachBatch``.

The reference changes one element per request; here a stream of change
records (e.g. a folder or topic of edge merges) is applied micro-batch by
micro-batch with the batch operators of ``orbweave.operators.mutate``. Each
micro-batch reads the current graph version, applies the changes as joins and
writes a *new* version folder ``v<epoch>`` in the sorted layouts, with the
requests it refused; then a new pointer folder names the version (none is ever
overwritten in place). Re-running an epoch after a failure rewrites the same
folder, so the sink is idempotent and the stream exactly-once end to end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbweave.model import Graph
from orbweave.operators import mutate
from orbweave.sources.fixture import read_graph, store_graph

POINTER = "_current"


def write_version(graph: Graph, store: str, version: int, rejected: DataFrame | None = None) -> None:
    store_graph(graph, f"{store}/v{version}")
    if rejected is not None:
        rejected.select("reason", F.to_json(F.struct(*rejected.columns)).alias("request")) \
            .write.mode("overwrite").parquet(f"{store}/v{version}/rejected")
    graph.spark.range(1).write.mode("overwrite").parquet(f"{store}/{POINTER}/version={version}")


def current_version(spark: SparkSession, store: str) -> int:
    return spark.read.parquet(f"{store}/{POINTER}").agg(F.max("version")).first()[0]


def read_current(spark: SparkSession, store: str) -> Graph:
    return read_graph(spark, f"{store}/v{current_version(spark, store)}")


def _apply(kind: str, graph: Graph, batch: DataFrame, stamp: str) -> mutate.Applied:
    if kind == "merge_edges":
        return mutate.merge_edges(graph, batch, stamp)
    if kind == "delete_edges":
        return mutate.delete_edges(graph, batch)
    if kind == "detach_delete_nodes":
        return mutate.detach_delete_nodes(graph, batch)
    if kind == "create_nodes":
        return mutate.create_nodes(graph, batch, stamp)
    if kind == "patch_nodes":
        return mutate.patch_nodes(graph, batch, stamp)
    raise ValueError(f"unknown change kind {kind!r}")


def apply_change_stream(changes: DataFrame, store: str, kind: str, checkpoint_location: str,
                        stamp_col: str | None = None, trigger_available_now: bool = True):
    """Start a streaming query applying ``changes`` (a streaming DataFrame) to the graph at ``store``.

    ``store`` must already hold version 0 (see ``write_version``). Returns the
    ``StreamingQuery``; version numbers are the micro-batch epochs + 1.
    """
    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        graph = read_current(spark, store)
        stamp = f"epoch-{epoch_id}"
        if stamp_col is not None:
            row = batch.agg(F.max(stamp_col)).first()
            stamp = row[0] if row and row[0] is not None else stamp
        target = epoch_id + 1
        if current_version(spark, store) >= target:
            return  # epoch already applied (replay after a failure)
        applied = _apply(kind, graph, batch, stamp)
        write_version(applied.graph, store, target, applied.rejected)

    writer = changes.writeStream.foreachBatch(each_batch) \
        .option("checkpointLocation", checkpoint_location)
    if trigger_available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
