"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbweave.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's checkpoint folder and read it from there.

    A reliable checkpoint outlives any executor; Spark removes the files when
    the frame is no longer referenced and
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the decimal text of an id, modulo ``folds`` (null id: null)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def labelled_sample(labels: DataFrame, label: str, bound: int) -> DataFrame:
    """At most ``bound`` distinct labelled documents (``doc_id``, ``label``), chosen by hash of the id.

    Rows without an id or label take no part; of a document with several
    labels the largest counts.
    """
    one = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
           .where("doc_id is not null and label is not null")
           .groupBy("doc_id").agg(F.max("label").alias("label")))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
