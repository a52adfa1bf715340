"""The training-data pipeline: toxicity, near duplicates, decontamination, pseudonyms, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written
and read again as the next stage's documents. All but the last return the
columns of ``documents``. ``labels`` and ``benchmark`` are read from ``sf_dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbweave.llm import decontaminate, neardup, packing, pii, toxicity
from orbweave.llm.common import table
from orbweave.session import checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Bytes of rows that Spark hands to a Python worker at a time (or one row), whatever a row holds.
BATCH_BYTES = 8 << 20
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def _bounded(stage: Stage) -> Stage:
    """``stage`` with the session's batches bounded by bytes, as rows may hold very long texts."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(_BATCHES, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run_stage


@_bounded
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, trained on the labels of these documents, doesn't reject."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@_bounded
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return neardup.keep_one(docs)


@_bounded
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@_bounded
def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal values replaced; ``n_chars`` follows the new text."""
    out = pii.pseudonymise(docs)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return out.select(*docs.columns)


@_bounded
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with the sequence and offset where each lies."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pseudonyms", pseudonymise),
    ("packing", pack),
]

#: SQL can express none of the trained, sampled or keyed stages; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
