"""Session defaults and lineage cutting.

Iterative operators (BFS levels, PageRank, Louvain) cut their lineage with a
*reliable* ``DataFrame.checkpoint()``. The directory comes from the cluster's
``spark.checkpoint.dir`` (a shared filesystem on a real cluster). Only when
that setting is absent *and* Spark runs in local mode (tests, the bench) do we
create a scratch directory of our own.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "orbweave") -> SparkSession:
    """A session with the settings every operator here assumes (AQE on, UTC, no UI)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ORBWEAVE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Input rows for each shuffle partition, so that a task's share doesn't grow with the input.
ROWS_PER_PARTITION = 250_000


#: What AQE makes of small partitions: a task's sorts and hash tables hold about ten times as much, unpacked.
ADVISORY_MB = 16


def spread_shuffles(spark: SparkSession, rows: int) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to one for each ``ROWS_PER_PARTITION`` of ``rows``, if it is below; returns it.

    A fixed number lets the sorts and hash tables of every task grow with the
    input, until they spill. AQE joins partitions that turn out small, to at most
    ``ADVISORY_MB`` (lowered to it, if above): else it would undo this for narrow rows.
    """
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_PARTITION))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    if _bytes(spark.conf.get(_ADVISORY)) > ADVISORY_MB << 20:
        spark.conf.set(_ADVISORY, f"{ADVISORY_MB}m")
    return n


@contextmanager
def shuffles_of(spark: SparkSession, partitions: int, adaptive: bool = True):
    """Within, shuffles have so many partitions: for frames much smaller than the tables that the session's number is for.

    ``adaptive=False``: plans run as they are, without a job and a plan for each
    stage, which takes most of the time of steps over a few rows.
    """
    with _settings(spark, {"spark.sql.shuffle.partitions": str(partitions)} | ({} if adaptive else {"spark.sql.adaptive.enabled": "false"})):
        yield


@contextmanager
def _settings(spark: SparkSession, given: dict[str, str]):
    before = {name: spark.conf.get(name, None) for name in given}
    for name, value in given.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shuffles_freed(spark: SparkSession):
    """A frame made within, or written within, leaves no shuffle files when its job ends (needs AQE).

    Otherwise they stay until the driver happens to collect its garbage: a loop
    keeps those of all its steps on disk. For frames that are run once only.
    """
    return _settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _bytes(size: str) -> int:
    """A size as Spark writes it (``64MB``, ``16m``, ``67108864b``) in bytes."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it up if needed.

    Order: an already configured SparkContext directory, then the
    ``spark.checkpoint.dir`` setting, then (local mode only) a scratch folder.
    On a cluster without the setting we refuse rather than write to a
    machine-local folder that an executor loss would take with it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            configured = None
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; iterative operators need a shared "
                "checkpoint directory on a cluster")
        configured = tempfile.mkdtemp(prefix="orbweave-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the reliable checkpoint directory and return it.

    Reliable checkpoints survive executor loss (unlike ``localCheckpoint``),
    keep the frame's partitioning, and stop the logical plan of loops from
    growing with the iteration count. (Measured here: cheaper than writing and
    re-reading a parquet table, whose commit protocol costs more.) The shuffle
    files behind the frame go with the write.
    """
    checkpoint_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):  # asked for when a frame is made: hence one more
        return df.select("*").checkpoint(eager=True)  # the write is the one run of the plan


def release(*frames: DataFrame) -> None:
    """Delete what ``cut_lineage`` wrote of frames that nothing reads any more; others are left alone.

    Spark itself does so only when the driver's garbage is collected, and only if told to.
    """
    for df in frames:
        plan = df._jdf.queryExecution().analyzed()
        if plan.nodeName() == "LogicalRDD" and plan.rdd().getCheckpointFile().isDefined():
            _delete(df.sparkSession, plan.rdd().getCheckpointFile().get())


@contextmanager
def stored(df: DataFrame):
    """``df`` written as parquet to the checkpoint directory and read again; deleted at the end.

    For large frames that a loop joins again and again: its size is then that of its files,
    while a checkpoint keeps the product of its parts' estimated sizes.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    try:
        with shuffles_freed(spark):
            df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
