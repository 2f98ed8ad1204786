"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tamarack")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; on a cluster
    a machine-local folder would be lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tamarack-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_WRITTEN: list[str] = []  # scratch paths handed out since the last drop_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    _WRITTEN.append(f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}")
    return _WRITTEN[-1]


def drop_scratch(spark: SparkSession) -> int:
    """Delete the tables that this process has left in the shared folder; how many there were.

    For the end of a job, or between two: results that were not written elsewhere
    can't be read any more.
    """
    n = 0
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Deal the rows of a scan out to all cores if it has too few splits for them.

    For inputs that cost much more to process than to read, such as texts. A
    scan with a split for every core, as any large table has, stays as it is.
    ``key`` is a unique column.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= 2 * cores:
        return scan
    return scan.repartition(4 * cores, key)


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries in here delete their shuffle files at their end, not when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage without losing data when an executor dies, computes a result
    that several branches need only once, and gives the optimizer true sizes.
    """
    path = scratch_path(df.sparkSession, name)
    with _shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
