"""Session settings the operators rely on, and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results: dates and clocks are UTC, and a JSON object that
# repeats a field keeps the last one.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings that only change plans. Hot join keys are split at run time, also
# where that costs a later exchange.
_PLANNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # HotSpot never compiles a larger method, so a larger stage would be interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# For the session builder only: recording the call site of every column costs more
# than building the column.
STATIC = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time SQL settings to a session and hand it back.

    Cluster sizing (shuffle partitions, memory, split size) is left to whoever
    submits the job.
    """
    for key, value in {**_REQUIRED, **_PLANNING}.items():
        spark.conf.set(key, value)
    return spark


# Bytes of compressed source files that one task of costly row work gets at most.
_SPREAD_BYTES = 2 << 20
# Tasks at most: 20 GB of files, then tasks grow.
_SPREAD_TASKS = 10_000


def spread(df: DataFrame, *, even: bool = False) -> DataFrame:
    """Give costly row work small, even tasks, however few splits or row groups a source has.

    A split that Spark cuts out of a Parquet file is empty unless a row group begins in
    it, so splits say nothing about rows. Tasks are as many as cores at least, and grow
    with the source's size. Splits of ``even`` files, such as Spark's own, do as they are
    unless there are fewer than cores.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if even:
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
    return df.repartition(spread_tasks(df))


def spread_tasks(df: DataFrame) -> int:
    """How many tasks ``spread`` makes of a source."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(cores, min(-(-size // _SPREAD_BYTES), _SPREAD_TASKS))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that is read more than once to the shared folder and reread it."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new directory below the session's shared checkpoint folder.

    A machine-local temporary folder is used only when no folder is configured,
    that is in local tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="rivermark-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
