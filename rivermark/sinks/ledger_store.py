"""The run ledger: an append-only table of status events."""

from __future__ import annotations

from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_per_key
from ..operators.quality import latest_gates
from ..schemas import RUN_LEDGER


def append_runs(
    spark: SparkSession,
    path: str,
    objects: DataFrame,
    *,
    statuses: tuple[str, ...],
    at: datetime,
    **values: Any,
) -> None:
    """Append one row per input object and status, in the order of the statuses.

    ``objects`` carry input_object_uri and input_checksum and may carry any other
    ledger column; ``values`` fill the rest.
    """
    steps = F.array(
        *[
            F.struct(F.lit(s).alias("status"), F.lit(at + timedelta(microseconds=n)).alias("at"))
            for n, s in enumerate(statuses)
        ]
    )
    rows = objects.withColumn("_step", F.explode(steps))
    given = {"status": F.col("_step.status"), "recorded_at": F.col("_step.at")}

    def column(name: str):
        if name in given:
            return given[name]
        return F.col(name) if name in objects.columns else F.lit(values.get(name))

    rows.select(
        *[column(f.name).cast(f.dataType).alias(f.name) for f in RUN_LEDGER.fields]
    ).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str, *, latest: bool = True) -> DataFrame:
    """Ledger rows, by default the last status of each run and input object."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], RUN_LEDGER)
    rows = spark.read.schema(RUN_LEDGER).parquet(path)
    if not latest:
        return rows
    return latest_per_key(
        rows, keys=["run_id", "input_object_uri"], order=F.struct("recorded_at")
    ).select(*RUN_LEDGER.fieldNames())


def append_gates(spark: SparkSession, path: str, gates: DataFrame, *, run_id: str, at: datetime) -> None:
    """Record a run's gate results."""
    gates.select(
        F.lit(run_id).alias("run_id"), *gates.columns, F.lit(at).cast("timestamp").alias("recorded_at")
    ).write.mode("append").parquet(path)


def read_gates(spark: SparkSession, path: str) -> DataFrame:
    """The last result of each rule of each run."""
    return latest_gates(spark.read.parquet(path))
