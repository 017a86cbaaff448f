"""Publishing datasets: partitioned layouts, fingerprints and immutable runs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ledger import completed_outputs
from .ledger_store import read_runs

# Where each output lives below the Silver root, and its partitions.
LAYOUT: dict[str, tuple[str, tuple[str, ...]]] = {
    "history": ("cdc/history", ("entity", "event_date")),
    "latest_all": ("cdc/latest_all", ("entity",)),
    "current": ("cdc/current", ("entity",)),
    "events": ("cdc/events", ("entity", "event_date")),
    "settlements": ("settlements", ("partner", "settlement_day")),
    "rejections": ("rejections", ("source", "entity")),
    "unresolved_references": ("unresolved_references", ("entity",)),
}


class CollisionError(RuntimeError):
    """A run directory already holds other content."""


@dataclass(frozen=True)
class Published:
    output_type: str
    entity_name: str
    path: str
    record_count: int
    content_hash: str


def fingerprint(rows: DataFrame) -> DataFrame:
    """Row count and an order-insensitive sum of row hashes, combined map-side."""
    text = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    part = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(part), F.lit(0)).cast("decimal(38,0)").alias("content_hash"),
    )


def run_path(root: str, output_type: str, run_id: str) -> str:
    folder, _ = LAYOUT[output_type]
    return f"{root.rstrip('/')}/{folder}/run_id={run_id}"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"))


def publish(
    rows: DataFrame,
    *,
    root: str,
    output_type: str,
    entity: str,
    run_id: str,
    schema: T.StructType,
    partitions: dict[str, Column] | None = None,
    sort: Sequence[str] = (),
) -> Published:
    """Write one output of a run, once.

    The directory is named after the run. Writing the same content again is no
    change, other content is an error. What was written is read back and counted;
    readers go by the ledger, so nothing is seen before the run is completed.
    """
    spark = rows.sparkSession
    path = run_path(root, output_type, run_id)
    names = schema.fieldNames()
    values = {"entity": F.lit(entity), **(partitions or {})}
    _, by = LAYOUT[output_type]
    shaped = rows.select(*names, *[values[p].alias(p) for p in by])
    if _exists(spark, path):
        known = _measure(spark, path, schema)
        if known != tuple(fingerprint(rows.select(*names)).first()):
            raise CollisionError(f"run directory holds other content: {path}")
        return Published(output_type, entity, path, known[0], str(known[1]))
    # Rows of a folder come together; at run time a folder with most of the rows is
    # split over several tasks and small ones are merged.
    shaped = shaped.hint("rebalance", *by)
    if sort:
        shaped = shaped.sortWithinPartitions(*by, *sort)
    shaped.write.mode("overwrite").partitionBy(*by).option(
        "compression", "zstd"
    ).parquet(path)
    written = _measure(spark, path, schema)
    return Published(output_type, entity, path, written[0], str(written[1]))


def _measure(spark: SparkSession, path: str, schema: T.StructType) -> tuple[int, int]:
    return tuple(fingerprint(read_published(spark, path, schema)).first())


def read_published(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A published output with its schema enforced, without its folder columns."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_output(
    spark: SparkSession,
    ledger_path: str,
    output_type: str,
    schema: T.StructType,
    *,
    entity: str | None = None,
) -> DataFrame:
    """Rows of one output over all completed runs; unfinished runs aren't seen.

    The paths, one per run, come to the driver, as Spark lists them there anyway.
    """
    outputs = completed_outputs(read_runs(spark, ledger_path)).where(F.col("output_type") == output_type)
    if entity is not None:
        outputs = outputs.where(F.col("entity_name") == entity)
    paths = [r["path"] for r in outputs.where("record_count > 0").select("path").distinct().collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths).select(*schema.fieldNames())
