"""Streaming sources of raw change records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..schemas import KAFKA


def kafka_stream(
    spark: SparkSession,
    *,
    servers: str,
    topics: Sequence[str],
    starting: str = "earliest",
    max_offsets: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Records of an explicit list of topics; progress lives in the checkpoint only.

    Needs the Kafka connector of Spark on the class path.
    """
    if not topics or starting not in ("earliest", "latest"):
        raise ValueError("topics and a start of earliest or latest are required")
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "true")
        .options(**(options or {}))
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(*KAFKA.fieldNames())


def file_stream(
    spark: SparkSession, path: str, *, max_files: int | None = None
) -> DataFrame:
    """The same rows from a folder of Parquet files."""
    reader = spark.readStream.schema(KAFKA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
