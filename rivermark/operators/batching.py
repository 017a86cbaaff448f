"""Contiguous offset ranges per topic partition and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from . import scan

# Fixed value: records per range unless told otherwise.
BATCH_SIZE = 100


def offset_ranges(
    rows: DataFrame, *, batch_size: int = BATCH_SIZE, piece_size: int = scan.PIECE
) -> DataFrame:
    """Add ``range_start``, the first offset of the range a row belongs to.

    A range ends at an offset gap, where entity, event date or schema version
    change, and after ``batch_size`` rows. Offsets inside a stretch without breaks
    have no gaps, so the position in the stretch is the distance to its start.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be greater than zero")
    where = {
        "groups": ["kafka_topic", "kafka_partition"],
        "levels": ["_piece"],
        "order": ["kafka_offset"],
    }
    traits = F.struct("kafka_offset", "entity_name", "event_date", "schema_version")
    linked = scan.previous(
        rows.withColumn("_piece", scan.piece("kafka_offset", piece_size)),
        value=traits,
        name="_previous",
        **where,
    )
    joins = (F.col("kafka_offset") == F.col("_previous.kafka_offset") + 1) & (
        F.struct("entity_name", "event_date", "schema_version")
        == F.struct("_previous.entity_name", "_previous.event_date", "_previous.schema_version")
    )
    stretch = scan.last_known(
        linked.withColumn("_joins", F.coalesce(joins, F.lit(False))),
        value=F.when(~F.col("_joins"), F.col("kafka_offset")),
        name="_stretch",
        **where,
    )
    inside = F.col("kafka_offset") - F.col("_stretch")
    return stretch.withColumn(
        "range_start", F.col("kafka_offset") - F.pmod(inside, F.lit(batch_size).cast("bigint"))
    ).drop("_piece", "_previous", "_joins", "_stretch")


def range_summaries(ranged: DataFrame) -> DataFrame:
    """One row per offset range, with its deterministic id."""
    summary = ranged.groupBy("kafka_topic", "kafka_partition", "range_start").agg(
        F.min("kafka_offset").alias("offset_start"),
        F.max("kafka_offset").alias("offset_end"),
        F.count(F.lit(1)).alias("record_count"),
        F.first("entity_name").alias("entity_name"),
        F.first("event_date").alias("event_date"),
        F.first("schema_version").alias("schema_version"),
        F.bool_or("is_snapshot").alias("contains_snapshot"),
        F.bool_or(F.col("is_deleted") & ~F.col("is_tombstone")).alias("contains_delete"),
        F.bool_or("is_tombstone").alias("contains_tombstone"),
    )
    return summary.select(
        fn.offset_batch_id(
            "kafka_topic", "kafka_partition", "offset_start", "offset_end", "schema_version"
        ).alias("batch_id"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        "offset_start",
        "offset_end",
        (F.col("offset_end") + 1).alias("next_offset"),
        "record_count",
        "entity_name",
        "event_date",
        "schema_version",
        "contains_snapshot",
        "contains_delete",
        "contains_tombstone",
    )
