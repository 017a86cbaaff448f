"""Event order and duplicate coordinates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COORDINATE = ("kafka_topic", "kafka_partition", "kafka_offset")


def event_order(tie: Sequence[str] = ()) -> Column:
    """Total order of change events; ``tie`` names the row's place in its source."""
    return F.struct(
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        F.coalesce("source_lsn", F.lit(-1).cast("bigint")).alias("lsn"),
        F.coalesce("source_ts", "event_time").alias("source_clock"),
        F.coalesce("connector_ts", "event_time").alias("connector_clock"),
        "ingested_at",
        "event_id",
        *tie,
    )


def mark_repeats(
    rows: DataFrame, *, keys: Sequence[str], order: Column, name: str = "is_repeat"
) -> DataFrame:
    """Flag every row of a key but its first one in ``order``.

    Only keys that do occur twice are looked up again. The count is combined
    before its exchange, the wide rows are joined to what is left: at run time a
    broadcast when that is small, else a join that splits hot keys.
    """
    placed = rows.withColumn("_place", order)
    repeated = (
        placed.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_copies"), F.min("_place").alias("_first"))
        .where("_copies > 1")
        .drop("_copies")
    )
    return (
        placed.join(repeated, [*keys], "left")
        .withColumn(name, F.coalesce(F.col("_place") > F.col("_first"), F.lit(False)))
        .drop("_place", "_first")
    )


def mark_duplicates(
    events: DataFrame, *, tie: Sequence[str] = (), verified_ids: bool = True
) -> DataFrame:
    """Add ``duplicate_code``: DUPLICATE_COORDINATE, DUPLICATE_EVENT or NULL.

    Copies that agree in the whole event order are told apart by ``tie``, for
    files their path and row position. With ``verified_ids`` every event id is
    known to be the hash of its coordinate, so a repeated id is a repeated
    coordinate and the second search is left out.
    """
    order = event_order(tie)
    marked = mark_repeats(events, keys=COORDINATE, order=order, name="_coordinate")
    code = F.when(F.col("_coordinate"), F.lit("DUPLICATE_COORDINATE"))
    if verified_ids:
        return marked.withColumn("duplicate_code", code).drop("_coordinate")
    first = marked.where(~F.col("_coordinate"))
    again = mark_repeats(first, keys=["event_id"], order=order, name="_id")
    both = again.unionByName(
        marked.where("_coordinate").withColumn("_id", F.lit(False)), allowMissingColumns=False
    )
    return both.withColumn(
        "duplicate_code", code.when(F.col("_id"), F.lit("DUPLICATE_EVENT"))
    ).drop("_coordinate", "_id")


def latest_per_key(rows: DataFrame, *, keys: Sequence[str], order: Column) -> DataFrame:
    """The last row of each key in ``order``, combined before the exchange."""
    names = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*names), order).alias("_row")
    )
    return best.select(*keys, *[F.col(f"_row.{n}").alias(n) for n in names])
