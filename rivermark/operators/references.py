"""References of applied events to keys that are not known yet."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import BUSINESS_KEYS, REFERENCE_RULES
from . import scan


def _with_references(
    applied: DataFrame, snapshot: DataFrame | None, entity: str, piece_size: int
) -> DataFrame:
    """Applied events with the reference fields of the row they leave behind.

    A tombstone keeps the row before it, so its references are the ones last seen
    on its key.
    """
    fields = [field for field, _ in REFERENCE_RULES[entity]]
    base = ["business_key", "event_id", "processing_run_id"]
    rows = applied.where(~F.col("is_tombstone"))
    direct = rows.select(*base, *[F.col(f"state.{f}").alias(f) for f in fields])
    buried = applied.where("is_tombstone").select("business_key").distinct()
    held = F.struct(*[F.col(f"state.{f}").alias(f) for f in fields])
    place = ["_rank", "kafka_topic", "kafka_partition", "kafka_offset"]
    trail = applied.select(
        *base,
        "is_tombstone",
        F.lit(1).alias("_rank"),
        *place[1:],
        F.when(~F.col("is_tombstone"), held).alias("_held"),
    )
    if snapshot is not None:
        trail = trail.unionByName(
            snapshot.select(
                F.col(BUSINESS_KEYS[entity]).alias("business_key"),
                F.lit(None).cast("string").alias("event_id"),
                "processing_run_id",
                F.lit(False).alias("is_tombstone"),
                F.lit(0).alias("_rank"),
                *place[1:],
                F.struct(*fields).alias("_held"),
            )
        )
    trail = trail.join(buried, "business_key", "left_semi").withColumn(
        "_piece", scan.piece("kafka_offset", piece_size)
    )
    known = scan.last_known(
        trail,
        groups=["business_key"],
        levels=["_rank", "kafka_topic", "kafka_partition", "_piece"],
        order=["kafka_offset"],
        value=F.col("_held"),
        name="_last",
    )
    carried = known.where("is_tombstone").select(
        *base, *[F.col(f"_last.{f}").alias(f) for f in fields]
    )
    return direct.unionByName(carried)


def missing_keys(values: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct non-empty values of a one-column frame that are not known."""
    (column,) = values.columns
    return (
        values.where(F.coalesce(F.col(column), F.lit("")) != "")
        .distinct()
        .join(known.toDF(column), column, "left_anti")
    )


def unresolved_references(
    applied: DataFrame,
    known_keys: Mapping[str, DataFrame],
    entity: str,
    *,
    snapshot: DataFrame | None = None,
    observed_at=None,
    piece_size: int = scan.PIECE,
) -> DataFrame | None:
    """One row per applied event and rule whose target key is not in ``known_keys``.

    ``known_keys`` holds a one-column frame of keys per target entity. The distinct
    values are looked up first, so a value shared by a third of the events is
    compared once; events then meet only the values that stayed open.
    """
    rules = REFERENCE_RULES.get(entity, ())
    if not rules:
        return None
    rows = _with_references(applied, snapshot, entity, piece_size)
    found = []
    for field, target in rules:
        values = rows.select(F.col(field).alias("reference_key"))
        known = known_keys.get(target)
        if known is None:
            open_keys = values.where(
                F.coalesce(F.col("reference_key"), F.lit("")) != ""
            ).distinct()
        else:
            open_keys = missing_keys(values, known)
        found.append(
            rows.withColumn("reference_key", F.col(field))
            .join(open_keys, "reference_key", "left_semi")
            .select(
                F.lit(entity).alias("entity_name"),
                "business_key",
                F.lit(target).alias("reference_entity"),
                "reference_key",
                F.lit(field).alias("reference_field"),
                F.lit("TEMPORARILY_UNRESOLVED").alias("classification"),
                F.col("event_id").alias("source_event_id"),
                "processing_run_id",
                F.lit(observed_at).cast("timestamp").alias("observed_at"),
            )
        )
    return reduce(DataFrame.unionByName, found)
