"""Latest state of every business key, folded from events without walking them.

Events of a key apply in order, but whether one applies can be told from a few
facts about its key and topic: the snapshot's position, the first event that can
start a row, and whether a row exists when the topic's events begin. Those facts
are aggregates, so a key with a third of all events costs no more than others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schemas import BUSINESS_KEYS, LINEAGE_NAMES, entity_schema
from .normalize import lineage

# Why an event is left out of the state.
_MOVED = "Business key moved across Kafka partitions"
_PRECEDES = "CDC event precedes the published entity state"

_KEYS = ("business_key", "kafka_topic")

# What deciding and merging read of projected events.
EVENT_COLUMNS = tuple(
    dict.fromkeys(
        [
            *("event_id", "business_key", "kafka_topic", "kafka_partition", "kafka_offset", "is_tombstone"),
            *("event_time", "source_lsn", "source_ts", "connector_ts", "ingested_at"),
            *("state", "projection_code", "projection_message"),
            *[n for n in LINEAGE_NAMES if n != "effective_event_time"],
        ]
    )
)


def _place():
    return F.struct("kafka_partition", "kafka_offset")


def _snapshot_positions(snapshot: DataFrame, key: str) -> DataFrame:
    return snapshot.select(
        F.col(key).alias("business_key"),
        F.col("kafka_topic").alias("_snap_topic"),
        F.struct("kafka_partition", "kafka_offset").alias("_snap"),
    )


def _topic_facts(events: DataFrame, positions: DataFrame | None) -> DataFrame:
    """One row per key and topic that has an event which does not simply apply."""
    tombstone = F.col("is_tombstone")
    sound = ~tombstone & F.col("projection_code").isNull()
    facts = events.groupBy(*_KEYS).agg(
        F.min(F.when(sound, _place())).alias("_first_row"),
        F.min(F.when(tombstone, _place())).alias("_first_tombstone"),
        F.min(_place()).alias("_first_any"),
        F.max("kafka_partition").alias("_last_partition"),
    )
    if positions is None:
        facts = facts.withColumn("_snap_topic", F.lit(None).cast("string")).withColumn(
            "_snap", F.lit(None).cast("struct<kafka_partition:int,kafka_offset:bigint>")
        )
    else:
        facts = facts.join(positions, "business_key", "left")
    # A key has as many of these rows as it has topics.
    earlier = (
        W.partitionBy("business_key")
        .orderBy("kafka_topic")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    started = F.coalesce(F.max(F.col("_first_row").isNotNull()).over(earlier), F.lit(False))
    touched = F.coalesce(
        F.max(F.col("_first_row").isNotNull() | F.col("_first_tombstone").isNotNull()).over(
            earlier
        ),
        F.lit(False),
    )
    facts = facts.select(
        "*",
        (F.col("_snap").isNotNull() | started).alias("_exists"),
        (F.coalesce(F.col("_snap_topic") == F.col("kafka_topic"), F.lit(False)) & ~touched).alias(
            "_pinned"
        ),
    ).withColumn(
        "_start",
        F.when(F.col("_exists"), F.least("_first_row", "_first_tombstone")).otherwise(
            F.col("_first_row")
        ),
    )
    one_partition = F.col("_first_any.kafka_partition") == F.col("_last_partition")
    in_order = F.when(
        F.col("_pinned"),
        (F.col("_first_any.kafka_partition") == F.col("_snap.kafka_partition"))
        & (F.col("_first_any") > F.col("_snap")),
    ).otherwise(
        F.col("_first_tombstone").isNull()
        | F.coalesce(F.col("_first_tombstone") >= F.col("_start"), F.lit(False))
    )
    plain = one_partition & in_order
    return facts.where(~plain).select(*_KEYS, "_pinned", "_snap", "_start")


def decide_events(
    events: DataFrame, snapshot: DataFrame | None = None, *, key: str | None = None
) -> DataFrame:
    """Add ``decision`` (APPLY, SKIP or REJECT) with ``decision_code`` and message.

    ``events`` are deduplicated and projected; ``snapshot`` is the newest published
    state, with ``key`` as its key column.
    """
    positions = None if snapshot is None else _snapshot_positions(snapshot, key or "business_key")
    facts = _topic_facts(events, positions).withColumn("_special", F.lit(True))
    rows = events.join(facts, [*_KEYS], "left")
    partition, place = F.col("kafka_partition"), _place()
    unsound = ~F.col("is_tombstone") & F.col("projection_code").isNotNull()
    pinned, special = F.coalesce("_pinned", F.lit(False)), F.col("_special").isNotNull()
    moved = special & F.when(
        pinned, partition != F.col("_snap.kafka_partition")
    ).otherwise(
        F.coalesce(partition > F.col("_start.kafka_partition"), F.lit(False))
    )
    precedes = pinned & (place < F.col("_snap"))
    replayed = pinned & (place == F.col("_snap"))
    not_started = (
        special & ~pinned & F.col("is_tombstone")
        & F.coalesce(place < F.col("_start"), F.lit(True))
    )
    code = (
        F.when(moved | precedes, F.lit("OUT_OF_ORDER_EVENT"))
        .when(replayed, F.lit(None))
        .when(unsound, F.col("projection_code"))
    )
    message = (
        F.when(moved, F.lit(_MOVED))
        .when(precedes, F.lit(_PRECEDES))
        .when(replayed, F.lit(None))
        .when(unsound, F.col("projection_message"))
    )
    decision = (
        F.when(moved | precedes, "REJECT")
        .when(replayed, "SKIP")
        .when(unsound, "REJECT")
        .when(not_started, "SKIP")
        .otherwise("APPLY")
    )
    return rows.select(
        *[F.col(c) for c in events.columns],
        decision.alias("decision"),
        code.alias("decision_code"),
        message.alias("decision_message"),
    )


def merge_state(
    applied: DataFrame, snapshot: DataFrame | None, entity: str
) -> DataFrame:
    """New latest rows, deleted ones included: the snapshot overlaid with events."""
    schema = entity_schema(entity)
    key = BUSINESS_KEYS[entity]
    business = [n for n in schema.fieldNames() if n not in LINEAGE_NAMES]
    changes = applied.select(
        "business_key",
        F.struct(
            F.lit(1).alias("rank"), "kafka_topic", "kafka_partition", "kafka_offset"
        ).alias("_at"),
        F.col("state").alias("_state"),
        lineage().alias("_lineage"),
    )
    if snapshot is not None:
        published = snapshot.select(
            F.col(key).alias("business_key"),
            F.struct(
                F.lit(0).alias("rank"), "kafka_topic", "kafka_partition", "kafka_offset"
            ).alias("_at"),
            F.struct(*business).alias("_state"),
            F.struct(*LINEAGE_NAMES).alias("_lineage"),
        )
        changes = changes.unionByName(published)
    latest = changes.groupBy("business_key").agg(
        F.max_by("_state", F.when(F.col("_state").isNotNull(), F.col("_at"))).alias("_state"),
        F.max_by("_lineage", "_at").alias("_lineage"),
    )
    return latest.select(
        *[F.col(f"_state.{n}").alias(n) for n in business],
        *[F.col(f"_lineage.{n}").alias(n) for n in LINEAGE_NAMES],
    )


def current(latest: DataFrame) -> DataFrame:
    """Rows that are not deleted."""
    return latest.where(~F.col("is_deleted"))


def append_only_rows(events: DataFrame, entity: str) -> DataFrame:
    """Typed rows of an entity that keeps every event and has no state."""
    schema = entity_schema(entity)
    rows = events.where(F.col("projection_code").isNull() & ~F.col("is_tombstone"))
    placed = rows.withColumn("_lineage", lineage())
    return placed.select(
        *[
            F.col(f"_lineage.{n}" if n in LINEAGE_NAMES else f"state.{n}").alias(n)
            for n in schema.fieldNames()
        ]
    )
