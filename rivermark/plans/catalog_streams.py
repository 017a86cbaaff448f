"""Queries that run as bounded streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import normalize
from ..operators.envelope import BRONZE_VERSION, bronze_rows, parse_envelopes
from ..schemas import BUSINESS_KEYS, CDC_BRONZE, entity_schema
from ..session import shared_dir, spread_tasks
from ..streaming import start_bronze_stream, start_state_stream, without_replays
from ..streaming.state import newest_version, snapshot_path
from . import derived
from .catalog_events import _ACCOUNT_STATE, _HISTORY, RUN_AT, _account_columns
from .derived import with_ctes
from .registry import query


def _events_stream(spark, sf_dir, **options) -> DataFrame:
    schema = derived.table(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return reader.options(**options).parquet(sf_dir)


def _wire_stream(spark, sf_dir) -> DataFrame:
    """Records of the stream in even tasks; the narrow table rows are what is moved."""
    tasks = spread_tasks(derived.table(spark, sf_dir, "events"))
    return derived.wire_columns(_events_stream(spark, sf_dir).repartition(tasks))


@query(
    "stream_bronze",
    with_ctes(
        "d_wire",
        body=f"SELECT event_id, entity_name, operation, business_payload_json AS payload, kafka_partition, kafka_offset FROM ({_HISTORY})",
    ),
)
def stream_bronze(spark, sf_dir):
    """Raw records streamed into Bronze, read back."""
    root = shared_dir(spark, "stream-bronze")
    start_bronze_stream(
        _wire_stream(spark, sf_dir),
        bronze_path=f"{root}/bronze",
        quarantine_path=f"{root}/quarantine",
        checkpoint=f"{root}/checkpoint",
    ).awaitTermination()
    rows = spark.read.schema(CDC_BRONZE).option("recursiveFileLookup", "true").parquet(
        f"{root}/bronze"
    )
    return rows.select(
        "event_id",
        "entity_name",
        "operation",
        F.coalesce("before_json", "after_json").alias("payload"),
        "kafka_partition",
        "kafka_offset",
    )


@query(
    "stream_bronze_ranges",
    with_ctes(
        "d_wire",
        body=f"""SELECT kafka_partition, MIN(kafka_offset) AS offset_start, MAX(kafka_offset) AS offset_end,
  COUNT(*) AS n_rows, COUNT(DISTINCT kafka_offset) AS n_offsets
FROM ({_HISTORY}) h
GROUP BY kafka_partition, kafka_offset > (SELECT (MIN(event_id) + MAX(event_id)) // 2 FROM events)""",
    ),
)
def stream_bronze_ranges(spark, sf_dir):
    """Offset ranges of Bronze after batches that overlap: each offset is stored once.

    Three streams with their own checkpoints write one Bronze folder: the records up to the
    middle offset, then all records (the lower half is covered, the upper half is new), then
    all records again (a replay: nothing is new). Result: rows and distinct offsets per range.
    """
    root = shared_dir(spark, "stream-bronze-ranges")
    span = derived.table(spark, sf_dir, "events").agg(F.min("event_id"), F.max("event_id")).first()
    cut = (span[0] + span[1]) // 2 if span[0] is not None else 0
    for name, wire in [
        ("lower", _wire_stream(spark, sf_dir).where(F.col("offset") <= cut)),
        ("all", _wire_stream(spark, sf_dir)),
        ("replay", _wire_stream(spark, sf_dir)),
    ]:
        start_bronze_stream(
            wire,
            bronze_path=f"{root}/bronze",
            quarantine_path=f"{root}/quarantine",
            checkpoint=f"{root}/checkpoint-{name}",
        ).awaitTermination()
    ranges = [T.StructField("offset_start", T.LongType()), T.StructField("offset_end", T.LongType())]
    rows = spark.read.schema(T.StructType(CDC_BRONZE.fields + ranges)).parquet(f"{root}/bronze")
    return rows.groupBy("kafka_partition", "offset_start", "offset_end").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("kafka_offset").alias("n_offsets")
    )


def _project(batch: DataFrame) -> DataFrame:
    bronze = bronze_rows(
        parse_envelopes(batch, ingested_at=RUN_AT, schema_version=BRONZE_VERSION)
    )
    events = normalize.normalize_events(bronze, run_id="run", processed_at=RUN_AT)
    good = events.where(F.col("error_code").isNull()).drop("error_code", "error_message")
    return normalize.project_entity(good, "accounts")


@query(
    "stream_current_state",
    with_ctes("d_wire", body="SELECT 1").replace("\nSELECT 1", ",\n" + _ACCOUNT_STATE),
)
def stream_current_state(spark, sf_dir):
    """Account state kept by a stream."""
    root = shared_dir(spark, "stream-state")
    stream = start_state_stream(
        _wire_stream(spark, sf_dir),
        root=f"{root}/state",
        entity="accounts",
        checkpoint=f"{root}/checkpoint",
        prepare=_project,
    )
    stream.awaitTermination()
    assert BUSINESS_KEYS["accounts"] == "account_id"
    rows = spark.read.schema(entity_schema("accounts")).parquet(
        snapshot_path(f"{root}/state", newest_version(spark, f"{root}/state"))
    )
    return _account_columns(rows)


@query(
    "stream_dedup",
    """SELECT user_id % 4 AS kafka_partition, event_id AS kafka_offset, event_type FROM events""",
)
def stream_dedup(spark, sf_dir):
    """Records delivered twice, kept once by the stream."""
    root = shared_dir(spark, "stream-dedup")
    events = _events_stream(spark, sf_dir).select(
        F.lit("cdc.users").alias("kafka_topic"),
        (F.col("user_id") % 4).alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        "event_type",
        F.col("ts").cast("timestamp").alias("ts"),
        F.explode(F.sequence(F.lit(0), F.lit(1))).alias("delivery"),
    )
    kept = without_replays(events)
    (
        kept.select("kafka_partition", "kafka_offset", "event_type")
        .writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{root}/out")
