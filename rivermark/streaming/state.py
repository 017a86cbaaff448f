"""Incremental keyed state: each micro-batch is folded into the last snapshot."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import dedup, state
from ..schemas import BUSINESS_KEYS, entity_schema
from ..session import configure, spread, stored


def without_replays(events: DataFrame) -> DataFrame:
    """Drop records whose coordinate was seen before, however long ago.

    No clock decides, so a record that arrives late for the first time is kept. The
    state holds one coordinate per record and doesn't expire; keep it in RocksDB where
    that is much (``spark.sql.streaming.stateStore.providerClass``).
    """
    return events.dropDuplicates(list(dedup.COORDINATE))


def snapshot_path(root: str, version: int) -> str:
    return f"{root}/version={version:012d}"


def rejections_path(root: str, version: int) -> str:
    """Where the events are that a version's micro-batch did not apply, with the reason."""
    return f"{root}/rejections/version={version:012d}"


def _stored_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions with a complete snapshot, oldest first."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(hadoop.Path(f"{root}/version=*/_SUCCESS")) or []
    return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in found)


def newest_version(spark: SparkSession, root: str) -> int:
    """The newest complete version, 0 when there is none."""
    return max(_stored_versions(spark, root), default=0)


def batch_version(spark: SparkSession, root: str, checkpoint: str, batch_id: int) -> int:
    """The version a micro-batch writes: the newest stored + 1, remembered per checkpoint and batch.

    A batch that runs again (same checkpoint, same number) keeps its version and overwrites it;
    a new checkpoint goes on after the newest snapshot instead of starting again at 1.
    The record is an empty folder ``_batches/<checkpoint digest>/batch=N/version=V`` below ``root``.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    key = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:20]
    folder = hadoop.Path(f"{root}/_batches/{key}/batch={batch_id:012d}")
    if files.exists(folder):
        kept = [s.getPath().getName() for s in files.listStatus(folder)]
        known = [int(name.split("=")[1]) for name in kept if name.startswith("version=")]
        if known:
            return max(known)
    version = newest_version(spark, root) + 1
    files.mkdirs(hadoop.Path(f"{root}/_batches/{key}/batch={batch_id:012d}/version={version:012d}"))
    return version


def read_snapshot(spark: SparkSession, root: str, entity: str, before: int) -> DataFrame | None:
    """The newest complete snapshot of an earlier version."""
    older = [v for v in _stored_versions(spark, root) if v < before]
    if not older:
        return None
    return spark.read.schema(entity_schema(entity)).parquet(snapshot_path(root, older[-1]))


def fold_batch(
    events: DataFrame, root: str, entity: str, version: int, *, tie: tuple[str, ...] = ()
) -> DataFrame:
    """Fold projected events into the snapshot before ``version`` and write the next.

    ``version`` comes from ``batch_version``, so running a batch again reads the same
    base and overwrites the same folders. Events that are refused or repeated are
    written beside it.
    """
    spark = events.sparkSession
    base = read_snapshot(spark, root, entity, version)
    # Parsed once: the searches and both outputs below read the stored events.
    events = stored(events.select(*dict.fromkeys([*state.EVENT_COLUMNS, *tie])), "state-batch")
    marked = dedup.mark_duplicates(events, tie=tie)
    fresh = marked.where(marked.duplicate_code.isNull()).drop("duplicate_code")
    decided = state.decide_events(fresh, base, key=BUSINESS_KEYS[entity])
    merged = state.merge_state(decided.where("decision = 'APPLY'"), base, entity)
    address = ["event_id", "business_key", *dedup.COORDINATE]
    refused = decided.where("decision = 'REJECT'").select(
        *address, decided.decision_code.alias("error_code"), decided.decision_message.alias("error_message")
    )
    repeated = marked.where(marked.duplicate_code.isNotNull()).select(
        *address, marked.duplicate_code.alias("error_code"), F.lit(None).cast("string").alias("error_message")
    )
    refused.unionByName(repeated).write.mode("overwrite").parquet(rejections_path(root, version))
    path = snapshot_path(root, version)
    merged.write.mode("overwrite").parquet(path)
    return spark.read.schema(entity_schema(entity)).parquet(path)


def start_state_stream(
    records: DataFrame,
    *,
    root: str,
    entity: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame],
    once: bool = True,
) -> StreamingQuery:
    """Keep the latest state of an entity from a stream; ``prepare`` projects a batch."""
    configure(records.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        version = batch_version(batch.sparkSession, root, checkpoint, batch_id)
        fold_batch(prepare(spread(batch, even=True)), root, entity, version)

    trigger = {"availableNow": True} if once else {"processingTime": "15 minutes"}
    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
