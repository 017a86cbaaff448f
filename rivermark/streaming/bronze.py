"""Raw change records to Bronze and quarantine, replay-safe."""

from __future__ import annotations

import operator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import envelope
from ..session import configure, spread

# Fixed value: seconds between micro-batches unless told otherwise.
FLUSH_SECONDS = 5

# What a record is, apart from when it was ingested.
_CONTENT = ("event_key_json", "raw_event_json", "operation", "schema_version")


class RangeConflict(RuntimeError):
    """An offset range is stored with other records than those that came now."""


def _exists(spark, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop.Path(path))


def _stored_ranges(rows: DataFrame, path: str, fmt: str) -> DataFrame | None:
    """Stored ranges under ``path`` that overlap the span of the rows in their topic and partition.

    The spans (one row per topic and partition of the batch) become a filter on the range
    folders, so only folders that overlap the batch are read, and only their folder names.
    """
    spark = rows.sparkSession
    if not _exists(spark, path):
        return None
    spans = rows.groupBy("topic", "partition").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    overlaps = [
        (F.col("topic") == s["topic"]) & (F.col("partition") == s["partition"])
        & (F.col("offset_start") <= s["high"]) & (F.col("offset_end") >= s["low"])
        for s in spans.collect()
        if s["low"] is not None
    ]
    if not overlaps:
        return None
    reader = spark.read.format(fmt)
    if fmt == "json":
        reader = reader.schema(_stored_schema(rows))
    return reader.load(path).where(reduce(operator.or_, overlaps)).select(
        F.col("topic").cast("string").alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset_start").cast("long").alias("offset_start"),
        F.col("offset_end").cast("long").alias("offset_end"),
    ).distinct()


# What tells apart the new ranges of a batch.
_GAP = ("topic", "partition", "gap", "covered")


def _search(stored: DataFrame):
    """Function of topic, partition and offset: whether a stored range covers it, and the start
    of the next range after it. The ranges that the batch overlaps go to every task, as Spark's
    listing of their folders does."""
    ranges: dict = {}
    for r in stored.orderBy("offset_start").collect():
        starts, ends = ranges.setdefault((r["topic"], r["partition"]), ([], []))
        starts.append(r["offset_start"])
        ends.append(r["offset_end"])
    ordered = {k: (np.array(s), np.maximum.accumulate(e)) for k, (s, e) in ranges.items()}

    @F.arrow_udf("struct<covered: boolean, gap: bigint>")
    def search(topic: pa.Array, partition: pa.Array, offset: pa.Array) -> pa.Array:
        at = pc.fill_null(offset, -(1 << 62)).to_numpy(zero_copy_only=False)
        covered, gap = np.zeros(len(at), bool), np.zeros(len(at), np.int64)
        known = np.zeros(len(at), bool)
        for (t, p), (starts, reach) in ordered.items():
            mine = pc.fill_null(pc.and_(pc.equal(topic, t), pc.equal(partition, p)), False)
            mine = np.flatnonzero(mine.to_numpy(zero_copy_only=False))
            after = np.searchsorted(starts, at[mine], "right")
            covered[mine] = (after > 0) & (reach[after - 1] >= at[mine])
            known[mine] = after < len(starts)
            gap[mine] = starts[np.minimum(after, len(starts) - 1)]
        return pa.StructArray.from_arrays([pa.array(covered), pa.array(gap, mask=~known)], ["covered", "gap"])

    return search


def _place(rows: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Mark rows covered by a stored range and give the others the range of their gap.

    A row is covered when the largest end of the stored ranges that start at or before it
    reaches it. Uncovered rows between the same two stored ranges form one new range (its
    smallest and largest offset), so new ranges never overlap stored ones. The ends of the
    new ranges, a row per range, are broadcast; the rows stay where they are.
    """
    if stored is None:
        marked = rows.withColumn("covered", F.lit(False)).withColumn("gap", F.lit(None).cast("long"))
    else:
        found = rows.withColumn("_found", _search(stored)("topic", "partition", "offset"))
        marked = found.select(*rows.columns, "_found.covered", "_found.gap")
    spans = (
        marked.groupBy("topic", "partition", "gap", "covered")
        .agg(F.min("offset").alias("offset_start"), F.max("offset").alias("offset_end"))
        .withColumnsRenamed({k: f"_{k}" for k in _GAP})
    )
    same = reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in _GAP])
    return marked.join(F.broadcast(spans), same, "left").drop(*[f"_{k}" for k in _GAP])


def _new_rows(rows: DataFrame, path: str, fmt: str, identity: list[str], *, check: bool = True) -> DataFrame:
    """The rows whose offsets no stored range covers, with the range they are stored under.

    With ``check``, covered rows must be stored already with the same content; else ``RangeConflict``.
    """
    stored = _stored_ranges(rows, path, fmt)
    placed = _place(rows, stored)
    if stored is not None and check:
        content = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in _content(rows)]).alias("content")
        spark = rows.sparkSession
        kept = spark.read.format(fmt).schema(_stored_schema(rows)).load(path)
        kept = kept.join(stored, ["topic", "partition", "offset_start", "offset_end"], "left_semi")
        again = placed.where("covered").select(*identity, content)
        other = again.join(kept.select(*identity, content), [*identity, "content"], "left_anti")
        found = other.select(*identity).first()
        if found:
            raise RangeConflict("stored with other content: " + ":".join(map(str, found)))
    return placed.where(~F.col("covered")).drop("covered", "gap", "offset")


_RANGE = ("topic", "partition", "offset_start", "offset_end", "offset", "entity", "event_date")


def _stored_schema(rows: DataFrame) -> T.StructType:
    """Schema of stored rows: the data columns, then the range folders."""
    data = [f for f in rows.schema.fields if f.name not in _RANGE]
    folders = [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset_start", T.LongType()),
        T.StructField("offset_end", T.LongType()),
    ]
    return T.StructType(data + folders)


def _content(rows: DataFrame) -> list[str]:
    return [c for c in _CONTENT if c in rows.columns] or [c for c in rows.columns if c not in _RANGE]


def write_bronze(parsed: DataFrame, path: str) -> None:
    """Bronze rows of one micro-batch, in folders named after their offset ranges.

    Offsets that a stored range covers are never written again, however the batches are cut:
    a replay, a wider batch (0-149 after 0-99) and a narrower one (50-60) store each offset once.
    A covered offset stored with other content is a ``RangeConflict``, and nothing is written.
    Rows of a folder come together, and a folder with most of the rows is split over tasks at
    run time.
    """
    keys = ["entity", "event_date", "topic", "partition", "offset_start", "offset_end"]
    bronze = envelope.bronze_rows(parsed)
    rows = bronze.select(
        "*",
        F.col("entity_name").alias("entity"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").cast("long").alias("offset"),
    )
    new = _new_rows(rows, path, "parquet", ["kafka_topic", "kafka_partition", "kafka_offset"])
    (
        new.hint("rebalance", *keys)
        .sortWithinPartitions(*keys, "kafka_offset")
        .write.mode("append")
        .partitionBy(*keys)
        .option("compression", "zstd")
        .parquet(path)
    )


def write_poison(parsed: DataFrame, path: str, *, consumer_group: str) -> None:
    """Poison evidence of one micro-batch as JSON lines, by offset range like Bronze, each offset once."""
    rows = envelope.poison_rows(parsed, consumer_group=consumer_group)
    rows = rows.select(
        "*",
        F.col("original_topic").alias("topic"),
        F.col("original_partition").alias("partition"),
        F.col("original_offset").cast("long").alias("offset"),
    )
    # Evidence carries the time it was taken, so a replay is recognised by its offsets alone.
    new = _new_rows(rows, path, "json", ["original_topic", "original_partition", "original_offset"], check=False)
    new.write.mode("append").partitionBy("topic", "partition", "offset_start", "offset_end").json(path)


def start_bronze_stream(
    records: DataFrame,
    *,
    bronze_path: str,
    quarantine_path: str,
    checkpoint: str,
    consumer_group: str = "bronze",
    once: bool = True,
    every_seconds: int = FLUSH_SECONDS,
) -> StreamingQuery:
    """Parse records and write both outputs before the source position moves on.

    Heartbeats only move the position. ``once`` drains what is there and stops.
    """
    configure(records.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Parsed once, on all cores, for both outputs and their searches.
        parsed = envelope.parse_envelopes(spread(batch, even=True)).persist(StorageLevel.DISK_ONLY)
        try:
            write_poison(parsed, quarantine_path, consumer_group=consumer_group)
            write_bronze(parsed, bronze_path)
        finally:
            parsed.unpersist()

    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": f"{every_seconds} seconds"}
    return writer.trigger(**trigger).start()
