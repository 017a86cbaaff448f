"""Run, file and batch ledgers: identities, latest attempts, legality and progress."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scan
from .dedup import latest_per_key

IDENTITY = ("pipeline_name", "input_checksum", "code_version", "schema_version")

# The statuses each status may be followed by.
RUN_TRANSITIONS = {
    "DISCOVERED": ("READING", "FAILED", "QUARANTINED"),
    "READING": ("VALIDATING", "FAILED", "QUARANTINED"),
    "VALIDATING": ("TRANSFORMING", "FAILED", "QUARANTINED"),
    "TRANSFORMING": ("WRITING", "FAILED", "QUARANTINED"),
    "WRITING": ("COMPLETED", "FAILED"),
    "COMPLETED": (),
    "FAILED": (),
    "QUARANTINED": (),
}
FILE_TRANSITIONS = {
    "DISCOVERED": ("VALIDATING", "FAILED"),
    "VALIDATING": ("VALIDATING", "VALIDATED", "QUARANTINED", "FAILED"),
    "VALIDATED": ("VALIDATING", "PROCESSING", "QUARANTINED", "FAILED"),
    "PROCESSING": ("VALIDATING", "PROCESSED", "QUARANTINED", "FAILED"),
    "FAILED": ("VALIDATING",),
    "QUARANTINED": (),
    "PROCESSED": (),
}
BATCH_TRANSITIONS = {
    "COLLECTING": ("SERIALIZING", "FAILED"),
    "SERIALIZING": ("UPLOADING", "FAILED"),
    "UPLOADING": ("UPLOADED", "FAILED"),
    "UPLOADED": ("COMMITTED",),
    "FAILED": ("SERIALIZING",),
    "COMMITTED": (),
}


def latest_attempt(
    runs: DataFrame, *, identity: Sequence[str] = IDENTITY, time: str = "started_at"
) -> DataFrame:
    """Newest run per identity, by time and then run id."""
    return latest_per_key(runs, keys=identity, order=F.struct(time, "run_id"))


def latest_completed(
    runs: DataFrame, *, identity: Sequence[str] = IDENTITY, time: str = "completed_at"
) -> DataFrame:
    """Newest completed run per identity."""
    done = runs.where("status = 'COMPLETED'")
    return latest_per_key(done, keys=identity, order=F.struct(time, "run_id"))


def latest_output(
    outputs: DataFrame,
    *,
    entity: str,
    output_type: str,
    exclude_checksum: str | None = None,
) -> DataFrame:
    """The newest completed output of one kind, at most one row.

    ``exclude_checksum`` leaves out runs of the same input when it is reprocessed.
    """
    rows = outputs.where(
        (F.col("entity_name") == entity)
        & (F.col("status") == "COMPLETED")
        & (F.col("output_type") == output_type)
    )
    if exclude_checksum is not None:
        rows = rows.where(F.col("input_checksum") != exclude_checksum)
    return rows.orderBy(F.desc("completed_at"), F.desc("run_id")).limit(1)


def unprocessed(
    inputs: DataFrame,
    runs: DataFrame,
    *,
    identity: Sequence[str] = IDENTITY,
    force: bool = False,
) -> DataFrame:
    """Inputs whose identity was never attempted; all of them when forced."""
    if force:
        return inputs
    return inputs.join(runs.select(*identity).distinct(), [*identity], "left_anti")


def completed_outputs(runs: DataFrame) -> DataFrame:
    """Outputs of the completed runs, one row each.

    ``runs`` carry the last status of each input and what its run wrote; inputs of one
    run name the same outputs.
    """
    outputs = "array<struct<output_type:string,entity_name:string,path:string,record_count:bigint,content_hash:string>>"
    return (
        runs.where("status = 'COMPLETED'")
        .select("run_id", F.explode(F.from_json("outputs_json", outputs)).alias("_output"))
        .select("run_id", "_output.*")
        .distinct()
    )


def unprocessed_counts(inputs: DataFrame, pending: DataFrame) -> DataFrame:
    """How many inputs there are and how many are still to be processed."""
    names = ("discovered_objects", "unprocessed_objects")
    zero = F.lit(0).cast("bigint")
    counts = inputs.agg(F.count(F.lit(1)).alias(names[0]), zero.alias(names[1])).unionByName(
        pending.agg(zero.alias(names[0]), F.count(F.lit(1)).alias(names[1]))
    )
    return counts.agg(*[F.sum(n).alias(n) for n in names])


def duplicate_kind(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Add ``duplicate_kind`` of each file against the files seen before.

    Both frames carry partner_id, file_name and checksum_sha256. A known content
    decides first, a known name second.
    """
    content = known.groupBy("partner_id", "checksum_sha256").agg(
        F.min_by("file_name", F.struct("discovered_at", "file_name")).alias("_known_name")
    )
    names = known.select("partner_id", "file_name").distinct().withColumn("_seen", F.lit(True))
    kind = (
        F.when(F.col("_known_name") == F.col("file_name"), "SAME_NAME_SAME_CONTENT")
        .when(F.col("_known_name").isNotNull(), "DIFFERENT_NAME_SAME_CONTENT")
        .when(F.col("_seen"), "SAME_NAME_CHANGED_CONTENT")
        .otherwise("NEW_FILE")
    )
    return (
        candidates.join(content, ["partner_id", "checksum_sha256"], "left")
        .join(names, ["partner_id", "file_name"], "left")
        .withColumn("duplicate_kind", kind)
        .drop("_known_name", "_seen")
    )


def latest_checksum(files: DataFrame) -> DataFrame:
    """Newest content seen under each file name."""
    return latest_per_key(
        files.select("partner_id", "file_name", "checksum_sha256", "discovered_at"),
        keys=["partner_id", "file_name"],
        order=F.struct("discovered_at", "checksum_sha256"),
    )


def allowed_pairs(spark: SparkSession, transitions: Mapping[str, Sequence[str]]) -> DataFrame:
    """The allowed pairs as a frame."""
    pairs = [(a, b) for a, followers in transitions.items() for b in followers]
    return spark.createDataFrame(pairs, "previous_status string, status string")


def illegal_transitions(
    events: DataFrame,
    transitions: Mapping[str, Sequence[str]],
    *,
    groups: Sequence[str],
    levels: Sequence[str],
    order: Sequence[str],
    initial: Sequence[str] | None = None,
) -> DataFrame:
    """Status events that may not follow the one before.

    ``levels`` cut the history of a group into pieces in time order; see
    :mod:`rivermark.operators.scan`. Without ``initial`` any first status will do.
    """
    linked = scan.previous(
        events,
        groups=groups,
        levels=levels,
        order=order,
        value=F.col("status"),
        name="previous_status",
    )
    pairs = F.concat_ws(">", "previous_status", "status").isin(
        *[f"{a}>{b}" for a, followers in transitions.items() for b in followers]
    )
    first = F.lit(True) if initial is None else F.col("status").isin(*initial)
    return linked.where(~F.when(F.col("previous_status").isNull(), first).otherwise(pairs))


def reconcile(batches: DataFrame, committed: DataFrame) -> DataFrame:
    """Uploaded ranges the source already moved past, as COMMITTED rows.

    ``committed`` carries topic, partition and next_offset.
    """
    return (
        batches.where("status = 'UPLOADED'")
        .join(committed, ["topic", "partition"])
        .where(F.col("next_offset") >= F.col("offset_end") + 1)
        .select(*[F.lit("COMMITTED").alias(c) if c == "status" else c for c in batches.columns])
    )


def highest_ranges(batches: DataFrame) -> DataFrame:
    """Furthest committed range per topic partition."""
    done = batches.where("status = 'COMMITTED'")
    return latest_per_key(
        done, keys=["topic", "partition"], order=F.struct("offset_end", "offset_start")
    )


def consumer_lag(high: DataFrame, committed: DataFrame) -> DataFrame:
    """Records not consumed yet per topic partition.

    ``high`` carries topic, partition, low_offset and high_offset; ``committed``
    carries topic, partition and next_offset, negative or absent when unknown.
    """
    at = F.when(F.col("next_offset") >= 0, F.col("next_offset")).otherwise(F.col("low_offset"))
    return high.join(committed, ["topic", "partition"], "left").select(
        "topic", "partition", F.greatest(F.col("high_offset") - at, F.lit(0)).alias("lag")
    )


def freshness(batches: DataFrame, now: Column) -> DataFrame:
    """Seconds since the last commit, and the number of committed batches."""
    done = F.col("status") == "COMMITTED"
    last = F.max(F.when(done, F.col("committed_at")))
    micros = F.timestamp_diff("MICROSECOND", F.col("last_committed_at"), now)
    return batches.agg(
        last.alias("last_committed_at"),
        F.count_if(done).alias("committed_batch_count"),
    ).select(
        "last_committed_at",
        "committed_batch_count",
        F.greatest(micros / F.lit(1_000_000), F.lit(0.0)).alias("freshness_seconds"),
    )


def missing_topics(required: DataFrame, present: DataFrame) -> DataFrame:
    """Required topics that are not there."""
    return required.select("topic").distinct().join(present, "topic", "left_anti")


def outcome_counts(files: DataFrame, *by: str) -> DataFrame:
    """Files and runs by outcome."""
    return files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.count_if(F.col("status").isin("PROCESSED", "COMPLETED")).alias("processed_files"),
        F.count_if(F.col("status") == "QUARANTINED").alias("quarantined_files"),
        F.count_if(F.col("status") == "FAILED").alias("failed_files"),
    )
