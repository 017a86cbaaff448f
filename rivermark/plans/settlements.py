"""The settlement job: partner files to raw, Silver and rejection datasets."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import file_id
from ..operators import ledger, quality, settlement
from ..operators.contract import Contract, load_contract
from ..operators.normalize import SILVER_VERSION
from ..schemas import REJECTION, SETTLEMENT
from ..session import configure, shared_dir
from ..sinks import Published, append_gates, append_runs, publish, read_runs
from ..sources import settlement_files as source

PIPELINE = "settlement-to-silver"
# Fixed value: name of the source in file identities.
SOURCE = "banking_partner_settlement"
CODE_VERSION = "1"


@dataclass
class SettlementResult:
    run_id: str
    status: str
    files: int = 0
    processed_files: int = 0
    quarantined_files: int = 0
    input_record_count: int = 0
    output_record_count: int = 0
    rejected_record_count: int = 0
    gate: str = "PASS"
    outputs: list[Published] = field(default_factory=list)
    duplicate_files: int = 0


def classify_files(files: DataFrame, runs: DataFrame) -> DataFrame:
    """Add how each file relates to the files of earlier runs."""
    known = runs.where(F.col("pipeline_name") == PIPELINE).select(
        F.col("entity_name").alias("partner_id"),
        F.element_at(F.split("input_object_uri", "/"), -1).alias("file_name"),
        F.col("input_checksum").alias("checksum_sha256"),
        F.col("started_at").alias("discovered_at"),
    )
    owner = F.coalesce("partner_id", F.lit("UNKNOWN"))
    return ledger.duplicate_kind(files.withColumn("partner_id", owner), known)


def first_of_content(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files that are the first of their partner with their content, and the others.

    The first is the one of smallest name, so a content is registered once per run. Files
    that are refused as such are neither first nor copies: each keeps its evidence.
    """
    keys = ["partner_id", "input_checksum"]
    sound = files.where(F.col("error_code").isNull())
    first = sound.groupBy(*keys).agg(F.min(F.struct("file_name", "path")).alias("_first"))
    marked = files.join(first, keys, "left").withColumn(
        "_is_first", F.col("error_code").isNotNull() | (F.col("_first.path") == F.col("path"))
    )
    one, other = (marked.where(c).select(*files.columns) for c in (F.col("_is_first"), ~F.col("_is_first")))
    return one, other


def run_settlements(
    spark: SparkSession,
    *,
    inbound: str,
    silver: str,
    raw: str,
    ledger_path: str,
    gates_path: str | None = None,
    contract: Contract | None = None,
    partner: str | None = None,
    strict: bool = False,
    force: bool = False,
    dry_run: bool = False,
    warn: float = quality.REJECTION_RATE[0],
    fail: float = quality.REJECTION_RATE[1],
    run_id: str | None = None,
    at: datetime | None = None,
    code_version: str = CODE_VERSION,
) -> SettlementResult:
    """Judge all files of a folder in one job; a bad file never stops the others.

    Files whose content was attempted before are skipped unless forced. In strict
    mode one rejected row keeps the whole file out. With ``gates_path`` the gate's result
    is recorded there.
    """
    configure(spark)
    contract = contract or load_contract()
    run_id, at = run_id or str(uuid.uuid4()), at or datetime.now(UTC)
    runs = read_runs(spark, ledger_path)
    work = shared_dir(spark, "settlements")
    found = source.identify_files(spark, inbound, contract, expected_partner=partner)
    classify_files(found, runs).select(
        "*",
        file_id(F.lit(SOURCE), F.col("partner_id"), F.col("checksum_sha256")).alias("file_id"),
        F.lit(PIPELINE).alias("pipeline_name"),
        F.col("checksum_sha256").alias("input_checksum"),
        F.lit(code_version).alias("code_version"),
        F.lit(contract.schema_version).alias("schema_version"),
    ).write.parquet(f"{work}/found")
    found = spark.read.parquet(f"{work}/found")
    # Only what the ledger doesn't know is parsed, landed and judged.
    ledger.unprocessed(found, runs, force=force).write.parquet(f"{work}/pending")
    pending = spark.read.parquet(f"{work}/pending")
    if pending.isEmpty():
        return SettlementResult(run_id, "SKIPPED")
    rows, files = source.read_settlements(spark, inbound, contract, work=work, files=pending)
    files.write.parquet(f"{work}/files")
    pending, copies = first_of_content(spark.read.parquet(f"{work}/files"))
    result = SettlementResult(run_id, "SKIPPED", duplicate_files=copies.count())

    judged = settlement.validate_rows(
        settlement.mark_file_duplicates(
            rows.join(pending.select("path"), "path", "left_semi"), contract, file=["path"]
        ),
        contract,
    )
    # Rows are read and judged once; counts and outputs use this table.
    judged.withColumn("ingestion_run_id", F.lit(run_id)).write.parquet(f"{work}/rows")
    judged = spark.read.parquet(f"{work}/rows")
    counts = settlement.file_counts(judged, file=["path"]).drop("record_count")
    outcome = pending.join(counts, "path", "left").fillna(
        0, ["record_count", "accepted_count", "rejected_count"]
    )
    refused = F.col("rejected_count") > 0 if strict else F.lit(False)
    outcome = outcome.withColumn(
        "file_code",
        F.coalesce("error_code", F.when(refused, F.lit("REJECTED_RECORDS_PRESENT"))),
    ).withColumn(
        "status", F.when(F.col("file_code").isNull(), "PROCESSED").otherwise("QUARANTINED")
    )
    totals = outcome.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("status") == "PROCESSED").alias("processed"),
        F.coalesce(F.sum("accepted_count"), F.lit(0)).alias("accepted"),
        F.coalesce(F.sum("rejected_count"), F.lit(0)).alias("rejected"),
        F.count_if(F.col("error_code").isNotNull()).alias("bad_files"),
    ).first()
    if not totals["files"]:
        return result
    result.files, result.processed_files = totals["files"], totals["processed"]
    result.quarantined_files = result.files - result.processed_files
    result.input_record_count = totals["accepted"] + totals["rejected"]

    kept = judged.join(outcome.where("status = 'PROCESSED'").select("path"), "path", "left_semi")
    accepted = settlement.accepted_rows(kept, run_id=run_id, processed_at=at)
    file_errors = quality.rejection_rows(
        outcome.where(F.col("error_code").isNotNull()),
        code=F.lit("INVALID_BRONZE_SCHEMA"),
        message=F.col("error_code"),
        reference=F.concat(F.lit("file:"), "file_name"),
        source=F.col("path"),
        event_id=F.lit(None),
        entity=F.lit("settlements"),
        business_key=F.lit(None),
        run_id=F.lit(run_id),
        rejected_at=F.lit(at),
    )
    rejections = settlement.settlement_rejections(
        judged, run_id=run_id, rejected_at=at, source=F.col("path")
    ).unionByName(file_errors)
    result.rejected_record_count = totals["rejected"] + totals["bad_files"]
    rate = result.rejected_record_count / max(result.input_record_count, 1)
    result.gate = "FAIL" if rate >= fail else "WARN" if rate >= warn else "PASS"
    result.status = quality.RUN_STATUS[result.gate]
    if dry_run:
        result.output_record_count = accepted.count()
        return result
    if gates_path:
        counted = spark.range(1).select(
            F.lit(result.input_record_count).alias("records_read"),
            F.lit(result.rejected_record_count).alias("records_rejected"),
        )
        gates = quality.rejection_gate(counted, warn=warn, fail=fail)
        append_gates(spark, gates_path, gates, run_id=run_id, at=at)

    base = dict(
        run_id=run_id,
        pipeline_name=PIPELINE,
        source_type="SETTLEMENT",
        started_at=at,
        code_version=code_version,
        schema_version=contract.schema_version,
    )
    objects = outcome.select(
        F.col("path").alias("input_object_uri"),
        "input_checksum",
        F.col("partner_id").alias("entity_name"),
        F.col("record_count").alias("input_record_count"),
        F.col("accepted_count").alias("output_record_count"),
        F.col("rejected_count").alias("rejected_record_count"),
        F.col("file_code").alias("error_code"),
        "status",
    )
    first = objects.drop("status")
    append_runs(spark, ledger_path, first, statuses=("DISCOVERED", "READING"), at=at, **base)
    land_raw(spark, inbound, outcome, raw)
    settlement.rejected_rows(judged, contract).write.mode("overwrite").json(
        f"{raw}/rejected/run_id={run_id}"
    )
    for name, frame, schema, partitions in (
        (
            "settlements",
            accepted,
            SETTLEMENT,
            {"partner": F.col("partner_id"), "settlement_day": F.col("settlement_date")},
        ),
        ("rejections", rejections, REJECTION, {"source": F.lit("settlement")}),
    ):
        written = publish(
            frame,
            root=silver,
            output_type=name,
            entity="settlements",
            run_id=run_id,
            schema=schema,
            partitions=partitions,
        )
        result.outputs.append(written)
        if name == "settlements":
            result.output_record_count = written.record_count
    published = json.dumps([asdict(o) for o in result.outputs])
    for status, steps in (
        ("PROCESSED", ("VALIDATING", "TRANSFORMING", "WRITING", "COMPLETED")),
        ("QUARANTINED", ("QUARANTINED",)),
    ):
        append_runs(
            spark,
            ledger_path,
            objects.where(F.col("status") == status).drop("status"),
            statuses=steps,
            at=datetime.now(UTC),
            completed_at=at,
            outputs_json=published if status == "PROCESSED" else "[]",
            **base,
        )
    return result


def land_raw(spark: SparkSession, inbound: str, outcome: DataFrame, raw: str) -> None:
    """Keep the bytes of every file, good ones and quarantined ones apart.

    Folders are named after the content, so landing it again changes nothing.
    """
    named = outcome.select(
        "path",
        "length",
        "has_bom",
        "file_id",
        "checksum_sha256",
        "file_name",
        F.when(F.col("status") == "PROCESSED", "bronze").otherwise("quarantine").alias("area"),
        F.coalesce("partner_id", F.lit("UNKNOWN")).alias("partner_id"),
        F.coalesce(F.col("settlement_date").cast("string"), F.lit("unknown")).alias(
            "settlement_date"
        ),
    )
    source.raw_blocks(spark, inbound, named).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("area", "partner_id", "settlement_date", "checksum_sha256").parquet(f"{raw}/files")
