"""Rejection rows, aggregate quality gates and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import REJECTION
from .dedup import latest_per_key

# Classes of a gate, mildest first, and the run status they lead to.
CLASSES = ("PASS", "WARN", "FAIL")
RUN_STATUS = {"PASS": "SUCCEEDED", "WARN": "PARTIAL", "FAIL": "FAILED"}

# Default thresholds, (warn, fail).
REJECTION_RATE = (0.01, 0.05)
CONSUMER_LAG = (1_000, 10_000)
FRESHNESS_SECONDS = (120, 600)


def rejection_rows(
    rows: DataFrame,
    *,
    code: Column,
    message: Column,
    reference: Column,
    source: Column,
    event_id: Column,
    entity: Column,
    business_key: Column,
    run_id: Column,
    rejected_at: Column,
) -> DataFrame:
    """Bounded evidence of rejected rows, without their payload."""
    values = {
        "source_object_uri": source,
        "source_event_id": event_id,
        "entity_name": entity,
        "business_key": business_key,
        "error_code": code,
        "error_message": F.substring(message, 1, 1000),
        "raw_reference": F.substring(reference, 1, 512),
        "processing_run_id": run_id,
        "rejected_at": rejected_at,
    }
    return rows.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in REJECTION.fields]
    )


def settlement_quality_code(joined_codes: Column) -> Column:
    """Quality code of a settlement row by what its joined codes contain."""
    return (
        F.when(joined_codes.contains("DECIMAL") | joined_codes.contains("AMOUNT"), "INVALID_DECIMAL")
        .when(
            joined_codes.contains("TIMESTAMP") | joined_codes.contains("DATE"), "INVALID_TIMESTAMP"
        )
        .when(joined_codes.contains("INTERNAL_TRANSACTION_ID"), "INVALID_REFERENCE")
        .otherwise("INVALID_BRONZE_SCHEMA")
    )


def classify(observed: Column, warn: float, fail: float) -> Column:
    """PASS, WARN or FAIL of a value against two lower bounds."""
    if warn > fail:
        raise ValueError("warn threshold must not exceed fail threshold")
    return F.when(observed >= fail, "FAIL").when(observed >= warn, "WARN").otherwise("PASS")


def rejection_rate(read: Column, rejected: Column) -> Column:
    return rejected.cast("double") / F.greatest(read, F.lit(1)).cast("double")


def gate_rows(
    measured: DataFrame, *, rule: str, value: Column, warn: float, fail: float, details: Column
) -> DataFrame:
    """Quality result rows of one rule."""
    return measured.select(
        F.lit(rule).alias("rule_name"),
        classify(value, warn, fail).alias("classification"),
        value.cast("decimal(20,6)").alias("observed_value"),
        F.lit(warn).cast("decimal(20,6)").alias("warn_threshold"),
        F.lit(fail).cast("decimal(20,6)").alias("fail_threshold"),
        details.alias("details"),
    )


def latest_gates(results: DataFrame) -> DataFrame:
    """The result that counts of each run and rule: the one recorded last."""
    return latest_per_key(results, keys=["run_id", "rule_name"], order=F.struct("recorded_at"))


def rejection_gate(
    counts: DataFrame, *, warn: float = REJECTION_RATE[0], fail: float = REJECTION_RATE[1]
) -> DataFrame:
    """Rejection-rate gate over ``records_read`` and ``records_rejected``."""
    return gate_rows(
        counts,
        rule="rejection_rate",
        value=rejection_rate(F.col("records_read"), F.col("records_rejected")),
        warn=warn,
        fail=fail,
        details=F.to_json(F.struct("records_read", "records_rejected")),
    )


def worst_status(gates: DataFrame, *by: str) -> DataFrame:
    """Run status: the worst class found."""
    severity = F.array_position(F.lit(list(CLASSES)), F.col("classification"))
    status = F.create_map(*[F.lit(x) for pair in RUN_STATUS.items() for x in pair])
    worst = gates.groupBy(*by).agg(F.coalesce(F.max(severity), F.lit(1)).alias("_worst"))
    return worst.select(
        *by, status[F.element_at(F.lit(list(CLASSES)), F.col("_worst").cast("int"))].alias("status")
    )


def task_totals(tasks: DataFrame, *by: str) -> DataFrame:
    """Sums over task results, with the distinct sorted output assets.

    The assets are the URIs one run wrote, a list that its ledger row holds anyway.
    """
    return tasks.groupBy(*by).agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("records_read", "records_written", "records_rejected")
        ],
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("output_assets")))).alias(
            "output_assets"
        ),
    )


def count_by(rows: DataFrame, *columns: str) -> DataFrame:
    """Row counts by the values of the given columns."""
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))


def offset_bounds(rows: DataFrame, *by: str) -> DataFrame:
    """First and last offset with the row count."""
    return rows.groupBy(*by).agg(
        F.min("kafka_offset").alias("offset_start"),
        F.max("kafka_offset").alias("offset_end"),
        F.count(F.lit(1)).alias("row_count"),
    )


def run_totals(outputs: DataFrame) -> DataFrame:
    """Per run: rows published outside of rejections, and rows rejected."""
    rejected = F.col("output_type") == "rejections"
    return outputs.groupBy("run_id").agg(
        F.coalesce(F.sum(F.when(~rejected, F.col("record_count"))), F.lit(0)).alias(
            "output_record_count"
        ),
        F.coalesce(F.sum(F.when(rejected, F.col("record_count"))), F.lit(0)).alias(
            "rejected_record_count"
        ),
    )
