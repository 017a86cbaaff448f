"""The change-event job: Bronze objects to the published Silver datasets of an entity."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from datetime import UTC, date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, inventory, ledger, normalize, quality, references, state
from ..schemas import (
    BUSINESS_KEYS,
    CDC_HISTORY,
    ENTITY_ORDER,
    REFERENCE_RULES,
    REJECTION,
    UNRESOLVED_REFERENCE,
    entity_schema,
)
from ..session import configure, shared_dir
from ..sinks import Published, append_runs, publish, read_published, read_runs
from ..sources import bronze as source

PIPELINE = "cdc-bronze-to-silver"
CODE_VERSION = "1"

# Fixed value: the message of a repeated identity.
_DUPLICATE = "Duplicate CDC identity was excluded from Silver outputs"


@dataclass
class RunResult:
    run_id: str
    entity: str
    status: str
    objects: int = 0
    quarantined_objects: int = 0
    input_record_count: int = 0
    output_record_count: int = 0
    rejected_record_count: int = 0
    outputs: list[Published] = field(default_factory=list)


def bronze_objects(spark: SparkSession, path: str) -> DataFrame:
    """Bronze files as ``object_key``, URI and identity, listed without reading them.

    A file's name holds its entity, date and offset range and is never written again with
    other rows, so name and length identify its content.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    key = F.concat(F.lit("cdc/"), F.regexp_extract("path", r"(entity=.*)$", 1))
    return files.select(
        key.alias("object_key"),
        F.col("path").alias("input_object_uri"),
        F.sha2(F.concat_ws("|", key, F.col("length").cast("string")), 256).alias("input_checksum"),
    )


def last_state(
    spark: SparkSession, runs: DataFrame, entity: str, output: str, *, exclude: DataFrame | None = None
) -> DataFrame | None:
    """Newest completed output of an entity, except of runs over the given inputs."""
    done = runs.where(
        (F.col("entity_name") == entity)
        & (F.col("status") == "COMPLETED")
        & F.col("outputs_json").contains(f'"output_type": "{output}"')
    )
    if exclude is not None:
        same = done.join(exclude.select("input_checksum"), "input_checksum").select("run_id")
        done = done.join(same.distinct(), "run_id", "left_anti")
    row = done.orderBy(F.desc("completed_at"), F.desc("run_id")).select("outputs_json").first()
    if row is None:
        return None
    path = next(o["path"] for o in json.loads(row[0]) if o["output_type"] == output)
    return read_published(spark, path, entity_schema(entity))


def _rejections(
    rows: DataFrame, code: str, message, reference, at: datetime, run_id: str
) -> DataFrame:
    return quality.rejection_rows(
        rows,
        code=F.col(code),
        message=message,
        reference=reference,
        source=F.col("source_object_uri"),
        event_id=F.col("event_id"),
        entity=F.coalesce("entity_name", F.lit("unknown")),
        business_key=F.col("business_key"),
        run_id=F.lit(run_id),
        rejected_at=F.lit(at),
    )


def run_cdc_silver(
    spark: SparkSession,
    *,
    bronze: str,
    silver: str,
    ledger_path: str,
    entity: str,
    force: bool = False,
    dry_run: bool = False,
    from_date: date | None = None,
    to_date: date | None = None,
    prefix: str | None = None,
    max_objects: int | None = None,
    run_id: str | None = None,
    at: datetime | None = None,
    code_version: str = CODE_VERSION,
) -> RunResult:
    """Process the Bronze objects of an entity that were never attempted, in one run.

    The objects of a run form one batch: duplicates are found across all of them.
    Objects that cannot be read are quarantined and do not stop the others. All pending
    objects are taken, or the first ``max_objects`` in offset order.
    """
    configure(spark)
    run_id, at = run_id or str(uuid.uuid4()), at or datetime.now(UTC)
    runs = read_runs(spark, ledger_path)
    found = inventory.discover(
        bronze_objects(spark, bronze),
        source_type="CDC",
        entity=entity,
        from_date=from_date,
        to_date=to_date,
        prefix=prefix,
    ).select(
        "object_key",
        "input_object_uri",
        "input_checksum",
        F.lit(PIPELINE).alias("pipeline_name"),
        F.lit(code_version).alias("code_version"),
        F.lit(normalize.SILVER_VERSION).alias("schema_version"),
    )
    # A bound counts what is left to do, so later runs go on behind it.
    pending = inventory.in_order(ledger.unprocessed(found, runs, force=force), max_objects=max_objects)
    names = [r["input_object_uri"] for r in pending.select("input_object_uri").collect()]
    result = RunResult(run_id, entity, "SKIPPED", len(names))
    if not names:
        return result

    bad = source.incompatible_objects(spark, names)
    good = [n for n in names if n not in bad]
    if good:
        rows = source.read_bronze(spark, bronze, files=good)
        versions = source.unsupported_versions(rows)
        wrong = {r["source_object_uri"]: r["error_code"] for r in versions.collect()}
        plain = {n.split(":", 1)[-1].lstrip("/"): n for n in good}
        for uri, code in wrong.items():
            name = plain[uri.split(":", 1)[-1].lstrip("/")]
            bad[name] = code
        good = [n for n in good if n not in bad]
    result.quarantined_objects = len(bad)
    listed = pending.select("input_object_uri", "input_checksum")
    base = dict(
        run_id=run_id,
        pipeline_name=PIPELINE,
        source_type="CDC",
        entity_name=entity,
        started_at=at,
        code_version=code_version,
        schema_version=normalize.SILVER_VERSION,
    )
    taken = spark.createDataFrame([(n,) for n in good], "input_object_uri string")
    failed = spark.createDataFrame(
        list(bad.items()) or [], "input_object_uri string, error_message string"
    )
    inputs = spark.createDataFrame(
        listed.join(taken, "input_object_uri").collect(), listed.schema
    )
    refused = spark.createDataFrame(
        listed.join(failed, "input_object_uri").collect(),
        "input_object_uri string, input_checksum string, error_message string",
    )
    if not dry_run:
        append_runs(spark, ledger_path, inputs, statuses=("DISCOVERED", "READING"), at=at, **base)
        append_runs(
            spark,
            ledger_path,
            refused.withColumn("error_code", F.lit("INVALID_BRONZE_SCHEMA")),
            statuses=("DISCOVERED", "READING", "QUARANTINED"),
            at=at,
            completed_at=at,
            rejected_record_count=1,
            **base,
        )
    if not good:
        result.status = "QUARANTINED"
        return result
    try:
        _process(spark, result, bronze, silver, good, runs, inputs, at, force, dry_run)
    except Exception as error:
        if not dry_run:
            append_runs(
                spark,
                ledger_path,
                inputs,
                statuses=("FAILED",),
                at=datetime.now(UTC),
                completed_at=at,
                error_code=type(error).__name__,
                error_message=str(error)[:1000],
                **base,
            )
        raise
    result.status = "COMPLETED"
    if not dry_run:
        append_runs(
            spark,
            ledger_path,
            inputs,
            statuses=("VALIDATING", "TRANSFORMING", "WRITING", "COMPLETED"),
            at=datetime.now(UTC),
            completed_at=at,
            outputs_json=json.dumps([asdict(o) for o in result.outputs]),
            input_record_count=result.input_record_count,
            output_record_count=result.output_record_count,
            rejected_record_count=result.rejected_record_count,
            **base,
        )
    return result


def _process(spark, result, bronze, silver, files, runs, inputs, at, force, dry_run) -> None:
    entity, run_id = result.entity, result.run_id
    key = BUSINESS_KEYS[entity]
    events = normalize.normalize_events(
        source.read_bronze(spark, bronze, files=files), run_id=run_id, processed_at=at
    )
    # Parsing is done once: every output below reads this table.
    work = shared_dir(spark, "cdc-silver")
    normalize.project_entity(events, entity).write.parquet(work)
    parsed = spark.read.parquet(work)
    sound = parsed.where(F.col("error_code").isNull())
    marked = dedup.mark_duplicates(sound, tie=normalize.ADDRESS)
    fresh = marked.where(F.col("duplicate_code").isNull())
    coordinate = F.concat_ws(
        ":", F.lit("coordinate"), "kafka_topic", "kafka_partition", "kafka_offset"
    )
    event = F.concat(F.lit("row:event_id="), F.coalesce("event_id", F.lit("unknown")))
    rejected = [
        _rejections(
            parsed.where(F.col("error_code").isNotNull()),
            "error_code",
            F.col("error_message"),
            event,
            at,
            run_id,
        ),
        _rejections(
            marked.where(F.col("duplicate_code").isNotNull()),
            "duplicate_code",
            F.lit(_DUPLICATE),
            coordinate,
            at,
            run_id,
        ),
    ]
    outputs: dict[str, tuple[DataFrame, object, dict, tuple]] = {
        "history": (
            fresh.select(*CDC_HISTORY.fieldNames()),
            CDC_HISTORY,
            {"event_date": F.to_date("event_time")},
            ("kafka_partition", "kafka_offset"),
        )
    }
    if entity == "transaction_events":
        unsound = fresh.where(F.col("projection_code").isNotNull())
        rejected.append(
            _rejections(unsound, "projection_code", F.col("projection_message"), event, at, run_id)
        )
        outputs["events"] = (
            state.append_only_rows(fresh, entity),
            entity_schema(entity),
            {"event_date": F.to_date("effective_event_time")},
            (key,),
        )
    else:
        snapshot = last_state(spark, runs, entity, "latest_all", exclude=inputs if force else None)
        decided = state.decide_events(fresh, snapshot, key=key)
        applied = decided.where("decision = 'APPLY'")
        rejected.append(
            _rejections(
                decided.where("decision = 'REJECT'"),
                "decision_code",
                F.col("decision_message"),
                event,
                at,
                run_id,
            )
        )
        schema = entity_schema(entity)
        latest = state.merge_state(applied, snapshot, entity)
        outputs["latest_all"] = (latest, schema, {}, (key,))
        outputs["current"] = (state.current(latest), schema, {}, (key,))
        if entity in REFERENCE_RULES:
            known = {}
            for _, target in REFERENCE_RULES[entity]:
                table = last_state(spark, runs, target, "current")
                if table is not None:
                    known[target] = table.select(BUSINESS_KEYS[target])
            outputs["unresolved_references"] = (
                references.unresolved_references(
                    applied, known, entity, snapshot=snapshot, observed_at=at
                ),
                UNRESOLVED_REFERENCE,
                {},
                (),
            )
    outputs["rejections"] = (
        reduce(DataFrame.unionByName, rejected), REJECTION, {"source": F.lit("cdc")}, ()
    )
    result.input_record_count = parsed.count()
    for name in list(outputs):
        rows, schema, partitions, sort = outputs[name]
        if dry_run:
            count = rows.count()
        else:
            written = publish(
                rows,
                root=silver,
                output_type=name,
                entity=entity,
                run_id=run_id,
                schema=schema,
                partitions=partitions,
                sort=sort,
            )
            result.outputs.append(written)
            count = written.record_count
            if name == "latest_all":
                # The current rows come from what was just published.
                published = read_published(spark, written.path, schema)
                outputs["current"] = (state.current(published), schema, {}, (key,))
        if name == "rejections":
            result.rejected_record_count = count
        else:
            result.output_record_count += count


def run_all_entities(spark: SparkSession, **options) -> list[RunResult]:
    """One run per entity, in dependency order, so references see their targets."""
    return [run_cdc_silver(spark, entity=entity, **options) for entity in ENTITY_ORDER]


def run_backfill(spark: SparkSession, request: inventory.Backfill, **options) -> list[RunResult]:
    """Process a checked backfill request."""
    if request.source_type != "CDC":
        raise ValueError("settlement backfills run through the settlement job")
    entities = [request.entity] if request.entity else list(ENTITY_ORDER)
    return [
        run_cdc_silver(
            spark,
            entity=entity,
            force=request.force,
            dry_run=request.dry_run,
            from_date=request.from_date,
            to_date=request.to_date,
            prefix=request.input_prefix,
            **options,
        )
        for entity in entities
    ]
