"""The change-event job and the streams that feed it."""

import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rivermark.operators import ledger, normalize
from rivermark.operators.envelope import bronze_rows, parse_envelopes
from rivermark.plans.cdc_silver import bronze_objects, run_all_entities, run_cdc_silver
from rivermark.schemas import KAFKA, RUN_LEDGER
from rivermark.sinks import CollisionError, fingerprint, publish, read_runs
from rivermark.sources.kafka import file_stream
from rivermark.streaming import start_bronze_stream, start_state_stream, without_replays
from rivermark.streaming.state import read_snapshot

AT = datetime(2025, 7, 22, 5, tzinfo=UTC)


def record(entity, offset, op="c", key="k1", partition=0, raw=None, at=None, **row):
    at = offset if at is None else at
    names = {"customers": "customer_id", "accounts": "account_id", "transaction_events": "event_id"}
    name = names[entity]
    body = {name: key, **row}
    value = {
        "payload": {
            "op": op,
            "before": body if op == "d" else None,
            "after": None if op == "d" else body,
            "source": {"table": entity, "lsn": at, "txId": 1, "ts_ms": 1753158600000 + at},
            "ts_ms": 1753158600000 + at,
        }
    }
    text = None if op == "t" else raw or json.dumps(value)
    return (
        json.dumps({"payload": {name: key}}).encode(),
        text.encode() if text is not None else None,
        f"app.{entity}",
        partition,
        offset,
        AT + timedelta(seconds=offset),
    )


def feed(spark, folder, records):
    spark.createDataFrame(records, KAFKA).coalesce(1).write.mode("append").parquet(str(folder))


def ingest(spark, tmp_path, records):
    feed(spark, tmp_path / "kafka", records)
    start_bronze_stream(
        file_stream(spark, str(tmp_path / "kafka"), max_files=1),
        bronze_path=str(tmp_path / "bronze"),
        quarantine_path=str(tmp_path / "quarantine"),
        checkpoint=str(tmp_path / "checkpoint"),
    ).awaitTermination()


def options(tmp_path, **more):
    return {
        "bronze": str(tmp_path / "bronze"),
        "silver": str(tmp_path / "silver"),
        "ledger_path": str(tmp_path / "ledger"),
        "at": AT,
        **more,
    }


def output(spark, result, name):
    return spark.read.parquet(next(o.path for o in result.outputs if o.output_type == name))


def test_job_over_two_runs(spark, tmp_path):
    ingest(
        spark,
        tmp_path,
        [
            record("customers", 0, full_name="Ann Lee"),
            record("customers", 1, key="k2", full_name="Bo"),
            record("customers", 1, key="k2", full_name="Bo"),
            record("customers", 2, raw="not-json"),
            record("customers", 3, raw='{"payload":{"ts_ms":1}}'),
            record("accounts", 0, key="a1", customer_id="k1", balance="12.50"),
            record("accounts", 1, key="a2", customer_id="k9", balance="bad"),
            record("accounts", 2, key="a3", customer_id="k9", balance="MDk="),
            record("transaction_events", 0, key="e1", event_version=1, event_payload='{"b":1,"a":2}'),
        ],
    )
    quarantined = spark.read.json(str(tmp_path / "quarantine"))
    assert [r["error_code"] for r in quarantined.collect()] == ["MALFORMED_JSON"]
    trial = run_cdc_silver(spark, entity="customers", dry_run=True, **options(tmp_path))
    assert trial.input_record_count == 3 and not (tmp_path / "ledger").exists()
    customers, _, accounts, _, events, _ = run_all_entities(spark, **options(tmp_path))
    assert customers.status == "COMPLETED" and customers.rejected_record_count == 1
    assert output(spark, customers, "current").count() == 2
    assert output(spark, customers, "history").count() == 2
    names = {r["customer_id"]: (r["first_name"], r["last_name"]) for r in output(spark, customers, "current").collect()}
    assert names == {"k1": ("Ann", "Lee"), "k2": ("Bo", None)}
    assert [r["error_code"] for r in output(spark, accounts, "rejections").collect()] == ["INVALID_DECIMAL"]
    unresolved = output(spark, accounts, "unresolved_references").collect()
    assert [(r["business_key"], r["reference_key"]) for r in unresolved] == [("a3", "k9")]
    assert output(spark, events, "events").first()["event_payload_json"] == '{"a":2,"b":1}'

    assert run_cdc_silver(spark, entity="customers", **options(tmp_path)).status == "SKIPPED"
    ingest(
        spark,
        tmp_path,
        [
            record("customers", 4, op="d", full_name="Ann Lee"),
            record("customers", 5, op="t"),
            record("customers", 6, key="k2", full_name="Late", at=0),
            record("customers", 9, key="k2", partition=1, full_name="Moved"),
        ],
    )
    later = options(tmp_path, at=AT + timedelta(hours=1))
    second = run_cdc_silver(spark, entity="customers", **later)
    assert second.input_record_count == 4
    state = {r["customer_id"]: r for r in output(spark, second, "latest_all").collect()}
    assert state["k1"]["is_deleted"] and state["k1"]["kafka_offset"] == 5
    assert state["k1"]["first_name"] == "Ann"
    # The late change comes at a new offset: Kafka order decides, so it applies; the event
    # that moved partitions is refused. (Offset 0 again with other content is a RangeConflict.)
    assert state["k2"]["first_name"] == "Late"
    assert output(spark, second, "current").count() == 1
    codes = [r["error_code"] for r in output(spark, second, "rejections").collect()]
    assert codes == ["OUT_OF_ORDER_EVENT"]

    forced = run_cdc_silver(
        spark, entity="customers", force=True, **options(tmp_path, at=AT + timedelta(hours=2))
    )
    assert forced.input_record_count == 7 and forced.status == "COMPLETED"
    ledger_rows = read_runs(spark, str(tmp_path / "ledger"), latest=False).withColumn(
        "_piece", F.lit(0)
    )
    broken = ledger.illegal_transitions(
        ledger_rows,
        ledger.RUN_TRANSITIONS,
        groups=["run_id", "input_object_uri"],
        levels=["_piece"],
        order=["recorded_at"],
        initial=["DISCOVERED"],
    )
    assert broken.count() == 0


def test_incompatible_objects_are_quarantined(spark, tmp_path):
    ingest(spark, tmp_path, [record("customers", 0, full_name="Ann Lee")])
    bad = tmp_path / "bronze/entity=customers/event_date=2025-07-22/topic=t/partition=0/offset_start=0/offset_end=2"
    spark.range(3).coalesce(1).write.parquet(str(bad))
    result = run_cdc_silver(spark, entity="customers", **options(tmp_path))
    assert (result.status, result.quarantined_objects) == ("COMPLETED", 1)
    rows = read_runs(spark, str(tmp_path / "ledger")).collect()
    assert sorted(r["status"] for r in rows) == ["COMPLETED", "QUARANTINED"]
    message = next(r["error_message"] for r in rows if r["status"] == "QUARANTINED")
    assert "missing:after_json" in message


def test_bounded_runs_work_off_the_backlog_in_offset_order(spark, tmp_path):
    for n in (1, 0, 2):
        ingest(spark, tmp_path, [record("customers", n, key=f"k{n}", full_name=f"N{n}")])
    done = [run_cdc_silver(spark, entity="customers", max_objects=1, **options(tmp_path)) for _ in range(4)]
    assert [r.status for r in done] == ["COMPLETED"] * 3 + ["SKIPPED"]
    offsets = [[r["kafka_offset"] for r in output(spark, d, "history").collect()] for d in done[:3]]
    assert offsets == [[0], [1], [2]]


def test_all_pending_objects_are_taken_by_default(spark, tmp_path):
    rows = [record("customers", n, key=f"k{n}", full_name="N") for n in range(130)]
    bronze = bronze_rows(parse_envelopes(spark.createDataFrame(rows, KAFKA), ingested_at=AT))
    bronze.withColumns(
        {"entity": F.lit("customers"), "topic": F.lit("t"), "partition": F.lit(0), "offset_start": "kafka_offset"}
    ).write.partitionBy("entity", "event_date", "topic", "partition", "offset_start").parquet(str(tmp_path / "bronze"))
    result = run_cdc_silver(spark, entity="customers", **options(tmp_path))
    assert (result.objects, result.input_record_count) == (130, 130)


def test_discovery_lists_without_content(spark, tmp_path):
    ingest(spark, tmp_path, [record("customers", 0, full_name="A")])
    plan = bronze_objects(spark, str(tmp_path / "bronze"))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_new_checkpoint_keeps_bronze(spark, tmp_path):
    def start(name, offsets, **fields):
        records = [record("customers", n, key=f"k{n}", **fields) for n in offsets] + [record("customers", 90, raw="?")]
        feed(spark, tmp_path / name, records)
        start_bronze_stream(
            file_stream(spark, str(tmp_path / name), max_files=1),
            bronze_path=str(tmp_path / "bronze"),
            quarantine_path=str(tmp_path / "quarantine"),
            checkpoint=str(tmp_path / f"{name}-checkpoint"),
        ).awaitTermination()

    def offsets():
        return sorted(r["kafka_offset"] for r in spark.read.parquet(str(tmp_path / "bronze")).collect())

    start("one", [0, 1], full_name="A")
    start("two", [50], full_name="A")
    assert offsets() == [0, 1, 50]
    start("three", [0, 1], full_name="A")
    assert offsets() == [0, 1, 50] and spark.read.json(str(tmp_path / "quarantine")).count() == 1
    with pytest.raises(Exception, match="stored with other content"):
        start("four", [0, 1], full_name="B")
    assert offsets() == [0, 1, 50]


def test_replays_are_dropped_and_late_records_kept(spark, tmp_path):
    for hour in (100, 101, 0, 1, 0):
        data = [("t", 0, hour, AT + timedelta(hours=hour))]
        spark.createDataFrame(data, "kafka_topic string, kafka_partition int, kafka_offset int, ts timestamp").coalesce(
            1
        ).write.mode("append").parquet(str(tmp_path / "in"))
    events = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).option("maxFilesPerTrigger", 1)
    without_replays(events.parquet(str(tmp_path / "in"))).writeStream.format("parquet").option(
        "path", str(tmp_path / "out")
    ).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r["kafka_offset"] for r in kept) == [0, 1, 100, 101]


def test_unsupported_versions_are_quarantined(spark, tmp_path):
    messages = spark.createDataFrame([record("customers", 0, full_name="A")], KAFKA)
    rows = bronze_rows(parse_envelopes(messages, schema_version="cdc-bronze-v2", ingested_at=AT))
    rows.withColumn("entity", F.lit("customers")).write.partitionBy("entity", "event_date").parquet(
        str(tmp_path / "bronze")
    )
    result = run_cdc_silver(spark, entity="customers", **options(tmp_path))
    assert result.status == "QUARANTINED" and result.quarantined_objects == 1


def project(batch):
    rows = bronze_rows(parse_envelopes(batch, ingested_at=AT))
    events = normalize.normalize_events(rows, run_id="r", processed_at=AT)
    good = events.where(F.col("error_code").isNull()).drop("error_code", "error_message")
    return normalize.project_entity(good, "customers")


def test_state_stream_equals_batch_and_survives_replay(spark, tmp_path):
    first = [record("customers", n, key=f"k{n % 3}", full_name=f"N{n}") for n in range(6)]
    second = [record("customers", n, key=f"k{n % 3}", op="d" if n == 7 else "u", full_name=f"N{n}") for n in range(4, 9)]

    def start(checkpoint):
        start_state_stream(
            file_stream(spark, str(tmp_path / "kafka"), max_files=1),
            root=str(tmp_path / "state"),
            entity="customers",
            checkpoint=str(tmp_path / checkpoint),
            prepare=project,
        ).awaitTermination()

    feed(spark, tmp_path / "kafka", first)
    start("checkpoint")
    feed(spark, tmp_path / "kafka", second)
    start("checkpoint")
    rows = read_snapshot(spark, str(tmp_path / "state"), "customers", 10**9)
    state = {r["customer_id"]: (r["kafka_offset"], r["first_name"], r["is_deleted"]) for r in rows.collect()}
    assert state == {"k0": (6, "N6", False), "k1": (7, "N7", True), "k2": (8, "N8", False)}
    before = fingerprint(rows.select("customer_id", "kafka_offset")).first()
    start("lost-checkpoint")
    rows = read_snapshot(spark, str(tmp_path / "state"), "customers", 10**9)
    assert fingerprint(rows.select("customer_id", "kafka_offset")).first() == before


def test_state_stream_goes_on_after_a_new_checkpoint(spark, tmp_path):
    def start(folder, checkpoint, records):
        feed(spark, tmp_path / folder, records)
        start_state_stream(
            file_stream(spark, str(tmp_path / folder), max_files=1),
            root=str(tmp_path / "state"),
            entity="customers",
            checkpoint=str(tmp_path / checkpoint),
            prepare=project,
        ).awaitTermination()

    start("one", "checkpoint-one", [record("customers", n, key=f"k{n}", full_name=f"N{n}") for n in range(15)])
    start("two", "checkpoint-two", [record("customers", n, key=f"k{n}", full_name=f"N{n}") for n in range(15, 19)])
    rows = read_snapshot(spark, str(tmp_path / "state"), "customers", 10**9)
    assert sorted(r["customer_id"] for r in rows.collect()) == sorted(f"k{n}" for n in range(19))
    versions = sorted(p.name for p in (tmp_path / "state").glob("version=*"))
    assert versions == ["version=000000000001", "version=000000000002"]


def test_state_stream_keeps_what_it_refuses(spark, tmp_path):
    for records in (
        [record("customers", 5, full_name="A")],
        [record("customers", 3, full_name="Late"), record("customers", 9, partition=1, full_name="Moved")],
    ):
        feed(spark, tmp_path / "kafka", records)
        start_state_stream(
            file_stream(spark, str(tmp_path / "kafka"), max_files=1),
            root=str(tmp_path / "state"),
            entity="customers",
            checkpoint=str(tmp_path / "checkpoint"),
            prepare=project,
        ).awaitTermination()
    refused = spark.read.parquet(str(tmp_path / "state" / "rejections")).collect()
    assert sorted((r["kafka_partition"], r["kafka_offset"], r["error_code"]) for r in refused) == [
        (0, 3, "OUT_OF_ORDER_EVENT"),
        (1, 9, "OUT_OF_ORDER_EVENT"),
    ]


def test_publishing_twice(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    where = dict(root=str(tmp_path), output_type="current", entity="x", run_id="r", schema=rows.schema)
    first = publish(rows, **where)
    assert publish(rows.orderBy(F.desc("n")), **where) == first
    with pytest.raises(CollisionError):
        publish(rows.where("n = 1"), **where)
    assert "status" in RUN_LEDGER.fieldNames()


def test_overlapping_ranges_store_each_offset_once(spark, tmp_path):
    def start(name, offsets, poison=()):
        records = [record("customers", n, key=f"k{n}", full_name="A") for n in offsets]
        records += [record("customers", n, raw="?") for n in poison]
        feed(spark, tmp_path / name, records)
        start_bronze_stream(
            file_stream(spark, str(tmp_path / name), max_files=1),
            bronze_path=str(tmp_path / "bronze"),
            quarantine_path=str(tmp_path / "quarantine"),
            checkpoint=str(tmp_path / f"{name}-checkpoint"),
        ).awaitTermination()

    start("one", range(0, 100), poison=[200])
    start("two", range(0, 150), poison=[200, 201])
    start("three", range(50, 61))
    start("four", list(range(140, 170)) + [300])
    stored = spark.read.parquet(str(tmp_path / "bronze"))
    offsets = sorted(r["kafka_offset"] for r in stored.select("kafka_offset").collect())
    assert offsets == list(range(0, 170)) + [300]
    ranges = sorted(tuple(r) for r in stored.select("offset_start", "offset_end").distinct().collect())
    assert ranges == [(0, 99), (100, 149), (150, 300)]
    poison = sorted(r["original_offset"] for r in spark.read.json(str(tmp_path / "quarantine")).collect())
    assert poison == [200, 201]
    with pytest.raises(Exception, match="stored with other content"):
        feed(spark, tmp_path / "five", [record("customers", 60, key="k60", full_name="B")])
        start_bronze_stream(
            file_stream(spark, str(tmp_path / "five"), max_files=1),
            bronze_path=str(tmp_path / "bronze"),
            quarantine_path=str(tmp_path / "quarantine"),
            checkpoint=str(tmp_path / "five-checkpoint"),
        ).awaitTermination()
