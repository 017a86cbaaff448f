"""Envelope classification, Bronze columns and normalization."""

import json
from datetime import UTC, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rivermark.operators import envelope, normalize
from rivermark.schemas import KAFKA

AT = datetime(2024, 3, 5, tzinfo=UTC)
TOPIC = "shop.changes.payment_transactions"


def change(op="c", before=None, after=None, **source):
    return {
        "before": before,
        "after": after,
        "op": op,
        "source": {"table": "payment_transactions", "lsn": 4711, "txId": 31, "ts_ms": 1709631000250, **source},
        "ts_ms": 1709631000900,
    }


def messages(spark, *values, key=b'{"payload":{"transaction_id":"pay-77"}}', topic=TOPIC):
    data = []
    for n, value in enumerate(values):
        if isinstance(value, (dict, list)):
            value = json.dumps(value)
        raw = value.encode() if isinstance(value, str) else value
        data.append((key, raw, topic, 0, n, datetime(2024, 3, 5, 9, 31, tzinfo=UTC)))
    return spark.createDataFrame(data, KAFKA)


CASES = [
    ("{oops", "MALFORMED_JSON"),
    (b"\xc3(", "MALFORMED_ENCODING"),
    ("[1,2]", "INVALID_ENVELOPE"),
    ('{"payload":null}', "MISSING_PAYLOAD"),
    ('{"payload":"text"}', "MISSING_PAYLOAD"),
    ({"payload": change(op="merge", after={"k": 1})}, "UNSUPPORTED_OPERATION"),
    ({"payload": {"op": "u", "after": {"k": 1}}}, "MISSING_SOURCE"),
    ({"payload": {"op": "u", "after": {"k": 1}, "source": {"txId": 8}}}, "MISSING_SOURCE_COORDINATES"),
    ({"payload": change(op="d", after={"k": 1})}, "INVALID_DELETE"),
    ({"payload": change(op="u", before={"k": 1})}, "INVALID_AFTER"),
    ({"payload": change(after={"k": 1}, lsn="12a")}, "INVALID_SOURCE_METADATA"),
    ({"payload": change(after={"k": 1}, lsn=False)}, "INVALID_SOURCE_METADATA"),
    ('{"payload":{"op":"r"}}}', "MALFORMED_JSON"),
]


def test_poison_codes(spark):
    parsed = envelope.parse_envelopes(messages(spark, *[v for v, _ in CASES]), ingested_at=AT)
    got = [(r["kind"], r["error_code"]) for r in parsed.orderBy("kafka_offset").collect()]
    assert got == [("POISON", code) for _, code in CASES]
    evidence = envelope.poison_rows(parsed, consumer_group="g").orderBy("original_offset").first()
    assert evidence["raw_value"] == "e29vcHM=" and evidence["error_message"]


def test_events_heartbeats_and_tombstones(spark):
    row = {"transaction_id": "pay-77", "amount": 2}
    text = json.dumps({"schema": {}, "payload": change(after=row)}).replace('"amount": 2', '"amount": 7.30')
    parsed = envelope.parse_envelopes(
        messages(
            spark,
            text,
            change(op="d", before=row),
            {"payload": {"ts_ms": 1709631060000}},
            None,
            change(op="r", after=row, lsn="806"),
        ),
        ingested_at=AT,
    ).orderBy("kafka_offset").collect()
    assert [r["kind"] for r in parsed] == ["EVENT", "EVENT", "HEARTBEAT", "EVENT", "EVENT"]
    first, delete, _, tombstone, snapshot = parsed
    assert first["after_json"] == '{"amount":"7.30","transaction_id":"pay-77"}'
    assert first["event_key_json"] == '{"payload":{"transaction_id":"pay-77"}}'
    assert (first["source_lsn"], first["source_tx_id"]) == (4711, 31)
    assert first["raw_event_json"] == text
    assert delete["is_deleted"] and delete["before_json"] and delete["after_json"] is None
    assert tombstone["is_tombstone"] and tombstone["entity_name"] == "payment_transactions"
    assert tombstone["raw_event_json"] is None and tombstone["source_lsn"] is None
    assert snapshot["is_snapshot"] and snapshot["source_lsn"] == 806
    assert str(first["event_date"]) == "2024-03-05"


def test_key_that_is_no_json(spark):
    parsed = envelope.parse_envelopes(messages(spark, None, key=b"\xff"), ingested_at=AT).first()
    assert parsed["event_key_json"] == '{"base64":"/w=="}'


def bronze(spark, *values, **options):
    rows = envelope.bronze_rows(envelope.parse_envelopes(messages(spark, *values, **options), ingested_at=AT))
    return rows


def normalized(rows):
    return normalize.normalize_events(rows, run_id="r", processed_at=AT)


@pytest.mark.parametrize(
    ("column", "value", "code"),
    [
        ("entity_name", "'other'", "INVALID_BRONZE_SCHEMA"),
        ("operation", "'x'", "UNSUPPORTED_OPERATION"),
        ("event_id", "'wrong'", "DUPLICATE_EVENT"),
        ("after_json", "'[2,3]'", "INVALID_JSON"),
        ("source_metadata_json", "'{-'", "INVALID_JSON"),
        ("after_json", "'{\"transaction_id\":null}'", "MISSING_BUSINESS_KEY"),
        ("source_ts_ms", "9000000000000000", "INVALID_TIMESTAMP"),
        ("after_json", "'{}'", None),
    ],
)
def test_normalization_codes(spark, column, value, code):
    rows = bronze(spark, change(after={"transaction_id": "pay-9"}))
    changed = rows.withColumn(column, F.expr(value).cast(rows.schema[column].dataType))
    got = normalized(changed).first()
    assert got["error_code"] == code
    if code is None:
        assert got["business_key"] == "pay-77"


def test_projection(spark):
    after = {
        "transaction_id": "pay-1",
        "customer_id": "c",
        "account_id": "a",
        "amount": "AYHN",
        "requested_at": 1709631000000000,
        "completed_at": "2024-03-05T09:30:00Z",
        "failed_at": None,
        "status": "COMPLETED",
    }
    rows = bronze(
        spark,
        change(after=after),
        change(after={**after, "amount": "7,30", "requested_at": "x"}),
        change(after={**after, "requested_at": "2024-03-05T09:30:00"}),
        change(after={**after, "account_id": ""}),
        change(after={**after, "amount": 5}),
    )
    got = normalize.project_entity(normalized(rows), "payment_transactions").orderBy("kafka_offset").collect()
    assert [r["projection_code"] for r in got] == [
        None, "INVALID_DECIMAL", "INVALID_TIMESTAMP", "INVALID_REFERENCE", None,
    ]
    assert got[0]["state"]["amount"] == Decimal("987.65") and got[4]["state"]["amount"] == Decimal("5.00")
    assert got[0]["state"]["requested_at"] == got[0]["state"]["completed_at"]
    assert got[3]["projection_message"] == "Required reference is missing: account_id"
