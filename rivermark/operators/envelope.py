"""Change-event envelopes: Kafka-shaped rows to typed Bronze rows or poison evidence."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..schemas import CDC_BRONZE

BRONZE_VERSION = "cdc-bronze-v1"

# Error codes with their messages, first match wins.
POISON = (
    ("MALFORMED_ENCODING", "Value is not valid UTF-8"),
    ("MALFORMED_JSON", "Value is not valid JSON"),
    ("INVALID_ENVELOPE", "CDC value must be a JSON object"),
    ("MISSING_PAYLOAD", "Debezium payload is missing"),
    ("UNSUPPORTED_OPERATION", "Debezium operation is absent or unsupported"),
    ("MISSING_SOURCE", "Debezium source metadata is missing"),
    ("MISSING_SOURCE_COORDINATES", "Debezium source table or LSN is missing"),
    ("INVALID_DELETE", "Delete event must retain before state"),
    ("INVALID_AFTER", "Non-delete event must contain after state"),
    ("INVALID_SOURCE_METADATA", "Debezium source coordinate or timestamp is invalid"),
)
OPERATIONS = ("r", "c", "u", "d")

_ENVELOPE = (
    "op: STRING, before: STRING, after: STRING, source: STRING, ts_ms: STRING, transaction: STRING"
)
_SOURCE = (
    "STRUCT<table: STRING, lsn: STRING, txId: STRING, ts_ms: STRING, snapshot: STRING>"
)
_KAFKA = ("key", "value", "topic", "partition", "offset", "timestamp")


def _integer(text: str) -> str:
    """SQL of an optional integer held as JSON scalar text; decimals are cut off."""
    return (
        f"CASE WHEN {text} RLIKE '^\\\\s*[+-]?[0-9]+\\\\s*$' THEN try_cast(trim({text}) AS BIGINT) "
        f"WHEN {text} RLIKE '^-?[0-9]+[.][0-9]+$' THEN "
        f"try_cast(try_cast({text} AS DECIMAL(38,6)) AS BIGINT) END"
    )


def _is_object(text: str) -> str:
    return f"coalesce(startswith(ltrim({text}), '{{'), false)"


def topic_entity(topic: Column) -> Column:
    """Entity named by the last part of a topic."""
    return F.coalesce(F.nullif(F.substring_index(topic, ".", -1), F.lit("")), F.lit("unknown"))


def parse_envelopes(
    messages: DataFrame,
    *,
    ingested_at: datetime | Column | None = None,
    schema_version: str = BRONZE_VERSION,
) -> DataFrame:
    """Classify Kafka-shaped rows and lay out the Bronze columns.

    Adds ``kind`` (EVENT, HEARTBEAT or POISON) with ``error_code`` and
    ``error_message``; ``key`` and ``value`` are kept for the quarantine.
    """
    observed = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    if ingested_at is None:
        observed = F.current_timestamp()

    text, key_text = F.col("value").cast("string"), F.col("key").cast("string")
    exact = F.when(F.is_valid_utf8(text), fn.quote_decimals(text))
    parsed = fn.computed(
        messages,
        _KAFKA,
        _text=text,
        _doc=fn.read_fields(exact, f"payload: STRUCT<{_ENVELOPE}>, {_ENVELOPE}"),
        _key=F.when(F.is_valid_utf8(key_text), fn.canonical(key_text)),
        _key_ok=fn.read_fields(F.when(F.is_valid_utf8(key_text), key_text), "payload: STRING")["e"]
        == 1,
    )
    # A payload that is read as nothing may be absent, and the document itself is
    # the envelope, or it may be there and be no object.
    bare = F.expr(
        f"{_is_object('_text')} AND NOT array_contains(json_object_keys(_text), 'payload')"
    )
    body = F.when(F.col("_doc.v.payload").isNotNull(), F.col("_doc.v.payload")).when(
        bare,
        F.expr(
            "struct(_doc.v.op, _doc.v.before, _doc.v.after, _doc.v.source, _doc.v.ts_ms, "
            "_doc.v.transaction)"
        ),
    )
    fields = fn.computed(parsed, [*parsed.columns], _body=body)
    fields = fn.computed(
        fields,
        [*fields.columns],
        _source=F.from_json("_body.source", _SOURCE),
        _has_ts=F.expr("_body.op IS NULL AND _body.ts_ms IS NOT NULL"),
    )
    numbers = {
        "source_lsn": "_source.lsn",
        "source_tx_id": "_source.txId",
        "source_ts_ms": "_source.ts_ms",
        "connector_ts_ms": "_body.ts_ms",
    }
    fields = fn.computed(
        fields, fields.columns, **{n: F.expr(_integer(t)) for n, t in numbers.items()}
    )
    operations = ", ".join(f"'{o}'" for o in OPERATIONS)
    tests = {
        "MALFORMED_ENCODING": "NOT is_valid_utf8(_text)",
        "MALFORMED_JSON": "_doc.e IS NULL",
        "INVALID_ENVELOPE": f"NOT {_is_object('_text')}",
        "MISSING_PAYLOAD": "_body IS NULL",
        "HEARTBEAT": "_has_ts",
        "UNSUPPORTED_OPERATION": f"NOT coalesce(_body.op IN ({operations}), false)",
        "MISSING_SOURCE": f"NOT {_is_object('_body.source')}",
        "MISSING_SOURCE_COORDINATES": "_source.table IS NULL OR _source.lsn IS NULL",
        "INVALID_DELETE": "_body.op = 'd' AND _body.before IS NULL",
        "INVALID_AFTER": "_body.op <> 'd' AND _body.after IS NULL",
        "INVALID_SOURCE_METADATA": " OR ".join(
            f"({t} IS NOT NULL AND {n} IS NULL)" for n, t in numbers.items()
        ),
    }
    cases = " ".join(f"WHEN {test} THEN '{code}'" for code, test in tests.items())
    classified = fn.computed(
        fields, fields.columns, _code=F.expr(f"CASE WHEN value IS NULL THEN NULL {cases} END")
    )
    names = F.create_map(*[F.lit(x) for pair in POISON for x in pair])
    event = "_code IS NULL AND value IS NOT NULL"
    rows = classified.select(
        F.expr(
            "CASE WHEN _code = 'HEARTBEAT' THEN 'HEARTBEAT' "
            "WHEN _code IS NOT NULL THEN 'POISON' ELSE 'EVENT' END AS kind"
        ),
        F.expr("nullif(_code, 'HEARTBEAT') AS error_code"),
        names[F.col("_code")].alias("error_message"),
        fn.event_id("topic", "partition", "offset").alias("event_id"),
        F.when(F.expr(event), F.col("_source.table"))
        .otherwise(topic_entity(F.col("topic")))
        .alias("entity_name"),
        F.expr(f"CASE WHEN value IS NULL THEN 't' WHEN {event} THEN _body.op END AS operation"),
        F.when(
            F.col("key").isNotNull(),
            F.coalesce(F.when(F.col("_key_ok"), F.col("_key")), fn.base64_object(F.col("key"))),
        ).alias("event_key_json"),
        F.when(F.expr(event), fn.sorted_text(F.col("_body.before"))).alias("before_json"),
        F.when(F.expr(event), fn.sorted_text(F.col("_body.after"))).alias("after_json"),
        F.when(F.expr(event), fn.sorted_text(F.col("_body.source"))).alias("source_metadata_json"),
        *[F.when(F.expr(event), F.col(n)).alias(n) for n in numbers],
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.unix_millis("timestamp").alias("kafka_message_ts_ms"),
        observed.cast("timestamp").alias("ingested_at"),
        F.lit(schema_version).alias("schema_version"),
        F.when(F.expr(event), F.col("_text")).alias("raw_event_json"),
        "key",
        "value",
    )
    clock = F.coalesce("source_ts_ms", "connector_ts_ms", "kafka_message_ts_ms")
    return rows.select(
        "*",
        F.expr("operation = 'r' AS is_snapshot"),
        F.expr("operation IN ('d', 't') AS is_deleted"),
        F.expr("operation = 't' AS is_tombstone"),
        F.to_date(F.coalesce(fn.epoch_millis(clock), "ingested_at")).alias("event_date"),
    )


def bronze_rows(parsed: DataFrame) -> DataFrame:
    """Bronze rows in contract order, plus ``event_date`` for the layout."""
    return parsed.where("kind = 'EVENT'").select(*CDC_BRONZE.fieldNames(), "event_date")


def poison_rows(parsed: DataFrame, *, consumer_group: str) -> DataFrame:
    """Quarantine evidence: coordinates, code and the untouched bytes in base64."""
    return parsed.where("kind = 'POISON'").select(
        "event_id",
        "error_code",
        "error_message",
        F.col("kafka_topic").alias("original_topic"),
        F.col("kafka_partition").alias("original_partition"),
        F.col("kafka_offset").alias("original_offset"),
        fn.base64_text(F.col("key")).alias("original_key"),
        fn.base64_text(F.col("value")).alias("raw_value"),
        F.lit("base64").alias("value_encoding"),
        F.timestamp_millis(F.coalesce("kafka_message_ts_ms", F.lit(0))).alias("failed_at"),
        F.lit(consumer_group).alias("consumer_group"),
        F.lit(0).alias("retry_count"),
    )


def envelope_summary(messages: DataFrame) -> DataFrame:
    """Operation, table, clocks and key of each envelope, without business payloads."""
    place = ["topic", "partition", "offset"]
    rows = fn.computed(
        messages,
        place,
        _doc=fn.read_fields(F.col("value").cast("string"), f"payload: STRUCT<{_ENVELOPE}>"),
        _keys=fn.read_fields(F.col("key").cast("string"), "payload: STRING"),
    ).where("_doc.e = 1")
    rows = fn.computed(
        rows,
        place,
        _body=F.col("_doc.v.payload"),
        _key=F.expr("CASE WHEN _keys.e = 1 THEN _keys.v.payload END"),
        _source=F.from_json("_doc.v.payload.source", _SOURCE),
    )
    return rows.where(F.col("_body.op").isin(*OPERATIONS) & (F.col("_source.table") != "")).select(
        *place,
        F.col("_body.op").alias("op"),
        F.col("_source.table").alias("source_table"),
        F.col("_source.snapshot").alias("snapshot"),
        F.expr(_integer("_source.lsn")).alias("source_lsn"),
        F.expr(_integer("_source.ts_ms")).alias("source_ts_ms"),
        F.expr(_integer("_body.ts_ms")).alias("event_ts_ms"),
        F.coalesce(
            F.get_json_object("_body.transaction", "$.id"), F.col("_source.txId")
        ).alias("transaction_id"),
        F.when(fn.is_object_text(F.col("_key")), fn.canonical(F.col("_key"))).alias("key_json"),
    )
