"""Explicit schemas and code lists shared by the operators.

The field names, their order and the code spellings below are fixed values of the
data contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
_STRING, _BOOL, _INT, _LONG = T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType()
_TS, _DATE = T.TimestampType(), T.DateType()


def _schema(required: str, *fields: tuple[str, T.DataType]) -> T.StructType:
    names = set(required.split())
    return T.StructType([T.StructField(n, t, n not in names) for n, t in fields])


KAFKA = _schema(
    "topic partition offset",
    ("key", T.BinaryType()),
    ("value", T.BinaryType()),
    ("topic", _STRING),
    ("partition", _INT),
    ("offset", _LONG),
    ("timestamp", _TS),
)

CDC_BRONZE = _schema(
    "event_id entity_name operation is_snapshot is_deleted is_tombstone "
    "kafka_topic kafka_partition kafka_offset ingested_at schema_version",
    ("event_id", _STRING),
    ("entity_name", _STRING),
    ("operation", _STRING),
    ("is_snapshot", _BOOL),
    ("is_deleted", _BOOL),
    ("is_tombstone", _BOOL),
    ("event_key_json", _STRING),
    ("before_json", _STRING),
    ("after_json", _STRING),
    ("source_metadata_json", _STRING),
    ("source_lsn", _LONG),
    ("source_tx_id", _LONG),
    ("source_ts_ms", _LONG),
    ("connector_ts_ms", _LONG),
    ("kafka_topic", _STRING),
    ("kafka_partition", _INT),
    ("kafka_offset", _LONG),
    ("kafka_message_ts_ms", _LONG),
    ("ingested_at", _TS),
    ("schema_version", _STRING),
    ("raw_event_json", _STRING),
)

CDC_HISTORY = _schema(
    "event_id entity_name business_key operation is_snapshot is_deleted is_tombstone "
    "kafka_topic kafka_partition kafka_offset event_time ingested_at processed_at "
    "processing_run_id source_schema_version silver_schema_version",
    ("event_id", _STRING),
    ("entity_name", _STRING),
    ("business_key", _STRING),
    ("operation", _STRING),
    ("is_snapshot", _BOOL),
    ("is_deleted", _BOOL),
    ("is_tombstone", _BOOL),
    ("before_json", _STRING),
    ("after_json", _STRING),
    ("business_payload_json", _STRING),
    ("source_lsn", _LONG),
    ("source_tx_id", _LONG),
    ("source_ts", _TS),
    ("connector_ts", _TS),
    ("kafka_message_ts", _TS),
    ("kafka_topic", _STRING),
    ("kafka_partition", _INT),
    ("kafka_offset", _LONG),
    ("event_time", _TS),
    ("ingested_at", _TS),
    ("processed_at", _TS),
    ("processing_run_id", _STRING),
    ("source_schema_version", _STRING),
    ("silver_schema_version", _STRING),
)

LINEAGE = (
    ("is_deleted", _BOOL),
    ("source_lsn", _LONG),
    ("kafka_topic", _STRING),
    ("kafka_partition", _INT),
    ("kafka_offset", _LONG),
    ("effective_event_time", _TS),
    ("processed_at", _TS),
    ("processing_run_id", _STRING),
    ("source_schema_version", _STRING),
    ("silver_schema_version", _STRING),
)
LINEAGE_NAMES = tuple(name for name, _ in LINEAGE)

ENTITY_FIELDS: dict[str, tuple[tuple[str, T.DataType], ...]] = {
    "customers": (
        ("customer_id", _STRING),
        ("external_customer_ref", _STRING),
        ("first_name", _STRING),
        ("last_name", _STRING),
        ("email", _STRING),
        ("country_code", _STRING),
        ("status", _STRING),
        ("created_at", _TS),
        ("updated_at", _TS),
    ),
    "accounts": (
        ("account_id", _STRING),
        ("customer_id", _STRING),
        ("account_number", _STRING),
        ("currency", _STRING),
        ("balance", MONEY),
        ("status", _STRING),
        ("created_at", _TS),
        ("updated_at", _TS),
    ),
    "merchants": (
        ("merchant_id", _STRING),
        ("merchant_code", _STRING),
        ("external_reference", _STRING),
        ("merchant_name", _STRING),
        ("category_code", _STRING),
        ("country_code", _STRING),
        ("settlement_currency", _STRING),
        ("status", _STRING),
        ("created_at", _TS),
        ("updated_at", _TS),
    ),
    "payment_transactions": (
        ("transaction_id", _STRING),
        ("customer_id", _STRING),
        ("account_id", _STRING),
        ("destination_account_id", _STRING),
        ("merchant_id", _STRING),
        ("transaction_type", _STRING),
        ("payment_channel", _STRING),
        ("amount", MONEY),
        ("currency", _STRING),
        ("status", _STRING),
        ("partner_reference", _STRING),
        ("idempotency_key", _STRING),
        ("failure_code", _STRING),
        ("requested_at", _TS),
        ("completed_at", _TS),
        ("failed_at", _TS),
        ("created_at", _TS),
        ("updated_at", _TS),
    ),
    "transaction_events": (
        ("event_id", _STRING),
        ("transaction_id", _STRING),
        ("event_type", _STRING),
        ("event_version", _INT),
        ("previous_status", _STRING),
        ("new_status", _STRING),
        ("event_time", _TS),
        ("producer_time", _TS),
        ("trace_id", _STRING),
        ("source_system", _STRING),
        ("event_payload_json", _STRING),
        ("created_at", _TS),
    ),
    "refunds": (
        ("refund_id", _STRING),
        ("transaction_id", _STRING),
        ("amount", MONEY),
        ("currency", _STRING),
        ("status", _STRING),
        ("reason_code", _STRING),
        ("partner_reference", _STRING),
        ("requested_at", _TS),
        ("completed_at", _TS),
        ("created_at", _TS),
        ("updated_at", _TS),
    ),
}

BUSINESS_KEYS = {entity: fields[0][0] for entity, fields in ENTITY_FIELDS.items()}

# Dependency order: an entity comes after the entities it refers to.
ENTITY_ORDER = (
    "customers",
    "merchants",
    "accounts",
    "payment_transactions",
    "transaction_events",
    "refunds",
)

# Entity -> (field, entity it refers to).
REFERENCE_RULES = {
    "accounts": (("customer_id", "customers"),),
    "payment_transactions": (
        ("customer_id", "customers"),
        ("account_id", "accounts"),
        ("merchant_id", "merchants"),
    ),
    "refunds": (("transaction_id", "payment_transactions"),),
}

# Entity -> references that may not be empty.
REQUIRED_REFERENCES = {
    "accounts": ("customer_id",),
    "payment_transactions": ("customer_id", "account_id"),
    "refunds": ("transaction_id",),
}


def entity_schema(entity: str) -> T.StructType:
    """Typed state schema of one entity: business fields, then lineage."""
    return T.StructType(
        [T.StructField(n, t) for n, t in ENTITY_FIELDS[entity]]
        + [T.StructField(n, t) for n, t in LINEAGE]
    )


SETTLEMENT = _schema(
    "partner_id settlement_date settlement_reference partner_transaction_reference "
    "transaction_timestamp amount currency settlement_status fee_amount net_amount "
    "source_file_name source_checksum source_row_number processing_run_id processed_at",
    ("partner_id", _STRING),
    ("settlement_date", _DATE),
    ("settlement_reference", _STRING),
    ("partner_transaction_reference", _STRING),
    ("internal_transaction_id", _STRING),
    ("transaction_timestamp", _TS),
    ("amount", MONEY),
    ("currency", _STRING),
    ("settlement_status", _STRING),
    ("fee_amount", MONEY),
    ("net_amount", MONEY),
    ("source_file_name", _STRING),
    ("source_checksum", _STRING),
    ("source_row_number", _LONG),
    ("ingestion_run_id", _STRING),
    ("processing_run_id", _STRING),
    ("processed_at", _TS),
)

REJECTION = _schema(
    "source_object_uri entity_name error_code error_message raw_reference "
    "processing_run_id rejected_at",
    ("source_object_uri", _STRING),
    ("source_event_id", _STRING),
    ("entity_name", _STRING),
    ("business_key", _STRING),
    ("error_code", _STRING),
    ("error_message", _STRING),
    ("raw_reference", _STRING),
    ("processing_run_id", _STRING),
    ("rejected_at", _TS),
)

UNRESOLVED_REFERENCE = _schema(
    "entity_name business_key reference_entity reference_key reference_field "
    "classification source_event_id processing_run_id observed_at",
    ("entity_name", _STRING),
    ("business_key", _STRING),
    ("reference_entity", _STRING),
    ("reference_key", _STRING),
    ("reference_field", _STRING),
    ("classification", _STRING),
    ("source_event_id", _STRING),
    ("processing_run_id", _STRING),
    ("observed_at", _TS),
)

RUN_LEDGER = _schema(
    "run_id pipeline_name source_type entity_name input_object_uri input_checksum status "
    "started_at code_version schema_version",
    ("run_id", _STRING),
    ("pipeline_name", _STRING),
    ("source_type", _STRING),
    ("entity_name", _STRING),
    ("input_object_uri", _STRING),
    ("input_checksum", _STRING),
    ("input_record_count", _LONG),
    ("status", _STRING),
    ("started_at", _TS),
    ("recorded_at", _TS),
    ("completed_at", _TS),
    ("outputs_json", _STRING),
    ("output_record_count", _LONG),
    ("rejected_record_count", _LONG),
    ("error_code", _STRING),
    ("error_message", _STRING),
    ("code_version", _STRING),
    ("schema_version", _STRING),
)
