"""Queries over change events: envelopes, history, duplicates, state and references."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import batching, dedup, envelope, normalize, quality, references, state
from ..session import stored
from . import derived
from .derived import with_ctes
from .registry import query

RUN_AT = datetime(2024, 2, 1, tzinfo=UTC)


# --- envelopes ---------------------------------------------------------------------

_KIND = """SELECT topic AS kafka_topic, "partition" AS kafka_partition, "offset" AS kafka_offset,
  CASE WHEN fault = 9 THEN 'HEARTBEAT' WHEN fault <= 12 AND fault NOT IN (10, 11) THEN 'POISON'
    ELSE 'EVENT' END AS kind,
  CASE fault WHEN 0 THEN 'MALFORMED_JSON' WHEN 1 THEN 'INVALID_ENVELOPE' WHEN 2 THEN 'MISSING_PAYLOAD'
    WHEN 3 THEN 'UNSUPPORTED_OPERATION' WHEN 4 THEN 'MISSING_SOURCE' WHEN 5 THEN 'INVALID_SOURCE_METADATA'
    WHEN 6 THEN 'MISSING_SOURCE_COORDINATES' WHEN 7 THEN 'INVALID_DELETE' WHEN 8 THEN 'INVALID_AFTER'
    WHEN 12 THEN 'MALFORMED_JSON' END AS error_code
FROM d_wire"""


def _parsed(spark, sf_dir) -> DataFrame:
    return envelope.parse_envelopes(derived.wire(spark, sf_dir), ingested_at=RUN_AT)


@query("envelope_kinds", with_ctes("d_wire", body=_KIND))
def envelope_kinds(spark, sf_dir):
    """Record kind and poison code of every raw record."""
    return _parsed(spark, sf_dir).select(
        "kafka_topic", "kafka_partition", "kafka_offset", "kind", "error_code"
    )


@query(
    "envelope_kind_counts",
    with_ctes(
        "d_wire",
        body=f"SELECT kind, error_code, count(*) AS row_count FROM ({_KIND}) GROUP BY kind, error_code",
    ),
)
def envelope_kind_counts(spark, sf_dir):
    """Records per kind and poison code."""
    return quality.count_by(_parsed(spark, sf_dir), "kind", "error_code")


@query(
    "poison_evidence",
    with_ctes(
        "d_wire",
        body=f"""SELECT sha256(concat(topic, ':', "partition", ':', "offset")) AS event_id, k.error_code,
  topic AS original_topic, "partition" AS original_partition, "offset" AS original_offset,
  to_base64(encode(key_text)) AS original_key, to_base64(encode(value_text)) AS raw_value,
  'bridge' AS consumer_group, 0 AS retry_count
FROM d_wire JOIN ({_KIND}) k ON k.kafka_partition = "partition" AND k.kafka_offset = "offset"
WHERE k.kind = 'POISON'""",
    ),
)
def poison_evidence(spark, sf_dir):
    """Quarantine rows with the untouched bytes."""
    rows = envelope.poison_rows(_parsed(spark, sf_dir), consumer_group="bridge")
    return rows.drop("error_message", "failed_at", "value_encoding")


@query(
    "envelope_keys",
    with_ctes(
        "d_wire",
        body="""SELECT "partition" AS kafka_partition, "offset" AS kafka_offset, concat('{"payload":{"account_id":"', user_id, '"}}') AS event_key_json,
  CAST(CASE WHEN fault = 10 THEN make_timestamp(1704067201000000 + event_id * 1000000)
    ELSE make_timestamp(1704067200000000 + event_id * 1000000) END AS DATE) AS event_date
FROM d_wire WHERE fault IN (10, 11) OR fault > 12""",
    ),
)
def envelope_keys(spark, sf_dir):
    """Key text and folder date of every event record."""
    rows = envelope.bronze_rows(_parsed(spark, sf_dir))
    return rows.select("kafka_partition", "kafka_offset", "event_key_json", "event_date")


_PLAIN_BALANCE = """CASE event_id % 3
    WHEN 1 THEN concat('"', to_base64(unhex(lpad(hex(CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT)), 16, '0'))), '"')
    ELSE concat('"', CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '"') END"""
_CANONICAL = f"""concat('{{"account_id":"', CAST(user_id AS VARCHAR), '","balance":', {_PLAIN_BALANCE},
    ',"currency":"USD","customer_id":"', CAST(user_id % 40 AS VARCHAR), '","status":"', event_type,
    '","updated_at":', CAST(1704067200000000 + event_id * 1000000 AS VARCHAR), '}}')"""
_HISTORY = f"""SELECT sha256(concat(topic, ':', "partition", ':', "offset")) AS event_id,
  'accounts' AS entity_name, CAST(user_id AS VARCHAR) AS business_key,
  CASE WHEN fault = 10 THEN 't' WHEN event_type = 'signup' THEN 'c' WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS operation,
  (fault = 10 OR event_type = 'error') AS is_deleted, (fault = 10) AS is_tombstone,
  CASE WHEN fault <> 10 THEN {_CANONICAL} END AS business_payload_json,
  CASE WHEN fault <> 10 THEN event_id + 1000 END AS source_lsn,
  CASE WHEN fault <> 10 THEN event_id + 5 END AS source_tx_id,
  "partition" AS kafka_partition, "offset" AS kafka_offset,
  CASE WHEN fault = 10 THEN make_timestamp(1704067201000000 + event_id * 1000000)
    ELSE make_timestamp(1704067200000000 + event_id * 1000000) END AS event_time,
  CAST(value AS DECIMAL(18,2)) AS balance, user_id
FROM d_wire WHERE fault IN (10, 11) OR fault > 12"""


def history(spark, sf_dir) -> DataFrame:
    """Raw records to normalized history rows."""
    bronze = envelope.bronze_rows(_parsed(spark, sf_dir))
    events = normalize.normalize_events(bronze, run_id="run", processed_at=RUN_AT)
    return events.where(F.col("error_code").isNull()).drop("error_code", "error_message")


@query(
    "cdc_history",
    with_ctes("d_wire", body=f"SELECT * EXCLUDE (balance, user_id) FROM ({_HISTORY})"),
)
def cdc_history(spark, sf_dir):
    """Normalized history with canonical payload text."""
    return history(spark, sf_dir).select(
        "event_id",
        "entity_name",
        "business_key",
        "operation",
        "is_deleted",
        "is_tombstone",
        "business_payload_json",
        "source_lsn",
        "source_tx_id",
        "kafka_partition",
        "kafka_offset",
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
    )


# The sequential reading: a tombstone keeps the payload before it, an event that
# follows on a deleted key revives it.
_ACCOUNT_STATE = f"""h AS ({_HISTORY}),
e AS (SELECT *, max(CASE WHEN NOT is_tombstone THEN kafka_offset END)
        OVER (PARTITION BY business_key ORDER BY kafka_offset) AS payload_at FROM h),
z AS (SELECT *, row_number() OVER (PARTITION BY business_key ORDER BY kafka_offset DESC) AS newest
      FROM e WHERE payload_at IS NOT NULL)
SELECT z.business_key AS account_id, CAST(z.user_id % 40 AS VARCHAR) AS customer_id, p.balance,
  make_timestamp(1704067200000000 + p.kafka_offset * 1000000) AS updated_at, z.is_deleted,
  z.source_lsn, z.kafka_partition, z.kafka_offset, z.event_time AS effective_event_time
FROM z JOIN h p ON p.kafka_offset = z.payload_at WHERE z.newest = 1"""


def account_state(spark, sf_dir) -> DataFrame:
    """Raw records to the latest row of every account.

    Deciding reads the projected events twice; they are parsed once and stored.
    """
    projected = normalize.project_entity(history(spark, sf_dir), "accounts")
    projected = stored(projected.select(*state.EVENT_COLUMNS), "accounts")
    decided = state.decide_events(projected)
    return state.merge_state(decided.where("decision = 'APPLY'"), None, "accounts")


def _account_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "account_id",
        "customer_id",
        "balance",
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
        "is_deleted",
        "source_lsn",
        "kafka_partition",
        "kafka_offset",
        F.col("effective_event_time").cast("timestamp_ntz").alias("effective_event_time"),
    )


@query("accounts_latest_all", with_ctes("d_wire", body="SELECT 1").replace("\nSELECT 1", ",\n" + _ACCOUNT_STATE))
def accounts_latest_all(spark, sf_dir):
    """Raw envelopes to latest account rows, deleted ones included."""
    return _account_columns(account_state(spark, sf_dir))


@query(
    "accounts_current",
    with_ctes("d_wire", body="SELECT 1").replace("\nSELECT 1", ",\n" + _ACCOUNT_STATE)
    + " AND NOT z.is_deleted",
)
def accounts_current(spark, sf_dir):
    """Raw envelopes to current account rows."""
    return _account_columns(state.current(account_state(spark, sf_dir)))


@query(
    "envelope_summary",
    with_ctes(
        "d_wire",
        body="""SELECT "partition", "offset",
  CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
  'accounts' AS source_table, event_id + 1000 AS source_lsn,
  1704067200000 + event_id * 1000 AS source_ts_ms, 1704067200500 + event_id * 1000 AS event_ts_ms,
  CAST(event_id + 5 AS VARCHAR) AS transaction_id,
  concat('{"account_id":"', CAST(user_id AS VARCHAR), '"}') AS key_json
FROM d_wire WHERE fault > 12
UNION ALL SELECT "partition", "offset", CASE fault WHEN 5 THEN 'u' WHEN 7 THEN 'd' ELSE 'c' END,
  'accounts', CASE WHEN fault <> 5 THEN 1 END, NULL, NULL, NULL,
  concat('{"account_id":"', CAST(user_id AS VARCHAR), '"}')
FROM d_wire WHERE fault IN (5, 7, 8)""",
    ),
)
def envelope_summary(spark, sf_dir):
    """Operations and clocks of wrapped envelopes, without their payload."""
    return envelope.envelope_summary(derived.wire(spark, sf_dir)).drop("topic", "snapshot")


# --- identities and duplicates -----------------------------------------------------


@query(
    "cdc_event_identity",
    with_ctes(
        "d_cdc",
        body="""SELECT kafka_partition, kafka_offset,
  sha256(concat(kafka_topic, ':', kafka_partition, ':', kafka_offset)) AS event_id FROM d_cdc""",
    ),
)
def cdc_event_identity(spark, sf_dir):
    """Coordinate hash of every event."""
    return derived.cdc(spark, sf_dir).select(
        "kafka_partition", "kafka_offset", fn.event_id().alias("event_id")
    )


_REPLAYED = """r AS (SELECT *, 0 AS delivery FROM d_cdc
  UNION ALL SELECT *, 1 AS delivery FROM d_cdc WHERE kafka_offset % 7 = 0),
n AS (SELECT *, row_number() OVER (PARTITION BY kafka_topic, kafka_partition, kafka_offset
  ORDER BY source_lsn, source_ts, delivery) AS copy FROM r)
"""


def replayed(spark, sf_dir) -> DataFrame:
    """Change events of which every seventh was delivered twice, duplicates marked."""
    rows = derived.cdc(spark, sf_dir)
    again = rows.where("kafka_offset % 7 = 0").withColumn("delivery", F.lit(1))
    events = (
        rows.withColumn("delivery", F.lit(0))
        .unionByName(again)
        .select(
            "*",
            fn.event_id().alias("event_id"),
            F.col("source_ts").alias("event_time"),
            F.col("source_ts").alias("connector_ts"),
            F.col("source_ts").alias("ingested_at"),
        )
    )
    return dedup.mark_duplicates(events, tie=["delivery"])


@query(
    "cdc_dedup_accepted",
    with_ctes("d_cdc", body="").rstrip()
    + ",\n"
    + _REPLAYED
    + "SELECT kafka_topic, kafka_partition, kafka_offset, business_key, operation, amount, source_lsn, delivery"
    " FROM n WHERE copy = 1",
)
def cdc_dedup_accepted(spark, sf_dir):
    """First copy of every coordinate."""
    rows = replayed(spark, sf_dir).where(F.col("duplicate_code").isNull())
    return rows.select(
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "business_key",
        "operation",
        "amount",
        "source_lsn",
        "delivery",
    )


@query(
    "cdc_dedup_rejected",
    with_ctes("d_cdc", body="").rstrip()
    + ",\n"
    + _REPLAYED
    + """SELECT 'replay' AS source_object_uri,
  sha256(concat(kafka_topic, ':', kafka_partition, ':', kafka_offset)) AS source_event_id,
  'users' AS entity_name, business_key, 'DUPLICATE_COORDINATE' AS error_code,
  'Duplicate CDC identity was excluded from Silver outputs' AS error_message,
  concat('coordinate:', kafka_topic, ':', kafka_partition, ':', kafka_offset) AS raw_reference,
  'run' AS processing_run_id FROM n WHERE copy > 1""",
)
def cdc_dedup_rejected(spark, sf_dir):
    """Further copies as rejection rows."""
    rows = replayed(spark, sf_dir).where(F.col("duplicate_code").isNotNull())
    return quality.rejection_rows(
        rows,
        code=F.col("duplicate_code"),
        message=F.lit("Duplicate CDC identity was excluded from Silver outputs"),
        reference=F.concat_ws(
            ":", F.lit("coordinate"), "kafka_topic", "kafka_partition", "kafka_offset"
        ),
        source=F.lit("replay"),
        event_id=F.col("event_id"),
        entity=F.lit("users"),
        business_key=F.col("business_key"),
        run_id=F.lit("run"),
        rejected_at=F.lit(RUN_AT),
    ).drop("rejected_at")


# --- state -------------------------------------------------------------------------


def _events(rows: DataFrame) -> DataFrame:
    """Derived events with the columns the state operators read."""
    columns = set(rows.columns)
    given = {
        "event_id": fn.event_id(),
        "is_tombstone": F.lit(False),
        "is_deleted": F.col("operation").isin("d", "t"),
        "event_time": F.col("source_ts") if "source_ts" in columns else F.col("event_time"),
        "source_lsn": F.col("source_lsn") if "source_lsn" in columns else F.col("kafka_offset"),
        "problem": F.lit(None).cast("string"),
    }
    extra = [c.alias(n) for n, c in given.items() if n not in columns]
    run = F.lit("run")
    return rows.select(
        "*",
        *extra,
        F.lit(RUN_AT).alias("processed_at"),
        run.alias("processing_run_id"),
        F.lit("cdc-bronze-v1").alias("source_schema_version"),
        F.lit("silver-v1").alias("silver_schema_version"),
    ).select(
        "*",
        F.col("problem").alias("projection_code"),
        F.when(F.col("problem").isNotNull(), "amount cannot be decoded").alias(
            "projection_message"
        ),
        F.when(
            ~F.col("is_tombstone"),
            F.struct(
                F.col("business_key").alias("account_id"),
                F.col("business_key").alias("customer_id"),
                F.lit(None).cast("string").alias("account_number"),
                F.lit("USD").alias("currency"),
                F.col("amount").alias("balance"),
                F.col("operation").alias("status"),
                F.col("event_time").cast("timestamp").alias("created_at"),
                F.col("event_time").cast("timestamp").alias("updated_at"),
            ),
        ).alias("state"),
    )


def latest_state(events: DataFrame, snapshot: DataFrame | None = None) -> DataFrame:
    """Latest rows of derived events over an optional snapshot."""
    decided = state.decide_events(events, snapshot, key="account_id")
    return state.merge_state(decided.where("decision = 'APPLY'"), snapshot, "accounts")


def _state_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("account_id").alias("business_key"),
        F.col("balance").alias("amount"),
        F.col("status").alias("operation"),
        "is_deleted",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
    )


_LATEST = """SELECT business_key, amount, operation, operation = 'd' AS is_deleted,
  kafka_topic, kafka_partition, kafka_offset FROM d_cdc
QUALIFY row_number() OVER (PARTITION BY business_key ORDER BY kafka_offset DESC) = 1"""


@query("cdc_latest_all", with_ctes("d_cdc", body=_LATEST))
def cdc_latest_all(spark, sf_dir):
    """Latest row per key, deleted ones included."""
    return _state_columns(latest_state(_events(derived.cdc(spark, sf_dir))))


@query(
    "cdc_current", with_ctes("d_cdc", body=f"SELECT * FROM ({_LATEST}) WHERE NOT is_deleted")
)
def cdc_current(spark, sf_dir):
    """Latest row per key that is not deleted."""
    return _state_columns(state.current(latest_state(_events(derived.cdc(spark, sf_dir)))))


# A published state of the first offsets, then a run that brings later events and,
# on some keys, repeats earlier ones.
_SPLIT = 100


@query("cdc_state_merge", with_ctes("d_cdc", body=_LATEST))
def cdc_state_merge(spark, sf_dir):
    """Snapshot of early events merged with a later run equals one run over all."""
    events = _events(derived.cdc(spark, sf_dir))
    snapshot = latest_state(events.where(F.col("kafka_offset") < _SPLIT))
    later = events.where((F.col("kafka_offset") >= _SPLIT) | (F.col("kafka_offset") % 5 == 0))
    return _state_columns(latest_state(later, snapshot))


# One step per event and key, in order, as a machine with one accumulator would do.
_FOLD = """ev AS (SELECT *, row_number() OVER (PARTITION BY business_key
    ORDER BY kafka_topic, kafka_partition, kafka_offset) AS n FROM d_log{where}),
fold AS (
  SELECT business_key, CAST(0 AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS acc_topic,
    CAST(NULL AS INT) AS acc_partition, CAST(NULL AS BIGINT) AS acc_offset,
    CAST(NULL AS DECIMAL(18,2)) AS acc_amount, CAST(NULL AS VARCHAR) AS acc_operation,
    CAST(NULL AS BOOLEAN) AS acc_deleted,
    CAST(NULL AS VARCHAR) AS decision, CAST(NULL AS VARCHAR) AS decision_code,
    CAST(NULL AS VARCHAR) AS kafka_topic, CAST(NULL AS INT) AS kafka_partition, CAST(NULL AS BIGINT) AS kafka_offset
  FROM (SELECT DISTINCT business_key FROM d_log)
  UNION ALL
  SELECT business_key, n, CASE WHEN ok THEN kafka_topic ELSE acc_topic END,
    CASE WHEN ok THEN kafka_partition ELSE acc_partition END,
    CASE WHEN ok THEN kafka_offset ELSE acc_offset END,
    CASE WHEN ok AND NOT is_tombstone THEN amount ELSE acc_amount END,
    CASE WHEN ok AND NOT is_tombstone THEN operation ELSE acc_operation END,
    CASE WHEN ok THEN operation IN ('d', 't') ELSE acc_deleted END,
    decision, code, kafka_topic, kafka_partition, kafka_offset
  FROM (
    SELECT *, decision = 'APPLY' AS ok FROM (
      SELECT f.business_key, e.n, f.acc_topic, f.acc_partition, f.acc_offset, f.acc_amount, f.acc_operation, f.acc_deleted,
        e.kafka_topic, e.kafka_partition, e.kafka_offset, e.is_tombstone, e.amount, e.operation,
        CASE WHEN f.acc_topic = e.kafka_topic AND f.acc_partition <> e.kafka_partition THEN 'REJECT'
          WHEN f.acc_topic = e.kafka_topic AND e.kafka_offset < f.acc_offset THEN 'REJECT'
          WHEN f.acc_topic = e.kafka_topic AND e.kafka_offset = f.acc_offset THEN 'SKIP'
          WHEN e.is_tombstone AND f.acc_topic IS NULL THEN 'SKIP'
          WHEN e.is_tombstone THEN 'APPLY'
          WHEN e.problem IS NOT NULL THEN 'REJECT' ELSE 'APPLY' END AS decision,
        CASE WHEN f.acc_topic = e.kafka_topic AND f.acc_partition <> e.kafka_partition THEN 'OUT_OF_ORDER_EVENT'
          WHEN f.acc_topic = e.kafka_topic AND e.kafka_offset < f.acc_offset THEN 'OUT_OF_ORDER_EVENT'
          WHEN f.acc_topic = e.kafka_topic AND e.kafka_offset = f.acc_offset THEN NULL
          WHEN NOT e.is_tombstone THEN e.problem END AS code
      FROM fold f JOIN ev e ON e.business_key = f.business_key AND e.n = f.n + 1)))
"""
_D_LOG = with_ctes("d_log", body="").rstrip().replace("WITH ", "WITH RECURSIVE ", 1)


@query(
    "cdc_event_decisions",
    _D_LOG
    + ",\n"
    + _FOLD.format(where="")
    + """SELECT business_key, kafka_topic, kafka_partition, kafka_offset, decision, decision_code
FROM fold WHERE n > 0""",
)
def cdc_event_decisions(spark, sf_dir):
    """Which events apply, which are skipped and which are rejected, and why."""
    return state.decide_events(_events(derived.log(spark, sf_dir))).select(
        "business_key",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "decision",
        "decision_code",
    )


@query(
    "cdc_out_of_order",
    _D_LOG
    + ",\n"
    + _FOLD.format(where="")
    + """SELECT 'cdc-log' AS source_object_uri,
  sha256(concat(kafka_topic, ':', kafka_partition, ':', kafka_offset)) AS source_event_id,
  'accounts' AS entity_name, business_key, decision_code AS error_code,
  concat('event:', kafka_offset) AS raw_reference
FROM fold WHERE n > 0 AND decision = 'REJECT'""",
)
def cdc_out_of_order(spark, sf_dir):
    """Rejected events as evidence rows."""
    decided = state.decide_events(_events(derived.log(spark, sf_dir)))
    return quality.rejection_rows(
        decided.where("decision = 'REJECT'"),
        code=F.col("decision_code"),
        message=F.col("decision_message"),
        reference=F.concat(F.lit("event:"), F.col("kafka_offset")),
        source=F.lit("cdc-log"),
        event_id=F.col("event_id"),
        entity=F.lit("accounts"),
        business_key=F.col("business_key"),
        run_id=F.col("processing_run_id"),
        rejected_at=F.lit(RUN_AT),
    ).drop("error_message", "processing_run_id", "rejected_at")


@query(
    "cdc_irregular_state",
    _D_LOG
    + ",\n"
    + _FOLD.format(where="")
    + """SELECT business_key, acc_amount AS amount, acc_operation AS operation, acc_deleted AS is_deleted,
  acc_topic AS kafka_topic, acc_partition AS kafka_partition, acc_offset AS kafka_offset
FROM fold WHERE acc_topic IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY business_key ORDER BY n DESC) = 1""",
)
def cdc_irregular_state(spark, sf_dir):
    """Latest rows where keys move, topics change and rows are buried."""
    return _state_columns(latest_state(_events(derived.log(spark, sf_dir))))


# --- offset ranges -----------------------------------------------------------------

_GAPPED = """g AS (SELECT *, CAST(source_ts AS DATE) AS event_date FROM d_cdc WHERE kafka_offset % 11 <> 0),
b AS (SELECT *, CASE WHEN lag(kafka_offset) OVER w = kafka_offset - 1 AND lag(event_date) OVER w = event_date
    THEN 0 ELSE 1 END AS brk FROM g WINDOW w AS (PARTITION BY kafka_partition ORDER BY kafka_offset)),
i AS (SELECT *, sum(brk) OVER (PARTITION BY kafka_partition ORDER BY kafka_offset) AS island FROM b),
k AS (SELECT *, row_number() OVER (PARTITION BY kafka_partition, island ORDER BY kafka_offset) - 1 AS pos FROM i),
s AS (SELECT *, min(kafka_offset) OVER (PARTITION BY kafka_partition, island, pos // 4) AS range_start FROM k)
"""


def ranged(spark, sf_dir) -> DataFrame:
    """Change events with lost offsets, cut into ranges of at most four rows."""
    rows = (
        derived.cdc(spark, sf_dir)
        .where("kafka_offset % 11 <> 0")
        .select(
            "*",
            F.col("source_ts").cast("date").alias("event_date"),
            F.lit("users").alias("entity_name"),
            F.lit("cdc-bronze-v1").alias("schema_version"),
            (F.col("operation") == "c").alias("is_snapshot"),
            (F.col("operation") == "d").alias("is_deleted"),
            F.lit(False).alias("is_tombstone"),
        )
    )
    return batching.offset_ranges(rows, batch_size=4)


@query(
    "cdc_offset_batches",
    with_ctes("d_cdc", body="").rstrip()
    + ",\n"
    + _GAPPED
    + "SELECT kafka_partition, kafka_offset, range_start FROM s",
)
def cdc_offset_batches(spark, sf_dir):
    """Range of every event."""
    return ranged(spark, sf_dir).select("kafka_partition", "kafka_offset", "range_start")


@query(
    "cdc_batch_summary",
    with_ctes("d_cdc", body="").rstrip()
    + ",\n"
    + _GAPPED
    + """SELECT sha256(concat('cdc.users:', kafka_partition, ':', min(kafka_offset), ':', max(kafka_offset), ':cdc-bronze-v1')) AS batch_id,
  'cdc.users' AS topic, kafka_partition AS "partition", min(kafka_offset) AS offset_start,
  max(kafka_offset) AS offset_end, max(kafka_offset) + 1 AS next_offset, count(*) AS record_count,
  'users' AS entity_name, any_value(event_date) AS event_date, 'cdc-bronze-v1' AS schema_version,
  bool_or(operation = 'c') AS contains_snapshot, bool_or(operation = 'd') AS contains_delete,
  false AS contains_tombstone
FROM s GROUP BY kafka_partition, range_start""",
)
def cdc_batch_summary(spark, sf_dir):
    """One summary row per range."""
    return batching.range_summaries(ranged(spark, sf_dir))


@query(
    "cdc_operation_counts",
    with_ctes(
        "d_cdc", body="SELECT operation, count(*) AS row_count FROM d_cdc GROUP BY operation"
    ),
)
def cdc_operation_counts(spark, sf_dir):
    """Events per operation."""
    return quality.count_by(derived.cdc(spark, sf_dir), "operation")


@query(
    "cdc_offset_bounds",
    with_ctes(
        "d_cdc",
        body="""SELECT kafka_topic, kafka_partition, min(kafka_offset) AS offset_start,
  max(kafka_offset) AS offset_end, count(*) AS row_count FROM d_cdc GROUP BY kafka_topic, kafka_partition""",
    ),
)
def cdc_offset_bounds(spark, sf_dir):
    """First and last offset per partition."""
    return quality.offset_bounds(derived.cdc(spark, sf_dir), "kafka_topic", "kafka_partition")


# --- references --------------------------------------------------------------------

_RULES = """SELECT transaction_id AS business_key, 'customers' AS reference_entity, customer_id AS reference_key,
    'customer_id' AS reference_field FROM d_pay
  WHERE customer_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 50 <> 0)
UNION ALL SELECT transaction_id, 'accounts', account_id, 'account_id' FROM d_pay
  WHERE account_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 0)
UNION ALL SELECT transaction_id, 'merchants', merchant_id, 'merchant_id' FROM d_pay
  WHERE merchant_id NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)"""


@query("refs_unresolved", with_ctes("d_pay", body=_RULES))
def refs_unresolved(spark, sf_dir):
    """Payment references to customers, accounts and merchants that are not known."""
    customers = derived.table(spark, sf_dir, "customer")
    suppliers = derived.table(spark, sf_dir, "supplier")
    applied = derived.payments(spark, sf_dir).select(
        F.col("transaction_id").alias("business_key"),
        F.lit("cdc.payments").alias("kafka_topic"),
        F.lit(0).alias("kafka_partition"),
        F.col("transaction_id").cast("bigint").alias("kafka_offset"),
        F.lit(False).alias("is_tombstone"),
        F.col("transaction_id").alias("event_id"),
        F.lit("run").alias("processing_run_id"),
        F.struct("customer_id", "account_id", "merchant_id").alias("state"),
    )
    known = {
        "customers": customers.where("c_custkey % 50 <> 0").select(
            F.col("c_custkey").cast("string")
        ),
        "accounts": customers.where("c_acctbal > 0").select(F.col("c_custkey").cast("string")),
        "merchants": suppliers.select(F.col("s_suppkey").cast("string")),
    }
    rows = references.unresolved_references(
        applied, known, "payment_transactions", observed_at=RUN_AT
    )
    return rows.select("business_key", "reference_entity", "reference_key", "reference_field")
