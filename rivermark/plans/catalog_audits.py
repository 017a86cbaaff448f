"""Audits of all source tables at once: constraints, unique keys and references.

The source tables are derived from the base tables, with faults by arithmetic on keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audits, ledger, quality
from . import derived
from .derived import with_ctes
from .registry import query

_LETTER = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', {key} + 1, 1)"
_EARLY, _AT, _LATE = (f"TIMESTAMP '2024-01-0{n} 00:00:00'" for n in (1, 2, 3))


def _clocks(key: str) -> dict[str, str]:
    return {"created_at": _AT, "updated_at": f"CASE WHEN {key} % 19 = 0 THEN {_EARLY} ELSE {_LATE} END"}


def _copied(prefix: str, key: str, every: int) -> str:
    """Text of a key; one in ``every`` rows has that of the row before."""
    return (
        f"concat('{prefix}', CAST(CASE WHEN {key} % {every} = 1 THEN {key} - 1 ELSE {key} END AS {{text}}))"
    )


# Table: the base table, and the columns; the first one identifies a row.
_TABLES: dict[str, tuple[str, dict[str, str]]] = {
    "currencies": (
        "nation",
        {
            "currency_code": f"CASE WHEN n_nationkey % 5 = 0 THEN 'eu' ELSE concat('CC', {_LETTER.format(key='n_nationkey')}) END",
            "minor_units": "n_nationkey % 7",
            **_clocks("n_nationkey"),
        },
    ),
    "payment_channels": (
        "nation",
        {
            "payment_channel_code": "CASE WHEN n_nationkey % 4 = 0 THEN 'x1' ELSE concat('CH_', CAST(n_nationkey AS {text})) END",
            **_clocks("n_nationkey"),
        },
    ),
    "merchant_categories": (
        "nation",
        {"category_code": "concat('100', CAST(n_nationkey % 12 AS {text}))", **_clocks("n_nationkey")},
    ),
    "customers": (
        "customer",
        {
            "customer_id": "CAST(c_custkey AS {text})",
            "external_customer_ref": _copied("X", "c_custkey", 50),
            "email": "CASE WHEN c_custkey % 40 = 1 THEN concat('USER', CAST(c_custkey - 1 AS {text}), '@x') "
            "WHEN c_custkey % 31 = 0 THEN '@x' WHEN c_custkey % 37 = 0 THEN NULL "
            "ELSE concat('User', CAST(c_custkey AS {text}), '@X') END",
            "status": "CASE WHEN c_custkey % 29 = 0 THEN 'GONE' ELSE 'ACTIVE' END",
            "country_code": "CASE WHEN c_custkey % 23 = 0 THEN 'vn' ELSE 'VN' END",
            **_clocks("c_custkey"),
        },
    ),
    "accounts": (
        "customer",
        {
            "account_id": "CAST(c_custkey AS {text})",
            "customer_id": "CAST(c_custkey * 2 AS {text})",
            "account_number": _copied("A", "c_custkey", 60),
            "currency": f"concat('CC', {_LETTER.format(key='c_nationkey')})",
            "balance": "CAST(c_acctbal AS DECIMAL(18,2))",
            "status": "CASE WHEN c_custkey % 27 = 0 THEN 'SUSPENDED' ELSE 'FROZEN' END",
            **_clocks("c_custkey"),
        },
    ),
    "merchants": (
        "supplier",
        {
            "merchant_id": "CAST(s_suppkey AS {text})",
            "merchant_code": "CASE WHEN s_suppkey % 9 = 0 THEN 'no code' ELSE concat('M-', CAST(s_suppkey AS {text})) END",
            "external_reference": _copied("E", "s_suppkey", 30),
            "category_code": "concat('100', CAST(s_suppkey % 13 AS {text}))",
            "settlement_currency": f"concat('CC', {_LETTER.format(key='s_nationkey')})",
            "country_code": "CASE WHEN s_suppkey % 11 = 0 THEN 'VNM' ELSE 'VN' END",
            "status": "CASE WHEN s_suppkey % 17 = 0 THEN 'PENDING' ELSE 'INACTIVE' END",
            **_clocks("s_suppkey"),
        },
    ),
    "payment_transactions": (
        "orders",
        {
            "transaction_id": "CAST(o_orderkey AS {text})",
            "customer_id": "CAST(o_custkey AS {text})",
            "account_id": "CAST(o_custkey + 1 AS {text})",
            "destination_account_id": "CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_custkey * 3 AS {text}) END",
            "merchant_id": "CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 130 AS {text}) END",
            "payment_channel": "concat('CH_', CAST(o_orderkey % 25 AS {text}))",
            "currency": f"concat('CC', {_LETTER.format(key='CAST(o_orderkey % 26 AS INT)')})",
            "partner_reference": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE " + _copied("P", "o_orderkey", 100) + " END",
            "idempotency_key": _copied("I", "o_orderkey", 90),
        },
    ),
    "transaction_events": (
        "events",
        {
            "event_id": "CAST(event_id AS {text})",
            "transaction_id": "CAST(user_id * 7 AS {text})",
            "event_version": "event_id % 40",
            "event_type": "CASE event_type WHEN 'signup' THEN 'PAYMENT_REQUESTED' WHEN 'view' THEN 'PAYMENT_AUTHORIZED' "
            "WHEN 'purchase' THEN 'PAYMENT_COMPLETED' WHEN 'error' THEN 'PAYMENT_FAILED' ELSE 'PAYMENT_LOST' END",
            "previous_status": "CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'AUTHORIZED' WHEN 2 THEN 'NONE' ELSE 'PENDING' END",
            "new_status": "CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'view' THEN 'AUTHORIZED' "
            "WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'FAILED' ELSE 'GONE' END",
            "event_payload_json": "CASE WHEN event_id % 14 = 0 THEN '[1]' ELSE props END",
            "event_time": "ts",
            "producer_time": "CASE WHEN event_id % 15 = 0 THEN ts - INTERVAL '1' DAY ELSE ts END",
            "created_at": "CASE WHEN event_id % 16 = 0 THEN ts - INTERVAL '1' DAY ELSE ts END",
        },
    ),
    "refunds": (
        "orders",
        {
            "refund_id": "CAST(o_orderkey AS {text})",
            "transaction_id": "CAST(o_orderkey * 2 AS {text})",
            "currency": f"concat('CC', {_LETTER.format(key='CAST(o_custkey % 26 AS INT)')})",
            "partner_reference": _copied("R", "o_orderkey", 70),
            "amount": "CAST(CASE WHEN o_orderkey % 41 = 0 THEN 0 ELSE o_totalprice END AS DECIMAL(18,2))",
            "status": "CASE WHEN o_orderkey % 43 = 0 THEN 'OPEN' WHEN o_orderstatus = 'F' THEN 'COMPLETED' ELSE 'PENDING' END",
            "reason_code": "CASE WHEN o_orderkey % 47 = 0 THEN 'late' ELSE 'LATE_2' END",
            "requested_at": "o_orderdate",
            "completed_at": "CASE WHEN o_orderkey % 53 = 0 THEN o_orderdate - INTERVAL '1' DAY "
            "WHEN o_orderstatus = 'F' AND o_orderkey % 59 <> 0 THEN o_orderdate END",
            **_clocks("o_orderkey"),
        },
    ),
}


def _columns(name: str, text: str) -> list[str]:
    return [f"{e.replace('{text}', text)} AS {c}" for c, e in _TABLES[name][1].items()]


def _source(spark, sf_dir: str, name: str) -> DataFrame:
    return derived.table(spark, sf_dir, _TABLES[name][0]).selectExpr(*_columns(name, "STRING"))


def _sources(spark, sf_dir: str, names) -> dict[str, DataFrame]:
    return {name: _source(spark, sf_dir, name) for name in names}


_WITH = "WITH " + ",\n".join(
    f"s_{name} AS (SELECT {', '.join(_columns(name, 'VARCHAR'))} FROM {base})" for name, (base, _) in _TABLES.items()
)

# What breaks each constraint.
_BROKEN = {
    "currencies": {
        "currencies_code_format": "currency_code = 'eu'",
        "currencies_minor_units_range": "minor_units > 4",
    },
    "payment_channels": {"payment_channels_code_format": "payment_channel_code = 'x1'"},
    "merchant_categories": {"merchant_categories_code_format": "length(category_code) > 4"},
    "customers": {
        "customers_country_code_format": "country_code = 'vn'",
        "customers_email_shape": "email = '@x'",
        "customers_status_valid": "status = 'GONE'",
    },
    "accounts": {
        "accounts_balance_non_negative": "balance < 0",
        "accounts_status_valid": "status = 'SUSPENDED'",
    },
    "merchants": {
        "merchants_country_code_format": "country_code = 'VNM'",
        "merchants_code_format": "merchant_code = 'no code'",
        "merchants_status_valid": "status = 'PENDING'",
    },
    "transaction_events": {
        "transaction_events_version_positive": "event_version = 0",
        "transaction_events_type_valid": "event_type = 'PAYMENT_LOST'",
        "transaction_events_previous_status_valid": "previous_status = 'NONE'",
        "transaction_events_new_status_valid": "new_status = 'GONE'",
        "transaction_events_transition_valid": """NOT (CASE event_type
            WHEN 'PAYMENT_REQUESTED' THEN previous_status IS NULL
            WHEN 'PAYMENT_AUTHORIZED' THEN previous_status = 'PENDING'
            WHEN 'PAYMENT_LOST' THEN FALSE ELSE previous_status IN ('PENDING', 'AUTHORIZED') END)""",
        "transaction_events_payload_object": "event_payload_json = '[1]'",
        "transaction_events_producer_after_event": "producer_time < event_time",
        "transaction_events_created_after_event": "created_at < event_time",
    },
    "refunds": {
        "refunds_amount_positive": "amount = 0",
        "refunds_status_valid": "status = 'OPEN'",
        "refunds_reason_code_format": "reason_code = 'late'",
        "refunds_status_timestamps_valid": "status = 'OPEN' OR (status = 'COMPLETED') <> (completed_at IS NOT NULL)",
        "refunds_completed_after_request": "completed_at < requested_at",
    },
}
for _name, _rules in _BROKEN.items():
    if _name != "transaction_events":
        _rules[f"{_name}_timestamps_ordered"] = "updated_at < created_at"


@query(
    "constraint_audit",
    _WITH
    + "\n"
    + "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, {next(iter(_TABLES[name][1]))} AS row_key, '{rule}' AS constraint_name FROM s_{name} WHERE {test}"
        for name, rules in _BROKEN.items()
        for rule, test in rules.items()
    ),
)
def constraint_audit(spark, sf_dir):
    """Broken constraints of eight source tables."""
    keys = {name: next(iter(_TABLES[name][1])) for name in _BROKEN}
    return audits.constraint_audit(_sources(spark, sf_dir, _BROKEN), keys)


_UNIQUE = {
    ("customers", "customers_external_customer_ref_key"): "external_customer_ref",
    ("customers", "ux_customers_email_case_insensitive"): "lower(email)",
    ("accounts", "accounts_account_number_key"): "account_number",
    ("merchants", "merchants_merchant_code_key"): "merchant_code",
    ("merchants", "merchants_external_reference_key"): "external_reference",
    ("payment_transactions", "payment_transactions_partner_reference_key"): "partner_reference",
    ("payment_transactions", "payment_transactions_idempotency_key_key"): "idempotency_key",
    ("transaction_events", "transaction_events_transaction_version_unique"): "transaction_id || '|' || event_version",
    ("refunds", "refunds_partner_reference_key"): "partner_reference",
}


@query(
    "unique_key_audit",
    _WITH
    + "\n"
    + "\nUNION ALL ".join(
        f"SELECT '{rule}' AS constraint_name, {key} AS key_value, count(*) AS row_count FROM s_{name} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1"
        for (name, rule), key in _UNIQUE.items()
    ),
)
def unique_key_audit(spark, sf_dir):
    """Repeated values of every unique key, e-mail addresses without regard to case."""
    return audits.unique_key_audit(_sources(spark, sf_dir, audits.UNIQUE_KEYS))


@query(
    "foreign_key_audit",
    _WITH
    + "\n"
    + "\nUNION ALL ".join(
        f"SELECT '{child}.{field}' AS relation, {field} AS reference_key, count(*) AS row_count FROM s_{child} c "
        f"WHERE {field} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM s_{parent} p WHERE p.{key} = c.{field}) GROUP BY {field}"
        for child, field, parent, key in audits.FOREIGN_KEYS
    ),
)
def foreign_key_audit(spark, sf_dir):
    """Orphans of every reference between the source tables."""
    return audits.foreign_key_audit(_sources(spark, sf_dir, _TABLES))


# --- file and batch ledgers --------------------------------------------------------

_FILE_STATUS = (
    "CASE event_type WHEN 'signup' THEN 'DISCOVERED' WHEN 'view' THEN 'VALIDATING' "
    "WHEN 'click' THEN 'VALIDATED' WHEN 'purchase' THEN 'PROCESSING' ELSE 'FAILED' END"
)
_BATCH_STATUS = (
    "CASE event_type WHEN 'signup' THEN 'COLLECTING' WHEN 'view' THEN 'SERIALIZING' "
    "WHEN 'click' THEN 'UPLOADING' WHEN 'purchase' THEN 'UPLOADED' ELSE 'FAILED' END"
)


def _illegal_sql(status: str, allowed: dict) -> str:
    pairs = ", ".join(f"('{a}', '{b}')" for a, after in allowed.items() for b in after)
    return f"""SELECT item, event_id, previous_status, status FROM (
  SELECT *, lag(status) OVER (PARTITION BY item ORDER BY ts, event_id) AS previous_status
  FROM (SELECT CAST(user_id AS VARCHAR) AS item, event_id, ts, {status} AS status FROM events))
WHERE previous_status IS NOT NULL AND (previous_status, status) NOT IN ({pairs})"""


def _illegal(spark, sf_dir: str, status: str, allowed: dict) -> DataFrame:
    rows = derived.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("item"),
        "event_id",
        "ts",
        F.expr(status).alias("status"),
        F.date_trunc("minute", "ts").alias("_minute"),
    )
    return ledger.illegal_transitions(
        rows, allowed, groups=["item"], levels=["_minute"], order=["ts", "event_id"]
    ).select("item", "event_id", "previous_status", "status")


@query("file_illegal_transitions", _illegal_sql(_FILE_STATUS, ledger.FILE_TRANSITIONS))
def file_illegal_transitions(spark, sf_dir):
    """File states that may not follow the one before."""
    return _illegal(spark, sf_dir, _FILE_STATUS, ledger.FILE_TRANSITIONS)


@query("batch_illegal_transitions", _illegal_sql(_BATCH_STATUS, ledger.BATCH_TRANSITIONS))
def batch_illegal_transitions(spark, sf_dir):
    """Batch states that may not follow the one before."""
    return _illegal(spark, sf_dir, _BATCH_STATUS, ledger.BATCH_TRANSITIONS)


# --- gates and published outputs ---------------------------------------------------


@query(
    "gate_results",
    """SELECT run_id, rule_name, observed_value, CASE WHEN observed_value >= 60 THEN 'FAIL' WHEN observed_value >= 20 THEN 'WARN' ELSE 'PASS' END AS classification
FROM (SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS rule_name, CAST(value AS DECIMAL(20,6)) AS observed_value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)""",
)
def gate_results(spark, sf_dir):
    """The last result of each rule of a run."""
    rows = derived.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("rule_name"),
        F.col("value").cast("decimal(20,6)").alias("observed_value"),
        quality.classify(F.col("value").cast("decimal(20,6)"), 20, 60).alias("classification"),
        F.struct("ts", "event_id").alias("recorded_at"),
    )
    return quality.latest_gates(rows).drop("recorded_at")


@query(
    "published_rows",
    with_ctes(
        "d_ledger",
        body="""SELECT run_id, CASE WHEN n = 1 THEN 'history' ELSE 'rejections' END AS output_type, concat('/out/', n, '/', run_id) AS path, CAST(n AS BIGINT) AS record_count
FROM (SELECT run_id, unnest([1, 2]) AS n FROM d_ledger WHERE status = 'COMPLETED')""",
    ),
)
def published_rows(spark, sf_dir):
    """Outputs of completed runs, by which readers go."""
    part = (
        '{{"output_type": "{0}", "entity_name": "accounts", "path": "/out/{1}/%s", '
        '"record_count": {1}, "content_hash": "0"}}'
    )
    text = "[" + ", ".join(part.format(*x) for x in (("history", 1), ("rejections", 2))) + "]"
    runs = derived.ledger(spark, sf_dir).withColumn("outputs_json", F.format_string(text, "run_id", "run_id"))
    return ledger.completed_outputs(runs).select("run_id", "output_type", "path", "record_count")
