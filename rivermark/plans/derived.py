"""Change events, settlement rows, payments and ledgers derived from the base tables.

Every frame here has a twin in :data:`SQL`, common table expressions that spell the
same derivation for another engine. Faults are injected by arithmetic on keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import scan
from ..session import configure, spread, stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


SQL: dict[str, str] = {}

# --- change events, one row per record -------------------------------------------

SQL["d_cdc"] = """d_cdc AS (
  SELECT 'cdc.users' AS kafka_topic, CAST(user_id % 4 AS INT) AS kafka_partition,
    CAST(row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS BIGINT) AS kafka_offset,
    CAST(user_id AS VARCHAR) AS business_key,
    CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS operation,
    CAST(value AS DECIMAL(18,2)) AS amount, event_id AS source_lsn, ts AS source_ts
  FROM events)"""


def cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped change events; a user always maps to one partition."""
    events = table(spark, sf_dir, "events")
    rows = events.select(
        F.lit("cdc.users").alias("kafka_topic"),
        (F.col("user_id") % 4).cast("int").alias("kafka_partition"),
        F.col("user_id").cast("string").alias("business_key"),
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "error", "d")
        .otherwise("u")
        .alias("operation"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.col("event_id").alias("source_lsn"),
        F.col("ts").alias("source_ts"),
        scan.piece("event_id").alias("_piece"),
    )
    return (
        scan.row_number(
            rows,
            groups=["kafka_partition"],
            levels=["_piece"],
            order=["source_lsn"],
            name="kafka_offset",
        )
        .withColumn("kafka_offset", F.col("kafka_offset") - 1)
        .drop("_piece")
    )


# --- change events with every irregularity the state knows -------------------------

_LOG = {
    "topic": "CASE WHEN user_id % 11 = 0 AND event_id % 3 = 0 THEN 'cdc.users_b' "
    "ELSE 'cdc.users_a' END",
    "partition": "CAST(CASE WHEN user_id % 5 = 0 AND event_id % 17 = 0 THEN (user_id + 1) % 4 "
    "ELSE user_id % 4 END AS INT)",
    "operation": "CASE WHEN event_type = 'signup' THEN 'c' "
    "WHEN event_type = 'error' AND event_id % 2 = 0 THEN 't' "
    "WHEN event_type = 'error' THEN 'd' ELSE 'u' END",
    "problem": "CASE WHEN event_type = 'view' AND event_id % 7 = 0 THEN 'INVALID_DECIMAL' END",
}
SQL["d_log"] = f"""d_log AS (
  SELECT {_LOG["topic"]} AS kafka_topic, {_LOG["partition"]} AS kafka_partition,
    event_id AS kafka_offset, CAST(user_id AS VARCHAR) AS business_key,
    {_LOG["operation"]} AS operation,
    CASE WHEN {_LOG["operation"]} <> 't' THEN {_LOG["problem"]} END AS problem,
    {_LOG["operation"]} = 't' AS is_tombstone,
    CAST(value AS DECIMAL(18,2)) AS amount, ts AS event_time
  FROM events)"""


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events with moved partitions, a second topic, tombstones and bad rows."""
    rows = table(spark, sf_dir, "events").selectExpr(
        f"{_LOG['topic']} AS kafka_topic",
        f"{_LOG['partition']} AS kafka_partition",
        "event_id AS kafka_offset",
        "CAST(user_id AS STRING) AS business_key",
        f"{_LOG['operation']} AS operation",
        f"{_LOG['problem']} AS problem",
        "CAST(value AS DECIMAL(18,2)) AS amount",
        "ts AS event_time",
    )
    tombstone = F.col("operation") == "t"
    return rows.withColumn("is_tombstone", tombstone).withColumn(
        "problem", F.when(~tombstone, F.col("problem"))
    )


# --- raw records with envelopes ----------------------------------------------------

_AFTER = (
    "concat('{{\"account_id\":\"', CAST(user_id AS {text}), '\",\"customer_id\":\"', "
    "CAST(user_id % 40 AS {text}), '\",\"balance\":', "
    "CASE event_id % 3 WHEN 0 THEN concat('\"', CAST(CAST(value AS DECIMAL(18,2)) AS {text}), '\"') "
    "WHEN 1 THEN concat('\"', {base64}(unhex(lpad(hex(CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT)), 16, '0'))), '\"') "
    "ELSE CAST(CAST(value AS DECIMAL(18,2)) AS {text}) END, "
    "',\"currency\":\"USD\",\"status\":\"', event_type, '\",\"updated_at\":', "
    "CAST(1704067200000000 + event_id * 1000000 AS {text}), '}}')"
)
_SOURCE = (
    "concat('{{\"table\":\"accounts\",\"lsn\":', CAST(event_id + 1000 AS {text}), "
    "',\"txId\":', CAST(event_id + 5 AS {text}), ',\"ts_ms\":', "
    "CAST(1704067200000 + event_id * 1000 AS {text}), '}}')"
)
_OP = "CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END"
_BODY = (
    "concat('{{\"op\":\"', " + _OP + ", '\",\"before\":', "
    "CASE WHEN event_type = 'error' THEN " + _AFTER + " ELSE 'null' END, ',\"after\":', "
    "CASE WHEN event_type = 'error' THEN 'null' ELSE " + _AFTER + " END, "
    "',\"source\":', " + _SOURCE + ", ',\"ts_ms\":', "
    "CAST(1704067200500 + event_id * 1000 AS {text}), '}}')"
)
# One record in thirteen of fifty-three is damaged in its own way.
_VALUE = (
    "CASE event_id % 53 WHEN 0 THEN 'not-json' WHEN 1 THEN '[]' "
    "WHEN 2 THEN '{{\"payload\":null}}' "
    "WHEN 3 THEN '{{\"payload\":{{\"op\":\"x\",\"source\":{{}}}}}}' "
    "WHEN 4 THEN '{{\"payload\":{{\"op\":\"u\",\"after\":{{}}}}}}' "
    "WHEN 5 THEN '{{\"payload\":{{\"op\":\"u\",\"after\":{{}},\"source\":{{\"table\":\"accounts\",\"lsn\":\"bad\"}}}}}}' "
    "WHEN 6 THEN '{{\"payload\":{{\"op\":\"u\",\"after\":{{}},\"source\":{{\"lsn\":1}}}}}}' "
    "WHEN 7 THEN '{{\"payload\":{{\"op\":\"d\",\"after\":{{}},\"source\":{{\"table\":\"accounts\",\"lsn\":1}}}}}}' "
    "WHEN 8 THEN '{{\"payload\":{{\"op\":\"c\",\"before\":{{}},\"source\":{{\"table\":\"accounts\",\"lsn\":1}}}}}}' "
    "WHEN 9 THEN '{{\"payload\":{{\"ts_ms\":1704067200000}}}}' "
    "WHEN 10 THEN NULL WHEN 11 THEN " + _BODY + " "
    "WHEN 12 THEN concat('{{\"payload\":', " + _BODY + ", '}} trailing') "
    "ELSE concat('{{\"payload\":', " + _BODY + ", '}}') END"
)
_KEY = "concat('{{\"payload\":{{\"account_id\":\"', CAST(user_id AS {text}), '\"}}}}')"


def _for(template: str, engine: str) -> str:
    words = {
        "spark": {"text": "STRING", "base64": "base64"},
        "sql": {"text": "VARCHAR", "base64": "to_base64"},
    }[engine]
    return template.format(**words)


SQL["d_wire"] = f"""d_wire AS (
  SELECT 'cdc.public.accounts' AS topic, CAST(user_id % 4 AS INT) AS "partition",
    event_id AS "offset", {_for(_KEY, "sql")} AS key_text, {_for(_VALUE, "sql")} AS value_text,
    event_id % 53 AS fault, user_id, event_type, event_id, value
  FROM events)"""


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka source rows whose values are change envelopes, some of them damaged."""
    return wire_columns(spread(table(spark, sf_dir, "events")))


def wire_columns(events: DataFrame) -> DataFrame:
    """Kafka source columns of event rows, also of a stream of them."""
    return events.selectExpr(
        f"CAST({_for(_KEY, 'spark')} AS BINARY) AS key",
        f"CAST({_for(_VALUE, 'spark')} AS BINARY) AS value",
        "'cdc.public.accounts' AS topic",
        "CAST(user_id % 4 AS INT) AS partition",
        "event_id AS offset",
        "timestamp_millis(1704067201000 + event_id * 1000) AS timestamp",
    )


# --- settlement rows as text -------------------------------------------------------

_SETTLE = {
    "partner_id": "CASE WHEN l_partkey % 211 = 0 THEN 'p-bad' "
    "ELSE concat('P', CAST(l_suppkey % 10 AS {text})) END",
    "settlement_date": "CASE WHEN l_partkey % 199 = 0 THEN '2024-13-01' "
    "ELSE CAST(CAST(l_shipdate AS DATE) AS {text}) END",
    "settlement_reference": "CASE WHEN l_partkey % 107 = 0 THEN ' ' "
    "WHEN l_partkey % 113 = 0 THEN repeat('r', 129) "
    "ELSE concat(CAST(l_orderkey AS {text}), '-', CAST(l_linenumber AS {text})) END",
    "partner_transaction_reference": "concat('T', CAST(l_partkey AS {text}))",
    "internal_transaction_id": "CASE WHEN l_partkey % 127 = 0 THEN 'not-a-uuid' "
    "WHEN l_partkey % 2 = 0 THEN '' "
    "ELSE concat('00000000-0000-4000-8000-', lpad(CAST(l_orderkey AS {text}), 12, '0')) END",
    "transaction_timestamp": "concat(CAST(CAST(l_shipdate AS DATE) AS {text}), "
    "CASE WHEN l_partkey % 103 = 0 THEN 'T10:15:30' WHEN l_partkey % 109 = 0 THEN ' noon' "
    "ELSE 'T10:15:30+07:00' END)",
    "amount": "CASE WHEN l_partkey % 101 = 0 THEN concat('-', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS {text})) "
    "WHEN l_partkey % 131 = 0 THEN 'not-a-decimal' WHEN l_partkey % 137 = 0 THEN '100.001' "
    "WHEN l_partkey % 139 = 0 THEN '1234567890123456789' "
    "ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS {text}) END",
    "currency": "CASE WHEN l_partkey % 89 = 0 THEN 'usd' ELSE 'USD' END",
    "settlement_status": "CASE WHEN l_suppkey % 83 = 0 THEN 'UNKNOWN' "
    "WHEN l_returnflag = 'R' THEN 'REVERSED' WHEN l_returnflag = 'A' THEN 'SETTLED' ELSE 'FAILED' END",
    "fee_amount": "CASE WHEN l_partkey % 149 = 0 THEN '-1.00' "
    "ELSE CAST(CAST(l_quantity AS DECIMAL(18,2)) AS {text}) END",
    "net_amount": "CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_quantity AS DECIMAL(18,2)) "
    "+ CASE WHEN l_partkey % 97 = 0 THEN 0.01 ELSE 0.00 END AS DECIMAL(18,2)) AS {text})",
}
_FILE_PARTNER = "concat('P', CAST(l_suppkey % 10 AS {text}))"
_LINE_ORDER = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, "
    "l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus"
)


def _file_name(text: str) -> str:
    return (
        f"concat('settlement_', {_FILE_PARTNER.format(text=text)}, '_', "
        f"CAST(CAST(l_shipdate AS DATE) AS {text}), '_001.csv')"
    )


SQL["d_settle"] = (
    "d_settle AS (\n  SELECT "
    + ",\n    ".join(f"{e.format(text='VARCHAR')} AS {n}" for n, e in _SETTLE.items())
    + f""",
    {_file_name("VARCHAR")} AS source_file_name,
    {_FILE_PARTNER.format(text="VARCHAR")} AS file_partner_id,
    CAST(l_shipdate AS DATE) AS file_settlement_date,
    CAST(row_number() OVER (PARTITION BY l_suppkey % 10, CAST(l_shipdate AS DATE)
      ORDER BY {_LINE_ORDER}) + 1 AS BIGINT) AS source_row_number
  FROM lineitem)"""
)


def settle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settlement rows as text, one file per partner and day, faults included.

    Lines are numbered before their texts are made, so that only the table's own
    columns are shuffled, and the numbered lines are stored for all their reads.
    """
    order = _LINE_ORDER.split(", ")
    lines = table(spark, sf_dir, "lineitem").select(
        *order,
        (F.col("l_suppkey") % 10).alias("_partner"),
        F.col("l_shipdate").cast("date").alias("file_settlement_date"),
        scan.piece("l_orderkey").alias("_piece"),
    )
    numbered = scan.row_number(
        lines,
        groups=["_partner", "file_settlement_date"],
        levels=["_piece"],
        order=order,
        name="source_row_number",
    )
    kept = spread(stored(numbered.drop("_partner", "_piece"), "settle"), even=True)
    return kept.selectExpr(
        *[f"{e.format(text='STRING')} AS {n}" for n, e in _SETTLE.items()],
        f"{_file_name('STRING')} AS source_file_name",
        f"{_FILE_PARTNER.format(text='STRING')} AS file_partner_id",
        "file_settlement_date",
        "source_row_number + 1 AS source_row_number",
    )


# --- payments, refunds, ledgers ----------------------------------------------------

SQL["d_pay"] = """d_pay AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    CAST(o_custkey AS VARCHAR) AS account_id, CAST(o_orderkey % 130 AS VARCHAR) AS merchant_id,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
    CASE WHEN o_orderkey % 29 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
    CASE o_orderstatus WHEN 'O' THEN 'PENDING' WHEN 'F' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
    o_orderdate AS requested_at
  FROM orders)"""


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments with customer, account and merchant references."""
    return spread(table(spark, sf_dir, "orders")).select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_custkey").cast("string").alias("account_id"),
        (F.col("o_orderkey") % 130).cast("string").alias("merchant_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.when(F.col("o_orderkey") % 29 == 0, "EUR").otherwise("USD").alias("currency"),
        F.when(F.col("o_orderstatus") == "O", "PENDING")
        .when(F.col("o_orderstatus") == "F", "FAILED")
        .otherwise("COMPLETED")
        .alias("status"),
        F.col("o_orderdate").alias("requested_at"),
    )


SQL["d_refund"] = f"""d_refund AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, 'USD' AS currency,
    CASE WHEN l_linestatus = 'O' THEN 'PENDING' WHEN l_partkey % 10 = 0 THEN 'CANCELLED'
      ELSE 'COMPLETED' END AS status,
    l_shipdate AS requested_at,
    CAST(row_number() OVER (ORDER BY {_LINE_ORDER}) AS BIGINT) AS refund_id
  FROM lineitem WHERE l_returnflag = 'R')"""


def refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refunds against payments, numbered through the whole table."""
    order = _LINE_ORDER.split(", ")
    rows = (
        table(spark, sf_dir, "lineitem")
        .where("l_returnflag = 'R'")
        .select(
            F.col("l_orderkey").cast("string").alias("transaction_id"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
            F.lit("USD").alias("currency"),
            F.when(F.col("l_linestatus") == "O", "PENDING")
            .when(F.col("l_partkey") % 10 == 0, "CANCELLED")
            .otherwise("COMPLETED")
            .alias("status"),
            F.col("l_shipdate").alias("requested_at"),
            *order,
            scan.piece("l_orderkey", 1 << 14).alias("_orders"),
            F.struct(
                "l_orderkey", "l_linenumber", scan.piece("l_partkey", 1 << 10).alias("part")
            ).alias("_lines"),
        )
    )
    # Order ranges first, then lines inside a range: an order with very many lines
    # is cut up as well.
    numbered = scan.row_number(
        rows, groups=[], levels=["_orders", "_lines"], order=order, name="refund_id"
    )
    return numbered.drop("_orders", "_lines", *order)


SQL["d_ledger"] = """d_ledger AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, CAST(user_id AS VARCHAR) AS input_checksum,
    CASE event_type WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'READING'
      WHEN 'view' THEN 'WRITING' ELSE 'DISCOVERED' END AS status, ts AS completed_at
  FROM events)"""


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run attempts, many per input."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("user_id").cast("string").alias("input_checksum"),
        F.when(F.col("event_type") == "purchase", "COMPLETED")
        .when(F.col("event_type") == "error", "FAILED")
        .when(F.col("event_type") == "click", "READING")
        .when(F.col("event_type") == "view", "WRITING")
        .otherwise("DISCOVERED")
        .alias("status"),
        F.col("ts").alias("completed_at"),
    )


def with_ctes(*names: str, body: str) -> str:
    """A statement over the named derivations."""
    return "WITH " + ",\n".join(SQL[n] for n in names) + "\n" + body
