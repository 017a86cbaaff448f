"""Queries over ledgers, progress, audits and single functions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fn
from ..functions.decode import clock
from ..functions.ids import URL_NAMESPACE
from ..operators import audits, batching, inventory, ledger, normalize, quality, scan
from ..sinks.publish import fingerprint
from . import derived
from .catalog_events import RUN_AT, ranged
from .derived import with_ctes
from .registry import query

# --- run ledger --------------------------------------------------------------------


@query(
    "latest_run",
    with_ctes(
        "d_ledger",
        body="""SELECT input_checksum, run_id, status, completed_at FROM d_ledger
QUALIFY row_number() OVER (PARTITION BY input_checksum ORDER BY completed_at DESC, run_id DESC) = 1""",
    ),
)
def latest_run(spark, sf_dir):
    """Newest attempt per input."""
    return ledger.latest_attempt(
        derived.ledger(spark, sf_dir), identity=["input_checksum"], time="completed_at"
    )


@query(
    "latest_completed_run",
    with_ctes(
        "d_ledger",
        body="""SELECT input_checksum, run_id, status, completed_at FROM d_ledger WHERE status = 'COMPLETED'
QUALIFY row_number() OVER (PARTITION BY input_checksum ORDER BY completed_at DESC, run_id DESC) = 1""",
    ),
)
def latest_completed_run(spark, sf_dir):
    """Newest completed attempt per input."""
    return ledger.latest_completed(derived.ledger(spark, sf_dir), identity=["input_checksum"])


@query(
    "latest_output_excluding_input",
    with_ctes(
        "d_ledger",
        body="""SELECT run_id, input_checksum, completed_at FROM d_ledger WHERE status = 'COMPLETED'
  AND input_checksum <> '7' ORDER BY completed_at DESC, run_id DESC LIMIT 1""",
    ),
)
def latest_output_excluding_input(spark, sf_dir):
    """Base of a forced run: newest completed output of another input."""
    outputs = derived.ledger(spark, sf_dir).select(
        "*", F.lit("users").alias("entity_name"), F.lit("latest_all").alias("output_type")
    )
    return ledger.latest_output(
        outputs, entity="users", output_type="latest_all", exclude_checksum="7"
    ).select("run_id", "input_checksum", "completed_at")


_PENDING = """SELECT CAST(c_custkey AS VARCHAR) AS input_checksum FROM customer
  WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT input_checksum FROM d_ledger)"""


def _inputs(spark, sf_dir) -> DataFrame:
    return derived.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("input_checksum")
    )


@query("unprocessed_inputs", with_ctes("d_ledger", body=_PENDING))
def unprocessed_inputs(spark, sf_dir):
    """Inputs without any attempt."""
    return ledger.unprocessed(
        _inputs(spark, sf_dir), derived.ledger(spark, sf_dir), identity=["input_checksum"]
    )


@query(
    "unprocessed_counts",
    with_ctes(
        "d_ledger",
        body=f"""SELECT (SELECT count(*) FROM customer) AS discovered_objects,
  (SELECT count(*) FROM ({_PENDING})) AS unprocessed_objects""",
    ),
)
def unprocessed_counts(spark, sf_dir):
    """How many inputs there are and how many are open."""
    inputs = _inputs(spark, sf_dir)
    pending = ledger.unprocessed(
        inputs, derived.ledger(spark, sf_dir), identity=["input_checksum"]
    )
    return ledger.unprocessed_counts(inputs, pending)


_PAIRS = ", ".join(
    f"('{a}', '{b}')" for a, bs in ledger.RUN_TRANSITIONS.items() for b in bs
)


@query(
    "ledger_illegal_transitions",
    with_ctes(
        "d_ledger",
        body=f"""SELECT input_checksum, run_id, previous_status, status FROM (
  SELECT *, lag(status) OVER (PARTITION BY input_checksum ORDER BY completed_at, run_id) AS previous_status FROM d_ledger)
WHERE CASE WHEN previous_status IS NULL THEN status <> 'DISCOVERED'
  ELSE (previous_status, status) NOT IN ({_PAIRS}) END""",
    ),
)
def ledger_illegal_transitions(spark, sf_dir):
    """Attempts whose status may not follow the one before."""
    rows = derived.ledger(spark, sf_dir).withColumn(
        "_minute", F.date_trunc("minute", "completed_at")
    )
    return ledger.illegal_transitions(
        rows,
        ledger.RUN_TRANSITIONS,
        groups=["input_checksum"],
        levels=["_minute"],
        order=["completed_at", "run_id"],
        initial=["DISCOVERED"],
    ).select("input_checksum", "run_id", "previous_status", "status")


@query(
    "ledger_status_counts",
    with_ctes("d_ledger", body="SELECT status, count(*) AS row_count FROM d_ledger GROUP BY status"),
)
def ledger_status_counts(spark, sf_dir):
    """Attempts per status."""
    return quality.count_by(derived.ledger(spark, sf_dir), "status")


# --- progress of the source --------------------------------------------------------

_RANGES = """b AS (SELECT kafka_topic AS topic, kafka_partition AS "partition", kafka_offset // 10 AS r,
    min(kafka_offset) AS offset_start, max(kafka_offset) AS offset_end, max(source_ts) AS committed_at,
    CASE WHEN (kafka_offset // 10) % 4 = 0 THEN 'UPLOADED' ELSE 'COMMITTED' END AS status
  FROM d_cdc GROUP BY ALL),
c AS (SELECT topic, "partition", CAST(max(offset_end) // 2 AS BIGINT) AS next_offset FROM b WHERE "partition" <> 3 GROUP BY ALL)
"""


def _ranges(spark, sf_dir) -> DataFrame:
    number = F.floor(F.col("kafka_offset") / 10)
    rows = (
        derived.cdc(spark, sf_dir)
        .groupBy(
            F.col("kafka_topic").alias("topic"),
            F.col("kafka_partition").alias("partition"),
            number.alias("_range"),
        )
        .agg(
            F.min("kafka_offset").alias("offset_start"),
            F.max("kafka_offset").alias("offset_end"),
            F.max("source_ts").alias("committed_at"),
        )
    )
    return rows.withColumn(
        "status", F.when(F.col("_range") % 4 == 0, "UPLOADED").otherwise("COMMITTED")
    ).drop("_range")


def _committed(ranges: DataFrame) -> DataFrame:
    return (
        ranges.where("partition <> 3")
        .groupBy("topic", "partition")
        .agg(F.floor(F.max("offset_end") / 2).alias("next_offset"))
    )


def _control(body: str) -> str:
    return with_ctes("d_cdc", body="").rstrip() + ",\n" + _RANGES + body


@query(
    "consumer_lag",
    _control(
        """SELECT h.topic, h."partition", greatest(h.high - coalesce(c.next_offset, h.low), 0) AS lag
FROM (SELECT topic, "partition", max(offset_end) + 1 AS high, min(offset_start) AS low FROM b GROUP BY ALL) h
LEFT JOIN c ON c.topic = h.topic AND c."partition" = h."partition" """
    ),
)
def consumer_lag(spark, sf_dir):
    """Records not consumed yet per partition."""
    ranges = _ranges(spark, sf_dir)
    high = ranges.groupBy("topic", "partition").agg(
        (F.max("offset_end") + 1).alias("high_offset"), F.min("offset_start").alias("low_offset")
    )
    return ledger.consumer_lag(high, _committed(ranges))


@query(
    "freshness",
    _control(
        """SELECT max(committed_at) FILTER (status = 'COMMITTED') AS last_committed_at,
  count(*) FILTER (status = 'COMMITTED') AS committed_batch_count,
  epoch_us(TIMESTAMP '2024-02-01 00:00:00') / 1e6 - epoch_us(max(committed_at) FILTER (status = 'COMMITTED')) / 1e6 > 0 AS is_past,
  CAST((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(committed_at) FILTER (status = 'COMMITTED'))) / 1000000.0 AS DECIMAL(18,3)) AS freshness_seconds
FROM b"""
    ),
)
def freshness(spark, sf_dir):
    """Age of the last commit."""
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    row = ledger.freshness(_ranges(spark, sf_dir), now)
    return row.select(
        "last_committed_at",
        "committed_batch_count",
        (F.col("freshness_seconds") > 0).alias("is_past"),
        F.col("freshness_seconds").cast("decimal(18,3)").alias("freshness_seconds"),
    )


@query(
    "highest_ranges",
    _control(
        """SELECT topic, "partition", offset_start, offset_end, committed_at, status FROM b WHERE status = 'COMMITTED'
QUALIFY row_number() OVER (PARTITION BY topic, "partition" ORDER BY offset_end DESC) = 1"""
    ),
)
def highest_ranges(spark, sf_dir):
    """Furthest committed range per partition."""
    return ledger.highest_ranges(_ranges(spark, sf_dir))


@query(
    "ledger_reconcile",
    _control(
        """SELECT b.topic, b."partition", offset_start, offset_end, committed_at, 'COMMITTED' AS status
FROM b JOIN c ON c.topic = b.topic AND c."partition" = b."partition"
WHERE status = 'UPLOADED' AND next_offset >= offset_end + 1"""
    ),
)
def ledger_reconcile(spark, sf_dir):
    """Uploaded ranges the source has passed."""
    ranges = _ranges(spark, sf_dir)
    return ledger.reconcile(ranges, _committed(ranges))


@query(
    "cdc_health_gate",
    _control(
        """SELECT rule_name, classification, CAST(observed_value AS DECIMAL(20,6)) AS observed_value FROM (
  SELECT 'cdc_consumer_group_lag' AS rule_name, CASE WHEN sum(lag) >= 10000 THEN 'FAIL' WHEN sum(lag) >= 1000 THEN 'WARN' ELSE 'PASS' END AS classification,
    sum(lag) AS observed_value FROM (
    SELECT greatest(h.high - coalesce(c.next_offset, h.low), 0) AS lag
    FROM (SELECT topic, "partition", max(offset_end) + 1 AS high, min(offset_start) AS low FROM b GROUP BY ALL) h
    LEFT JOIN c ON c.topic = h.topic AND c."partition" = h."partition"))"""
    ),
)
def cdc_health_gate(spark, sf_dir):
    """Total lag against its thresholds."""
    lag = consumer_lag(spark, sf_dir).agg(F.sum("lag").alias("total_lag"))
    warn, fail = quality.CONSUMER_LAG
    return quality.gate_rows(
        lag,
        rule="cdc_consumer_group_lag",
        value=F.col("total_lag"),
        warn=warn,
        fail=fail,
        details=F.lit("{}"),
    ).select("rule_name", "classification", "observed_value")


@query(
    "missing_topics",
    """SELECT DISTINCT concat('cdc.nation.', n_nationkey) AS topic FROM nation
WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)""",
)
def missing_topics(spark, sf_dir):
    """Required topics without data."""
    required = derived.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("cdc.nation."), "n_nationkey").alias("topic")
    )
    present = (
        derived.table(spark, sf_dir, "customer")
        .where("c_acctbal > 9900")
        .select(F.concat(F.lit("cdc.nation."), "c_nationkey").alias("topic"))
    )
    return ledger.missing_topics(required, present)


@query(
    "task_totals",
    """SELECT p, sum(n) AS records_read, sum(n) - sum(bad) AS records_written, sum(bad) AS records_rejected, string_agg(DISTINCT asset, ',' ORDER BY asset) AS output_assets
FROM (SELECT l_suppkey % 10 AS p, CAST(l_shipdate AS DATE) AS d, concat('asset-', year(l_shipdate)) AS asset, count(*) AS n,
  count(*) FILTER (l_partkey % 101 = 0) AS bad FROM lineitem GROUP BY ALL) GROUP BY p""",
)
def task_totals(spark, sf_dir):
    """Task results added up per partner."""
    tasks = (
        derived.table(spark, sf_dir, "lineitem")
        .groupBy(
            (F.col("l_suppkey") % 10).alias("p"),
            F.col("l_shipdate").cast("date").alias("d"),
            F.concat(F.lit("asset-"), F.year("l_shipdate")).alias("asset"),
        )
        .agg(
            F.count(F.lit(1)).alias("records_read"),
            F.count_if(F.col("l_partkey") % 101 == 0).alias("records_rejected"),
        )
        .select(
            "*",
            (F.col("records_read") - F.col("records_rejected")).alias("records_written"),
            F.array("asset").alias("output_assets"),
        )
    )
    return quality.task_totals(tasks, "p").withColumn(
        "output_assets", F.array_join("output_assets", ",")
    )


@query(
    "run_totals",
    """SELECT CAST(o_custkey AS VARCHAR) AS run_id, CAST(count(*) FILTER (o_orderstatus <> 'F') AS BIGINT) AS output_record_count,
  CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS rejected_record_count FROM orders GROUP BY o_custkey""",
)
def run_totals(spark, sf_dir):
    """Published and rejected rows per run."""
    outputs = (
        derived.table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_custkey").cast("string").alias("run_id"),
            F.when(F.col("o_orderstatus") == "F", "rejections")
            .otherwise("history")
            .alias("output_type"),
        )
        .agg(F.count(F.lit(1)).alias("record_count"))
    )
    return quality.run_totals(outputs)


@query(
    "schema_versions",
    with_ctes(
        "d_cdc",
        body="""SELECT kafka_partition, string_agg(DISTINCT v, ',' ORDER BY v) AS versions,
  count(DISTINCT v) = 1 AND min(v) = 'v1' AS is_supported
FROM (SELECT kafka_partition, CASE WHEN kafka_partition = 2 AND source_lsn % 3 = 0 THEN 'v2' ELSE 'v1' END AS v FROM d_cdc)
GROUP BY kafka_partition""",
    ),
)
def schema_versions(spark, sf_dir):
    """Schema versions found per source object, and whether they are the supported one."""
    rows = derived.cdc(spark, sf_dir).select(
        "kafka_partition",
        F.when((F.col("kafka_partition") == 2) & (F.col("source_lsn") % 3 == 0), "v2")
        .otherwise("v1")
        .alias("v"),
    )
    found = rows.groupBy("kafka_partition").agg(F.sort_array(F.collect_set("v")).alias("vs"))
    return found.select(
        "kafka_partition",
        F.array_join("vs", ",").alias("versions"),
        (F.col("vs") == F.array(F.lit("v1"))).alias("is_supported"),
    )


# --- discovery ---------------------------------------------------------------------

_OBJECTS = """o AS (SELECT DISTINCT concat('cdc/entity=', CASE event_type WHEN 'signup' THEN 'customers' WHEN 'click' THEN 'accounts'
    WHEN 'view' THEN 'refunds' WHEN 'error' THEN 'payment_transactions' ELSE 'other' END, '/event_date=',
    CASE WHEN user_id % 37 = 0 THEN 'bad' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END, '/topic=t/partition=', user_id % 4,
    '/offset_start=', event_id, '/batch', CASE WHEN user_id % 41 = 0 THEN '.tmp' ELSE '.parquet' END) AS object_key,
  event_type, user_id, CAST(ts AS DATE) AS d, event_id FROM events)
"""


@query(
    "bronze_discovery",
    "WITH "
    + _OBJECTS
    + """SELECT object_key FROM o WHERE user_id % 37 <> 0 AND user_id % 41 <> 0 AND d BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
ORDER BY CASE event_type WHEN 'signup' THEN 0 WHEN 'click' THEN 2 WHEN 'error' THEN 3 WHEN 'view' THEN 5 ELSE 99 END,
  user_id % 4, event_id LIMIT 100""",
)
def bronze_discovery(spark, sf_dir):
    """The next hundred objects of a date range in dependency order."""
    entity = (
        F.when(F.col("event_type") == "signup", "customers")
        .when(F.col("event_type") == "click", "accounts")
        .when(F.col("event_type") == "view", "refunds")
        .when(F.col("event_type") == "error", "payment_transactions")
        .otherwise("other")
    )
    objects = derived.table(spark, sf_dir, "events").select(
        F.concat(
            F.lit("cdc/entity="),
            entity,
            F.lit("/event_date="),
            F.when(F.col("user_id") % 37 == 0, "bad").otherwise(
                F.col("ts").cast("date").cast("string")
            ),
            F.lit("/topic=t/partition="),
            F.col("user_id") % 4,
            F.lit("/offset_start="),
            F.col("event_id"),
            F.lit("/batch"),
            F.when(F.col("user_id") % 41 == 0, ".tmp").otherwise(".parquet"),
        ).alias("object_key")
    )
    return inventory.discover(
        objects,
        source_type="CDC",
        from_date=date(2024, 1, 10),
        to_date=date(2024, 1, 20),
        max_objects=100,
    )


# --- audits ------------------------------------------------------------------------


@query(
    "fk_orphans",
    """SELECT 'lineitem.l_orderkey' AS relation, CAST(l_orderkey AS VARCHAR) AS reference_key, count(*) AS row_count FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0) GROUP BY l_orderkey
UNION ALL SELECT 'orders.o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 50 <> 0) GROUP BY o_custkey""",
)
def fk_orphans(spark, sf_dir):
    """Referenced keys without a parent row."""
    orders = derived.table(spark, sf_dir, "orders")
    lines = derived.table(spark, sf_dir, "lineitem")
    customers = derived.table(spark, sf_dir, "customer")
    relations = (
        ("lineitem.l_orderkey", lines, "l_orderkey", orders.where("o_orderkey % 10 <> 0"), "o_orderkey"),
        ("orders.o_custkey", orders, "o_custkey", customers.where("c_custkey % 50 <> 0"), "c_custkey"),
    )
    found = [
        audits.orphan_keys(child, field, parent, key).select(
            F.lit(name).alias("relation"),
            F.col("reference_key").cast("string").alias("reference_key"),
            "row_count",
        )
        for name, child, field, parent, key in relations
    ]
    return found[0].unionByName(found[1])


@query(
    "unique_key_violations",
    """SELECT 'lineitem_order_line_unique' AS constraint_name, concat(l_orderkey, '|', l_linenumber) AS key_value, count(*) AS row_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def unique_key_violations(spark, sf_dir):
    """Key values that occur more than once."""
    return audits.repeated_keys(
        derived.table(spark, sf_dir, "lineitem"),
        key=["l_orderkey", "l_linenumber"],
        name="lineitem_order_line_unique",
    )


_PAY_ROWS = """p AS (SELECT transaction_id, account_id, merchant_id, amount, status, requested_at,
    CASE WHEN customer_id % 23 = 0 THEN NULL WHEN customer_id % 7 = 0 THEN account_id ELSE NULL END AS destination_account_id,
    CASE WHEN customer_id % 7 = 0 THEN 'ACCOUNT_TRANSFER' WHEN customer_id % 31 = 0 THEN 'GIFT' ELSE 'MERCHANT_PAYMENT' END AS transaction_type,
    CASE WHEN status = 'COMPLETED' THEN CAST(requested_at + INTERVAL 1 DAY * (CASE WHEN amount % 13 < 1 THEN -1 ELSE 1 END) AS TIMESTAMP) END AS completed_at,
    CASE WHEN status = 'FAILED' AND amount % 17 >= 1 THEN requested_at END AS failed_at
  FROM (SELECT * REPLACE (CAST(customer_id AS BIGINT) AS customer_id) FROM d_pay))
"""


@query(
    "row_constraint_violations",
    with_ctes("d_pay", body="").rstrip()
    + ",\n"
    + _PAY_ROWS
    + """SELECT transaction_id, unnest(list_filter([
  CASE WHEN NOT amount > 0 THEN 'payment_transactions_amount_positive' END,
  CASE WHEN transaction_type NOT IN ('MERCHANT_PAYMENT', 'ACCOUNT_TRANSFER') THEN 'payment_transactions_type_valid' END,
  CASE WHEN NOT ((transaction_type = 'MERCHANT_PAYMENT' AND merchant_id IS NOT NULL AND destination_account_id IS NULL)
    OR (transaction_type = 'ACCOUNT_TRANSFER' AND merchant_id IS NULL AND destination_account_id IS NOT NULL
      AND destination_account_id <> account_id)) THEN 'payment_transactions_target_valid' END,
  CASE WHEN NOT ((status = 'COMPLETED' AND completed_at IS NOT NULL AND failed_at IS NULL)
    OR (status = 'FAILED' AND failed_at IS NOT NULL AND completed_at IS NULL)
    OR (status IN ('PENDING', 'AUTHORIZED', 'CANCELLED') AND completed_at IS NULL AND failed_at IS NULL))
    THEN 'payment_transactions_status_timestamps_valid' END,
  CASE WHEN completed_at < requested_at THEN 'payment_transactions_completed_after_request' END],
  lambda x: x IS NOT NULL)) AS constraint_name FROM p""",
)
def row_constraint_violations(spark, sf_dir):
    """Broken payment constraints."""
    customer = F.col("customer_id").cast("bigint")
    rows = derived.payments(spark, sf_dir).select(
        "*",
        F.when(customer % 23 == 0, F.lit(None))
        .when(customer % 7 == 0, F.col("account_id"))
        .alias("destination_account_id"),
        F.when(customer % 7 == 0, "ACCOUNT_TRANSFER")
        .when(customer % 31 == 0, "GIFT")
        .otherwise("MERCHANT_PAYMENT")
        .alias("transaction_type"),
        F.expr(
            "CASE WHEN status = 'COMPLETED' THEN requested_at + "
            "make_dt_interval(CASE WHEN amount % 13 < 1 THEN -1 ELSE 1 END) END AS completed_at"
        ),
        F.expr("CASE WHEN status = 'FAILED' AND amount % 17 >= 1 THEN requested_at END AS failed_at"),
        F.col("requested_at").alias("created_at"),
        F.col("requested_at").alias("updated_at"),
    )
    return audits.violations(
        rows, audits.constraints("payment_transactions"), keep=["transaction_id"]
    )


def _refund_levels(spark, sf_dir) -> DataFrame:
    return derived.refunds(spark, sf_dir).withColumn("_day", F.col("requested_at").cast("date"))


_RUNNING = """r AS (SELECT *, CASE WHEN status IN ('PENDING', 'COMPLETED') THEN amount ELSE 0 END AS counted FROM d_refund),
t AS (SELECT *, sum(counted) OVER (PARTITION BY transaction_id ORDER BY requested_at, refund_id
    ROWS UNBOUNDED PRECEDING) AS running_total FROM r)
"""


@query(
    "refund_running_total",
    with_ctes("d_refund", body="").rstrip()
    + ",\n"
    + _RUNNING
    + "SELECT refund_id, transaction_id, amount, CAST(running_total AS DECIMAL(28,2)) AS running_total FROM t",
)
def refund_running_total(spark, sf_dir):
    """Refunds added up per payment in request order."""
    rows = audits.running_refunds(
        _refund_levels(spark, sf_dir), levels=["_day"], order=["requested_at", "refund_id"]
    )
    return rows.select(
        "refund_id",
        "transaction_id",
        "amount",
        F.col("running_total").cast("decimal(28,2)").alias("running_total"),
    )


@query(
    "refunded_totals",
    with_ctes(
        "d_refund",
        body="""SELECT transaction_id, CAST(coalesce(sum(amount) FILTER (status IN ('PENDING', 'COMPLETED')), 0) AS DECIMAL(28,2)) AS refunded_amount
FROM d_refund GROUP BY transaction_id""",
    ),
)
def refunded_totals(spark, sf_dir):
    """Counted refunds per payment."""
    return audits.refunded_totals(derived.refunds(spark, sf_dir)).withColumn(
        "refunded_amount", F.col("refunded_amount").cast("decimal(28,2)")
    )


@query(
    "refund_violations",
    with_ctes("d_refund", "d_pay", body="").rstrip()
    + ",\n"
    + _RUNNING
    + """SELECT refund_id, violation FROM (SELECT t.refund_id,
    CASE WHEN p.transaction_id IS NULL THEN 'ORIGINAL_TRANSACTION_MISSING' WHEN p.status <> 'COMPLETED' THEN 'TRANSACTION_NOT_COMPLETED'
      WHEN p.currency <> t.currency THEN 'CURRENCY_MISMATCH'
      WHEN t.running_total - t.counted + t.amount > p.amount THEN 'REFUND_TOTAL_EXCEEDED' END AS violation
  FROM t LEFT JOIN (SELECT * FROM d_pay WHERE CAST(transaction_id AS BIGINT) % 40 <> 0) p USING (transaction_id))
WHERE violation IS NOT NULL""",
)
def refund_violations(spark, sf_dir):
    """Refunds against the rules of their payment."""
    paid = derived.payments(spark, sf_dir).where("CAST(transaction_id AS BIGINT) % 40 <> 0")
    return audits.refund_violations(
        _refund_levels(spark, sf_dir), paid, levels=["_day"], order=["requested_at", "refund_id"]
    ).select("refund_id", "violation")


_LIFE = """e AS (SELECT CAST(user_id AS VARCHAR) AS transaction_id, event_id, event_type AS new_status, ts,
    CASE WHEN event_id % 19 = 0 THEN 'lost' ELSE lag(event_type) OVER w END AS previous_status,
    row_number() OVER w + CASE WHEN event_id % 23 = 0 THEN 1 ELSE 0 END AS event_version
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
"""


@query(
    "lifecycle_transitions",
    "WITH "
    + _LIFE
    + """SELECT transaction_id, event_id FROM (SELECT *, lag(new_status) OVER w AS before, row_number() OVER w AS n
  FROM e WINDOW w AS (PARTITION BY transaction_id ORDER BY ts, event_id))
WHERE previous_status IS DISTINCT FROM before OR event_version <> n""",
)
def lifecycle_transitions(spark, sf_dir):
    """Events that do not follow the event before."""
    levels, order = ["_day", "_minute"], ["ts", "event_id"]
    rows = derived.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("transaction_id"),
        "event_id",
        F.col("event_type").alias("new_status"),
        "ts",
        F.col("ts").cast("date").alias("_day"),
        F.date_trunc("minute", "ts").alias("_minute"),
    )
    where = {"groups": ["transaction_id"], "levels": levels, "order": order}
    told = scan.previous(rows, value=F.col("new_status"), name="previous_status", **where)
    told = scan.row_number(told, name="event_version", **where)
    told = told.withColumn(
        "previous_status",
        F.when(F.col("event_id") % 19 == 0, "lost").otherwise(F.col("previous_status")),
    ).withColumn(
        "event_version",
        F.col("event_version") + F.when(F.col("event_id") % 23 == 0, 1).otherwise(0),
    )
    return audits.lifecycle_breaks(told, levels=levels, order=order).select(
        "transaction_id", "event_id"
    )


# --- single functions --------------------------------------------------------------


@query(
    "money_decode",
    """SELECT o_orderkey, CAST(CASE o_orderkey % 4 WHEN 2 THEN NULL WHEN 3 THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(18,2)) AS amount
FROM orders""",
)
def money_decode(spark, sf_dir):
    """Money from decimal text, base64 bytes of either sign, and text that is none."""
    orders = derived.table(spark, sf_dir, "orders")
    cents = F.col("o_totalprice").cast("decimal(18,2)") * 100
    packed = fn.base64_text(F.unhex(F.lpad(F.hex(cents.cast("bigint")), 16, "0")))
    negative = fn.base64_text(F.unhex(F.hex((-cents).cast("bigint"))))
    kind = F.col("o_orderkey") % 4
    text = (
        F.when(kind == 0, F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
        .when(kind == 1, packed)
        .when(kind == 2, "not-decimal")
        .otherwise(negative)
    )
    return orders.select("o_orderkey", fn.money(text).alias("amount"))


@query(
    "ts_decode",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN make_timestamp(epoch_us(ts)) WHEN 1 THEN make_timestamp(epoch_us(ts) // 1000 * 1000)
  WHEN 2 THEN make_timestamp(epoch_us(ts) // 1000000 * 1000000 - 7 * 3600000000) ELSE NULL END AS decoded FROM events""",
)
def ts_decode(spark, sf_dir):
    """Clocks from microseconds, milliseconds and zoned text; text without a zone is none."""
    stamp = F.col("ts").cast("timestamp")
    kind = F.col("event_id") % 4
    text = (
        F.when(kind == 0, F.unix_micros(stamp).cast("string"))
        .when(kind == 1, F.unix_millis(stamp).cast("string"))
        .when(kind == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+07:00'"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    )
    token = F.when(kind < 2, text).otherwise(F.concat(F.lit('"'), text, F.lit('"')))
    return derived.table(spark, sf_dir, "events").select(
        "event_id", clock(text, token).cast("timestamp_ntz").alias("decoded")
    )


@query(
    "name_split",
    """SELECT p_partkey, nullif(string_split(trim(p_name), ' ')[1], '') AS first_name,
  CASE WHEN position(' ' IN trim(p_name)) > 0 THEN substr(trim(p_name), position(' ' IN trim(p_name)) + 1) END AS last_name FROM part""",
)
def name_split(spark, sf_dir):
    """First word and remainder of part names."""
    return derived.table(spark, sf_dir, "part").select(
        "p_partkey",
        fn.first_name(F.concat(F.lit("  "), "p_name")).alias("first_name"),
        fn.last_name(F.col("p_name")).alias("last_name"),
    )


@query(
    "canonical_json",
    """SELECT event_id, concat('{"a":{"k":[1,"1.50"],"z":null},"amount":"', CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '","type":"', event_type, '"}') AS json_text
FROM events""",
)
def canonical_json(spark, sf_dir):
    """Sorted compact JSON with decimals as text."""
    source = F.concat(
        F.lit('{ "type": "'),
        "event_type",
        F.lit('", "amount": '),
        F.col("value").cast("decimal(18,2)").cast("string"),
        F.lit(', "a": {"z": null, "k": [1, 1.50]} }'),
    )
    return derived.table(spark, sf_dir, "events").select(
        "event_id", fn.canonical(source).alias("json_text")
    )


@query(
    "run_identities",
    """SELECT DISTINCT user_id, concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-5', substr(h, 14, 3), '-',
  substr('89ab89ab89ab89ab', position(substr(h, 17, 1) IN '0123456789abcdef'), 1), substr(h, 18, 3), '-', substr(h, 21, 12)) AS run_id, part_id
FROM (SELECT user_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(concat('cdc-silver:', user_id))) AS h,
  substr(sha256(concat(user_id, ':history:users:0')), 1, 16) AS part_id FROM events)""",
)
def run_identities(spark, sf_dir):
    """Name-based run ids and output part ids."""
    users = derived.table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select(
        "user_id",
        fn.uuid5(URL_NAMESPACE, F.concat(F.lit("cdc-silver:"), "user_id")).alias("run_id"),
        fn.output_part_id("user_id", F.lit("history"), F.lit("users")).alias("part_id"),
    )


@query(
    "safe_metadata",
    """SELECT o_orderkey, concat('partner_id=P', o_custkey % 10, ';record_count=', o_orderkey) AS entries FROM orders""",
)
def safe_metadata(spark, sf_dir):
    """Allow-listed metadata entries."""
    metadata = F.create_map(
        F.lit("Partner-Id"),
        F.concat(F.lit(" P"), F.col("o_custkey") % 10),
        F.lit("password"),
        F.lit("hidden"),
        F.lit("record_count"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit("\n")),
        F.lit("topic"),
        F.lit(None).cast("string"),
    )
    safe = fn.safe_metadata(metadata)
    entries = F.array_join(
        F.array_sort(
            F.transform(F.map_entries(safe), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
        ),
        ";",
    )
    return derived.table(spark, sf_dir, "orders").select("o_orderkey", entries.alias("entries"))


@query(
    "dataset_fingerprint",
    with_ctes(
        "d_pay",
        body="""SELECT count(*) AS row_count, CAST(sum(CAST(concat('0x', substr(h, 1, 15)) AS BIGINT)) AS DECIMAL(38,0)) AS content_hash
FROM (SELECT sha256(to_json({transaction_id: transaction_id, customer_id: customer_id, status: status})) AS h FROM d_pay)""",
    ),
)
def dataset_fingerprint(spark, sf_dir):
    """Order-insensitive fingerprint of a dataset."""
    return fingerprint(
        derived.payments(spark, sf_dir).select("transaction_id", "customer_id", "status")
    )


# --- typed entities ----------------------------------------------------------------


def _history(rows: DataFrame, entity: str, payload) -> DataFrame:
    """History rows of an entity whose payload is built from table columns."""
    return rows.select(
        F.lit(entity).alias("entity_name"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("business_payload_json"),
        F.lit(False).alias("is_tombstone"),
    )


def _projected(rows: DataFrame, entity: str, payload) -> DataFrame:
    made = normalize.project_entity(_history(rows, entity, payload), entity)
    clocks = [
        f.name
        for f in made.schema["state"].dataType.fields
        if isinstance(f.dataType, T.TimestampType)
    ]
    state = made.select("state.*", "projection_code")
    for name in clocks:
        state = state.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return state


@query(
    "project_customers",
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, concat('R', c_custkey) AS external_customer_ref, 'Ann' AS first_name,
  c_name AS last_name, CAST(NULL AS VARCHAR) AS email, 'VN' AS country_code, c_mktsegment AS status,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at,
  CAST(NULL AS VARCHAR) AS projection_code FROM customer""",
)
def project_customers(spark, sf_dir):
    """Customer payloads to typed rows."""
    rows = derived.table(spark, sf_dir, "customer")
    payload = F.struct(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.concat(F.lit("R"), "c_custkey").alias("external_customer_ref"),
        F.concat(F.lit(" Ann "), "c_name", F.lit(" ")).alias("full_name"),
        F.lit(None).cast("string").alias("email"),
        F.lit("VN").alias("country_code"),
        F.col("c_mktsegment").alias("status"),
        (F.lit(1704067200000) + F.col("c_custkey") * 1000).alias("created_at"),
        F.lit("").alias("updated_at"),
    )
    return _projected(rows, "customers", payload)


@query(
    "project_merchants",
    """SELECT CAST(s_suppkey AS VARCHAR) AS merchant_id, concat('M', s_suppkey) AS merchant_code, concat('X', s_suppkey) AS external_reference,
  s_name AS merchant_name, '5411' AS category_code, 'VN' AS country_code, 'USD' AS settlement_currency, 'ACTIVE' AS status,
  TIMESTAMP '2023-12-31 17:00:00' AS created_at, CASE WHEN s_suppkey % 3 <> 0 THEN TIMESTAMP '2024-01-01 00:00:00.123456' END AS updated_at,
  CASE WHEN s_suppkey % 3 = 0 THEN 'INVALID_TIMESTAMP' END AS projection_code FROM supplier""",
)
def project_merchants(spark, sf_dir):
    """Merchant payloads to typed rows, some with a clock that lacks its zone."""
    rows = derived.table(spark, sf_dir, "supplier")
    payload = F.struct(
        F.col("s_suppkey").cast("string").alias("merchant_id"),
        F.concat(F.lit("M"), "s_suppkey").alias("merchant_code"),
        F.concat(F.lit("X"), "s_suppkey").alias("external_reference"),
        F.col("s_name").alias("merchant_name"),
        F.lit("5411").alias("category_code"),
        F.lit("VN").alias("country_code"),
        F.lit("USD").alias("settlement_currency"),
        F.lit("ACTIVE").alias("status"),
        F.lit("2024-01-01T00:00:00+07:00").alias("created_at"),
        F.when(F.col("s_suppkey") % 3 == 0, "2024-01-01T00:00:00")
        .otherwise("2024-01-01T00:00:00.123456Z")
        .alias("updated_at"),
    )
    return _projected(rows, "merchants", payload)


@query(
    "project_payments",
    with_ctes(
        "d_pay",
        body="""SELECT transaction_id, CASE WHEN CAST(transaction_id AS BIGINT) % 9 <> 0 THEN customer_id ELSE '' END AS customer_id, account_id,
  CAST(NULL AS VARCHAR) AS destination_account_id, merchant_id, 'MERCHANT_PAYMENT' AS transaction_type, 'QR' AS payment_channel,
  CASE WHEN CAST(transaction_id AS BIGINT) % 8 <> 0 THEN amount END AS amount, currency, status, CAST(NULL AS VARCHAR) AS partner_reference,
  concat('K', transaction_id) AS idempotency_key, CAST(NULL AS VARCHAR) AS failure_code, requested_at,
  CAST(NULL AS TIMESTAMP) AS completed_at, CAST(NULL AS TIMESTAMP) AS failed_at, requested_at AS created_at, requested_at AS updated_at,
  CASE WHEN CAST(transaction_id AS BIGINT) % 8 = 0 THEN 'INVALID_DECIMAL' WHEN CAST(transaction_id AS BIGINT) % 9 = 0 THEN 'INVALID_REFERENCE' END AS projection_code
FROM d_pay""",
    ),
)
def project_payments(spark, sf_dir):
    """Payment payloads to typed rows, some with bad money or no customer."""
    rows = derived.payments(spark, sf_dir)
    key = F.col("transaction_id").cast("bigint")
    micros = F.unix_micros(F.col("requested_at").cast("timestamp"))
    nothing = F.lit(None).cast("string")
    payload = F.struct(
        "transaction_id",
        F.when(key % 9 == 0, "").otherwise(F.col("customer_id")).alias("customer_id"),
        "account_id",
        nothing.alias("destination_account_id"),
        "merchant_id",
        F.lit("MERCHANT_PAYMENT").alias("transaction_type"),
        F.lit("QR").alias("payment_channel"),
        F.when(key % 8 == 0, "12,5").otherwise(F.col("amount").cast("string")).alias("amount"),
        "currency",
        "status",
        F.concat(F.lit("K"), "transaction_id").alias("idempotency_key"),
        micros.alias("requested_at"),
        micros.alias("created_at"),
        micros.alias("updated_at"),
    )
    return _projected(rows, "payment_transactions", payload)


@query(
    "project_transaction_events",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS transaction_id, event_type, CAST(event_id % 5 AS INT) AS event_version,
  CAST(NULL AS VARCHAR) AS previous_status, event_type AS new_status, ts AS event_time, ts AS producer_time, CAST(NULL AS VARCHAR) AS trace_id,
  'app' AS source_system, replace(props, ' ', '') AS event_payload_json, ts AS created_at, CAST(NULL AS VARCHAR) AS projection_code FROM events""",
)
def project_transaction_events(spark, sf_dir):
    """Event payloads to append-only typed rows."""
    rows = derived.table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    payload = F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("transaction_id"),
        "event_type",
        (F.col("event_id") % 5).alias("event_version"),
        F.col("event_type").alias("new_status"),
        micros.alias("event_time"),
        micros.alias("producer_time"),
        F.lit("app").alias("source_system"),
        F.col("props").alias("event_payload"),
        micros.alias("created_at"),
    )
    return _projected(rows, "transaction_events", payload)


@query(
    "project_refunds",
    with_ctes(
        "d_refund",
        body="""SELECT CAST(refund_id AS VARCHAR) AS refund_id, transaction_id, amount, currency, status, 'CUSTOMER' AS reason_code,
  CAST(NULL AS VARCHAR) AS partner_reference, requested_at, CASE WHEN status = 'COMPLETED' THEN requested_at END AS completed_at,
  requested_at AS created_at, requested_at AS updated_at, CAST(NULL AS VARCHAR) AS projection_code FROM d_refund""",
    ),
)
def project_refunds(spark, sf_dir):
    """Refund payloads to typed rows, money as base64 bytes."""
    rows = derived.refunds(spark, sf_dir)
    micros = F.unix_micros(F.col("requested_at").cast("timestamp"))
    cents = (F.col("amount") * 100).cast("bigint")
    payload = F.struct(
        F.col("refund_id").cast("string").alias("refund_id"),
        "transaction_id",
        fn.base64_text(F.unhex(F.lpad(F.hex(cents), 16, "0"))).alias("amount"),
        "currency",
        "status",
        F.lit("CUSTOMER").alias("reason_code"),
        micros.alias("requested_at"),
        F.when(F.col("status") == "COMPLETED", micros).alias("completed_at"),
        micros.alias("created_at"),
        micros.alias("updated_at"),
    )
    return _projected(rows, "refunds", payload)
