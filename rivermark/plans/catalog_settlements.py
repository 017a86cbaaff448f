"""Queries over settlement rows: duplicates, rules, outcomes and file identities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import file_id
from ..operators import inventory, ledger, quality, settlement
from ..operators.contract import load_contract
from . import derived
from .catalog_events import RUN_AT
from .derived import with_ctes
from .registry import query
from .settlements import SOURCE

CONTRACT = load_contract()


def judged(spark, sf_dir) -> DataFrame:
    """Settlement rows with their codes."""
    marked = settlement.mark_file_duplicates(derived.settle(spark, sf_dir), CONTRACT)
    return settlement.validate_rows(marked, CONTRACT)


_RAW = ", ".join(CONTRACT.names)
_FLAGGED = f"""f AS (SELECT *,
    row_number() OVER (PARTITION BY source_file_name, {_RAW} ORDER BY source_row_number) > 1 AS dup_row,
    trim(settlement_reference) <> '' AND row_number() OVER (PARTITION BY source_file_name, trim(settlement_reference)
      ORDER BY source_row_number) > 1 AS ref_again,
    try_cast(settlement_date AS DATE) AS d, try_cast(amount AS DECIMAL(38,10)) AS a,
    try_cast(fee_amount AS DECIMAL(38,10)) AS fee, try_cast(net_amount AS DECIMAL(38,10)) AS net
  FROM d_settle),
j AS (SELECT *, dup_row AS duplicate_row, ref_again AND NOT dup_row AS duplicate_reference,
    CASE WHEN amount NOT IN ('not-a-decimal', '100.001', '1234567890123456789') THEN a END AS amt FROM f)
"""
_CODES = """concat_ws('|',
    CASE WHEN duplicate_row THEN 'DUPLICATE_ROW' END,
    CASE WHEN duplicate_reference THEN 'DUPLICATE_SETTLEMENT_REFERENCE' END,
    CASE WHEN trim(settlement_reference) = '' THEN 'REQUIRED_FIELD_EMPTY' END,
    CASE WHEN length(trim(settlement_reference)) > 128 THEN 'MAX_LENGTH_EXCEEDED' END,
    CASE WHEN partner_id = 'p-bad' THEN 'INVALID_PARTNER_ID' END,
    CASE WHEN partner_id <> file_partner_id THEN 'PARTNER_MISMATCH' END,
    CASE WHEN d IS NULL THEN 'INVALID_SETTLEMENT_DATE' END,
    CASE WHEN d <> file_settlement_date THEN 'SETTLEMENT_DATE_MISMATCH' END,
    CASE WHEN internal_transaction_id = 'not-a-uuid' THEN 'INVALID_INTERNAL_TRANSACTION_ID' END,
    CASE WHEN transaction_timestamp LIKE '% noon' THEN 'INVALID_TRANSACTION_TIMESTAMP' END,
    CASE WHEN transaction_timestamp LIKE '%T10:15:30' THEN 'TIMESTAMP_TIMEZONE_REQUIRED' END,
    CASE WHEN amount = 'not-a-decimal' THEN 'INVALID_DECIMAL' END,
    CASE WHEN amount = '100.001' THEN 'DECIMAL_SCALE_EXCEEDED' END,
    CASE WHEN amount = '1234567890123456789' THEN 'DECIMAL_PRECISION_EXCEEDED' END,
    CASE WHEN amt <= 0 THEN 'AMOUNT_NOT_POSITIVE' END,
    CASE WHEN currency = 'usd' THEN 'INVALID_CURRENCY' END,
    CASE WHEN settlement_status = 'UNKNOWN' THEN 'INVALID_SETTLEMENT_STATUS' END,
    CASE WHEN fee < 0 THEN 'NEGATIVE_FEE_AMOUNT' END,
    CASE WHEN net <> amt - fee THEN 'NET_AMOUNT_INCONSISTENT' END)"""
_JUDGED = _FLAGGED + f""", v AS (SELECT *, nullif({_CODES}, '') AS error_code FROM j)
"""


def _sql(body: str) -> str:
    return with_ctes("d_settle", body="").rstrip() + ",\n" + _JUDGED + body


@query("settle_validate", _sql("SELECT source_file_name, source_row_number, error_code FROM v"))
def settle_validate(spark, sf_dir):
    """Joined codes of every settlement row."""
    return judged(spark, sf_dir).select("source_file_name", "source_row_number", "error_code")


@query(
    "settle_accepted",
    _sql(
        """SELECT partner_id, d AS settlement_date, settlement_reference, partner_transaction_reference,
  nullif(internal_transaction_id, '') AS internal_transaction_id,
  CAST(concat(CAST(file_settlement_date AS VARCHAR), ' 03:15:30') AS TIMESTAMP) AS transaction_timestamp,
  CAST(amt AS DECIMAL(18,2)) AS amount, currency, settlement_status, CAST(fee AS DECIMAL(18,2)) AS fee_amount,
  CAST(net AS DECIMAL(18,2)) AS net_amount, source_file_name, source_row_number
FROM v WHERE error_code IS NULL"""
    ),
)
def settle_accepted(spark, sf_dir):
    """Typed rows that break no rule."""
    rows = judged(spark, sf_dir).withColumn("source_checksum", F.lit("derived"))
    return (
        settlement.accepted_rows(rows, run_id="run", processed_at=RUN_AT)
        .drop("source_checksum", "ingestion_run_id", "processing_run_id", "processed_at")
        .withColumn("transaction_timestamp", F.col("transaction_timestamp").cast("timestamp_ntz"))
    )


_QUALITY = """CASE WHEN contains(error_code, 'DECIMAL') OR contains(error_code, 'AMOUNT') THEN 'INVALID_DECIMAL'
    WHEN contains(error_code, 'TIMESTAMP') OR contains(error_code, 'DATE') THEN 'INVALID_TIMESTAMP'
    WHEN contains(error_code, 'INTERNAL_TRANSACTION_ID') THEN 'INVALID_REFERENCE'
    ELSE 'INVALID_BRONZE_SCHEMA' END"""


@query(
    "settle_rejected",
    _sql(
        f"""SELECT source_file_name AS source_object_uri, settlement_reference AS business_key,
  {_QUALITY} AS error_code, concat('row:', source_row_number) AS raw_reference
FROM v WHERE error_code IS NOT NULL"""
    ),
)
def settle_rejected(spark, sf_dir):
    """Rejected rows as quality evidence."""
    rows = settlement.settlement_rejections(
        judged(spark, sf_dir), run_id="run", rejected_at=RUN_AT, source=F.col("source_file_name")
    )
    return rows.select("source_object_uri", "business_key", "error_code", "raw_reference")


@query(
    "settle_rejected_evidence",
    _sql(
        """SELECT source_file_name, source_row_number,
  to_json({partner_id: partner_id, settlement_date: settlement_date, settlement_reference: settlement_reference,
    partner_transaction_reference: partner_transaction_reference, internal_transaction_id: internal_transaction_id,
    transaction_timestamp: transaction_timestamp, amount: amount, currency: currency,
    settlement_status: settlement_status, fee_amount: fee_amount, net_amount: net_amount}) AS raw_record,
  error_code FROM v WHERE error_code IS NOT NULL"""
    ),
)
def settle_rejected_evidence(spark, sf_dir):
    """Rejected rows with their raw record."""
    return settlement.rejected_rows(judged(spark, sf_dir), CONTRACT).select(
        "source_file_name", "source_row_number", F.col("raw_record").cast("string"), "error_code"
    )


@query(
    "settle_code_counts",
    _sql(
        """SELECT code, count(*) AS row_count FROM (
  SELECT unnest(string_split(error_code, '|')) AS code FROM v WHERE error_code IS NOT NULL) GROUP BY code"""
    ),
)
def settle_code_counts(spark, sf_dir):
    """How often each code was raised."""
    codes = judged(spark, sf_dir).where("error_code IS NOT NULL")
    return quality.count_by(
        codes.select(F.explode(F.split("error_code", "\\|")).alias("code")), "code"
    )


@query(
    "settle_duplicates",
    _sql(
        """SELECT source_file_name, source_row_number, duplicate_row, duplicate_reference
FROM v WHERE duplicate_row OR duplicate_reference"""
    ),
)
def settle_duplicates(spark, sf_dir):
    """Rows that repeat an earlier row or reference of their file."""
    marked = settlement.mark_file_duplicates(derived.settle(spark, sf_dir), CONTRACT)
    return marked.where("duplicate_row OR duplicate_reference").select(
        "source_file_name", "source_row_number", "duplicate_row", "duplicate_reference"
    )


_COUNTS = """SELECT source_file_name, count(*) AS record_count, count(*) FILTER (error_code IS NULL) AS accepted_count,
    count(*) FILTER (error_code IS NOT NULL) AS rejected_count FROM v GROUP BY source_file_name"""


@query("settle_file_counts", _sql(_COUNTS))
def settle_file_counts(spark, sf_dir):
    """Rows read, accepted and rejected per file."""
    return settlement.file_counts(judged(spark, sf_dir))


@query(
    "settle_strict_gate",
    _sql(
        f"""SELECT *, CASE WHEN rejected_count > 0 THEN 'QUARANTINED' ELSE 'PROCESSED' END AS status,
  CASE WHEN rejected_count > 0 THEN 'REJECTED_RECORDS_PRESENT' END AS file_error_code FROM ({_COUNTS})"""
    ),
)
def settle_strict_gate(spark, sf_dir):
    """File outcomes in strict mode."""
    return settlement.strict_files(settlement.file_counts(judged(spark, sf_dir)))


@query(
    "settle_outcome_counts",
    _sql(
        f"""SELECT count(*) AS file_count, count(*) FILTER (rejected_count = 0) AS processed_files,
  count(*) FILTER (rejected_count > 0) AS quarantined_files, CAST(0 AS BIGINT) AS failed_files FROM ({_COUNTS})"""
    ),
)
def settle_outcome_counts(spark, sf_dir):
    """Files by outcome in strict mode."""
    return ledger.outcome_counts(
        settlement.strict_files(settlement.file_counts(judged(spark, sf_dir)))
    )


@query(
    "rejection_rate_gate",
    _sql(
        """SELECT file_partner_id, count(*) AS records_read, count(error_code) AS records_rejected,
  CAST(count(error_code) / count(*) AS DECIMAL(20,6)) AS observed_value,
  CASE WHEN count(error_code) / count(*) >= 0.1 THEN 'FAIL' WHEN count(error_code) / count(*) >= 0.05 THEN 'WARN'
    ELSE 'PASS' END AS classification FROM v GROUP BY file_partner_id"""
    ),
)
def rejection_rate_gate(spark, sf_dir):
    """Rejection-rate class per partner."""
    counts = judged(spark, sf_dir).groupBy("file_partner_id").agg(
        F.count(F.lit(1)).alias("records_read"), F.count("error_code").alias("records_rejected")
    )
    rate = quality.rejection_rate(F.col("records_read"), F.col("records_rejected"))
    return counts.select(
        "*",
        rate.cast("decimal(20,6)").alias("observed_value"),
        quality.classify(rate, 0.05, 0.1).alias("classification"),
    )


@query(
    "run_status",
    _sql(
        """SELECT CASE WHEN max(rate) >= 0.1 THEN 'FAILED' WHEN max(rate) >= 0.05 THEN 'PARTIAL'
  ELSE 'SUCCEEDED' END AS status
FROM (SELECT count(error_code) / count(*) AS rate FROM v GROUP BY file_partner_id)"""
    ),
)
def run_status(spark, sf_dir):
    """Worst class over all partners as a run status."""
    counts = judged(spark, sf_dir).groupBy("file_partner_id").agg(
        F.count(F.lit(1)).alias("records_read"), F.count("error_code").alias("records_rejected")
    )
    return quality.worst_status(quality.rejection_gate(counts, warn=0.05, fail=0.1))


# --- files -------------------------------------------------------------------------

_NAMES = """n AS (SELECT DISTINCT concat(CASE WHEN l_suppkey % 17 = 0 THEN 'settle_' ELSE 'settlement_' END,
    'P', CAST(l_suppkey % 10 AS VARCHAR), '_',
    CASE WHEN l_suppkey % 13 = 0 THEN '2024-02-30' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END, '_',
    CASE WHEN l_suppkey % 11 = 0 THEN '000' ELSE '001' END,
    CASE WHEN l_suppkey % 19 = 0 THEN '.txt' ELSE '.csv' END) AS file_name, l_suppkey FROM lineitem)"""


@query(
    "settle_file_names",
    f"WITH {_NAMES}"
    """, c AS (SELECT DISTINCT file_name, CASE WHEN l_suppkey % 19 = 0 THEN 'INVALID_EXTENSION'
    WHEN l_suppkey % 17 = 0 THEN 'INVALID_FILE_NAME' WHEN l_suppkey % 13 = 0 THEN 'INVALID_SETTLEMENT_DATE'
    WHEN l_suppkey % 11 = 0 THEN 'INVALID_FILE_SEQUENCE' END AS error_code FROM n)
SELECT file_name, CASE WHEN error_code IS NULL THEN substr(file_name, 12, 2) END AS partner_id,
  CASE WHEN error_code IS NULL THEN CAST(substr(file_name, 15, 10) AS DATE) END AS settlement_date, error_code FROM c""",
)
def settle_file_names(spark, sf_dir):
    """Partner, date and sequence of file names, and what is wrong with them."""
    lines = derived.table(spark, sf_dir, "lineitem")
    names = lines.select(
        F.concat(
            F.when(F.col("l_suppkey") % 17 == 0, "settle_").otherwise("settlement_"),
            F.lit("P"),
            (F.col("l_suppkey") % 10).cast("string"),
            F.lit("_"),
            F.when(F.col("l_suppkey") % 13 == 0, "2024-02-30").otherwise(
                F.col("l_shipdate").cast("date").cast("string")
            ),
            F.lit("_"),
            F.when(F.col("l_suppkey") % 11 == 0, "000").otherwise("001"),
            F.when(F.col("l_suppkey") % 19 == 0, ".txt").otherwise(".csv"),
        ).alias("file_name")
    ).distinct()
    return inventory.parse_file_names(names, CONTRACT).select(
        "file_name", "partner_id", "settlement_date", "error_code"
    )


_FILES = """files AS (SELECT source_file_name AS file_name, file_partner_id AS partner_id,
    file_settlement_date AS discovered_at, CAST(sum(source_row_number) AS VARCHAR) AS checksum_sha256
  FROM d_settle GROUP BY ALL),
known AS (SELECT * FROM files WHERE discovered_at < DATE '1998-01-01'),
cand AS (SELECT CASE WHEN day(discovered_at) % 3 = 0 THEN concat('again_', file_name) ELSE file_name END AS file_name,
    partner_id, CASE WHEN day(discovered_at) % 3 = 1 THEN concat(checksum_sha256, 'x') ELSE checksum_sha256 END AS checksum_sha256
  FROM files WHERE discovered_at < DATE '1999-01-01')
"""


def _files(spark, sf_dir) -> DataFrame:
    return (
        derived.settle(spark, sf_dir)
        .groupBy(
            F.col("source_file_name").alias("file_name"),
            F.col("file_partner_id").alias("partner_id"),
            F.col("file_settlement_date").alias("discovered_at"),
        )
        .agg(F.sum("source_row_number").cast("string").alias("checksum_sha256"))
    )


@query(
    "file_duplicate_kind",
    with_ctes("d_settle", body="").rstrip()
    + ",\n"
    + _FILES
    + """SELECT c.file_name, c.partner_id, c.checksum_sha256, CASE WHEN k.n = c.file_name THEN 'SAME_NAME_SAME_CONTENT'
    WHEN k.n IS NOT NULL THEN 'DIFFERENT_NAME_SAME_CONTENT' WHEN s.file_name IS NOT NULL THEN 'SAME_NAME_CHANGED_CONTENT'
    ELSE 'NEW_FILE' END AS duplicate_kind
FROM cand c LEFT JOIN (SELECT partner_id, checksum_sha256, arg_min(file_name, (discovered_at, file_name)) AS n FROM known GROUP BY ALL) k
    USING (partner_id, checksum_sha256)
  LEFT JOIN (SELECT DISTINCT partner_id, file_name FROM known) s ON s.partner_id = c.partner_id AND s.file_name = c.file_name""",
)
def file_duplicate_kind(spark, sf_dir):
    """New, repeated, renamed and changed files against the files known before."""
    files = _files(spark, sf_dir)
    day = F.dayofmonth("discovered_at") % 3
    candidates = files.where("discovered_at < DATE '1999-01-01'").select(
        F.when(day == 0, F.concat(F.lit("again_"), "file_name"))
        .otherwise(F.col("file_name"))
        .alias("file_name"),
        "partner_id",
        F.when(day == 1, F.concat("checksum_sha256", F.lit("x")))
        .otherwise(F.col("checksum_sha256"))
        .alias("checksum_sha256"),
    )
    return ledger.duplicate_kind(candidates, files.where("discovered_at < DATE '1998-01-01'"))


@query(
    "file_latest_checksum",
    with_ctes("d_settle", body="").rstrip()
    + ",\n"
    + _FILES
    + "SELECT partner_id, file_name, checksum_sha256, discovered_at FROM files",
)
def file_latest_checksum(spark, sf_dir):
    """Newest content of every file name, with an older delivery of each."""
    files = _files(spark, sf_dir)
    older = files.select(
        "file_name",
        "partner_id",
        F.date_sub("discovered_at", 1).alias("discovered_at"),
        F.lit("older").alias("checksum_sha256"),
    )
    return ledger.latest_checksum(files.unionByName(older))


@query(
    "file_identities",
    with_ctes("d_settle", body="").rstrip()
    + ",\n"
    + _FILES.rstrip()
    + """,
ids AS (SELECT file_name, sha1(unhex('22a08d63cffc4d368a83a7b0d31c9f16')
    || encode(concat('banking_partner_settlement:', partner_id, ':', checksum_sha256))) AS h FROM files)
SELECT file_name, concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-5', substr(h, 14, 3), '-',
  substr('89ab89ab89ab89ab', position(substr(h, 17, 1) IN '0123456789abcdef'), 1), substr(h, 18, 3), '-', substr(h, 21, 12)) AS file_id
FROM ids""",
)
def file_identities(spark, sf_dir):
    """Ids of the files by source, partner and content."""
    return _files(spark, sf_dir).select(
        "file_name", file_id(F.lit(SOURCE), F.col("partner_id"), F.col("checksum_sha256")).alias("file_id")
    )
