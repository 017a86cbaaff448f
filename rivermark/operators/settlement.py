"""Settlement rows: duplicate search, ordered rules, typed and rejected outputs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..schemas import MONEY, SETTLEMENT
from ..session import stored
from .contract import Contract, Field
from .quality import rejection_rows, settlement_quality_code

_UUID = r"^[0-9a-fA-F]{32}$"
_NOT_FINITE = "(?i)^[+-]?(inf|infinity|s?nan[0-9]*)$"

# A rule is a code, the SQL of its test and the message, or SQL of one.
Rule = tuple[str, str, str]


def _text(value: str) -> str:
    return "'" + value.replace("'", "\\'") + "'"


def _like(pattern: str | None) -> str:
    return _text((pattern or "").replace("\\", "\\\\"))


# Bytes a repeated key takes where it is broadcast, and how many may be.
_KEY_BYTES = 128
_BROADCAST_BYTES = 64 << 20


def _digest(*columns: Column | str) -> Column:
    """SHA-256 of the columns' JSON, as 32 bytes."""
    return F.unhex(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256))


def mark_file_duplicates(
    rows: DataFrame, contract: Contract, *, file: Sequence[str] = ("source_file_name",)
) -> DataFrame:
    """Add ``duplicate_row`` and ``duplicate_reference`` within each file.

    The first row in file order is never a duplicate, whether it is valid or not.
    An identical row is only called a duplicate row.
    """
    named = F.nullif(fn.clean(F.col("settlement_reference")), F.lit(""))
    in_file = reduce(Column.__and__, [F.col(f).isNotNull() for f in file])
    keyed = rows.withColumns(
        {
            "_row": F.when(in_file, _digest(*file, *contract.names)),
            "_named": F.when(in_file & named.isNotNull(), _digest(*file, named)),
        }
    )
    # Two keys per row, counted in one exchange; only those that come twice are kept.
    keys = keyed.select(F.explode(F.array("_row", "_named")).alias("_key"), "source_row_number")
    repeated = stored(
        keys.where("_key IS NOT NULL")
        .groupBy("_key")
        .agg(F.count(F.lit(1)).alias("_copies"), F.min("source_row_number").alias("_first"))
        .where("_copies > 1")
        .drop("_copies"),
        "settle-repeated",
    )
    small = repeated.count() * _KEY_BYTES <= _BROADCAST_BYTES
    for key, name in (("_row", "duplicate_row"), ("_named", "_again")):
        first = repeated.withColumnsRenamed({"_key": key, "_first": f"_first{key}"})
        keyed = keyed.join(F.broadcast(first) if small else first, key, "left").withColumn(
            name, F.coalesce(F.col("source_row_number") > F.col(f"_first{key}"), F.lit(False))
        )
    return keyed.withColumn("duplicate_reference", F.col("_again") & ~F.col("duplicate_row")).select(
        *rows.columns, "duplicate_row", "duplicate_reference"
    )


def _presence_rules(contract: Contract) -> list[Rule]:
    rules = []
    for f in contract.fields:
        text = f"_text.{f.name}"
        if f.required:
            rules.append(
                ("REQUIRED_FIELD_MISSING", f"`{f.name}` IS NULL", f"{f.name} column value is missing")
            )
        if not f.nullable:
            rules.append(
                (
                    "REQUIRED_FIELD_EMPTY",
                    f"`{f.name}` IS NOT NULL AND {text} = ''",
                    f"{f.name} must not be empty",
                )
            )
        if f.max_length:
            rules.append(
                (
                    "MAX_LENGTH_EXCEEDED",
                    f"length({text}) > {f.max_length}",
                    f"{f.name} exceeds maximum length",
                )
            )
    return rules


def _decimal_problem(f: Field) -> Column:
    """Code of the rule a decimal text breaks, NULL for a good or an empty one."""
    text = f"_text.{f.name}"
    scale, precision = f.scale or 0, f.precision or 18
    plain = f"^[+-]?[0-9]{{1,{precision - scale}}}([.][0-9]{{0,{scale}}})?$"
    exponent = f"coalesce(try_cast(regexp_extract({text}, '[eE]([+-]?[0-9]+)$', 1) AS INT), 0)"
    fraction = f"regexp_extract({text}, '[.]([0-9]*)', 1)"
    whole = f"regexp_extract({text}, '^[+-]?([0-9]*)', 1)"
    digits = f"greatest(length(ltrim('0', concat({whole}, {fraction}))), 1)"
    shift = f"({exponent} - length({fraction}))"
    return F.expr(
        f"CASE WHEN {text} = '' OR {text} RLIKE '{plain}' THEN NULL "
        f"WHEN NOT {text} RLIKE '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$' "
        "THEN 'INVALID_DECIMAL' "
        f"WHEN greatest(-{shift}, 0) > {scale} THEN 'DECIMAL_SCALE_EXCEEDED' "
        f"WHEN {digits} + greatest({shift}, 0) > {precision} "
        f"OR try_cast({text} AS DECIMAL({precision},{scale})) IS NULL "
        "THEN 'DECIMAL_PRECISION_EXCEEDED' END"
    )


def _decimal_rules(f: Field) -> list[Rule]:
    problem = f"_problem.{f.name}"
    return [
        (
            "INVALID_DECIMAL",
            f"{problem} = 'INVALID_DECIMAL' AND _text.{f.name} RLIKE '{_NOT_FINITE}'",
            f"{f.name} must be finite",
        ),
        (
            "INVALID_DECIMAL",
            f"{problem} = 'INVALID_DECIMAL' AND NOT _text.{f.name} RLIKE '{_NOT_FINITE}'",
            f"{f.name} is not a decimal",
        ),
        (
            "DECIMAL_SCALE_EXCEEDED",
            f"{problem} = 'DECIMAL_SCALE_EXCEEDED'",
            f"{f.name} exceeds scale {f.scale}",
        ),
        (
            "DECIMAL_PRECISION_EXCEEDED",
            f"{problem} = 'DECIMAL_PRECISION_EXCEEDED'",
            f"{f.name} exceeds precision {f.precision}",
        ),
    ]


def validate_rows(rows: DataFrame, contract: Contract) -> DataFrame:
    """Judge raw text rows; adds ``typed``, ``error_code`` and ``error_message``.

    ``rows`` carry the contract's columns as text, ``file_partner_id`` and
    ``file_settlement_date`` from the file name and the two duplicate flags. Codes
    keep the rule order, each once; both error columns are NULL for good rows.
    """
    amounts = ("amount", "fee_amount", "net_amount")
    trimmed = fn.computed(
        rows,
        rows.columns,
        _text=F.struct(*[fn.clean(F.col(n)).alias(n) for n in contract.names]),
    )
    problem = {n: _decimal_problem(contract[n]) for n in amounts}
    text = {n: F.col(f"_text.{n}") for n in contract.names}
    day = F.when(
        text["settlement_date"].rlike(r"^\d{4}-\d{2}-\d{2}$"),
        F.try_to_date(text["settlement_date"], "yyyy-MM-dd"),
    )
    hexes = F.expr(
        "lower(replace(translate(replace(replace(_text.internal_transaction_id, 'urn:'), 'uuid:'), "
        "'{}', ''), '-'))"
    )
    uuid = F.when(
        text["internal_transaction_id"] != "",
        F.when(
            hexes.rlike(_UUID),
            F.regexp_replace(hexes, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"),
        ),
    )
    zoned = fn.offset_timestamp(text["transaction_timestamp"])
    made = {
        **text,
        "settlement_date": day,
        "internal_transaction_id": uuid,
        "transaction_timestamp": zoned,
        **{
            n: F.when(problem[n].isNull(), text[n].try_cast(MONEY)) for n in amounts
        },
    }
    # One layer, as each copies the row; its projection shares the common parts.
    typed = fn.computed(
        trimmed,
        trimmed.columns,
        _problem=F.struct(*[problem[n].alias(n) for n in amounts]),
        typed=F.struct(*[made[n].alias(n) for n in contract.names]),
        _any_clock=F.when(zoned.isNull(), fn.iso_timestamp(text["transaction_timestamp"])),
    )
    statuses = contract["settlement_status"].allowed_values
    allowed = ", ".join(_text(x) for x in statuses)
    bad_clock = "_text.transaction_timestamp <> '' AND typed.transaction_timestamp IS NULL"
    # Codes, messages and their order.
    rules: list[Rule] = [
        ("DUPLICATE_ROW", "duplicate_row", "Identical row already appeared in file"),
        (
            "DUPLICATE_SETTLEMENT_REFERENCE",
            "duplicate_reference",
            "settlement_reference must be unique within one file",
        ),
        *_presence_rules(contract),
        (
            "INVALID_PARTNER_ID",
            "_text.partner_id <> '' AND NOT _text.partner_id RLIKE "
            + _like(contract["partner_id"].pattern),
            "partner_id format is invalid",
        ),
        (
            "PARTNER_MISMATCH",
            "_text.partner_id <> '' AND _text.partner_id <> file_partner_id",
            "partner_id does not match the file name",
        ),
        (
            "INVALID_SETTLEMENT_DATE",
            "_text.settlement_date <> '' AND typed.settlement_date IS NULL",
            "settlement_date is not ISO date",
        ),
        (
            "SETTLEMENT_DATE_MISMATCH",
            "typed.settlement_date <> file_settlement_date",
            "settlement_date does not match file name",
        ),
        (
            "INVALID_INTERNAL_TRANSACTION_ID",
            "_text.internal_transaction_id <> '' AND typed.internal_transaction_id IS NULL",
            "internal_transaction_id is not UUID",
        ),
        (
            "INVALID_TRANSACTION_TIMESTAMP",
            f"{bad_clock} AND _any_clock IS NULL",
            "transaction_timestamp is not ISO-8601",
        ),
        (
            "TIMESTAMP_TIMEZONE_REQUIRED",
            f"{bad_clock} AND _any_clock IS NOT NULL",
            "transaction_timestamp must contain an explicit UTC offset",
        ),
        *_decimal_rules(contract["amount"]),
        ("AMOUNT_NOT_POSITIVE", "typed.amount <= 0", "amount must be greater than zero"),
        (
            "INVALID_CURRENCY",
            "_text.currency <> '' AND NOT _text.currency RLIKE "
            + _like(contract["currency"].pattern),
            "currency must be three uppercase letters",
        ),
        (
            "INVALID_SETTLEMENT_STATUS",
            f"_text.settlement_status <> '' AND NOT _text.settlement_status IN ({allowed})",
            f"settlement_status must be one of {', '.join(statuses)}",
        ),
        *_decimal_rules(contract["fee_amount"]),
        ("NEGATIVE_FEE_AMOUNT", "typed.fee_amount < 0", "fee_amount must be zero or greater"),
        *_decimal_rules(contract["net_amount"]),
        (
            "NET_AMOUNT_INCONSISTENT",
            "typed.net_amount <> typed.amount - typed.fee_amount",
            "net_amount must equal amount minus fee_amount",
        ),
    ]
    cases = ", ".join(
        f"CASE WHEN {test} THEN named_struct('code', {_text(code)}, 'message', {_text(message)}) END"
        for code, test, message in rules
    )
    # Rules that hold leave NULL, which joining passes over. Dropping it here would take the
    # tests out of generated code.
    found = F.expr(f"array({cases})")
    judged = fn.computed(typed, [*rows.columns, "typed"], _found=found)
    codes = F.array_join(F.array_distinct(F.col("_found.code")), "|")
    messages = F.array_join(F.col("_found.message"), "; ")
    return judged.select(
        *rows.columns,
        "typed",
        F.nullif(codes, F.lit("")).alias("error_code"),
        F.nullif(messages, F.lit("")).alias("error_message"),
    )


def accepted_rows(
    judged: DataFrame, *, run_id: str | Column, processed_at: datetime | Column
) -> DataFrame:
    """Typed settlement rows of files and rows without errors."""
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    at = processed_at if isinstance(processed_at, Column) else F.lit(processed_at)
    given = {"processing_run_id": run, "processed_at": at}
    fields = {f.name for f in SETTLEMENT.fields} & set(judged.schema["typed"].dataType.names)

    def source(name: str) -> Column:
        if name in given:
            return given[name]
        if name in fields:
            return F.col(f"typed.{name}")
        return F.col(name) if name in judged.columns else F.lit(None)

    return judged.where(F.col("error_code").isNull()).select(
        *[source(f.name).cast(f.dataType).alias(f.name) for f in SETTLEMENT.fields]
    )


def rejected_rows(judged: DataFrame, contract: Contract) -> DataFrame:
    """Rejected rows with their raw record and joined codes."""
    raw = F.to_json(F.struct(*contract.names), {"ignoreNullFields": "false"})
    return judged.where(F.col("error_code").isNotNull()).select(
        "source_file_name",
        "source_row_number",
        raw.alias("raw_record"),
        "error_code",
        "error_message",
        settlement_quality_code(F.col("error_code")).alias("quality_code"),
    )


def settlement_rejections(
    judged: DataFrame, *, run_id: str | Column, rejected_at: datetime | Column, source: Column
) -> DataFrame:
    """Rejected rows as quality evidence."""
    rejected = judged.where(F.col("error_code").isNotNull())
    return rejection_rows(
        rejected,
        code=settlement_quality_code(F.col("error_code")),
        message=F.col("error_message"),
        reference=F.concat(F.lit("row:"), F.col("source_row_number")),
        source=source,
        event_id=F.col("settlement_reference"),
        entity=F.lit("settlements"),
        business_key=F.col("settlement_reference"),
        run_id=run_id if isinstance(run_id, Column) else F.lit(run_id),
        rejected_at=rejected_at if isinstance(rejected_at, Column) else F.lit(rejected_at),
    )


def file_counts(judged: DataFrame, *, file: Sequence[str] = ("source_file_name",)) -> DataFrame:
    """Rows read, accepted and rejected per file."""
    return judged.groupBy(*file).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(F.col("error_code").isNull()).alias("accepted_count"),
        F.count_if(F.col("error_code").isNotNull()).alias("rejected_count"),
    )


def strict_files(counts: DataFrame) -> DataFrame:
    """File outcome when one rejected row is enough to quarantine a file."""
    bad = F.col("rejected_count") > 0
    return counts.select(
        "*",
        F.when(bad, "QUARANTINED").otherwise("PROCESSED").alias("status"),
        F.when(bad, "REJECTED_RECORDS_PRESENT").alias("file_error_code"),
    )
