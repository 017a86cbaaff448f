"""Declarative audits: row constraints, keys, references, refunds and lifecycles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scan

# Status lists, code formats and event transitions of the source tables.
CUSTOMER_STATUSES = ("PENDING_VERIFICATION", "ACTIVE", "SUSPENDED", "CLOSED")
ACCOUNT_STATUSES = ("PENDING", "ACTIVE", "FROZEN", "CLOSED")
MERCHANT_STATUSES = ("ACTIVE", "SUSPENDED", "INACTIVE", "CLOSED")
PAYMENT_STATUSES = ("PENDING", "AUTHORIZED", "COMPLETED", "FAILED", "CANCELLED")
REFUND_STATUSES = ("PENDING", "COMPLETED", "FAILED", "CANCELLED")
PAYMENT_TYPES = ("MERCHANT_PAYMENT", "ACCOUNT_TRANSFER")
EVENT_TYPES = (
    "PAYMENT_REQUESTED",
    "PAYMENT_AUTHORIZED",
    "PAYMENT_COMPLETED",
    "PAYMENT_FAILED",
)
COUNTED_REFUNDS = ("PENDING", "COMPLETED")


def _c(name: str) -> Column:
    return F.col(name)


def _ordered() -> Column:
    return _c("updated_at") >= _c("created_at")


def _payment_target() -> Column:
    merchant, other = _c("merchant_id"), _c("destination_account_id")
    return (
        (_c("transaction_type") == "MERCHANT_PAYMENT") & merchant.isNotNull() & other.isNull()
    ) | (
        (_c("transaction_type") == "ACCOUNT_TRANSFER")
        & merchant.isNull()
        & other.isNotNull()
        & (other != _c("account_id"))
    )


def _payment_clocks() -> Column:
    done, failed = _c("completed_at"), _c("failed_at")
    return (
        ((_c("status") == "COMPLETED") & done.isNotNull() & failed.isNull())
        | ((_c("status") == "FAILED") & failed.isNotNull() & done.isNull())
        | (
            _c("status").isin("PENDING", "AUTHORIZED", "CANCELLED")
            & done.isNull()
            & failed.isNull()
        )
    )


def _event_transition() -> Column:
    before, after, kind = _c("previous_status"), _c("new_status"), _c("event_type")
    open_before = before.isin("PENDING", "AUTHORIZED")
    return (
        ((kind == "PAYMENT_REQUESTED") & before.isNull() & (after == "PENDING"))
        | ((kind == "PAYMENT_AUTHORIZED") & (before == "PENDING") & (after == "AUTHORIZED"))
        | ((kind == "PAYMENT_COMPLETED") & open_before & (after == "COMPLETED"))
        | ((kind == "PAYMENT_FAILED") & open_before & (after == "FAILED"))
    )


def constraints(table: str) -> dict[str, Column]:
    """Named row constraints of a source table."""
    rules = {
        "currencies": lambda: {
            "currencies_code_format": _c("currency_code").rlike("^[A-Z]{3}$"),
            "currencies_minor_units_range": _c("minor_units").between(0, 4),
            "currencies_timestamps_ordered": _ordered(),
        },
        "payment_channels": lambda: {
            "payment_channels_code_format": _c("payment_channel_code").rlike("^[A-Z][A-Z0-9_]*$"),
            "payment_channels_timestamps_ordered": _ordered(),
        },
        "merchant_categories": lambda: {
            "merchant_categories_code_format": _c("category_code").rlike("^[0-9]{4}$"),
            "merchant_categories_timestamps_ordered": _ordered(),
        },
        "customers": lambda: {
            "customers_country_code_format": _c("country_code").rlike("^[A-Z]{2}$"),
            "customers_email_shape": _c("email").isNull() | (F.instr("email", "@") > 1),
            "customers_status_valid": _c("status").isin(*CUSTOMER_STATUSES),
            "customers_timestamps_ordered": _ordered(),
        },
        "accounts": lambda: {
            "accounts_balance_non_negative": _c("balance") >= 0,
            "accounts_status_valid": _c("status").isin(*ACCOUNT_STATUSES),
            "accounts_timestamps_ordered": _ordered(),
        },
        "merchants": lambda: {
            "merchants_country_code_format": _c("country_code").rlike("^[A-Z]{2}$"),
            "merchants_code_format": _c("merchant_code").rlike("^[A-Z][A-Z0-9_-]*$"),
            "merchants_status_valid": _c("status").isin(*MERCHANT_STATUSES),
            "merchants_timestamps_ordered": _ordered(),
        },
        "payment_transactions": lambda: {
            "payment_transactions_amount_positive": _c("amount") > 0,
            "payment_transactions_type_valid": _c("transaction_type").isin(*PAYMENT_TYPES),
            "payment_transactions_status_valid": _c("status").isin(*PAYMENT_STATUSES),
            "payment_transactions_target_valid": _payment_target(),
            "payment_transactions_status_timestamps_valid": _payment_clocks(),
            "payment_transactions_completed_after_request": _c("completed_at").isNull()
            | (_c("completed_at") >= _c("requested_at")),
            "payment_transactions_failed_after_request": _c("failed_at").isNull()
            | (_c("failed_at") >= _c("requested_at")),
            "payment_transactions_timestamps_ordered": _ordered(),
        },
        "transaction_events": lambda: {
            "transaction_events_version_positive": _c("event_version") > 0,
            "transaction_events_type_valid": _c("event_type").isin(*EVENT_TYPES),
            "transaction_events_previous_status_valid": _c("previous_status").isNull()
            | _c("previous_status").isin(*PAYMENT_STATUSES),
            "transaction_events_new_status_valid": _c("new_status").isin(*PAYMENT_STATUSES),
            "transaction_events_transition_valid": _event_transition(),
            "transaction_events_payload_object": F.regexp_extract(
                F.schema_of_variant(F.try_parse_json("event_payload_json")), "^([A-Z]+)", 1
            )
            == "OBJECT",
            "transaction_events_producer_after_event": _c("producer_time") >= _c("event_time"),
            "transaction_events_created_after_event": _c("created_at") >= _c("event_time"),
        },
        "refunds": lambda: {
            "refunds_amount_positive": _c("amount") > 0,
            "refunds_status_valid": _c("status").isin(*REFUND_STATUSES),
            "refunds_reason_code_format": _c("reason_code").rlike("^[A-Z][A-Z0-9_]*$"),
            "refunds_status_timestamps_valid": (
                (_c("status") == "COMPLETED") & _c("completed_at").isNotNull()
            )
            | (
                _c("status").isin("PENDING", "FAILED", "CANCELLED") & _c("completed_at").isNull()
            ),
            "refunds_completed_after_request": _c("completed_at").isNull()
            | (_c("completed_at") >= _c("requested_at")),
            "refunds_timestamps_ordered": _ordered(),
        },
    }
    return rules[table]()


def violations(
    rows: DataFrame, rules: dict[str, Column], *, keep: Sequence[str]
) -> DataFrame:
    """One row per broken constraint. As in SQL, an unknown result breaks nothing."""
    broken = F.array_compact(
        F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()])
    )
    return rows.select(*keep, F.explode(broken).alias("constraint_name"))


def constraint_audit(tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """Broken constraints of several source tables, with the row's key as text."""
    found = [
        violations(rows.withColumn("row_key", F.col(keys[name]).cast("string")), constraints(name), keep=["row_key"])
        .select(F.lit(name).alias("table_name"), "row_key", "constraint_name")
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, found)


def repeated_keys(rows: DataFrame, *, key: Sequence[str], name: str) -> DataFrame:
    """Values of a key, SQL expressions, that occur more than once; NULLs never do."""
    parts = [f"_key{n}" for n in range(len(key))]
    filled = rows.select(*[F.expr(k).cast("string").alias(p) for k, p in zip(key, parts)]).dropna()
    counted = filled.groupBy(*parts).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where("row_count > 1").select(
        F.lit(name).alias("constraint_name"), F.concat_ws("|", *parts).alias("key_value"), "row_count"
    )


# Unique keys of the source tables, by constraint.
UNIQUE_KEYS = {
    "customers": {
        "customers_external_customer_ref_key": ("external_customer_ref",),
        "ux_customers_email_case_insensitive": ("lower(email)",),
    },
    "accounts": {"accounts_account_number_key": ("account_number",)},
    "merchants": {
        "merchants_merchant_code_key": ("merchant_code",),
        "merchants_external_reference_key": ("external_reference",),
    },
    "payment_transactions": {
        "payment_transactions_partner_reference_key": ("partner_reference",),
        "payment_transactions_idempotency_key_key": ("idempotency_key",),
    },
    "transaction_events": {
        "transaction_events_transaction_version_unique": ("transaction_id", "event_version"),
    },
    "refunds": {"refunds_partner_reference_key": ("partner_reference",)},
}


def unique_key_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated values of every unique key of the given source tables."""
    found = [
        repeated_keys(rows, key=key, name=constraint)
        for name, rows in tables.items()
        for constraint, key in UNIQUE_KEYS[name].items()
    ]
    return reduce(DataFrame.unionByName, found)


# Fixed values: (table, field, referenced table, referenced field).
FOREIGN_KEYS = (
    ("accounts", "customer_id", "customers", "customer_id"),
    ("accounts", "currency", "currencies", "currency_code"),
    ("merchants", "category_code", "merchant_categories", "category_code"),
    ("merchants", "settlement_currency", "currencies", "currency_code"),
    ("payment_transactions", "customer_id", "customers", "customer_id"),
    ("payment_transactions", "account_id", "accounts", "account_id"),
    ("payment_transactions", "destination_account_id", "accounts", "account_id"),
    ("payment_transactions", "merchant_id", "merchants", "merchant_id"),
    ("payment_transactions", "payment_channel", "payment_channels", "payment_channel_code"),
    ("payment_transactions", "currency", "currencies", "currency_code"),
    ("transaction_events", "transaction_id", "payment_transactions", "transaction_id"),
    ("refunds", "transaction_id", "payment_transactions", "transaction_id"),
    ("refunds", "currency", "currencies", "currency_code"),
)


def orphan_keys(child: DataFrame, field: str, parent: DataFrame, key: str) -> DataFrame:
    """Referenced values without a parent row, with how many child rows hold them.

    Children are counted per value before they meet the parent keys.
    """
    counted = (
        child.where(F.col(field).isNotNull())
        .groupBy(F.col(field).alias("reference_key"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return counted.join(parent.select(F.col(key).alias("reference_key")), "reference_key", "left_anti")


def foreign_key_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Orphans of every reference between the given source tables."""
    found = [
        orphan_keys(tables[child], field, tables[parent], key).select(
            F.lit(f"{child}.{field}").alias("relation"),
            F.col("reference_key").cast("string").alias("reference_key"),
            "row_count",
        )
        for child, field, parent, key in FOREIGN_KEYS
        if child in tables and parent in tables
    ]
    return reduce(DataFrame.unionByName, found)


def refunded_totals(refunds: DataFrame) -> DataFrame:
    """Pending and completed refunds summed per payment."""
    counted = F.col("status").isin(*COUNTED_REFUNDS)
    return refunds.groupBy("transaction_id").agg(
        F.coalesce(F.sum(F.when(counted, F.col("amount"))), F.lit(0).cast("decimal(18,2)")).alias(
            "refunded_amount"
        )
    )


def running_refunds(
    refunds: DataFrame, *, levels: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Add ``running_total`` of counted refunds per payment in request order."""
    counted = F.when(F.col("status").isin(*COUNTED_REFUNDS), F.col("amount")).otherwise(
        F.lit(0).cast("decimal(18,2)")
    )
    return scan.running_total(
        refunds,
        groups=["transaction_id"],
        levels=levels,
        order=order,
        value=counted,
        name="running_total",
    )


def refund_violations(
    refunds: DataFrame,
    payments: DataFrame,
    *,
    levels: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Refunds against the rules of their payment, first broken rule per refund.

    As at insert time, every earlier counted refund adds to the total whether or
    not it was itself in order; the refund in question counts with its full amount.
    """
    own = F.col("amount")
    counted = F.when(F.col("status").isin(*COUNTED_REFUNDS), own).otherwise(
        F.lit(0).cast("decimal(18,2)")
    )
    totals = running_refunds(refunds, levels=levels, order=order).withColumn(
        "total_with_refund", F.col("running_total") - counted + own
    )
    paid = payments.select(
        "transaction_id",
        F.col("amount").alias("payment_amount"),
        F.col("currency").alias("payment_currency"),
        F.col("status").alias("payment_status"),
    )
    # Rule names in the order they are tested.
    rule = (
        F.when(F.col("payment_status").isNull(), "ORIGINAL_TRANSACTION_MISSING")
        .when(F.col("payment_status") != "COMPLETED", "TRANSACTION_NOT_COMPLETED")
        .when(F.col("payment_currency") != F.col("currency"), "CURRENCY_MISMATCH")
        .when(F.col("total_with_refund") > F.col("payment_amount"), "REFUND_TOTAL_EXCEEDED")
    )
    return (
        totals.join(paid, "transaction_id", "left")
        .withColumn("violation", rule)
        .where(F.col("violation").isNotNull())
    )


def lifecycle_breaks(
    events: DataFrame, *, levels: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Events whose previous status or version does not follow the event before."""
    linked = scan.previous(
        events,
        groups=["transaction_id"],
        levels=levels,
        order=order,
        value=F.col("new_status"),
        name="status_before",
    )
    numbered = scan.row_number(
        linked, groups=["transaction_id"], levels=levels, order=order, name="expected_version"
    )
    broken = ~F.col("previous_status").eqNullSafe(F.col("status_before")) | (
        F.col("event_version") != F.col("expected_version")
    )
    return numbered.where(broken)
