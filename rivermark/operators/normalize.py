"""Bronze rows to normalized history rows and typed entity rows."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fn
from ..functions.decode import clock
from ..schemas import (
    BUSINESS_KEYS,
    CDC_HISTORY,
    ENTITY_FIELDS,
    LINEAGE_NAMES,
    MONEY,
    REQUIRED_REFERENCES,
)

SILVER_VERSION = "silver-v1"
OPERATIONS = ("r", "c", "u", "d", "t")
ADDRESS = ("source_object_uri", "source_row_index")


_KEY_FIELDS = ", ".join(dict.fromkeys(f"{k}: STRING" for k in BUSINESS_KEYS.values()))
_IMAGES = ("before_json", "after_json", "event_key_json", "source_metadata_json")


def normalize_events(
    bronze: DataFrame,
    *,
    run_id: str,
    processed_at: datetime,
    silver_version: str = SILVER_VERSION,
    canonical_input: bool = True,
) -> DataFrame:
    """History columns plus ``error_code`` and ``error_message`` (NULL when good).

    Bronze promises canonical JSON, so images are passed on as they are; without
    that promise set ``canonical_input`` to False and they are rendered again.
    Columns that address the row in its source are passed on when present.
    """
    address = [c for c in ADDRESS if c in bronze.columns]
    parsed = fn.computed(
        bronze,
        bronze.columns,
        _before=fn.read_fields(F.col("before_json"), _KEY_FIELDS),
        _after=fn.read_fields(F.col("after_json"), _KEY_FIELDS),
        _key=fn.read_fields(
            F.col("event_key_json"), f"payload: STRUCT<{_KEY_FIELDS}>, {_KEY_FIELDS}"
        ),
        _meta=fn.read_fields(F.col("source_metadata_json"), "table: STRING"),
    )
    images = parsed.select(
        "*",
        F.expr(
            "CASE operation WHEN 'd' THEN _before.v WHEN 't' THEN NULL ELSE _after.v END AS _row"
        ),
        F.expr(
            "CASE operation WHEN 'd' THEN before_json WHEN 't' THEN NULL ELSE after_json END "
            "AS _row_text"
        ),
    )
    # A key field that is present in the row wins even when it is null.
    pick = " ".join(
        f"WHEN '{e}' THEN coalesce(_row.{k}, CASE WHEN "
        f"coalesce(array_contains(json_object_keys(_row_text), '{k}'), false) THEN NULL "
        f"ELSE coalesce(_key.v.payload.{k}, _key.v.{k}) END)"
        for e, k in BUSINESS_KEYS.items()
    )
    keyed = fn.computed(
        images, images.columns, business_key=F.expr(f"CASE entity_name {pick} END")
    )
    clocks = keyed.select(
        "*",
        fn.epoch_millis(F.col("source_ts_ms")).alias("source_ts"),
        fn.epoch_millis(F.col("connector_ts_ms")).alias("connector_ts"),
        fn.epoch_millis(F.col("kafka_message_ts_ms")).alias("kafka_message_ts"),
    )
    bad_clock = " OR ".join(
        f"({c}_ms IS NOT NULL AND {c} IS NULL)"
        for c in ("source_ts", "connector_ts", "kafka_message_ts")
    )
    entities = ", ".join(f"'{e}'" for e in BUSINESS_KEYS)
    operations = ", ".join(f"'{o}'" for o in OPERATIONS)
    key_name = F.create_map(*[F.lit(x) for pair in BUSINESS_KEYS.items() for x in pair])
    # The codes and messages, first match wins.
    rules = [
        (
            F.expr(f"NOT coalesce(entity_name IN ({entities}), false)"),
            "INVALID_BRONZE_SCHEMA",
            F.lit("CDC entity is unsupported"),
        ),
        (
            F.expr(f"NOT coalesce(operation IN ({operations}), false)"),
            "UNSUPPORTED_OPERATION",
            F.lit("CDC operation is unsupported"),
        ),
        (
            ~F.col("event_id").eqNullSafe(fn.event_id()),
            "DUPLICATE_EVENT",
            F.lit("event_id does not match Kafka coordinates"),
        ),
    ]
    for text, value in zip(_IMAGES, ("_before", "_after", "_key", "_meta"), strict=True):
        rules.append(
            (
                F.expr(
                    f"{text} IS NOT NULL AND NOT (coalesce({value}.e = 1, false) AND "
                    f"(startswith(ltrim({text}), '{{') OR trim({text}) = 'null'))"
                ),
                "INVALID_JSON",
                F.when(F.expr(f"{value}.e IS NULL"), f"{text} is invalid JSON").otherwise(
                    f"{text} must be a JSON object"
                ),
            )
        )
    rules += [
        (
            F.expr("coalesce(business_key, '') = ''"),
            "MISSING_BUSINESS_KEY",
            F.concat(key_name[F.col("entity_name")], F.lit(" is missing")),
        ),
        (F.expr(bad_clock), "INVALID_TIMESTAMP", F.lit("Epoch milliseconds are invalid")),
    ]
    broken = F.lit(None).cast("int")
    for number, (test, _, _) in reversed(list(enumerate(rules))):
        broken = F.when(test, F.lit(number)).otherwise(broken)

    def image(name: str) -> Column:
        text = F.nullif(F.trim(name), F.lit("null"))
        return text if canonical_input else fn.canonical(text)

    judged = fn.computed(
        clocks,
        clocks.columns,
        _broken=broken,
        _before_text=image("before_json"),
        _after_text=image("after_json"),
    )
    message = F.when(F.lit(False), F.lit(None))
    for number, (_, _, text) in enumerate(rules):
        message = message.when(F.col("_broken") == number, text)
    operation = F.col("operation")
    values = {
        "before_json": F.col("_before_text"),
        "after_json": F.col("_after_text"),
        "business_payload_json": F.when(operation == "d", F.col("_before_text")).when(
            operation != "t", F.col("_after_text")
        ),
        "is_snapshot": operation == "r",
        "is_deleted": operation.isin("d", "t"),
        "is_tombstone": operation == "t",
        "event_time": F.coalesce("source_ts", "connector_ts", "kafka_message_ts", "ingested_at"),
        "processed_at": F.lit(processed_at).cast("timestamp"),
        "processing_run_id": F.lit(run_id),
        "source_schema_version": F.col("schema_version"),
        "silver_schema_version": F.lit(silver_version),
    }
    codes = F.array(*[F.lit(code) for _, code, _ in rules])
    return judged.select(
        *[values.get(n, F.col(n)).alias(n) for n in CDC_HISTORY.fieldNames()],
        F.get(codes, F.col("_broken")).alias("error_code"),
        message.cast("string").alias("error_message"),
        *address,
    )


def _decoded(name: str, data_type: T.DataType) -> tuple[Column, str]:
    """Value of a payload field from its JSON token, and the code when it is bad."""
    text, token = F.col(f"_text.{name}"), F.col(f"_token.{name}")
    if data_type == MONEY:
        yes = F.when(token == "true", F.lit(1)).when(token == "false", F.lit(0))
        number = fn.money(F.when(~token.rlike("^[tf{\\[]"), text))
        return F.coalesce(yes.cast(MONEY), number), "INVALID_DECIMAL"
    if isinstance(data_type, T.TimestampType):
        return clock(text, token), "INVALID_TIMESTAMP"
    return text.try_cast("decimal(38,6)").try_cast("int"), "INVALID_BRONZE_SCHEMA"


def project_entity(history: DataFrame, entity: str) -> DataFrame:
    """Add ``state``, the typed business row, and why it could not be built.

    ``projection_code`` and ``projection_message`` are NULL for tombstones, which
    carry no row of their own.
    """
    fields = ENTITY_FIELDS[entity]
    coded = [n for n, t in fields if not isinstance(t, T.StringType)]
    # Fields that are read under another name.
    renamed = {"first_name": "full_name", "last_name": "full_name"}
    renamed["event_payload_json"] = "event_payload"
    read = {renamed.get(n, n): "VARIANT" if n in coded else "STRING" for n, _ in fields}
    # The payload text was written by the normalizer, so it is one valid value.
    names = "STRUCT<" + ", ".join(f"{n}: {t}" for n, t in read.items()) + ">"
    rows = fn.computed(
        history, history.columns, _payload=F.from_json("business_payload_json", names)
    )
    # A token shows whether a scalar was text or a number.
    token = F.struct(*[F.to_json(f"_payload.{n}").alias(n) for n in coded])
    rows = fn.computed(rows, rows.columns, _token=token)
    bare = [
        F.when(
            F.col(f"_token.{n}").startswith('"'),
            F.expr(f"substring(_token.{n}, 2, length(_token.{n}) - 2)"),
        )
        .otherwise(F.col(f"_token.{n}"))
        .alias(n)
        for n in coded
    ]
    rows = fn.computed(rows, rows.columns, _text=F.struct(*bare))
    columns, problems = [], []
    for name, data_type in fields:
        if name == "first_name":
            value = fn.first_name(F.col("_payload.full_name"))
        elif name == "last_name":
            value = fn.last_name(F.col("_payload.full_name"))
        elif name == "event_payload_json":
            value = fn.canonical(F.col("_payload.event_payload"))
        elif isinstance(data_type, T.StringType):
            value = F.col(f"_payload.{name}")
        else:
            value, code = _decoded(name, data_type)
            given = f"_token.{name} <> 'null'"
            if code == "INVALID_TIMESTAMP":
                given += f" AND _text.{name} <> ''"
            bad = F.expr(f"coalesce({given}, false) AND state.{name} IS NULL")
            problems.append((code, F.lit(f"{name} cannot be decoded"), bad))
        columns.append(value.alias(name))
    built = fn.computed(
        rows, [*history.columns, "_token", "_text"], state=F.struct(*columns)
    )
    empty = [
        (f, F.expr(f"coalesce(state.{f}, '') = ''")) for f in REQUIRED_REFERENCES.get(entity, ())
    ]
    if empty:
        missing = F.array_join(F.array_compact(F.array(*[F.when(t, f) for f, t in empty])), ", ")
        problems.append(
            (
                "INVALID_REFERENCE",
                F.concat(F.lit("Required reference is missing: "), missing),
                reduce(Column.__or__, [t for _, t in empty]),
            )
        )
    # Money is judged first, then clocks, versions and references.
    rank = ("INVALID_DECIMAL", "INVALID_TIMESTAMP", "INVALID_BRONZE_SCHEMA", "INVALID_REFERENCE")
    problems.sort(key=lambda p: rank.index(p[0]))
    broken = F.lit(None).cast("int")
    for number, (_, _, bad) in reversed(list(enumerate(problems))):
        broken = F.when(bad, F.lit(number)).otherwise(broken)
    judged = fn.computed(
        built,
        [*history.columns, "state"],
        _broken=F.when(~F.col("is_tombstone"), broken),
    )
    codes = F.array(*[F.lit(code) for code, _, _ in problems]).cast("array<string>")
    message = F.when(F.lit(False), F.lit(None))
    for number, (_, text, _) in enumerate(problems):
        message = message.when(F.col("_broken") == number, text)
    return judged.select(
        *history.columns,
        F.when(~F.col("is_tombstone"), F.col("state")).alias("state"),
        F.get(codes, F.col("_broken")).alias("projection_code"),
        message.cast("string").alias("projection_message"),
    )


def lineage(event_columns: dict[str, Column] | None = None) -> Column:
    """Lineage struct of an event row."""
    source = {"effective_event_time": F.col("event_time"), **(event_columns or {})}
    return F.struct(*[source.get(n, F.col(n)).alias(n) for n in LINEAGE_NAMES])
