"""File names, object inventories and bounded incremental discovery."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date
from typing import Any
from uuid import UUID

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import BUSINESS_KEYS, ENTITY_ORDER
from .contract import Contract


def parse_file_names(
    files: DataFrame, contract: Contract, *, expected_partner: str | Column | None = None
) -> DataFrame:
    """Add partner_id, settlement_date, sequence and ``error_code`` from ``file_name``."""
    pattern, group = contract.name_groups()
    name = F.col("file_name")

    def part(key: str) -> Column:
        return F.regexp_extract(name, pattern, group[key])

    partner, day = part("partner_id"), F.try_to_date(part("settlement_date"), "yyyy-MM-dd")
    sequence = part("sequence").try_cast("int")
    expected = expected_partner
    if expected is not None and not isinstance(expected, Column):
        expected = F.lit(expected)
    code = F.when(~name.endswith(".csv") | name.startswith(".csv"), "INVALID_EXTENSION").when(
        ~name.rlike(pattern), "INVALID_FILE_NAME"
    )
    if expected is not None:
        code = code.when(partner != expected, "PARTNER_FILE_NAME_MISMATCH")
    code = code.when(day.isNull(), "INVALID_SETTLEMENT_DATE").when(
        sequence < 1, "INVALID_FILE_SEQUENCE"
    )
    good = F.col("error_code").isNull()
    return files.withColumn("error_code", code).select(
        "*",
        F.when(good, partner).alias("partner_id"),
        F.when(good, day).alias("settlement_date"),
        F.when(good, sequence).alias("sequence"),
    )


def path_value(path: Column, name: str) -> Column:
    """Value of a ``name=value`` part of a path, NULL without one."""
    return F.nullif(F.regexp_extract(path, f"(?:^|/){name}=([^/]*)/", 1), F.lit(""))


def entity_rank(entity: Column) -> Column:
    """Dependency rank of an entity, unknown ones last."""
    ranks = F.create_map(*[F.lit(x) for r, e in enumerate(ENTITY_ORDER) for x in (e, r)])
    return F.coalesce(ranks[entity], F.lit(99))


def discover(
    objects: DataFrame,
    *,
    source_type: str,
    entity: str | None = None,
    from_date: date | None = None,
    to_date: date | None = None,
    prefix: str | None = None,
    max_objects: int | None = None,
) -> DataFrame:
    """Objects to process, by ``object_key``, in dependency order; all by default.

    An object without a date in its path passes the date filter, one with a
    malformed date does not. What was processed before has to be left out first where
    a bound is asked for; ``in_order`` bounds what is left.
    """
    key = F.col("object_key")
    cdc = source_type.upper() == "CDC"
    root, suffix, field = (
        ("cdc/", ".parquet", "event_date") if cdc else ("settlements/", ".csv", "settlement_date")
    )
    wanted = key.startswith(prefix or root) & key.startswith(root) & key.endswith(suffix)
    if cdc and entity:
        wanted = wanted & key.contains(f"entity={entity}/")
    text = path_value(key, field)
    day = F.try_to_date(text, "yyyy-MM-dd")
    inside = F.lit(True)
    if from_date:
        inside = inside & (day >= F.lit(from_date))
    if to_date:
        inside = inside & (day <= F.lit(to_date))
    wanted = wanted & (text.isNull() | (day.isNotNull() & inside))
    return in_order(objects.where(wanted), max_objects=max_objects)


def in_order(objects: DataFrame, *, max_objects: int | None = None) -> DataFrame:
    """Objects by entity dependency, partition and first offset, then by key.

    Keys without these parts (settlement files) are ordered by the key alone. With
    ``max_objects`` only so many, the first ones.
    """
    if max_objects is not None and max_objects < 1:
        raise ValueError("max_objects must be at least 1")
    key = F.col("object_key")

    def number(part: str) -> Column:
        return F.coalesce(path_value(key, part).try_cast("bigint"), F.lit(0))

    entity = path_value(key, "entity")
    ordered = objects.orderBy(entity_rank(entity), entity, number("partition"), number("offset_start"), key)
    return ordered if max_objects is None else ordered.limit(max_objects)


@dataclass(frozen=True)
class Backfill:
    request_id: str
    source_type: str
    entity: str | None
    input_prefix: str | None
    from_date: date | None
    to_date: date | None
    force: bool
    dry_run: bool


def _blank_to_none(value: Any) -> Any:
    return None if value == "" else value


# Parameter: what it is turned into, and what is wrong where that fails.
_FIELDS = {
    "request_id": (lambda v: str(UUID(str(v))), "is no UUID"),
    "source_type": (lambda v: {"CDC": "CDC", "SETTLEMENT": "SETTLEMENT"}[str(v).upper()], "names no source"),
    "entity": (lambda v: v if v is None else {e: e for e in BUSINESS_KEYS}[v], "names no entity"),
    "input_prefix": (lambda v: v if v is None else _inner_path(v), "leaves the object store's folder"),
    "from_date": (lambda v: v if v is None else date.fromisoformat(str(v)), "is no ISO date"),
    "to_date": (lambda v: v if v is None else date.fromisoformat(str(v)), "is no ISO date"),
}
# What must hold between parameters that are right by themselves.
_TOGETHER = {
    "entity: settlements have none": lambda p: p["source_type"] == "CDC" or p["entity"] is None,
    "to_date: lies before from_date": lambda p: None in (p["from_date"], p["to_date"]) or p["from_date"] <= p["to_date"],
}


def _inner_path(path: str) -> str:
    parts = re.split(r"[/\\]", path)
    if not parts[0] or ".." in parts:
        raise ValueError(path)
    return path


def backfill_request(params: dict[str, Any]) -> Backfill:
    """The request that the parameters of a backfill make; all problems in one error."""
    values, problems = {}, []
    for name, (turn, problem) in _FIELDS.items():
        try:
            values[name] = turn(_blank_to_none(params.get(name)))
        except (KeyError, TypeError, ValueError):
            problems.append(f"{name}: {problem}")
    if not problems:
        problems = [problem for problem, holds in _TOGETHER.items() if not holds(values)]
    if problems:
        raise ValueError("; ".join(problems))
    return Backfill(
        **values, force=bool(params.get("force_reprocess", False)), dry_run=bool(params.get("dry_run", True))
    )
