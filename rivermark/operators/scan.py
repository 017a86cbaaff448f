"""Running values along an order, computed in bounded pieces.

A plain window puts a whole group into one task. Here the caller names *levels*,
columns that cut every group into pieces in order (an offset range, a day, a file
block). A piece is windowed on its own, and one summary row per piece carries the
rest over, so no task ever holds more than a piece or the summaries. Groups and
levels must not be NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Rows of one unique integer sequence that share a piece.
PIECE = 1 << 20


def piece(position: Column | str, size: int = PIECE) -> Column:
    """Piece number of an integer position."""
    column = F.col(position) if isinstance(position, str) else position
    return F.floor(column / F.lit(size)).cast("bigint")


def _before(groups: Sequence[str], order: Sequence[str]):
    return W.partitionBy(*groups).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)


def _totals_before(
    sums: DataFrame, groups: Sequence[str], levels: Sequence[str], value: str, out: str
) -> DataFrame:
    """Per piece, the total of all earlier pieces of its group."""
    outer, last = list(levels[:-1]), levels[-1]
    inside = sums.withColumn(
        out, F.coalesce(F.sum(value).over(_before([*groups, *outer], [last])), F.lit(0))
    )
    if not outer:
        return inside.drop(value)
    coarse = sums.groupBy(*groups, *outer).agg(F.sum(value).alias(value))
    base = _totals_before(coarse, groups, outer, value, "_outer")
    return (
        inside.join(base, [*groups, *outer])
        .withColumn(out, F.col(out) + F.col("_outer"))
        .drop(value, "_outer")
    )


def running_total(
    df: DataFrame,
    *,
    groups: Sequence[str],
    levels: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
) -> DataFrame:
    """Add the running sum of ``value`` up to and including each row."""
    keys = [*groups, *levels]
    rows = df.withColumn("_value", value)
    sums = rows.groupBy(*keys).agg(F.sum("_value").alias("_value"))
    base = _totals_before(sums, groups, levels, "_value", "_base")
    upto = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return (
        rows.withColumn("_local", F.sum("_value").over(upto))
        .join(base, keys)
        .withColumn(name, F.col("_base") + F.col("_local"))
        .drop("_value", "_local", "_base")
    )


def row_number(
    df: DataFrame,
    *,
    groups: Sequence[str],
    levels: Sequence[str],
    order: Sequence[str],
    name: str,
) -> DataFrame:
    """Add the 1-based position of each row in its group."""
    keys = [*groups, *levels]
    sums = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    base = _totals_before(sums, groups, levels, "_rows", "_base")
    return (
        df.withColumn("_local", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
        .join(base, keys)
        .withColumn(name, (F.col("_base") + F.col("_local")).cast("bigint"))
        .drop("_local", "_base")
    )


def _carry(
    df: DataFrame,
    groups: Sequence[str],
    levels: Sequence[str],
    order: Sequence[str],
    boxed: Column,
) -> DataFrame:
    """Per piece, the last boxed value of the earlier pieces of its group."""
    position = F.struct(*order)
    ends = df.groupBy(*groups, *levels).agg(
        F.max_by(boxed, F.when(boxed.isNotNull(), position)).alias("_end")
    )
    last = F.last("_end", ignorenulls=True).over(_before(groups, levels))
    return ends.withColumn("_carry", last).drop("_end")


def last_known(
    df: DataFrame,
    *,
    groups: Sequence[str],
    levels: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
) -> DataFrame:
    """Add the latest non-NULL ``value`` at or before each row."""
    keys = [*groups, *levels]
    rows = df.withColumn("_value", value)
    boxed = F.when(F.col("_value").isNotNull(), F.struct("_value"))
    carry = _carry(rows, groups, levels, order, boxed)
    upto = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return (
        rows.withColumn("_local", F.last("_value", ignorenulls=True).over(upto))
        .join(carry, keys)
        .withColumn(name, F.coalesce("_local", "_carry._value"))
        .drop("_value", "_local", "_carry")
    )


def previous(
    df: DataFrame,
    *,
    groups: Sequence[str],
    levels: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
) -> DataFrame:
    """Add the ``value`` of the row just before, NULL on the first row of a group."""
    keys = [*groups, *levels]
    rows = df.withColumn("_value", F.struct(value.alias("v")))
    carry = _carry(rows, groups, levels, order, F.col("_value"))
    local = F.lag("_value").over(W.partitionBy(*keys).orderBy(*order))
    return (
        rows.withColumn("_local", local)
        .join(carry, keys)
        .withColumn(name, F.coalesce("_local", "_carry")["v"])
        .drop("_value", "_local", "_carry")
    )
