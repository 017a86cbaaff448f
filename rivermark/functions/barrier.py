"""Keeping costly columns from being computed again by later filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def computed(df: DataFrame, keep: Sequence[str], **columns: Column) -> DataFrame:
    """Select ``keep`` plus new columns, each computed exactly once per row.

    The optimizer copies the expression behind a column into every filter it moves
    below the projection, so a parsed document would be parsed again per filter.
    It does not move filters through a generator, here one that yields one row.
    Names in ``columns`` must be new.
    """
    # The projection shares common parts between the columns; the generator does not.
    made = df.withColumns(columns)
    packed = ", ".join(f"`{n}`" for n in columns)
    return made.selectExpr(*[f"`{c}`" for c in keep], f"inline(array(struct({packed})))")
