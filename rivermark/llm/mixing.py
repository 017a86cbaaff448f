"""Mixing sources to target weights.

Every document gets a random key (a hash of its id). Per source, documents are put
in key order in ranges of the key space, the ranges' word totals give each document
the words before it (distributed prefix sums), and the source is cut at its budget.
A budget beyond the source's size first takes whole epochs.

The plan shuffles narrow rows only: the size of each text is computed in the scan.
A source may hold any share of the rows, as its key space is cut into 65,536 ranges.
Sources themselves are counted on one row each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rivermark.operators.scan import running_total

from .common import stored, word_count


def source_targets(
    sizes: DataFrame, *, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """Targets of sources (``source``, ``source_size``) that share a total by weight.

    Sources take the weights in turn by code point, NULL last. The total is ``share``
    times all sizes; a target stops at ``most`` times its source's size, and what is
    over goes to the others by weight until none is above. Sorted by the level at
    which they fill up, the first source that doesn't fill fixes the level of the rest.
    """
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    named = W.orderBy(F.col("source").asc_nulls_last())
    filling = W.orderBy("_fill", F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int"),
    )
    full = (
        sizes.withColumn("_weight", weight)
        .withColumn("_total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_most", F.col("source_size") * F.lit(float(most)))
        .withColumn("_fill", F.col("_most") / F.col("_weight"))
        .withColumn(
            "_given",
            F.coalesce(
                F.sum("_most").over(filling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)
            ),
        )
        .withColumn(
            "_sharing", F.sum("_weight").over(filling.rowsBetween(0, W.unboundedFollowing))
        )
        .withColumn("_level", (F.col("_total") - F.col("_given")) / F.col("_sharing"))
    )
    first = F.min_by(
        F.when(F.col("_fill") >= F.col("_level"), F.col("_level")),
        F.when(F.col("_fill") >= F.col("_level"), F.col("_fill")),
    ).over(everything)
    return full.withColumn("_final", first).select(
        "source",
        "source_size",
        F.when(F.col("_final").isNull(), F.col("_most"))
        .otherwise(F.least("_most", F.col("_weight") * F.col("_final")))
        .alias("target"),
    )


def mix(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Words to take of each document so that sources meet their targets.

    Returns ``doc_id, size, source_size, target, taken`` and the columns in ``keep``;
    one row per input row. A document that the cut goes through is taken in part.

    NULL text has size 0 and is taken 0 words; a NULL source is a source of its own and
    comes last; a NULL id is hashed as such. Equal ids are ordered by size, so repeated
    rows share a result up to their order. Empty tables give empty results. Other
    columns are ignored, also where their names are those used here.
    """
    wanted = [F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)]
    sized = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        *wanted,
    )
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    key = F.md5(F.concat(F.lit(f"{seed}:"), ident))
    group = F.when(F.col("source").isNull(), F.lit("-")).otherwise(
        F.concat(F.lit("+"), F.col("source"))
    )
    rows = stored(
        sized.withColumn("_group", group)
        .withColumn("_key", key)
        .withColumn("_part", F.substring("_key", 1, 2))
        .withColumn("_range", F.substring("_key", 3, 2)),
        "mix-sizes",
    )
    # One row per source; small ones are broadcast by the size of the stored table.
    targets = stored(
        source_targets(
        rows.groupBy("_group", "source")
        .agg(F.sum("size").alias("source_size"))
        .select("source", "source_size"),
        weights=weights,
        share=share,
        most=most,
        ),
        "mix-targets",
    )
    ranked = running_total(
        rows,
        groups=["_group"],
        levels=["_part", "_range"],
        order=["_key", "doc_id", "size"],
        value=F.col("size"),
        name="_upto",
    ).drop("source")
    group_of: Column = F.when(F.col("source").isNull(), F.lit("-")).otherwise(
        F.concat(F.lit("+"), F.col("source"))
    )
    budget = F.floor("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    return (
        ranked.join(targets.withColumn("_group", group_of).drop("source"), "_group")
        .withColumn("_epochs", epochs.cast("bigint"))
        .withColumn("_rest", budget - F.col("_epochs") * F.col("source_size"))
        .withColumn("_left", F.col("_rest") - (F.col("_upto") - F.col("size")))
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            (
                F.col("_epochs") * F.col("size")
                + F.greatest(F.lit(0), F.least(F.col("size"), F.col("_left")))
            )
            .cast("bigint")
            .alias("taken"),
            *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
        )
    )
