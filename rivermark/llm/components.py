"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """The smallest node of each node's component: ``node, label``.

    ``links`` has ``a`` and ``b``; nodes without a link are not in the result. In turn,
    every node's larger neighbours and every node's smaller neighbours are linked to the
    smallest one, until nothing changes. The links are written to the shared folder after
    each turn, and only a count and a checksum come to the driver.
    """
    edges = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(),
        "links",
    )
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("v", "u") % (1 << 40)).alias("s")).first()
        if mark == seen:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("label"))
        seen = mark
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stored(
            edges.join(least, "u").select("v", F.col("m").alias("u")).filter("v <> u").distinct(), "links"
        )
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        edges = stored(
            large.join(least, "v")
            .select(F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e"))
            .select("e.v", "e.u")
            .filter("v <> u")
            .distinct(),
            "links",
        )
