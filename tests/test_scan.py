"""Piecewise running values against plain windows, with very small pieces."""

import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rivermark.operators import batching, scan


def rows(spark):
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.5 else f"g{rng.randrange(4)}", i, rng.choice([None, 1, 2, 3]))
            for i in range(400)]
    return spark.createDataFrame(data, "g string, i bigint, v int").withColumn(
        "p", scan.piece("i", 7)
    ).withColumn("c", scan.piece("i", 49))


def test_scans_match_windows(spark):
    df = rows(spark)
    where = {"groups": ["g"], "order": ["i"]}
    total = scan.running_total(df, levels=["c", "p"], value=F.coalesce("v", F.lit(0)), name="t", **where)
    number = scan.row_number(total, levels=["p"], name="n", **where)
    known = scan.last_known(number, levels=["p"], value=F.col("v"), name="k", **where)
    got = scan.previous(known, levels=["p"], value=F.col("v"), name="b", **where)
    w = W.partitionBy("g").orderBy("i")
    expected = df.select(
        "g",
        "i",
        F.sum(F.coalesce("v", F.lit(0))).over(w).alias("t"),
        F.row_number().over(w).alias("n"),
        F.last("v", ignorenulls=True).over(w).alias("k"),
        F.lag("v").over(w).alias("b"),
    )
    columns = ["g", "i", "t", "n", "k", "b"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, expected.collect()))


def test_number_over_whole_table(spark):
    df = rows(spark).select("i", "p", "c")
    got = scan.row_number(df, groups=[], levels=["c", "p"], order=["i"], name="n")
    assert got.where("n <> i + 1").count() == 0


def test_offset_ranges(spark):
    offsets = [0, 1, 2, 3, 4, 7, 8, 9, 20, 21]
    data = [("t", 0, o, "a", "d1" if o < 9 else "d2", "v") for o in offsets]
    df = spark.createDataFrame(
        data,
        "kafka_topic string, kafka_partition int, kafka_offset bigint, entity_name string, "
        "event_date string, schema_version string",
    )
    for size in (3, 1 << 20):
        got = batching.offset_ranges(df, batch_size=3, piece_size=size)
        starts = {r["kafka_offset"]: r["range_start"] for r in got.collect()}
        assert starts == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 7: 7, 8: 7, 9: 9, 20: 20, 21: 20}
