"""Work that must stay even, narrow and done once, whatever the size of the input."""

from datetime import UTC, datetime

from pyspark.sql import functions as F

from rivermark.operators import settlement
from rivermark.operators.contract import load_contract
from rivermark.plans import catalog_events, derived
from rivermark.session import spread, stored
from rivermark.streaming import bronze

CONTRACT = load_contract()


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def sizes(df):
    return [n for n in df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]


def test_spread_deals_out_one_row_group(spark, tmp_path):
    path = str(tmp_path / "one")
    spark.range(20_000).withColumn("t", F.sha2(F.col("id").cast("string"), 256)).coalesce(1).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60k")
    try:
        rows = spark.read.parquet(path)
        cores = spark.sparkContext.defaultParallelism
        assert rows.rdd.getNumPartitions() >= cores and len(sizes(rows)) == 1
        dealt = sizes(spread(rows))
        assert len(dealt) >= cores and max(dealt) < 20_000 / 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def settlement_rows(spark):
    base = {n: "x" for n in CONTRACT.names}
    data = [
        ("a", 2, base | {"settlement_reference": " r1"}),
        ("a", 3, base | {"settlement_reference": " r1"}),
        ("a", 4, base | {"settlement_reference": "r1", "amount": "2"}),
        ("a", 5, base | {"settlement_reference": " "}),
        ("a", 6, base | {"settlement_reference": "", "amount": "2"}),
        ("b", 2, base | {"settlement_reference": "r1"}),
        (None, 2, base),
        (None, 3, base),
    ]
    names = ", ".join(f"{n} string" for n in CONTRACT.names)
    flat = [(f, i, *[v[n] for n in CONTRACT.names]) for f, i, v in data]
    return spark.createDataFrame(flat, f"source_file_name string, source_row_number bigint, {names}")


def test_duplicate_search_moves_no_wide_rows(spark):
    marked = settlement.mark_file_duplicates(stored(settlement_rows(spark), "test"), CONTRACT)
    got = {
        (r["source_file_name"], r["source_row_number"]): (r["duplicate_row"], r["duplicate_reference"])
        for r in marked.collect()
    }
    flagged = {k: v for k, v in got.items() if any(v)}
    assert len(got) == 8 and flagged == {("a", 3): (True, False), ("a", 4): (False, True)}
    assert "hashpartitioning" not in plan(marked)[1]


def test_rules_stay_in_generated_code(spark):
    rows = settlement_rows(spark).withColumns(
        {
            "file_partner_id": F.lit("x"),
            "file_settlement_date": F.lit("2024-01-01").cast("date"),
            "duplicate_row": F.lit(False),
            "duplicate_reference": F.lit(False),
        }
    )
    assert "lambda" not in plan(settlement.validate_rows(rows, CONTRACT))[0]


def test_settlement_lines_are_numbered_before_their_texts(spark, tmp_path):
    line = (1, 1, 2, 3, 10.0, 1.0, 0.0, 0.0, datetime(2024, 1, 1, tzinfo=UTC), "A", "F")
    other = (2, 1, 2, 13, 10.0, 1.0, 0.0, 0.0, datetime(2024, 1, 1, tzinfo=UTC), "A", "F")
    names = (
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double, "
        "l_quantity double, l_discount double, l_tax double, l_shipdate timestamp, l_returnflag string, l_linestatus string"
    )
    spark.createDataFrame([other, line], names).write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = derived.settle(spark, str(tmp_path))
    got = sorted((r["settlement_reference"], r["source_row_number"], r["source_file_name"]) for r in rows.collect())
    name = "settlement_P3_2024-01-01_001.csv"
    assert got == [("1-1", 2, name), ("2-1", 3, name)]
    assert "Window" not in plan(rows)[0]


def test_account_events_are_parsed_once(spark, tmp_path):
    when = datetime(2024, 1, 1, tzinfo=UTC)
    data = [(20, when, 1, "signup", 5.0, "{}"), (21, when, 1, "click", 6.0, "{}"), (33, when, 2, "error", 7.0, "{}")]
    names = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(data, names).write.parquet(str(tmp_path / "events.parquet"))
    latest = catalog_events.account_state(spark, str(tmp_path))
    assert {(r["account_id"], r["kafka_offset"]) for r in latest.collect()} == {("1", 21), ("2", 33)}
    assert "from_json" not in plan(latest)[0]


def test_offset_ranges_need_no_window_over_whole_partitions(spark):
    rows = spark.createDataFrame(
        [("t", 0, o) for o in range(10)] + [("t", 1, 3), ("t", None, 4), ("t", 0, None)],
        "topic string, partition int, offset bigint",
    )
    kept = spark.createDataFrame(
        [("t", 0, 2, 3), ("t", 0, 6, 6)], "topic string, partition int, offset_start bigint, offset_end bigint"
    )
    for stored_ranges, expected in (
        (None, {(0, 9), (3, 3), (4, 4)}),
        (kept, {(0, 1), (4, 5), (7, 9), (3, 3), (4, 4)}),
    ):
        placed = bronze._place(rows, stored_ranges)
        assert placed.count() == rows.count()
        new = placed.where("NOT covered")
        assert {(r["offset_start"], r["offset_end"]) for r in new.collect()} == expected
        assert "Window" not in plan(placed)[0]
