"""The set-based fold against a sequential one, on random and hand-made histories."""

import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from rivermark.operators import dedup, references, state
from rivermark.schemas import REFERENCE_RULES

AT = datetime(2025, 1, 1, tzinfo=UTC)
EVENT = (
    "business_key string, kafka_topic string, kafka_partition int, kafka_offset bigint, "
    "is_tombstone boolean, is_deleted boolean, projection_code string, customer_id string"
)


def frame(spark, events):
    return spark.createDataFrame(events, EVENT).select(
        "*",
        F.concat_ws(":", "kafka_topic", "kafka_partition", "kafka_offset").alias("event_id"),
        F.lit("bad").alias("projection_message"),
        F.lit(1).cast("bigint").alias("source_lsn"),
        F.lit(AT).alias("event_time"),
        F.lit(AT).alias("processed_at"),
        F.lit("run").alias("processing_run_id"),
        F.lit("v").alias("source_schema_version"),
        F.lit("v").alias("silver_schema_version"),
        F.when(
            ~F.col("is_tombstone"),
            F.struct(
                F.col("business_key").alias("account_id"),
                "customer_id",
                F.lit("n").alias("account_number"),
                F.lit("USD").alias("currency"),
                F.lit(0).cast("decimal(18,2)").alias("balance"),
                F.lit("s").alias("status"),
                F.lit(AT).alias("created_at"),
                F.lit(AT).alias("updated_at"),
            ),
        ).alias("state"),
    )


def sequential(events, snapshot):
    """One accumulator per key, walked in order."""
    accs = {k: dict(v) for k, v in snapshot.items()}
    decisions, applied = {}, []
    for e in sorted(events, key=lambda e: (e[1], e[2], e[3])):
        key, topic, part, off, tomb, deleted, problem, customer = e
        acc = accs.get(key)
        if acc and acc["topic"] == topic:
            if acc["part"] != part or off < acc["off"]:
                decisions[(topic, part, off)] = "REJECT"
                continue
            if off == acc["off"]:
                decisions[(topic, part, off)] = "SKIP"
                continue
        if tomb:
            if acc is None:
                decisions[(topic, part, off)] = "SKIP"
                continue
            customer = acc["customer"]
        elif problem:
            decisions[(topic, part, off)] = "REJECT"
            continue
        accs[key] = {"topic": topic, "part": part, "off": off, "customer": customer, "deleted": deleted}
        decisions[(topic, part, off)] = "APPLY"
        applied.append((key, customer, f"{topic}:{part}:{off}"))
    return accs, decisions, applied


def random_events(rng, keys, count, first=0):
    events = []
    for off in range(first, first + count):
        key = rng.choice(keys)
        tomb = rng.random() < 0.2
        problem = "INVALID_DECIMAL" if not tomb and rng.random() < 0.15 else None
        deleted = tomb or rng.random() < 0.1
        topic = "a" if rng.random() < 0.8 else rng.choice("bc")
        part = int(key[1:]) % 3 if rng.random() < 0.85 else rng.randrange(3)
        events.append((key, topic, part, off, tomb, deleted, problem, f"c{rng.randrange(5)}"))
    return events


def as_state(rows):
    return {
        r["account_id"]: {
            "topic": r["kafka_topic"],
            "part": r["kafka_partition"],
            "off": r["kafka_offset"],
            "customer": r["customer_id"],
            "deleted": r["is_deleted"],
        }
        for r in rows.collect()
    }


@pytest.mark.parametrize("seed", range(4))
def test_fold_matches_sequential(spark, seed):
    rng = random.Random(seed)
    keys = [f"k{i}" for i in range(12)]
    early = random_events(rng, keys, 40)
    late = random_events(rng, keys, 120, first=25)
    base, _, _ = sequential(early, {})
    wanted, decisions, applied = sequential(late, base)

    first = state.decide_events(frame(spark, early))
    snapshot = state.merge_state(first.where("decision = 'APPLY'"), None, "accounts").cache()
    assert as_state(snapshot) == base
    decided = state.decide_events(frame(spark, late), snapshot, key="account_id").cache()
    got = {
        (r["kafka_topic"], r["kafka_partition"], r["kafka_offset"]): r["decision"]
        for r in decided.collect()
    }
    assert got == decisions
    done = decided.where("decision = 'APPLY'")
    assert as_state(state.merge_state(done, snapshot, "accounts")) == wanted

    known = {"customers": spark.createDataFrame([("c0",), ("c3",)], "k string")}
    found = references.unresolved_references(
        done, known, "accounts", snapshot=snapshot, observed_at=AT, piece_size=5
    )
    open_rows = sorted((r["business_key"], r["reference_key"], r["source_event_id"]) for r in found.collect())
    assert open_rows == sorted(a for a in applied if a[1] not in ("c0", "c3"))


def test_create_delete_tombstone(spark):
    events = [
        ("k", "a", 0, 1, False, False, None, "c1"),
        ("k", "a", 0, 2, False, True, None, "c1"),
        ("k", "a", 0, 3, True, True, None, None),
        ("gone", "a", 0, 4, True, True, None, None),
    ]
    decided = state.decide_events(frame(spark, events))
    latest = state.merge_state(decided.where("decision = 'APPLY'"), None, "accounts")
    rows = as_state(latest)
    assert rows == {"k": {"topic": "a", "part": 0, "off": 3, "customer": "c1", "deleted": True}}
    assert state.current(latest).count() == 0


def test_references_without_rules(spark):
    assert "customers" not in REFERENCE_RULES
    decided = state.decide_events(frame(spark, [("k", "a", 0, 1, False, False, None, "c")]))
    assert references.unresolved_references(decided, {}, "customers") is None


def test_duplicates_with_full_ties_and_wrong_ids(spark):
    base = frame(
        spark,
        [("k", "a", 0, o, False, False, None, "c") for o in (1, 1, 1, 2, 3)],
    ).withColumn("source_ts", F.col("event_time")).withColumn("connector_ts", F.col("event_time"))
    rows = base.withColumn("ingested_at", F.col("event_time")).withColumn(
        "source_row_index", F.monotonically_increasing_id()
    ).cache()
    marked = dedup.mark_duplicates(rows, tie=["source_row_index"])
    assert marked.where("duplicate_code = 'DUPLICATE_COORDINATE'").count() == 2
    assert marked.where("duplicate_code IS NULL").count() == 3
    same = rows.withColumn("event_id", F.lit("same"))
    marked = dedup.mark_duplicates(same, tie=["source_row_index"], verified_ids=False)
    counts = {r["duplicate_code"]: r["count"] for r in marked.groupBy("duplicate_code").count().collect()}
    assert counts == {None: 1, "DUPLICATE_COORDINATE": 2, "DUPLICATE_EVENT": 2}
