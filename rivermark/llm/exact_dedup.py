"""Exact duplicates by a stream with keyed state.

Documents are landed once with the digest of their normalised text. A stream over the
landed files keeps, per digest and for good, the smallest id, the place of that row
(file and row number) and the number of rows; the state lives in RocksDB, on the
executors' disks and in the checkpoint of the shared folder. Landing further files and
running the stream again goes on from there. The state is then read as a table.

Rows whose digest was met more than once are compared with the kept row byte by byte.
A row that differs in spite of its digest forms groups of its own by its whole text.

Digests are counted before they are shuffled, so a text that a third of all rows
share is one row per task. Texts are shuffled for possible hits only: a table of the
first five hex digits of repeated digests (at most 16^5 rows) is broadcast to leave
out the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermark.session import shared_dir

from .common import BLANKS, settings, stored

_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    # Without it each store takes several MB of disk before it holds a row.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """Runs of blanks as one space; empty for NULL."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def digest_state(
    spark: SparkSession, landed: str, checkpoint: str, *, files_per_batch: int | None = None
) -> DataFrame:
    """Run the stream over what is landed and not yet seen; the state as a table.

    Returns ``digest, keeper (unnamed, id, file, at), n``. ``files_per_batch`` bounds a
    micro-batch; without it one batch takes all new files.
    """
    schema = spark.read.parquet(landed).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(landed).select(
        "digest",
        F.struct(
            F.col("doc_id").isNull().alias("unnamed"),
            F.col("doc_id").alias("id"),
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.row_index").alias("at"),
        ).alias("place"),
    )
    state = rows.groupBy("digest").agg(F.min("place").alias("keeper"), F.count(F.lit(1)).alias("n"))
    with settings(spark, _STATE):
        stream = (
            state.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        stream.awaitTermination()
        kept = spark.read.format("statestore").load(checkpoint)
        keeper, n = (f.name for f in kept.schema["value"].dataType.fields)
        return stored(
            kept.select(
                F.col("key.digest").alias("digest"),
                F.col("value")[keeper].alias("keeper"),
                F.col("value")[n].alias("n"),
            ),
            "exact-state",
        )


def exact_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: Column | None = None,
    files_per_batch: int | None = None,
    keep_row: bool = False,
) -> DataFrame:
    """Groups of equal texts and the row of each that stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``, one row per input row,
    with ``keep_row`` also ``row``, a struct of all input columns.

    Texts are equal when identical after each run of blanks became one space; NULL is
    the empty text, and empty texts equal each other. The smallest id stays, NULL ids
    come last; of rows with the same id the first landed one stays, so exactly one row
    of a group is kept. Empty tables give empty results. Further columns are carried in
    ``row`` only, so their names don't clash. ``digest`` replaces the SHA-256, for tests.
    """
    spark = docs.sparkSession
    work = shared_dir(spark, "exact-dedup")
    source = F.struct(*[docs[c] for c in docs.columns]) if keep_row else F.struct(docs[text].alias(text))
    docs.select(
        docs[doc_id].alias("doc_id"),
        F.sha2(normalised(docs[text]), 256).alias("digest") if digest is None else digest.alias("digest"),
        source.alias("row"),
    ).write.parquet(f"{work}/landed")
    landed = spark.read.parquet(f"{work}/landed").select(
        "doc_id",
        "digest",
        "row",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("at"),
    )
    state = digest_state(spark, f"{work}/landed", f"{work}/checkpoint", files_per_batch=files_per_batch)
    repeated = state.filter("n > 1")
    marks = repeated.select(F.substring("digest", 1, 5).alias("mark")).distinct()
    place = F.struct("file", "at")
    kept_place = F.struct("keeper.file", "keeper.at")
    hits = (
        landed.select("doc_id", "digest", F.col("row")[text].alias("text"), "file", "at")
        .withColumn("mark", F.substring("digest", 1, 5))
        .join(F.broadcast(marks), "mark", "left_semi")
        .join(repeated, "digest")
        .withColumn("text", normalised(F.col("text")))
    )
    kept_text = hits.filter(place == kept_place).select("digest", F.col("text").alias("kept_text"))
    # Only rows that differ from the row kept under their digest.
    other = stored(
        hits.join(kept_text, "digest")
        .filter(F.col("text") != F.col("kept_text"))
        .select("digest", "doc_id", "text", "file", "at"),
        "exact-collisions",
    )
    groups = other.groupBy("digest", "text").agg(
        F.min(
            F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), "file", "at")
        ).alias("own_keeper"),
        F.count(F.lit(1)).alias("own_n"),
    )
    moved = other.join(groups, ["digest", "text"]).select("file", "at", "own_keeper", "own_n")
    less = other.groupBy("digest").agg(F.count(F.lit(1)).alias("less"))
    sizes = state.join(less, "digest", "left").withColumn(
        "n", F.col("n") - F.coalesce(F.col("less"), F.lit(0))
    )
    decided = (
        (landed if keep_row else landed.drop("row"))
        .join(sizes.select("digest", "keeper", "n"), "digest")
        .join(moved, ["file", "at"], "left")
    )
    keeper = F.coalesce("own_keeper", "keeper")
    columns = [
        F.col("doc_id"),
        keeper["id"].alias("keep_id"),
        F.coalesce("own_n", "n").alias("group_size"),
        ((F.col("file") == keeper["file"]) & (F.col("at") == keeper["at"])).alias("kept"),
        F.col("digest").alias("text_sha256"),
    ]
    return decided.select(*columns, *(["row"] if keep_row else []))


def without_exact_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The row of each group of equal texts that stays, with all its columns."""
    found = exact_duplicates(docs, keep_row=True, **options).filter("kept")
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns])
