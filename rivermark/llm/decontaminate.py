"""Benchmark decontamination by a prefix-filtered set join.

A window is ``width`` consecutive words of an item. Its words are ordered by how rare
they are in the documents; as all of them must occur, the join needs a prefix of one
word, the rarest. Documents meet a window at that word; the word's places in both give
the window's start there (positional bound), which must leave room for it (length
bound), and the words between are compared one by one.

Documents are read twice: for word counts and for the join. With windows of a
measured size the join runs in the scan of the documents and nothing but hits and one
row per document is shuffled. Larger benchmarks are joined by a shuffle on the word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, row_key, stored, words_of


def item_windows(items: DataFrame, *, item_id: str, text: str, width: int) -> DataFrame:
    """Distinct windows of the items: ``window_id, window, items``.

    An item with fewer words than ``width``, but not none, is one window.
    """
    words = items.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(width), F.lit(0)) + 1)
    return (
        words.filter(F.size("w") > 0)
        .select("item", "w", F.explode(starts).alias("at"))
        .select("item", F.slice("w", F.col("at"), F.lit(width)).alias("window"))
        .groupBy("window")
        .agg(F.collect_set("item").alias("items"))
        .withColumn("window_id", F.md5(F.concat_ws(" ", "window")))
    )


def _rarest_word(windows: DataFrame, texts: DataFrame, small: bool) -> DataFrame:
    """Each window with its rarest word and that word's first place in it.

    Windows with a word that no document has are dropped: they can't occur.
    """
    places = windows.select("window_id", F.posexplode("window").alias("offset", "word"))
    vocabulary = places.select("word").distinct()
    counts = (
        texts.select(F.explode("words").alias("word"))
        .join(F.broadcast(vocabulary) if small else vocabulary, "word")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    first = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset")).alias("p")
    prefix = places.join(counts, "word", "left").groupBy("window_id").agg(first)
    return windows.join(prefix, "window_id").filter("p.n > 0").select(
        F.col("p.word").alias("word"), F.col("p.offset").alias("offset"), "window", "items", "window_id"
    )


def _hits_in_scan(texts: DataFrame, probes: DataFrame) -> DataFrame:
    """Occurrences, found while the words go by, and one row per document.

    Each document ends in an empty word that meets an empty window.
    """
    end = texts.sparkSession.range(1).select(
        F.lit("").alias("word"),
        F.lit(0).alias("offset"),
        F.array().cast("array<string>").alias("window"),
        F.array().cast("array<string>").alias("items"),
    )
    probes = probes.drop("window_id").unionByName(end)
    placed = texts.select(
        "doc_id", "key", "words", F.posexplode(F.concat("words", F.array(F.lit("")))).alias("at", "word")
    )
    start = F.col("at") - F.col("offset")
    length = F.size("window")
    return (
        placed.join(
            F.broadcast(probes),
            (placed["word"] == probes["word"])
            & (start >= 0)
            & (start + length <= F.size("words"))
            & (F.slice("words", start + 1, length) == F.col("window")),
        )
        .select(
            "doc_id",
            "key",
            F.size("words").alias("n_words"),
            F.when(length > 0, F.struct(start.alias("a"), (start + length).alias("b"))).alias("span"),
            F.when(length > 0, F.col("items")).alias("items"),
        )
    )


def _hits_by_shuffle(texts: DataFrame, probes: DataFrame) -> DataFrame:
    """The same rows by a shuffle on the word, then on the document."""
    places = texts.select("key", F.posexplode("words").alias("at", "word"))
    found = (
        places.join(probes, "word")
        .select("key", (F.col("at") - F.col("offset")).alias("start"), "window", "items")
        .filter("start >= 0")
        .distinct()
    )
    whole = texts.select("key", "words").dropDuplicates(["key"])
    length = F.size("window")
    spans = (
        found.join(whole, "key")
        .filter(F.slice("words", F.col("start") + 1, length) == F.col("window"))
        .select("key", F.struct(F.col("start").alias("a"), (F.col("start") + length).alias("b")).alias("span"), "items")
    )
    documents = texts.select("doc_id", "key", F.size("words").alias("n_words"))
    ids = documents.dropDuplicates(["key"]).join(spans, "key")
    nothing = documents.select(
        "doc_id",
        "key",
        "n_words",
        F.lit(None).cast("struct<a:int,b:int>").alias("span"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    return ids.select("doc_id", "key", "n_words", "span", "items").unionByName(nothing)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = 10,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """What of each document stands in the items.

    Returns ``doc_id, key, n_words, n_hit, items, spans, contaminated``, one row per
    input row: words inside occurring windows, the ids of the items these belong to
    (sorted as strings) and the word ranges ``[a, b)`` of the occurrences.

    NULL or empty texts have no words: such documents are never hit, such items have no
    window. Repeated rows get equal results, as do rows that share an id but not a text
    (each its own). Empty tables are fine on either side; a NULL item id counts as an
    occurring window without an id. Other columns are ignored.
    """
    texts = docs.select(
        F.col(doc_id).alias("doc_id"),
        row_key(F.col(doc_id), F.col(text)).alias("key"),
        words_of(F.col(text)).alias("words"),
    )
    windows = stored(item_windows(items, item_id=item_id, text=item_text, width=width), "windows")
    size = F.sum(
        F.length(F.concat_ws(" ", "window")) * 3 + F.length(F.concat_ws(" ", "items")) + F.lit(200)
    )
    small = (windows.agg(size.alias("b")).first()["b"] or 0) <= broadcast_bytes
    probes = stored(_rarest_word(windows, texts, small), "window-prefixes")
    rows = _hits_in_scan(texts, probes) if small else _hits_by_shuffle(texts, probes)
    grouped = rows.groupBy("doc_id", "key").agg(
        F.first("n_words").alias("n_words"),
        F.count_if(F.col("span").isNull()).alias("copies"),
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(s["upto"], x["a"]))).alias("n"),
            F.greatest(s["upto"], x["b"]).alias("upto"),
        ),
        lambda s: s["n"],
    )
    return (
        grouped.withColumn("n_hit", covered)
        .select(
            "doc_id",
            "key",
            F.col("n_words").cast("bigint").alias("n_words"),
            "n_hit",
            "items",
            "spans",
            (F.col("n_hit") > 0).alias("contaminated"),
            F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
        )
        .drop("copy")
    )


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark window, with all their columns."""
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    found = contamination(docs, items, **options).filter("contaminated").select("key").distinct()
    names = docs.columns
    keyed = docs.select(
        F.struct(*[docs[c] for c in names]).alias("row"), row_key(docs[doc_id], docs[text]).alias("key")
    )
    return keyed.join(found, "key", "left_anti").select(*[F.col("row")[c].alias(c) for c in names])
