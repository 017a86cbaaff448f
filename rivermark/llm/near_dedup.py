"""Near-duplicate documents by dart signatures and banding.

Texts are compared as sets of runs of five words (with ``weighted``, as multisets).

1. One pass over the texts gives each its signature's bands and a digest of its words.
2. Texts with the same words are one node.
3. Nodes that share a band are a bucket. Every node is compared with the bucket's pivot,
   not with all others, and what is similar is linked. The pivot is the node that meets
   most others over all its buckets: of a text and its copies, the text itself.
4. Components of the links are labelled. In a bucket whose nodes don't all have one
   label, pairs with different labels are left. Small buckets are compared out. In others
   the pivot helps: two texts that are similar though one isn't similar to the pivot
   share a run of words that the pivot lacks, or else the other is smaller than the pivot
   and both have so much of it as their similarity takes. So pairs are found by a join on
   the runs beyond the pivot, in which the rarest shared run must leave room for all that
   the pair has to share, and by one on sizes; few do without being similar.
5. The components of all links are the classes.

Compared are the texts themselves: every pair's similarity is exact. A pair of
similarity 0.8 shares no band with a probability of 5 in a million.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import row_key, ship, stored
from .components import connected_components
from .darts import bands, digest, overlaps, shingles, signatures, text_words

SIMILARITY = 0.8
# Parts that the pairs of one node are dealt to.
_PARTS = 64
# Nodes of a bucket whose pairs are compared without the pivot's help.
_SMALL = 8


def _signer(weighted: bool):
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, docs, word, doc in text_words(batch.column(2)):
                of, element, times = shingles(word, doc, docs)
                weight = times.astype(float) if weighted else np.ones(len(times))
                keys = bands(signatures(of, element, weight, docs))
                high, low = digest(word, doc, docs)
                size = np.bincount(of, weight, minlength=docs).astype(float)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(docs + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first : first + docs], batch.column(1)[first : first + docs], pa.array(high), pa.array(low), pa.array(size), lists],
                    ["doc_id", "key", "high", "low", "size", "bands"],
                )

    return sign


def _paired(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) with both texts.

    The pairs of a node ``b`` are dealt to parts, and its text to the parts in use.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = ends.join(nodes.select("node", "key"), "node")
    text = stored(
        texts.join(wanted, "key").groupBy("node").agg(F.min("text").alias("text")), "near-texts"
    )
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("a"), F.lit(_PARTS)))
    copies = dealt.select("b", "part").distinct().join(
        text.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )
    full = dealt.join(copies, ["b", "part"]).join(
        text.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"
    )
    return full.select("a", "b", "text_a", "text_b")


def _links(pairs: DataFrame, similarity: float, weighted: bool) -> DataFrame:
    """The pairs whose texts are similar."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in overlaps(batch.column(2), batch.column(3), weighted=weighted):
                close = pa.array(np.flatnonzero(part.similarity() >= similarity) + part.first)
                yield pa.RecordBatch.from_arrays([c.take(close) for c in batch.columns[:2]], ["a", "b"])

    return pairs.mapInArrow(measure, "a bigint, b bigint")


def _beyond(pairs: DataFrame, weighted: bool) -> DataFrame:
    """Of each pair the weight in common, and the runs of ``a`` that ``b`` lacks."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in overlaps(batch.column(2), batch.column(3), weighted=weighted):
                row, element, weight = part.beyond
                n = len(part.common)
                at = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                names = pa.StructArray.from_arrays([pa.array(element), pa.array(weight.astype(float))], ["s", "w"])
                yield pa.RecordBatch.from_arrays(
                    [*(c[part.first : part.first + n] for c in batch.columns[:2]), pa.array(part.common.astype(float)),
                     pa.array(part.right.astype(float)), pa.ListArray.from_arrays(pa.array(at), names)],
                    ["a", "b", "common", "pivot_size", "beyond"],
                )

    return pairs.mapInArrow(
        measure, "a bigint, b bigint, common double, pivot_size double, beyond array<struct<s:bigint,w:double>>"
    )


def _pairs_by_pivot(legs: DataFrame, similarity: float) -> DataFrame:
    """Pairs with different labels that can be similar, from what is known of nodes and
    the pivot of their bucket (``pivot, node, label, size, common, pivot_size, beyond``)."""
    share = similarity / (1 + similarity)
    slack = 1e-9
    each = legs.select("pivot", "node", "label", "size", "common", F.explode("beyond").alias("r")).select(
        "pivot", "node", "label", "size", "common", F.col("r.s").alias("s"), F.col("r.w").alias("w")
    )
    # A node's runs by rarity, each with its weight and that of the more frequent ones:
    # what two nodes can share if this is the first run they have in common.
    often = each.groupBy("pivot", "s").agg(F.count(F.lit(1)).alias("often"))
    later = W.partitionBy("pivot", "node").orderBy("often", "s").rowsBetween(0, W.unboundedFollowing)
    runs = each.join(often, ["pivot", "s"]).withColumn("rest", F.sum("w").over(later)).filter("often > 1")
    one, two = ([F.col(c).alias(f"{c}_{k}") for c in ("node", "label", "size", "common", "rest")] for k in "ab")
    needed = share * (F.col("size_a") + F.col("size_b")) - F.least("common_a", "common_b") - slack
    meeting = (
        runs.select("pivot", "s", *one)
        .join(runs.select("pivot", "s", *two), ["pivot", "s"])
        .filter("node_a < node_b AND label_a <> label_b")
        .filter(F.least("rest_a", "rest_b") >= needed)
    )
    # The largest partner that a node's part of the pivot suffices for.
    room = legs.select(
        "pivot", "node", "label", "size", "pivot_size", F.floor(F.col("common") / share - F.col("size") + slack).alias("room")
    )
    least, most = F.ceil(F.col("size") * similarity - slack), F.least("room", F.ceil("pivot_size") - 1)
    within = (
        room.filter(most >= least)
        .select("pivot", F.col("node").alias("node_a"), F.col("label").alias("label_a"), F.col("size").alias("size_a"),
                F.explode(F.sequence(least, most)).alias("size"))
        .join(room.select("pivot", F.col("size").cast("bigint").alias("size"), F.col("node").alias("node_b"),
                          F.col("label").alias("label_b"), F.col("room").alias("room_b")), ["pivot", "size"])
        .filter("node_a <> node_b AND label_a <> label_b AND room_b >= size_a")
    )
    return (
        meeting.select("node_a", "node_b")
        .unionByName(within.select(F.least("node_a", "node_b").alias("node_a"), F.greatest("node_a", "node_b").alias("node_b")))
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        .distinct()
    )


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets with several labels, with their label, its most frequent
    one and the number of the bucket's nodes."""
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    shares = labelled.groupBy("h", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = (
        shares.groupBy("h")
        .agg(F.max(F.struct("n", "label")).alias("top"), F.count(F.lit(1)).alias("labels"), F.sum("n").alias("nodes"))
        .filter("labels > 1")
        .select("h", F.col("top.label").alias("top"), "nodes")
    )
    return labelled.join(mixed, "h").select("h", "node", "size", "pivot", "label", "top", "nodes")


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    weighted: bool = False,
) -> DataFrame:
    """Class of near-duplicates of every document.

    Returns ``doc_id, key, class_id, class_size, kept``, one row per input row: the
    smallest id of its class, the number of rows in it, and whether it is the one that
    stays. ``key`` identifies a row by id and text.

    Words are runs of non-blank characters, A-Z lowered. Fewer than five words are one
    run; texts without words (also NULL) form one class. NULL ids come last. Of repeated
    rows one is kept. Empty tables give no rows; other columns are ignored.
    """
    ship(docs.sparkSession)
    ident = docs.schema[doc_id].dataType.simpleString()
    texts = docs.select(
        F.col(doc_id).alias("doc_id"),
        row_key(F.col(doc_id), F.col(text)).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = stored(
        texts.mapInArrow(
            _signer(weighted),
            f"doc_id {ident}, key string, high bigint, low bigint, size double, bands array<bigint>",
        ).withColumn("at", F.monotonically_increasing_id()),
        "near-signatures",
    )
    nodes = stored(
        rows.groupBy("high", "low")
        .agg(F.min("key").alias("key"), F.first("size").alias("size"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()),
        "near-nodes",
    )
    # Nodes of the buckets with more than one, and how many others each meets.
    banded = nodes.filter("size > 0").select(F.explode("bands").alias("h"), "node", "size")
    buckets = banded.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = stored(banded.join(buckets, "h"), "near-buckets")
    degrees = met.groupBy("node").agg(F.sum("n").alias("met"))
    like = F.least("size", "other_size") >= F.lit(similarity - 1e-9) * F.greatest("size", "other_size")

    def compared(pairs: DataFrame) -> DataFrame:
        return stored(_links(_paired(pairs, nodes, texts), similarity, weighted), "near-links")

    pivots = met.join(degrees, "node").groupBy("h").agg(F.max(F.struct("met", "node", "size")).alias("p"))
    members = stored(
        met.drop("n").join(pivots.select("h", F.col("p.node").alias("pivot"), F.col("p.size").alias("other_size")), "h"),
        "near-members",
    )
    known = stored(
        members.filter((F.col("node") != F.col("pivot")) & like)
        .select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        .distinct(),
        "near-pairs",
    )
    links = compared(known)
    inside = stored(_mixed(members, connected_components(links)), "near-mixed")
    # Small buckets: nodes outside the most frequent label meet all with another label.
    small = inside.filter(F.col("nodes") <= _SMALL)
    outer = small.filter("label <> top").select(
        "h", F.col("node").alias("a"), F.col("label").alias("a_label"), F.col("size").alias("other_size")
    )
    direct = (
        outer.join(small.select("h", "node", "label", "top", "size"), "h")
        .filter((F.col("label") != F.col("a_label")) & ((F.col("label") == F.col("top")) | (F.col("node") < F.col("a"))) & like)
        .select(F.col("a"), F.col("node").alias("b"))
        .distinct()
    )
    legs = stored(
        inside.filter((F.col("nodes") > _SMALL) & (F.col("node") != F.col("pivot"))).select("pivot", "node", "label", "size").distinct(),
        "near-legs",
    )
    beyond = _beyond(_paired(legs.select(F.col("node").alias("a"), F.col("pivot").alias("b")), nodes, texts), weighted)
    by_pivot = _pairs_by_pivot(
        stored(legs.join(beyond.withColumnsRenamed({"a": "node", "b": "pivot"}), ["node", "pivot"]), "near-beyond"), similarity
    )
    done = known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = direct.unionByName(by_pivot).distinct().join(done, ["a", "b"], "left_anti")
    final = connected_components(links.unionByName(compared(stored(rest, "near-pairs"))))
    named = nodes.select("high", "low", "node").join(final, "node", "left").select(
        "high", "low", F.coalesce("label", "node").alias("label")
    )
    placed = rows.select("doc_id", "key", "high", "low", "at").join(named, ["high", "low"])
    classes = placed.groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), "at")).alias("keeper"),
        F.count(F.lit(1)).alias("class_size"),
    )
    return placed.join(classes, "label").select(
        "doc_id",
        "key",
        F.col("keeper.id").alias("class_id"),
        "class_size",
        (F.col("at") == F.col("keeper.at")).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each class stays, with all its columns."""
    kept = near_duplicates(docs, doc_id=doc_id, text=text, **options).filter("kept").select("key")
    names = docs.columns
    keyed = docs.select(
        F.struct(*[docs[c] for c in names]).alias("row"), row_key(docs[doc_id], docs[text]).alias("key")
    )
    rows = keyed.join(kept, "key").dropDuplicates(["key"])
    return rows.select(*[F.col("row")[c].alias(c) for c in names])
