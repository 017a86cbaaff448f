"""Ranked lexical search by bit-sliced Bloom signatures with exact rescoring.

Scoring (integer BM25 form): N documents with at least one term, L all their terms, n the terms
of one document, df the documents holding a term, tf its occurrences in the document. A term of
the query weighs w = floor(1000 * ln((2N + 2) / (2df + 1))); a document has
m = 10 + (90 n N) div L; its score sums w * ((10^9 tf) div (1000 tf + 8 m)) over the distinct
terms of the query.

The method, per block of SIGNATURE_BLOCK documents (inside an Arrow batch in a task):

* every document's distinct terms set K bits of a Bloom signature of SIGNATURE_BITS bits; the
  signatures are stored bit-sliced, one packed bitmap over the block's documents per bit;
* a query term's possible documents are the AND of its K slices (a superset: false positives,
  never false negatives);
* a document's upper bound for a query is bound(d) * sum of w over the query terms it may hold,
  where bound(d) = (10^9 maxtf) div (1000 maxtf + 8 m) is the largest share any term of d can add;
* documents are then rescored exactly in falling order of their bounds until the bound falls
  below the block's tenth best exact score; all others are provably out of the block's top k.

The tasks return each query's top k of their block; one window over those few rows per query
gives the global ranking. Corpus statistics (N, L, df of the query terms) come from Spark
aggregations over all documents beforehand.

Rows: NULL text has no terms; NULL doc_id is ranked after all ids at equal score; repeated rows
are separate documents; an item's terms are the distinct terms of all its rows (NULL item_id is
one item); items without terms, or empty tables, give no rows. Very long texts are scored whole.
Only the id and text columns are read, so other columns never clash.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.barrier import computed
from .common import BROADCAST_BYTES, UPPER, lower_ascii, stored

#: Characters that are not part of a term; fixed values.
NOT_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(UPPER, UPPER.lower())

#: Bits of a document signature and bits set per term.
SIGNATURE_BITS = 2048
PROBES = 3
#: Documents per signature block: bounds a task's memory whatever the Arrow batch size; each
#: block keeps its own top k, so the ranking stays exact.
SIGNATURE_BLOCK = 1024
#: Query terms handed to the tasks in one pass over the documents; larger query sets take
#: several passes, each over all documents.
BLOCK_TERMS = 200_000


def terms_of(text) -> list[str]:
    """Terms of a text: maximal runs of digits, ASCII letters and non-ASCII, A-Z lower-cased."""
    return TERM.findall(text.translate(LOWER)) if text else []


def _positions(term: str) -> np.ndarray:
    h = hash(term) & 0xFFFFFFFFFFFFFFFF
    return np.array([(h >> (21 * k)) % SIGNATURE_BITS for k in range(PROBES)], np.int64)


def _gain(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _block_top(
    ids: list, texts: list, queries: dict, n_docs: int, n_terms: int, k: int, block: int = SIGNATURE_BLOCK
) -> Iterator[tuple]:
    """The top k of every ``block`` documents of a batch for every query: (item_id, doc_id, score) rows."""
    for start in range(0, len(texts), block):
        end = start + block
        yield from _signature_top(ids[start:end], texts[start:end], queries, n_docs, n_terms, k)


def _signature_top(
    ids: list, texts: list, queries: dict, n_docs: int, n_terms: int, k: int
) -> Iterator[tuple]:
    """The top k of one signature block for every query."""
    counts = [Counter(terms_of(t)) for t in texts]
    size = len(counts)
    n = np.fromiter((sum(c.values()) for c in counts), np.int64, size)
    most = np.fromiter((max(c.values(), default=0) for c in counts), np.int64, size)
    m = 10 + (90 * n * n_docs) // max(n_terms, 1)
    bound = _gain(most, m)
    # Bit slices: one packed bitmap over the block's documents per signature bit. Term
    # positions are computed once per distinct term; (document, term) pairs are index arrays.
    vocabulary: dict[str, int] = {}
    places = np.fromiter((vocabulary.setdefault(t, len(vocabulary)) for c in counts for t in c), np.int64)
    owners = np.repeat(np.arange(size, dtype=np.int64), [len(c) for c in counts])
    plain = np.zeros((SIGNATURE_BITS, size), bool)
    if vocabulary:
        positions = np.stack([_positions(t) for t in vocabulary])
        plain[positions[places].ravel(), np.repeat(owners, PROBES)] = True
    slices = np.packbits(plain, axis=1)
    del plain, vocabulary, places, owners
    order_key = [(i is None, i if i is not None else 0) for i in ids]
    possible: dict[str, np.ndarray] = {}
    for item, weights in queries.items():
        total = np.zeros(size, np.int64)
        for term, w in weights.items():
            if term not in possible:
                p = _positions(term)
                bits = np.bitwise_and.reduce(slices[p], axis=0)
                possible[term] = np.unpackbits(bits, count=size).astype(bool)
            if w:
                total += w * possible[term]
        upper = total * bound
        candidates = np.flatnonzero(upper > 0)
        if not len(candidates):
            continue
        candidates = candidates[np.argsort(-upper[candidates], kind="stable")]
        best: list[tuple] = []  # heap of (score, reversed order) for the block's top k
        for d in candidates:
            if len(best) == k and upper[d] < best[0][0]:
                break
            c = counts[d]
            score = sum(w * _gain(c[t], int(m[d])) for t, w in weights.items() if t in c)
            if score <= 0:
                continue
            entry = (score, _Reverse(order_key[d]), d)
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry[:2] > best[0][:2]:
                heapq.heapreplace(best, entry)
        for score, _, d in best:
            yield item, ids[d], int(score)


class _Reverse:
    """Order key in reverse, so that the heap's smallest is the lowest score, then largest id."""

    __slots__ = ("key",)

    def __init__(self, key):
        self.key = key

    def __lt__(self, other):
        return self.key > other.key

    def __gt__(self, other):
        return self.key < other.key

    def __eq__(self, other):
        return self.key == other.key


def _terms(text_col: str):
    return F.array_remove(F.split(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), NOT_TERM), "")


def query_weights(docs: DataFrame, items: DataFrame, *, id_col: str = "item_id", text: str = "text") -> tuple[DataFrame, int, int]:
    """(item_id, term, w) for the distinct terms of each item, with N and L of the documents.

    Where the query vocabulary is small enough to broadcast, N, L and every df come from one
    pass over the documents: each document adds a row without a term that carries its size.
    Else N and L take a pass of their own and df a shuffle of all postings.
    """
    wanted = items.select(F.col(id_col).alias("item_id"), F.explode(_terms(text)).alias("term")).distinct()
    vocabulary = wanted.select("term").distinct()
    size = vocabulary.agg(F.sum(F.length("term") + 48)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        split = computed(docs.select(F.col(text).alias("_text")), [], terms=_terms("_text"))
        marks = split.select(
            F.size("terms").cast("bigint").alias("n"),
            F.explode(F.concat(F.array(F.lit(None).cast("string")), F.array_distinct("terms"))).alias("term"),
        )
        asked = F.broadcast(vocabulary.withColumn("_asked", F.lit(True)))
        counted = (
            marks.join(asked, "term", "left")
            .where(F.col("term").isNull() | F.col("_asked"))
            .groupBy("term")
            .agg(
                F.count(F.lit(1)).alias("df"),
                F.count(F.when(F.col("n") > 0, 1)).alias("N"),
                F.sum("n").alias("L"),
            )
        )
        counted = stored(counted, "lexical-df")
        totals = counted.where(F.col("term").isNull()).first()
        df = counted.where(F.col("term").isNotNull()).select("term", "df")
    else:
        sized = docs.select(F.size(_terms(text)).cast("bigint").alias("n"))
        totals = sized.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.sum("n").alias("L")).first()
        held = docs.select(F.explode(F.array_distinct(_terms(text))).alias("term"))
        df = held.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n_docs = int(totals["N"] or 0) if totals else 0
    n_terms = int(totals["L"] or 0) if totals else 0
    weight = F.floor(F.lit(1000.0) * F.log((2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("bigint")
    weights = wanted.join(df, "term").select("item_id", "term", weight.alias("w"))
    return stored(weights, "lexical-weights"), n_docs, n_terms


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 10,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    block: int = SIGNATURE_BLOCK,
) -> DataFrame:
    """The k highest-scoring documents (score above 0) of every item: item_id, rank, doc_id, score.

    Equal scores are ranked by ascending doc_id. The items are a stated query set; they reach the
    tasks in blocks of BLOCK_TERMS query terms, each block one pass over all documents.
    """
    spark = docs.sparkSession
    body = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    weights, n_docs, n_terms = query_weights(body, asked)
    kind = asked.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, doc_id bigint, score bigint"
    # Blocks of whole items, by a running count of their terms.
    per_item = weights.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    ordered = per_item.withColumn("upto", F.sum("n").over(Window.orderBy(F.col("item_id").asc_nulls_first())))
    blocks = ordered.select("item_id", (F.floor((F.col("upto") - 1) / BLOCK_TERMS)).cast("bigint").alias("block"))
    found = None
    for (item_block,) in blocks.select("block").distinct().orderBy("block").collect():
        part_ids = blocks.where(F.col("block") == item_block).select(F.col("item_id").alias("_id"))
        chosen = weights.join(part_ids, weights["item_id"].eqNullSafe(part_ids["_id"]), "left_semi")
        queries: dict = {}
        for row in chosen.toLocalIterator():
            queries.setdefault(row["item_id"], {})[row["term"]] = int(row["w"])

        def ranked(batches: Iterator[pd.DataFrame], queries=queries) -> Iterator[pd.DataFrame]:
            for batch in batches:
                ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
                out = list(_block_top(ids, batch["text"].tolist(), queries, n_docs, n_terms, k, block))
                yield pd.DataFrame(out, columns=["item_id", "doc_id", "score"]).astype({"score": "int64"})

        part = body.mapInPandas(ranked, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("item_id", F.col("rank").cast("int"), "doc_id", "score")
    )
