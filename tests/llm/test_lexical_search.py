"""Ranked lexical search against a brute-force ranking of every document."""

import math
import random
from collections import Counter

from rivermark.llm.lexical_search import search, terms_of


def brute(docs, items, k=10):
    terms = [(d, terms_of(t)) for d, t in docs]
    n_docs = sum(1 for _, t in terms if t)
    total = sum(len(t) for _, t in terms)
    df = Counter(w for _, t in terms for w in set(t))
    out = []
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms_of(t))
    for item, words in asked.items():
        scored = []
        for d, t in terms:
            c, m = Counter(t), 10 + (90 * len(t) * n_docs) // max(total, 1)
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
                for w in words
                if c[w]
            )
            if s > 0:
                scored.append((-s, d is None, d or 0, d, s))
        for rank, (*_, d, s) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, d, s))
    return sorted(out, key=str)


def test_equals_brute_force_with_ties_nulls_and_repeats(spark):
    random.seed(5)
    vocab = [f"w{k}" for k in range(40)] + ["Ünï", "x9", "The", "THE"]
    docs = [(k, " ".join(random.choices(vocab, k=random.randint(0, 30)))) for k in range(300)]
    docs += [(300, None), (301, ""), (302, docs[7][1]), (302, docs[7][1]), (None, docs[9][1])]
    docs += [(303, " ".join(["w1"] * 50_000 + ["w2"]))]
    items = [(1, "w1 w2 the"), (2, "ünï x9 w3"), (2, "w4"), (3, ""), (None, "w5"), (4, "zzz")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("rank", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("x"))
    i = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((tuple(r) for r in search(d, i).collect()), key=str)
    assert got == brute(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert search(docs, items).collect() == []
    assert search(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), items.limit(0)).collect() == []


def test_small_signature_blocks_keep_the_ranking_exact(spark):
    random.seed(8)
    vocab = [f"w{k}" for k in range(12)]
    docs = [(k, " ".join(random.choices(vocab, k=random.randint(0, 12)))) for k in range(120)]
    docs += [(120, docs[3][1]), (None, docs[3][1])]
    items = [(1, "w1 w2"), (2, "w3 w4 w5"), (3, "w0")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(1)
    i = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((tuple(r) for r in search(d, i, block=7).collect()), key=str)
    assert got == brute(docs, items)
