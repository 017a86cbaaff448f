"""Spelling variants against a brute-force version over all pairs of words."""

import random
import re
import zlib
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from rivermark.llm import queries
from rivermark.llm.spelling_variants import gram_candidates, spelling_variants

DATA = Path("/root/testdata/sf0.001")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 97 == 0:
                    k = h % len(run)
                    run = run[:k] + run[k + 1 :]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def test_equals_brute_force(spark):
    random.seed(3)
    stems = ["colour", "color", "colours", "théâtre", "theatre", "grammar", "grammer", "aaaaa", "aaaab", "baaaa"]
    rows = []
    for k in range(400):
        words = random.choices(stems, weights=[20, 9, 4, 3, 7, 11, 5, 6, 3, 3], k=random.randint(0, 12))
        rows.append((k, " ".join(w.upper() if random.random() < 0.1 else w for w in words)))
    rows += [(None, "colour colour colour"), (5000, None), (5001, ""), (5002, "x" * 20000), (5002, "x" * 20000)]
    rows += [(6000 + k, "x" * 20000 + " colr colr zzzzz") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumnRenamed("doc_id", "doc_id")
    got = sorted(tuple(r) for r in spelling_variants(docs.withColumn("n", docs.doc_id)).collect())
    assert got == brute(rows)


def test_a_shared_gram_elsewhere_is_no_candidate(spark):
    # The gram "qz" is in every word, at another place in each, but in two pairs.
    words = ["abqzcdefgh", "abcqzdefgh", "abcdqzefgh", "abcdeqzfgh", "abqzcdefgx", "abcqzdefghi"]
    rows = [(w, len(w), [("qz", w.index("qz"))]) for w in words]
    listed = spark.createDataFrame(rows, "word string, len int, keys array<struct<grams: string, places: int>>")
    got = {tuple(r) for r in gram_candidates(listed).collect()}
    # The longer word has the gram where "abcqzdefgh" has it, and one place after where the two first have it.
    assert got == {("abqzcdefgh", "abqzcdefgx"), ("abcqzdefgh", "abcqzdefghi"), ("abqzcdefgh", "abcqzdefghi"), ("abqzcdefgx", "abcqzdefghi")}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert spelling_variants(docs).collect() == []


@pytest.mark.skipif(not DATA.exists(), reason="base tables are not there")
def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(DATA / "documents.parquet").to_pylist()]
    got = sorted(tuple(r) for r in queries.op13_spelling_variants(spark, str(DATA)).collect())
    assert got == brute(rows)
