"""Token counts by prefix sums against the library encoding whole texts."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rivermark.llm import queries
from rivermark.llm.token_counts import _tokenizer, resolve, token_counts, truncate

DATA = Path("/root/testdata/sf0.001")
ODD = [
    None,
    "",
    "   \n\t ",
    "a<|endoftext|>b  <|startoftext|>",
    "Straße ΣΑΣ x y",
    "don't (it's) 'tis x.'s a\x1cb c\xa0d <x>y, 　z",
    "wORd,, ((Hello)) a--b <|endoftext|>. 12,345.6",
    "é́ ́e",
    " ".join(f"w{k % 977}x" for k in range(60_000)),
    "y" * 50_000,
]


def whole(texts, name="word_bpe_49k.json"):
    tokenizer = _tokenizer(resolve(name))
    return [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_counts_equal_whole_encoding(spark):
    rows = [(k, t, "x") for k, t in enumerate(ODD)] + [(len(ODD), ODD[3], "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    got = token_counts(docs, budgets=(5, 2048), prefixes=True).orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == whole([r[1] for r in rows])
    assert got[0].n_bytes == 0 and got[0].prefix_tokens == [] and got[0].fit_5 == 0
    assert got[-1].n_tokens == got[-2].n_tokens
    assert docs.columns[:2] == token_counts(docs).columns[:2]


def test_prefix_counts_are_exact_and_truncation_fits(spark):
    texts = ["The quick (brown) fox's tail, jumps! over 12 lazy dogs.", ODD[5], ODD[6]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = token_counts(docs, budgets=(7,), prefixes=True).withColumn(
        "cut", truncate(F.col("text"), F.col("prefix_ends"), F.col("prefix_tokens"), 7)
    ).orderBy("doc_id").collect()
    for row in got:
        prefixes = [row.text[:end] for end in row.prefix_ends]
        assert row.prefix_tokens == whole(prefixes)
        assert len(row.cut) == row.fit_7 and whole([row.cut])[0] <= 7


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_counts(docs).collect() == []


@pytest.mark.skipif(not DATA.exists(), reason="base tables are not there")
def test_query_against_whole_encoding(spark):
    table = pq.read_table(DATA / "documents.parquet", columns=["doc_id", "text"]).to_pylist()
    expected = dict(zip([r["doc_id"] for r in table], whole([r["text"] for r in table])))
    got = queries.op11_token_counts(spark, str(DATA)).collect()
    assert len(got) == len(table)
    for row in got:
        assert row.n_tokens == expected[row.doc_id]
        assert row.over_limit == (row.n_tokens > 2048)
