"""The registered queries against their SQL or brute force, on the smallest tables."""

import collections
import html
import math
import re
import zlib
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from rivermark.llm import queries

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="base tables are not there")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.fixture(scope="module")
def result(spark):
    known = {}

    def rows(name):
        if name not in known:
            known[name] = queries.QUERIES[name](spark, str(DATA)).collect()
        return known[name]

    return rows


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(result, duck, name):
    said = duck.execute(queries.ORACLES[name])
    names = [c[0] for c in said.description]
    want = sorted((tuple(map(plain, r)) for r in said.fetchall()), key=str)
    assert sorted((tuple(plain(r[c]) for c in names) for r in result(name)), key=str) == want


@pytest.mark.parametrize(("name", "label", "of", "held"), [("op1_quality", "quality", 3, 1), ("op2_toxicity", "toxic", 5, 0)])
def test_classifiers_on_held_out_labels(result, duck, name, label, of, held):
    rows = {r.doc_id: r for r in result(name)}
    assert len(rows) == duck.execute("SELECT count(*) FROM documents").fetchone()[0]
    for doc_id, row in rows.items():
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % of == held)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
    labels = duck.execute(f"SELECT doc_id, {label} FROM labels").fetchall()
    judged = [rows[d].predicted == y for d, y in labels if rows[d].held_out]
    assert sum(judged) >= 0.9 * len(judged)


def test_html_text_is_the_article(result, duck):
    pages = dict(duck.execute("SELECT page_id, html FROM pages").fetchall())
    for row in result("op3_html_text"):
        article = re.search(r"<article>(.*?)</article>", pages[row.page_id], re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert row.text == "\n\n".join(b for b in blocks if b)
        assert row.n_chars == len(row.text)


def test_lm_base_score_and_gain(result, duck):
    tokens = {
        d: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [" "]
        for d, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()
    }
    counts = collections.Counter(
        w for d, ws in tokens.items() if zlib.crc32(str(d).encode()) % 5 != 1 for w in ws
    )
    n = sum(counts.values())
    norm = n + 0.5 * (len(counts) + 1)
    held = [0.0, 0.0]
    for row in result("op5_lm_scores"):
        words = tokens[row.doc_id]
        assert row.n_tokens == len(words) and row.train_tokens == n
        assert row.n_known == sum(counts[w] > 0 for w in words)
        assert row.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / norm) for w in words))
        if row.held_out:
            held = [held[0] + row.base_score, held[1] + row.score]
    assert held[1] > held[0]


def shingle_set(text):
    words = (text or "").translate(LOWER).split()
    return frozenset(zip(*(words[k:] for k in range(5)), strict=False)) or frozenset([tuple(words)])


def test_near_duplicates_are_the_brute_force_classes(result, duck):
    sets = {d: shingle_set(t) for d, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()}
    label = {d: d for d in sets}

    def top(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                label[y] = x
    for row in result("op8_near_dedup"):
        assert row.class_id == top(row.doc_id)
        assert row.kept == (row.class_id == row.doc_id)


def test_urls(result, duck):
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    urls = dict(duck.execute("SELECT page_id, url FROM pages").fetchall())
    for row in result("op10_url_filter"):
        rest = urls[row.page_id].partition("://")[2]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(LOWER)
        fits = [
            r for r in rules
            if f".{host}".endswith("." + r.split("/")[0]) and path.startswith("/" + r.split("/", 1)[1])
        ]
        best = max(fits, key=len, default=None)
        assert (row.host, row.path, row.rule) == (host, path, best)
        assert row.verdict == (rules[best] if best else "block" if row.score >= 0.5 else "allow")


def test_pipeline_stages(spark, duck):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    labels = {d: q for d, q in duck.execute("SELECT doc_id, quality FROM labels").fetchall()}
    items = duck.execute("SELECT text FROM benchmark").fetchall()

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))

    windows = {tuple(w[k : k + 10]) for (t,) in items if (w := words(t)) for k in range(max(1, len(w) - 9))}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, str(DATA)), "test-stage")
        after = {r.doc_id: r.text for r in docs.collect()}
        gone = {d: t for d, t in before.items() if d not in after}
        if name == "quality":
            assert not [d for d in gone if labels.get(d) == 1] and not [d for d in after if labels.get(d) == 0]
        elif name == "exact_dedup":
            first = {}
            for d in sorted(before):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[d]), d)
            assert set(after) == set(first.values())
        elif name == "near_dedup":
            kept = [shingle_set(t) for t in after.values()]
            for text in gone.values():
                own = shingle_set(text)
                assert any(len(own & k) >= 0.8 * len(own | k) for k in kept)
        elif name == "decontamination":
            def hit(text):
                w = words(text)
                return any(tuple(w[k : k + len(x)]) == x for x in windows for k in range(len(w) - len(x) + 1) if w[k] == x[0])

            assert all(map(hit, gone.values())) and not any(map(hit, after.values()))
        else:
            assert not gone and {"taken", "target", "text"} <= set(docs.columns)
        if name != "mixing":
            assert docs.columns == columns
        before = after
