"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import random
import textwrap
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rivermark.llm import darts, html_text, license_scan, lm, quality, textbytes, toxicity
from rivermark.llm.components import connected_components
from rivermark.llm.decontaminate import contamination, decontaminate
from rivermark.llm.exact_dedup import exact_duplicates, without_exact_duplicates
from rivermark.llm.html_text import extract_text, main_text
from rivermark.llm.license_scan import scan_licenses
from rivermark.llm.lm import score_texts
from rivermark.llm.mixing import mix, source_targets
from rivermark.llm.near_dedup import near_duplicates, without_near_duplicates
from rivermark.llm.quality import quality_model, with_quality
from rivermark.llm.toxicity import toxicity_model, with_toxicity
from rivermark.llm.url_filter import judge_urls

LONG = " ".join(f"w{k % 977}" for k in range(200_000))
NAMES = "key digest node label size score row words h n"
DOCS = "doc_id bigint, text string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    """Odd rows, with columns named like those the operators use inside."""
    rows = [
        (1, "one two three four five six seven", "a"), (2, "one  two\tthree four five six seven", "a"),
        (2, "one  two\tthree four five six seven", "a"), (None, None, None), (None, "", "b"), (3, "", "b"),
        (4, LONG, "a"), (5, "Ünïcode Wörter", None), (6, "short", "c"), (7, "   ", "c"),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    return frame.withColumns({c: F.lit("x") for c in NAMES.split()})


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (1, 0, 0), (3, None, 1), (None, 1, 1), (4, 1, 0), (6, 0, 1), (99, 1, 1)],
        "doc_id bigint, quality int, toxic int",
    )


def test_quality(docs, none, labels):
    model = quality_model(docs, labels, usable=F.lit(True))
    rows = with_quality(docs, model, name="p").collect()
    assert len(rows) == 10 and all(0 <= r.p <= 1 for r in rows)
    assert len({r.p for r in rows if not r.text}) == 1
    assert with_quality(none, model, name="p").count() == 0
    assert quality_model(docs, labels.limit(0), usable=F.lit(True)).scores(pa.array(["x"]))[0] == 0.5
    only = quality_model(docs, labels.filter("quality = 1"), usable=F.lit(True))
    assert only.scores(pa.array(["x", None])).min() > 0.5


def test_quality_is_not_learnt_on_the_driver(docs, labels, monkeypatch):
    want = quality_model(docs, labels, usable=F.lit(True))
    monkeypatch.setattr(quality, "train", lambda *a, **k: pytest.fail("trained on the driver"))
    got = quality_model(docs, labels, usable=F.lit(True))
    assert got.intercept == want.intercept and (got.weights == want.weights).all() and len(got.weights) == quality.BUCKETS


def test_quality_learns_and_ignores_slices():
    rng = random.Random(1)
    good = [" ".join(rng.choices(["river", "stone", "meadow", "cloud"], k=30)) for _ in range(40)]
    bad = [" ".join(w + "%%%" for w in rng.choices(["river", "stone", "meadow", "cloud"], k=30)) for _ in range(40)]
    model = quality.train(good[:30] + bad[:30], [1] * 30 + [0] * 30)
    scores = model.scores(pa.array(good[30:] + bad[30:]))
    assert (scores[:10] > 0.5).all() and (scores[10:] < 0.5).all()
    alone = [model.scores(pa.array([t]))[0] for t in good[:5]]
    assert np.allclose(alone, model.scores(pa.array(good[:5])))


def test_slices_cut_long_texts_at_blanks():
    texts = pa.array(["ab cd", None, "x" * 30 + " yy zz " + "w" * 50, ""])
    parts = list(textbytes.slices(texts, 10))
    assert b"".join(d.tobytes() for _, _, d in parts) == "".join(t.as_py() or "" for t in texts).encode()
    for _, starts, data in parts:
        opens, ends = textbytes.word_bounds(data, starts)
        assert {data[a:b].tobytes() for a, b in zip(opens, ends, strict=True)} <= {b"ab", b"cd", b"x" * 30, b"yy", b"zz", b"w" * 50}


def test_toxicity(docs, none, labels):
    lexicon = toxicity_model(docs, labels, usable=F.lit(True))
    rows = with_toxicity(docs, lexicon, name="p").collect()
    assert len(rows) == 10 and all(0 <= r.p < 0.5 for r in rows)
    assert with_toxicity(none, lexicon, name="p").count() == 0


@pytest.mark.parametrize("text", ["you m0r0n", "yоu are an idiоt", "what a $tupid thing", "IDIOT!", "such a l​oser"])
def test_folded_words_are_found(text):
    assert toxicity.train([], []).scores(pa.array([text]))[0] > 0.5


@pytest.mark.parametrize(
    "text", ["a$$hole", "what a dumba$$", "dumba$$, really", "scum$", "IDIOT!!you", "you \u039cORO\u039d", "S\u0397IT\u0397EAD w\u0397ORE"]
)
def test_doubled_and_final_signs_and_greek_capitals_are_found(text):
    assert toxicity.train([], []).scores(pa.array([text]))[0] > 0.5
    assert toxicity.train([], []).density("what trash can$ hold!") == 0


@pytest.mark.parametrize("text", ["put it in the trash can", "idiomatic prose", "", None, "100 $ or 1!"])
def test_clean_texts_and_exceptions_are_not(text):
    assert toxicity.train([], []).scores(pa.array([text]))[0] < 0.5


def test_lexicon_learns_stems_but_not_from_copies():
    rng = random.Random(2)
    common = [f"{a}{b}" for a in ("al", "be", "ga", "de", "om", "si") for b in ("pha", "ta", "mma", "lta", "ega", "gma", "ra")]
    clean = [" ".join(rng.choices(common, k=40)) for _ in range(80)]
    toxic = [" ".join(rng.choices(common, k=30) + [f"zorb{rng.choice('aeiou')}k"] + rng.choices(common, k=9)) for _ in range(30)]
    copy = "omega rareword " + toxic[0]
    lexicon = toxicity.train(toxic + [copy] * 50 + clean, [1] * 80 + [0] * 80)
    assert any(text.startswith("zorb") for text, _ in lexicon.weights)
    assert not any(text.startswith("rare") for text, _ in lexicon.weights)


PAGE = (
    "<html><head><title>T</title></head><body><nav><a href='/'>Home</a></nav><div class='cookie-notice'>We use cookies</div>"
    "<article><h1>A &amp; B</h1><p>One<br>two <b>three<p>Four&nbsp;five<script>var a='</p>';</script></article>"
    "<section class='comments'><p>First!</p></section><footer>End</footer></body></html>"
)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (PAGE, "A & B\n\nOne two three\n\nFour five"), (None, ""), ("", ""), ("plain  text", "plain text"),
        ("<p>a<p>b", "a\n\nb"), ("<div>x<!-- y --><style>z{}</style></div><aside>q</aside>", "x"), ("<p>cut <a hre", "cut"),
        ("<ul><li>a<li>b</ul>1 < 2", "a\n\nb\n\n1 < 2"), ("<p>" * 5000 + "deep", "deep"),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article class='post has-sidebar'><p>x</p></article>", "x"), ("<main class='no-sidebar'><p>x</p></main>", "x"),
        ("<div id=page class=with-banner><article><p>x</p></article></div>", "x"),
        ("<div class='entry comments-open'><p>x</p></div>", "x"), ("<main class=sidebar><p>x</p></main>", "x"),
        ("<div class=banner><article><p>x</p></article></div>", "x"),
        ("<article class=comment><p>x</p></article>", "x"), ("<div class='site-footer x'>y</div><p>x</p>", "x"),
        ("<article><p>x</p></article><div class=comments><article class=comment>y</article></div>", "x"),
    ],
)
def test_role_words_keep_articles(page, text):
    assert main_text(page) == text


def test_site_tree_removes_what_all_pages_share(spark):
    pages = [
        (k, f"http://h.example/{k}", f"<body><div class=box>Same on all</div><div><p>Text {k} of its own</p></div></body>")
        for k in range(20)
    ]
    pages += [(90, None, None), (91, "nohost", "<p>x</p>"), (91, "nohost", "<p>x</p>")]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("host", F.lit("?"))
    for size in (html_text.BROADCAST_BYTES, -1):
        rows = [(r.page_id, r.text) for r in extract_text(frame, broadcast_bytes=size).collect()]
        assert sorted(rows) == [(k, f"Text {k} of its own") for k in range(20)] + [(90, ""), (91, "x"), (91, "x")]
    assert extract_text(frame.limit(0)).count() == 0


def test_site_tree_decides_inside_articles(spark):
    box = "<div class=box>Same on all</div>"
    bodies = {
        "box": lambda k: f"<article><h1>T{k}</h1>{box}<div><p>Text {k} of its own</p></div><ul><li><a href=x>Ref {k}</a></ul></article>",
        "several": lambda k: f"<main class='w-1/2'><article class=a>{box}</article><article class=b><p>Own {k}</p></article></main>",
        "teaser": lambda k: f"<article><p>Read this</p></article><div class=story><p>A long story, number {k}</p></div>",
        "copies": lambda k: f"<div>{k}</div><article><h1>H</h1><p>{'One text' if k else 'Another text'}</p></article>",
    }
    pages = [(k, f"http://{h}.example/{k}", body(k)) for h, body in bodies.items() for k in range(20)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {(r.url[7:].split(".")[0], r.page_id): r.text for r in extract_text(frame).collect()}
    for k in range(20):
        assert got["box", k] == f"T{k}\n\nText {k} of its own\n\nRef {k}"
        assert got["several", k] == f"Own {k}"
        assert got["teaser", k] == f"A long story, number {k}"
        assert got["copies", k].endswith("One text" if k else "Another text")


def test_mix(docs, none):
    rows = mix(docs, keep=["text"]).collect()
    assert len(rows) == 10
    taken, target = {}, {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source_size, r.target] = taken.get((r.source_size, r.target), 0) + r.taken
        target[r.source_size, r.target] = r.target
    assert all(abs(taken[k] - target[k]) < 2 for k in taken)
    assert [r.size for r in rows if r.doc_id is None] == [0, 0]
    assert mix(none).count() == 0
    assert sorted(map(str, mix(docs).collect())) == sorted(map(str, mix(docs.repartition(3)).collect()))


def test_targets_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 100), (None, 0)], "source string, source_size bigint")
    got = {r.source: r.target for r in source_targets(sizes, weights=(3, 1, 2), share=1.5, most=2).collect()}
    assert got["a"] == 20 and got[None] == 0
    assert got["b"] == pytest.approx(295 / 3) and got["c"] == pytest.approx(590 / 3)


def test_lm(docs, none):
    rows = score_texts(docs, training=F.col("doc_id") != 4, frequent=3).collect()
    assert len(rows) == 10 and all(r.score <= 0 and r.base_score <= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (None, 3, 7)} == {1}
    assert [r.n_tokens for r in rows if r.doc_id == 4] == [200_001]
    assert score_texts(none, training=F.lit(True)).count() == 0
    untrained = score_texts(docs, training=F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens) for r in untrained} == {(0, 0)}


def test_filter_gives_counts_back():
    rng = np.random.default_rng(3)
    hashes = np.unique(rng.integers(0, 1 << 48, 4000, dtype=np.uint64))
    counts = rng.geometric(0.2, len(hashes))
    bits, number, total = lm.fill_segment(hashes, counts)
    values = np.where(number > 0, total / np.maximum(number, 1), 0)
    model = lm.Model(np.frombuffer(bits, np.uint8), 1, values, 10, 5, 2)
    assert np.median(np.abs(model.counts(hashes) / counts - 1)) < 0.25
    assert (model.counts(rng.integers(0, 1 << 48, 2000, dtype=np.uint64)) > 0).mean() < 0.05


def test_full_segment_leaves_out_the_rarest():
    hashes = np.arange(300_000, dtype=np.uint64)
    counts = np.where(hashes < 1000, 50, 1)
    _, number, _ = lm.fill_segment(hashes, counts)
    assert number.sum() == 1000


def test_what_a_full_segment_leaves_out_is_passed_on():
    hashes = np.sort(np.random.default_rng(5).choice(1 << 40, 1_200_000, replace=False)).astype(np.int64)
    counts = np.where(np.arange(len(hashes)) % 100 == 0, 50, 1 + np.arange(len(hashes)) % 5)
    batches = [pa.RecordBatch.from_arrays([pa.array(hashes[k : k + 10_000]), pa.array(counts[k : k + 10_000])], ["h", "n"]) for k in range(0, len(hashes), 10_000)]
    rows = pa.Table.from_batches(lm._segment_filler(1)(batches)).to_pylist()
    rest = sorted((r["h"], r["n"]) for r in rows if r["h"] is not None)
    (segment,) = (r for r in rows if r["segment"] is not None)
    assert len(rest) + sum(segment["number"]) == len(hashes)
    values = np.array([t / n if n else 0 for n, t in zip(segment["number"], segment["total"])])
    model = lm.Model(np.frombuffer(segment["bits"], np.uint8), 1, values, 10, 5, 2, least=np.array([segment["least"]]))
    found = model.counts(hashes.astype(np.uint64), (np.array([h for h, _ in rest], np.uint64), np.array([n for _, n in rest], float)))
    assert (np.abs(found / counts - 1) > 0.25).mean() < 0.001 and model.full


def test_lm_with_a_full_filter_knows_every_count(spark):
    long = [f"w{k}" for k in range(40_000)]
    rows = [(0, long), (1, long[:20_000]), (2, ["w1", "w2", "w3", "x"]), (3, ["w5", "w4"]), (3, ["w5", "w4"]), (None, ["w7", "w8", "w9"]), (4, [])]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id bigint, text string")
    got = score_texts(docs, training=F.coalesce("doc_id", F.lit(9)) < 2, segments=1).collect()
    got = sorted((r.n_tokens, r.doc_id or 0, r.score) for r in got)
    one, two = Counter({"^": 2}), Counter()
    for _, words in rows[:2]:
        one.update([*words, "$"])
        two.update(zip(["^", *words], [*words, "$"]))
    norm = 60_002 + 0.5 * (40_001 + 1)

    def scores(m):
        for k, words in rows:
            pairs = zip(["^", *words], [*words, "$"])
            value = sum(np.log10((two[v, w] + m * (one[w] + 0.5) / norm) / (one[v] + m)) for v, w in pairs)
            yield len(words) + 1, k or 0, value

    want = [sorted(scores(m)) for m in lm.SMOOTHING]
    assert any([w[:2] for w in ws] == [g[:2] for g in got] and [w[2] for w in ws] == pytest.approx([g[2] for g in got]) for ws in want)


def test_blocks_send_ngrams_packed_and_get_their_counts():
    rng = np.random.default_rng(11)
    words = [[f"w{k}" for k in rng.integers(0, 50_000, 40_000)] for _ in range(4)]
    training = [True, False, True, True]
    blocks, ngrams = [], []
    for a in (0, 2):
        texts, learnt = pa.array([" ".join(w) for w in words[a : a + 2]]), pa.array(training[a : a + 2])
        ngrams.append(lm._ngrams(texts, learnt.to_numpy(zero_copy_only=False)))
        blocks.append(lm._packed_rows([pa.RecordBatch.from_arrays([texts, learnt], ["text", "training"])]))
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8], pa.int64()), pa.array(blocks, pa.binary())], ["block", "data"])
    sent = pa.Table.from_batches(lm._sender(5)([batch])).sort_by("bucket").combine_chunks()
    size = sum(len(x) for name in ("hashes", "counts") for x in sent[name].to_pylist())
    assert size < 5 * sum(len(h) for h, _ in ngrams)
    sample = ngrams[0][0][:100]
    rows = pa.Table.from_batches(lm._bucket_filler(2, 5, sample)(sent.to_batches(max_chunksize=3))).to_pylist()
    total = Counter()
    for hashes, counts in ngrams:
        total.update(dict(zip(hashes.tolist(), counts.tolist())))
    for block, (hashes, _) in zip((7, 8), ngrams):
        assert lm._answered([r for r in rows if r["block"] == block]).tolist() == [total[h] for h in hashes.tolist()]
    held = sum(sum(r["number"]) for r in rows if r["segment"] is not None)
    left = [r["h"] for r in rows if r["h"] is not None]
    assert sum(r["segment"] is not None for r in rows) == 2 and 0 < held < sum(n > 0 for n in total.values())
    assert set(left) <= set(sample.tolist()) and all(r["n"] == total[r["h"]] for r in rows if r["h"] is not None)


def test_contamination(spark, docs, none):
    items = spark.createDataFrame(
        [(1, "Two three FOUR"), (2, None), (3, ""), (None, "short"), (2, "two, three; four"), (4, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11")],
        "item_id bigint, text string",
    )
    results = []
    for size in (1 << 26, -1):
        rows = contamination(docs, items, broadcast_bytes=size).collect()
        assert len(rows) == 10
        found = {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in rows}
        assert (2, 7, 3, ("1", "2"), True) in found and (3, 0, 0, (), False) in found and (6, 1, 1, (), True) in found
        results.append(found)
    assert results[0] == results[1]
    assert contamination(docs, items.limit(0)).filter("contaminated").count() == 0
    assert contamination(none, items).count() == 0
    clean = decontaminate(docs, items)
    assert clean.columns == docs.columns and clean.count() == 5


@pytest.mark.parametrize("short", [False, True])
def test_exact_duplicates(docs, none, short):
    digest = F.lit("d") if short else None  # all digests collide: only bytes tell
    rows = exact_duplicates(docs, digest=digest).collect()
    assert len(rows) == 10 and sum(r.kept for r in rows) == 6
    assert [(r.keep_id, r.group_size) for r in rows if r.doc_id == 2] == [(1, 3), (1, 3)]
    assert {(r.keep_id, r.group_size) for r in rows if r.doc_id in (None, 3)} == {(3, 3)}
    assert exact_duplicates(none).count() == 0


def test_exact_stage_in_small_batches(docs):
    kept = without_exact_duplicates(docs.repartition(5), files_per_batch=1)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 6, 7]


def test_url_filter(spark):
    rows = [(1, None), (1, None), (2, "nothing"), (3, "HTTP://A.Net/x"), (4, "http://net"), (5, "ftp://q.example.net/en/?a=1"), (6, "http://o.org/fr/1"), (7, "http://z.com/" + "a" * 9000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("label", F.lit("x"))
    got = {r.page_id: r for r in judge_urls(pages).collect()}
    assert (got[1].host, got[1].path, got[1].rule) == ("", "", None)
    assert (got[3].host, got[3].rule, got[3].verdict) == ("a.net", "net/", "block")
    assert (got[4].rule, got[5].rule, got[6].rule) == (None, "example.net/en/", "org/fr/")
    assert judge_urls(pages).count() == 8 and judge_urls(pages.limit(0)).count() == 0
    given = spark.createDataFrame([("http://bad.biz/9?a=1&b=2", 1), ("http://good.edu/a", 0), (None, None)] * 20, "url string, label int")
    new = spark.createDataFrame([(1, "http://bad.biz/8?a=1&b=2"), (2, "http://good.edu/b")], "page_id bigint, url string")
    assert {r.page_id: r.verdict for r in judge_urls(new, labelled=given).collect()} == {1: "block", 2: "allow"}


def test_near_duplicates(spark, docs, none):
    rows = near_duplicates(docs).collect()
    assert len(rows) == 10 and sum(r.kept for r in rows) == 5
    assert {r.class_id for r in rows if r.doc_id in (1, 2)} == {1}
    assert near_duplicates(none).count() == 0
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == 5


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
    return words


@pytest.mark.parametrize("weighted", [False, True])
def test_near_classes_of_a_large_group(spark, weighted):
    """One text with many edits of it, some too far from it but near to each other."""
    rng = random.Random(5)
    base = [f"b{k}" for k in range(150)]
    texts = [base] + [edited(rng, base, rng.randrange(1, 7)) for _ in range(60)]
    far = edited(rng, base, 9)[:144]
    texts += [far, edited(rng, far, 1), edited(rng, far, 2)] + [[f"o{j}_{k}" for k in range(50)] for j in range(5)]
    rows = list(enumerate(" ".join(w) for w in texts))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in texts]
    label = list(range(len(sets)))
    changed = True
    while changed:
        changed = False
        for i in range(len(sets)):
            for j in range(i):
                if label[i] != label[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                    low, high = sorted((label[i], label[j]))
                    label = [low if x == high else x for x in label]
                    changed = True
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in near_duplicates(frame, weighted=weighted).collect()}
    assert [got[k] for k in range(len(sets))] == label


def test_signatures_agree_as_weighted_jaccard():
    rng = np.random.default_rng(4)
    element = rng.integers(0, 1 << 44, 400).astype(np.uint64)
    left, right = rng.integers(0, 4, 400) + 0.5, rng.integers(0, 4, 400) + 0.5
    doc = np.repeat([0, 1], 400)
    names = darts.signatures(doc, np.tile(element, 2), np.concatenate([left, right]), 2)
    true = np.minimum(left, right).sum() / np.maximum(left, right).sum()
    assert abs((names[0] == names[1]).mean() - true) < 0.12
    assert (darts.signatures(doc[:1] * 0, element[:1], left[:1], 2)[1] == 0).all()


def test_components(spark):
    rng = random.Random(6)
    links = [(k, k + 1) for k in range(30)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7), (200, 201)] * 2
    rng.shuffle(links)
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(1, 31)} | {100 + k: 100 for k in range(1, 40)} | {201: 200}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_licenses(spark, docs, none):
    texts = [
        "LICENSED under the apache licence,\n version 2.0", "prose\n  Released under the MIT   Licence!  \nmore",
        "Copyright (c) 2020 Somebody\n\nReleased under the MIT License.", "mentions the MIT License. Released under", None, "",
        "Licensed under CC BY-NC 4.0\nThis work is licensed under the GNU General Public License, version 3.",
        f"{'word ' * 50000}\n\nLicensed under the Apache License,\nVersion 2.0.\n\nend",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)) + [(1, texts[1])], "doc_id bigint, text string").withColumn("unit", F.lit(1))
    for size in (1 << 26, -1):
        got = sorted((r.doc_id, tuple(r.licenses), r.whole) for r in scan_licenses(frame, broadcast_bytes=size).collect())
        assert got == [
            (0, ("Apache-2.0",), True), (1, ("MIT",), False), (1, ("MIT",), False), (2, ("MIT",), True), (3, (), False),
            (4, (), False), (5, (), False), (6, ("CC-BY-NC-4.0", "GPL-3.0"), False), (7, ("Apache-2.0",), False),
        ]
    assert scan_licenses(docs).count() == 10 and scan_licenses(none).count() == 0
    nothing = spark.createDataFrame([], "license string, text string")
    assert [r.licenses for r in scan_licenses(docs, known=nothing).collect()] == [[]] * 10
    both = spark.createDataFrame([("A", "short"), ("B", "Short."), ("C", "(c) x")], "license string, text string")
    assert {r.doc_id: r.licenses for r in scan_licenses(docs, known=both).collect()}[6] == ["A", "B"]


def test_full_license_texts(spark):
    def text(name):
        return (Path(license_scan.__file__).parent / "licenses" / f"{name}.txt").read_text()

    def wrapped(*paragraphs, width=70):
        return "\n\n".join(textwrap.fill(p, width) for p in paragraphs)

    mit = license_scan._MIT.replace("conditions: The", "conditions:\0The").split("\0") + [license_scan._AS_IS]
    isc = [license_scan._ISC, license_scan._ISC_AS_IS]
    bsd = [license_scan._BSD, "1. " + license_scan._BSD_1, "2. " + license_scan._BSD_2]
    as_is = license_scan._BSD_AS_IS.format("HOLDER")
    head = "Copyright 2020 Jane Doe"
    whole = {name: text(name) for name in license_scan.FULL_TEXTS} | {
        "MIT": wrapped("MIT License", head, *mit), "ISC": wrapped("ISC License", head, *isc),
        "BSD-2-Clause": wrapped(head, *bsd, as_is),
        "BSD-3-Clause": wrapped(head, *bsd, "3. " + license_scan._BSD_3, as_is),
    }
    rows = [(f"whole {n}", t) for n, t in whole.items()]
    rows += [(f"inside {n}", f"Some words before.\n\n{t}\n\nand some after.") for n, t in whole.items()]
    rows += [(f"source MIT {w}", "\n".join(f" * {x}" for x in wrapped(head, *mit, width=w).split("\n")) + "\n */\nint x;") for w in range(60, 80)]
    frame = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: (r.licenses, r.whole) for r in scan_licenses(frame).collect()}
    for name in whole:
        assert got[f"whole {name}"] == ([name], True)
        if name != "BSD-2-Clause":
            assert got[f"inside {name}"] == ([name], False)
    for width in range(60, 80):
        assert got[f"source MIT {width}"] == (["MIT"], False)
