"""Quality classifier on supervised subword embeddings.

A text is the average of learned vectors: one per hashed word, one per hashed run of
three and of four bytes, and one for "the word before, again". A softmax over the
average gives the class. Vectors and softmax are trained by stochastic gradient
descent in numpy on a bounded sample of labelled texts, by one task, so that the driver
gets only the weights. As both are linear, scoring
needs one number per bucket (the vector times the difference of the class weights),
and a text of any length is scored slice by slice in bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship
from .textbytes import mix, slices, word_bounds, word_hashes

BUCKETS = 1 << 18
DIMENSIONS = 16
# Labelled texts to learn from at most, half of it per class; those of smallest hash.
TRAINING_DOCS = 4_000
EPOCHS = 12
RATE = 40.0
_GRAMS = (3, 4)
_AGAIN = np.array([7], np.uint64)


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)


def _features(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of (position in the slice, bucket), positions ascending."""
    opens, ends = word_bounds(data, starts)
    hashes = word_hashes(data, opens, ends)
    yield opens, _buckets(hashes)
    text = np.searchsorted(starts, opens, "right")
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])) + 1
    yield opens[again], np.broadcast_to(_buckets(mix(_AGAIN)), len(again))
    wide = data.astype(np.uint32)
    for n in _GRAMS:
        if len(data) < n:
            continue
        value = np.full(len(data) - n + 1, n, np.uint32)
        for k in range(n):
            value = value * np.uint32(0x01000193) + wide[k : len(data) - n + 1 + k]
        value = (value ^ (value >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        inside = np.ones(len(value), bool)
        for k in range(1, n):
            edge = starts[1:-1] - k
            inside[edge[(edge >= 0) & (edge < len(value))]] = False
        at = np.flatnonzero(inside)
        yield at, (value[at] >> np.uint32(12)).astype(np.int64) & (BUCKETS - 1)


def _sums(positions: np.ndarray, values: np.ndarray | None, starts: np.ndarray) -> np.ndarray:
    """Per text, the sum of values (or the number of positions)."""
    bounds = np.searchsorted(positions, starts)
    if values is None:
        return np.diff(bounds).astype(np.float64)
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return np.diff(total[bounds])


@dataclass
class Model:
    """One number per bucket and the intercept; the log-odds of class 1 are
    ``intercept`` plus the average over a text's features."""

    weights: np.ndarray
    intercept: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability of class 1; the intercept's for texts without a feature."""
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for first, starts, data in slices(texts):
            upto = first + len(starts) - 1
            for positions, buckets in _features(data, starts):
                total[first:upto] += _sums(positions, self.weights[buckets], starts)
                count[first:upto] += _sums(positions, None, starts)
        odds = self.intercept + total / np.maximum(count, 1)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    found = [
        buckets
        for _, starts, data in slices(pa.array([text]))
        for _, buckets in _features(data, starts)
    ]
    buckets, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, int), np.zeros(0))
    return buckets.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)


def train(texts: list[str], labels: list[int], *, epochs: int = EPOCHS, rate: float = RATE, seed: int = 11) -> Model:
    """Fit vectors and softmax; both classes get the same weight.

    With labels of one class only, every text is that class; without labels, 0.5.
    """
    y = np.asarray(labels, int)
    share = np.bincount(y, minlength=2) / max(1, len(y))
    if share.min() == 0:
        return Model(np.zeros(BUCKETS, np.float32), float(np.sign(share[1] - share[0]) * 4.0))
    random = np.random.default_rng(seed)
    docs = [_sparse(t) for t in texts]
    vectors = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    out = (random.standard_normal((DIMENSIONS, 2)) * 0.1).astype(np.float32)
    bias = np.zeros(2, np.float32)
    steps, done = epochs * len(docs), 0
    for _ in range(epochs):
        for i in random.permutation(len(docs)):
            buckets, w = docs[i]
            step = rate * (1 - done / steps)
            done += 1
            mean = w @ vectors[buckets]
            logits = mean @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= 0.5 / share[y[i]]
            back = out @ p
            out -= 0.01 * step * np.outer(mean, p)
            bias -= 0.001 * step * p
            vectors[buckets] -= step * np.outer(w, back)
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; NULL ids hash as ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % of


def _labelled(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str,
    usable: Column,
    limit: int,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = 3,
) -> DataFrame:
    """(id, y, t): at most ``limit`` labelled texts, half per class: those of smallest hash.

    Labels other than 0 and 1 and NULL ids are left out; an id with both labels counts
    as 0. Of repeated rows with one id the smallest text is taken. The chosen ids (a
    table bounded by ``limit``) are broadcast, so texts aren't shuffled.
    """
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col(label).alias("y"))
        .filter(F.col("y").isin(0, 1) & F.col("id").isNotNull())
        .filter(usable)
        .groupBy("id")
        .agg(F.min("y").alias("y"))
    )
    order = [F.xxhash64("id", F.lit(seed)), "id"]
    half = max(1, limit // 2)
    chosen = (
        known.filter("y = 0").orderBy(*order).limit(half)
        .unionByName(known.filter("y = 1").orderBy(*order).limit(half))
    )
    return (
        docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
        .join(F.broadcast(chosen), "id")
        .groupBy("id", "y")
        .agg(F.min("t").alias("t"))
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, **options) -> list[tuple[str, int]]:
    """The texts and labels of ``_labelled`` (same options), by id."""
    return [(r["t"], r["y"]) for r in _labelled(docs, labels, **options).orderBy("id").collect()]


def scorer(model) -> Column:
    """The model's score as a function of a text column, run on Arrow batches."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.scores(texts), pa.float64())

    return score


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task that trains on all its rows (text, label)."""
    texts, labels = [], []
    for batch in batches:
        texts += batch.column(0).to_pylist()
        labels += batch.column(1).to_pylist()
    model = train(texts, labels)
    yield pa.RecordBatch.from_arrays(
        [pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.intercept], pa.float64())],
        ["weights", "intercept"],
    )


def quality_model(docs: DataFrame, labels: DataFrame, *, usable: Column, limit: int = TRAINING_DOCS) -> Model:
    """Train on the labelled texts that ``usable`` (a condition on ``id``) allows."""
    ship(docs.sparkSession)
    sample = _labelled(docs, labels, label="quality", usable=usable, limit=limit)
    # The sample is bounded, and one task learns from it in the order of ids.
    fitted = (
        sample.repartition(1).sortWithinPartitions("id").select("t", "y")
        .mapInArrow(_fit, "weights binary, intercept double").first()
    )
    return train([], []) if fitted is None else Model(np.frombuffer(fitted["weights"], np.float32), fitted["intercept"])


def with_quality(docs: DataFrame, model: Model, *, text: str = "text", name: str = "score") -> DataFrame:
    """Add the probability that a text is good; all rows and columns stay.

    NULL is scored as the empty text. Repeated rows score alike, empty tables are fine.
    A column called ``name`` is replaced, so name one that is free.
    """
    ship(docs.sparkSession)
    return docs.withColumn(name, scorer(model)(F.coalesce(F.col(text), F.lit(""))))
