"""Weighted minwise signatures by thrown darts, in numpy.

An element of weight w owns the region [0, w) x [0, inf) of weights and ranks. Darts
fall on regions by a Poisson process of one dart per unit square, drawn from hashes of
the element and the square, so every set that holds an element sees the same darts in
it. Each dart also names a coordinate of the signature. A set's signature keeps, per
coordinate, the dart of lowest rank in its regions; two sets agree in a coordinate with
the probability of their weighted Jaccard similarity. Ranks are looked at in blocks
that double (1, 2, 4, ... squares), and a set is done when all its coordinates are
filled, so the work follows the set's size plus the darts it takes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .lm import tokenised
from .textbytes import mix

# 40 bands of 6 coordinates: a pair of similarity 0.8 shares a band but for 5 in a million.
BANDS = 40
ROWS = 6
COORDINATES = BANDS * ROWS
WORDS = 5

_SHINGLE_BITS = 44
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.uint64(0xD1B54A32D192ED03)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW32 = np.uint64(0xFFFFFFFF)
# Chances of at most 0, 1, 2, ... darts on a unit square.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])
_CHUNK = 1 << 20


def _combine(parts: list[np.ndarray]) -> np.ndarray:
    value = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        value = mix(value * _STEP + part + _SALT)
    return value


def text_words(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Groups of whole texts: number of the first, how many, per word its hash and text."""
    held: list[np.ndarray] = []
    for tokens in tokenised(texts):
        word = tokens.hashes[tokens.code]
        if tokens.begins and tokens.ends:
            yield tokens.first, tokens.docs, word, tokens.doc
            continue
        held.append(word)
        if tokens.ends:
            word, held = np.concatenate(held), []
            yield tokens.first, 1, word, np.zeros(len(word), np.int64)


def shingles(word: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of WORDS words: text, element (44 bits), how often; by text.

    A text with fewer words, but not none, has one run of all its words.
    """
    n = np.bincount(doc, minlength=docs)
    if len(word) >= WORDS:
        whole = np.flatnonzero(doc[WORDS - 1 :] == doc[: len(doc) - WORDS + 1])
        value, at = _combine([word[whole + k] for k in range(WORDS)]), doc[whole]
    else:
        value, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    start = np.cumsum(n) - n
    for size in range(1, WORDS):
        short = np.flatnonzero(n == size)
        if len(short):
            value = np.concatenate([value, _combine([word[start[short] + k] for k in range(size)])])
            at = np.concatenate([at, short])
    packed = (at.astype(np.uint64) << np.uint64(_SHINGLE_BITS)) | (value >> np.uint64(64 - _SHINGLE_BITS))
    packed, times = np.unique(packed, return_counts=True)
    mask = np.uint64((1 << _SHINGLE_BITS) - 1)
    return (packed >> np.uint64(_SHINGLE_BITS)).astype(np.int64), packed & mask, times


def _throw(
    found: np.ndarray, doc: np.ndarray, element: np.ndarray, weight: np.ndarray, block: int
) -> None:
    """Lower ``found`` (per text and coordinate: rank and dart) by a block's darts."""
    first, width = (1 << block) - 1, 1 << block
    columns = np.ceil(weight).astype(np.int64)
    squares = columns * width
    upto = np.cumsum(squares)
    low = 0
    while low < len(doc):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + _CHUNK, "right")))
        own = np.repeat(np.arange(low, high), squares[low:high])
        place = np.arange(len(own)) - np.repeat(upto[low:high] - squares[low:high] - (upto[low - 1] if low else 0), squares[low:high])
        level, column = place % width, place // width
        low = high
        square = mix(mix(element[own] * _STEP + column.astype(np.uint64)) + (level + first).astype(np.uint64) * _SALT)
        darts = np.searchsorted(_POISSON, (square >> np.uint64(11)).astype(np.float64) / (1 << 53), "right")
        hit = np.repeat(np.arange(len(own)), darts)
        turn = np.arange(len(hit)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = mix(square[hit] + (turn + 1).astype(np.uint64) * _STEP)
        more = mix(dart ^ _SALT)
        height = (more >> np.uint64(11)).astype(np.float64) / (1 << 53)
        inside = column[hit] + height < weight[own[hit]]
        hit, dart, more = hit[inside], dart[inside], more[inside]
        rank = ((level[hit].astype(np.uint64) << np.uint64(32)) | (dart & _LOW32)) >> np.uint64(block)
        coordinate = ((dart >> np.uint64(32)) % np.uint64(COORDINATES)).astype(np.int64)
        name = mix(more + _STEP) & _LOW32
        np.minimum.at(found, doc[own[hit]] * COORDINATES + coordinate, (rank << np.uint64(32)) | name)


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int) -> np.ndarray:
    """Per text the names of its earliest darts, one per coordinate (0 without elements)."""
    names = np.zeros((docs, COORDINATES), np.uint64)
    filled = np.ones(docs, bool)
    filled[doc] = False
    done = np.zeros((docs, COORDINATES), bool)
    block = 0
    while not filled.all():
        some = ~filled[doc]
        number = np.cumsum(~filled) - 1
        found = np.full(int((~filled).sum()) * COORDINATES, _NONE)
        _throw(found, number[doc[some]], element[some], weight[some], block)
        found = found.reshape(-1, COORDINATES)
        open_texts = np.flatnonzero(~filled)
        fresh = (found != _NONE) & ~done[open_texts]
        names[open_texts] = np.where(fresh, found & _LOW32, names[open_texts])
        done[open_texts] |= fresh
        filled[open_texts] = done[open_texts].all(axis=1)
        block += 1
    return names


def bands(names: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each signature."""
    parts = names.reshape(len(names), BANDS, ROWS)
    value = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64) + _SALT), parts.shape[:2])
    for k in range(ROWS):
        value = mix(value * _STEP + parts[:, :, k])
    return value.view(np.int64) if value.dtype == np.uint64 else value.astype(np.int64)


def digest(word: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text's sequence of words."""
    n = np.bincount(doc, minlength=docs)
    at = (np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint64)
    out = []
    for salt in (_STEP, _SALT):
        value = mix(mix(word + salt) + at * salt)
        total = np.zeros(len(word) + 1, np.uint64)
        np.cumsum(value, out=total[1:])
        ends = np.cumsum(n)
        out.append(mix(total[ends] - total[ends - n] + n.astype(np.uint64) * salt).view(np.int64))
    return out[0], out[1]


@dataclass
class Overlaps:
    """Rows ``first`` to ``first + len(common)`` of two columns of texts: weight of either
    text's runs of words, weight in common, and the left text's runs (row, element,
    weight) beyond the right one's."""

    first: int
    left: np.ndarray
    right: np.ndarray
    common: np.ndarray
    beyond: tuple[np.ndarray, np.ndarray, np.ndarray]

    def similarity(self) -> np.ndarray:
        """Jaccard similarity; 0 without words."""
        return self.common / np.maximum(self.left + self.right - self.common, 1)


def _sizes(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    return np.diff(np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1])


def overlaps(left: pa.Array, right: pa.Array, *, weighted: bool) -> Iterator[Overlaps]:
    """Compare texts row by row; ``weighted`` counts how often a run occurs."""
    bits, mask = np.uint64(_SHINGLE_BITS), np.uint64((1 << _SHINGLE_BITS) - 1)
    upto = np.cumsum(_sizes(left).astype(np.int64) + _sizes(right))
    low = 0
    while low < len(left):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + (4 << 20), "right")))
        keys, times, totals = [], [], []
        for side in (left, right):
            rows = [(first, *shingles(word, doc, docs)) for first, docs, word, doc in text_words(side[low:high])]
            keys.append(np.concatenate([((doc + first).astype(np.uint64) << bits) | e for first, doc, e, _ in rows]))
            times.append(np.concatenate([t if weighted else np.ones(len(t), np.int64) for *_, t in rows]))
            totals.append(np.bincount((keys[-1] >> bits).astype(np.int64), times[-1], minlength=high - low))
        both, a, b = np.intersect1d(*keys, assume_unique=True, return_indices=True)
        shared = np.minimum(times[0][a], times[1][b])
        common = np.bincount((both >> bits).astype(np.int64), shared, minlength=high - low)
        more = times[0].copy()
        more[a] -= shared
        at = np.flatnonzero(more)
        beyond = ((keys[0][at] >> bits).astype(np.int64), (keys[0][at] & mask).astype(np.int64), more[at])
        yield Overlaps(low, totals[0], totals[1], common, beyond)
        low = high
