"""Texts of an Arrow array as slices of UTF-8 bytes, for numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes that are worked on at once, so memory doesn't follow a text's length.
SLICE = 1 << 20

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Rolling hashes modulo 2^64: an odd factor, its inverse, and their powers.
_FACTOR = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def slices(texts: pa.Array, size: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of the first text, starts of the texts in the slice (with the end), bytes.

    NULL texts are empty. A slice holds whole texts of ``size`` bytes together, or a
    part of one longer text: such a text is cut after the last blank of a part's second
    half or else the next blank, so words stay whole and a cut depends on that text alone.
    """
    if len(texts) == 0:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        if last == first + 1 and at[last] - at[first] > size:
            left, end = int(at[first]), int(at[last])
            while left < end:
                right = min(end, left + size)
                if right < end:
                    blanks = np.flatnonzero(BLANK[every[left + size // 2 : right]])
                    while not len(blanks) and right < end:
                        blanks = np.flatnonzero(BLANK[every[right : right + size]])[:1] + (right - left - size // 2)
                        right = min(end, right + size)
                    right = left + size // 2 + int(blanks[-1]) + 1 if len(blanks) else end
                yield first, np.array([0, right - left]), every[left:right]
                left = right
        else:
            yield first, at[first : last + 1] - at[first], every[at[first] : at[last]]
        first = last


def word_bounds(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of non-blank bytes that don't cross texts."""
    solid = ~BLANK[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[starts] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = solid[:-1]
    opens = solid & (~before | cut[:-1])
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    closes = solid & (~after | cut[1:])
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values."""
    values = values ^ (values >> np.uint64(33))
    values = values * _MIX
    return values ^ (values >> np.uint64(29))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        inverse = pow(_FACTOR, -1, 1 << 64)
        up, down = np.full(size, _FACTOR, np.uint64), np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        _powers.clear()
        _powers[size] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _powers[size]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; equal ranges have equal hashes."""
    up, down = _power_table(len(data) + 1)
    upto = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=upto[1:])
    return mix((upto[ends] - upto[starts]) * down[starts] + (ends - starts).astype(np.uint64))
