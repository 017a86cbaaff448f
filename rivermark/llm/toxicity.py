"""Toxicity by a weighted lexicon.

Texts are folded (lower case, look-alike letters, digits and signs that stand for
letters, invisible characters), then one Aho-Corasick pass finds lexicon entries and
exception phrases. An entry counts at the start of a word, as a whole word or as its
stem; inside an exception phrase it doesn't. The sum of weights per hundred words goes
through a logistic function. Entries, weights and the function are learned from a
bounded sample of labelled texts, on top of a short fixed list.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from .common import ship
from .quality import labelled_sample, scorer

# Labelled texts to learn from at most, half of it per class; those of smallest hash.
TRAINING_DOCS = 8_000

# Entries known beforehand and phrases in which an entry is harmless; fixed values.
WORDS = (
    "idiot", "idiots", "idiotic", "moron", "morons", "moronic", "stupid", "loser", "losers", "scum",
    "scumbag", "pathetic", "worthless", "disgusting", "trash", "clown", "clowns", "imbecile", "dumbass",
    "asshole", "bastard", "bitch", "retard", "retarded", "shithead", "fuck", "fucking", "fucker",
    "motherfucker", "cunt", "whore", "slut", "degenerate", "vermin", "subhuman",
)
EXCEPTIONS = (
    "trash can", "trash cans", "trash bin", "trash bag", "trash bags", "trash collection", "taking out the trash",
    "take out the trash", "circus clown", "class clown", "clown fish", "clown car", "pond scum",
    "sore loser", "gracious loser", "winner and loser", "winners and losers",
)

# Letters of other scripts that look Latin, by the letter they look like; fixed values.
LOOK_ALIKES = {
    "a": "аα", "b": "вβ", "c": "сϲ", "d": "ԁ", "e": "еε",
    "h": "нһ", "i": "іιı", "j": "ј", "k": "кκ", "m": "м",
    "n": "η", "o": "оο", "p": "рρ", "q": "ԛ", "s": "ѕ",
    "t": "тτ", "u": "υ", "v": "ν", "w": "ԝ", "x": "хχ", "y": "уγ",
}
# Greek capitals that look like other letters than their small ones do.
CAPITALS = {"Η": "h", "Ν": "n", "Υ": "y", "Μ": "m", "Ζ": "z"}
# Digits and signs that stand for letters. One and l are both folded to i.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "l": "i"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}

_TABLE = {ord(x): letter for letter, all_of in LOOK_ALIKES.items() for x in all_of}
_TABLE |= {0xFF01 + k: chr(0x21 + k) for k in range(94)}
_TABLE |= dict.fromkeys((0x00AD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF), None)
_CAPITALS = str.maketrans(CAPITALS)
_LETTERS = str.maketrans(DIGITS)
_SIGN = re.compile(r"[@$!|](?=\w)")
_SIGN_RUN = re.compile(r"[@$!|]+(?=\w)|(?<=\w)[@$!|]+")
_WORD = re.compile(r"\w+")
_STEM_LENGTHS = range(4, 9)

# Evidence for an entry: how much more toxic texts use it, and twice the log likelihood ratio.
LEAST_ODDS = 4.0
LEAST_GAIN = 30.0


def fold(text: str, *, runs: bool = False) -> str:
    """Lower case, look-alikes and stand-ins as plain letters, of signs one before a
    letter, or with ``runs`` all that touch one. Both give texts of one length."""
    text = (text if text.isascii() else text.translate(_CAPITALS)).lower()
    if not text.isascii():
        text = text.translate(_TABLE)
    if "@" in text or "$" in text or "!" in text or "|" in text:
        text = (_SIGN_RUN if runs else _SIGN).sub(lambda m: "".join(SIGNS[x] for x in m[0]), text)
    return text.translate(_LETTERS)


@dataclass
class Lexicon:
    """Entries (folded text, whole word only) with weights, and the logistic function."""

    weights: dict[tuple[str, bool], float]
    slope: float = 8.0
    intercept: float = -2.0
    exceptions: Sequence[str] = EXCEPTIONS
    _automaton: object = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_automaton": None}

    def _search(self):
        if self._automaton is None:
            found = ahocorasick.Automaton()
            entries: dict[str, list[tuple[int, bool, float]]] = {}
            for (text, whole), weight in self.weights.items():
                entries.setdefault(text, []).append((len(text), whole, weight))
            for text in map(fold, self.exceptions):
                entries.setdefault(text, []).append((len(text), True, -1.0))
            for text, uses in entries.items():
                found.add_word(text, uses)
            if entries:
                found.make_automaton()
            self._automaton = found
        return self._automaton

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """Start, end and weight of the entries that count, in order."""
        search = self._search()
        if not len(search):
            return []
        hits, excused = {}, []
        for last, uses in search.iter(folded):
            for length, whole, weight in uses:
                start, end = last - length + 1, last + 1
                if start and folded[start - 1].isalnum():
                    continue
                if whole and end < len(folded) and folded[end].isalnum():
                    continue
                if weight < 0:
                    excused.append((start, end))
                else:
                    hits[start] = max(hits.get(start, (0.0, 0)), (weight, end))
        return [
            (start, end, weight)
            for start, (weight, end) in sorted(hits.items())
            if not any(a <= start and end <= b for a, b in excused)
        ]

    def density(self, text: str | None) -> float:
        """Weight per hundred words."""
        if not text:
            return 0.0
        folded = fold(text)
        found = {start: w for start, _, w in self.matches(folded)}
        # A sign after a letter may be punctuation or a letter, so both readings count.
        if any(sign in folded for sign in SIGNS) and (other := fold(text, runs=True)) != folded:
            for start, end, w in self.matches(other):
                # What both readings spell alike was judged above, exceptions included.
                if folded[start : end + 1] != other[start : end + 1]:
                    found[start] = max(found.get(start, 0.0), w)
        return 100 * sum(found.values()) / len(text.split()) if found else 0.0

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability of toxicity; the same small one for all texts without a match."""
        x = np.log1p([self.density(t.as_py()) for t in texts])
        return 1 / (1 + np.exp(-(self.intercept + self.slope * x)))


def _uses(texts: Sequence[str]) -> tuple[Counter, int]:
    """How many different (word before, word) pairs each word and stem is in.

    Pairs, not documents, are counted, so copies of a text add nothing.
    """
    pairs = set()
    for text in texts:
        words = _WORD.findall(fold(text))
        pairs.update(zip(["", *words], words, strict=False))
    counts = Counter()
    for word, n in Counter(w for _, w in pairs if len(w) > 2).items():
        counts[word, True] += n
        for k in _STEM_LENGTHS:
            if len(word) >= k:
                counts[word[:k], False] += n
    return counts, max(1, len(pairs))


def learn_entries(toxic: Sequence[str], clean: Sequence[str]) -> dict[tuple[str, bool], float]:
    """Words and stems (4 to 8 letters) that toxic texts use more than others do.

    Candidates are taken by the likelihood ratio of their uses, the clearest first; one
    that begins with a chosen stem, or is the beginning of a chosen entry, is left out.
    """
    here, n_here = _uses(toxic)
    there, n_there = _uses(clean)
    share = n_here / (n_here + n_there)
    found = []
    for entry, n in here.items():
        other = there[entry]
        odds = (n / n_here) / ((other + 0.5) / n_there)
        if n < 4 or odds < LEAST_ODDS:
            continue
        gain = n * math.log(n / ((n + other) * share))
        gain += other * math.log(other / ((n + other) * (1 - share))) if other else 0.0
        if 2 * gain >= LEAST_GAIN:
            found.append((-gain, not entry[1], -len(entry[0]), entry, odds))
    entries: dict[tuple[str, bool], float] = {}
    beginnings: set[str] = set()
    for *_, entry, odds in sorted(found):
        text = entry[0]
        if text in beginnings or any((text[:k], False) in entries for k in _STEM_LENGTHS):
            continue
        entries[entry] = min(1.0, math.log(odds) / 4)
        beginnings.update(text[:k] for k in range(3, len(text) + 1))
    return entries


def train(texts: Sequence[str], labels: Sequence[int], *, words: Sequence[str] = WORDS) -> Lexicon:
    """Lexicon and logistic function from labelled texts (1: toxic).

    Without both labels the fixed words are used with the default function.
    """
    y = np.asarray(labels, float)
    toxic = [t for t, label in zip(texts, labels, strict=True) if label]
    clean = [t for t, label in zip(texts, labels, strict=True) if not label]
    weights = {(fold(w), True): 1.0 for w in words}
    if not toxic or not clean:
        return Lexicon(weights)
    lexicon = Lexicon(learn_entries(toxic, clean) | weights)
    x = np.log1p([lexicon.density(t) for t in texts])
    if not x.any():
        return lexicon
    # Newton's steps with equal classes and a ridge, so separable classes are fine.
    design = np.stack([np.ones_like(x), x], 1)
    share = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    at = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        slope = design.T @ (share * (p - y)) + 1e-2 * at
        bend = (design * (share * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        at = at - np.linalg.solve(bend, slope)
    lexicon.intercept, lexicon.slope = map(float, at)
    return lexicon


def toxicity_model(docs: DataFrame, labels: DataFrame, *, usable: Column, limit: int = TRAINING_DOCS) -> Lexicon:
    """Learn from the labelled texts that ``usable`` (a condition on ``id``) allows."""
    sample = labelled_sample(docs, labels, label="toxic", usable=usable, limit=limit)
    return train([t for t, _ in sample], [y for _, y in sample])


def with_toxicity(docs: DataFrame, lexicon: Lexicon, *, text: str = "text", name: str = "score") -> DataFrame:
    """Add the probability that a text is toxic; all rows and columns stay.

    NULL is scored as the empty text. Repeated rows score alike, empty tables are fine.
    A column called ``name`` is replaced, so name one that is free.
    """
    ship(docs.sparkSession)
    return docs.withColumn(name, scorer(lexicon)(docs[text]))
