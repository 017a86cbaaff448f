"""Token counts of texts by prefix sums over white-space pieces, for truncation and budgets.

The method: a text is cut at white space into pieces. For a tokenizers file (``.json``) with
the word pre-tokenizer (tokens never cross white space, which is dropped), the count of a text is the sum of
the counts of its pieces, so the count of every prefix that ends at a piece is one running sum
(the dynamic programme ``count[k] = count[k-1] + tokens(piece k)``). Each distinct piece is
encoded once per task by the library itself, with its normaliser, added tokens and model; the
running sums are then exact answers to "how many tokens has the text up to here" and "how much
of the text fits into B tokens", without encoding any prefix again.

A sentencepiece file (``.model``) adds a prefix space to every input and a byte-level file keeps
white space inside tokens, so pieces are not independent there: such texts are encoded whole, and
prefixes are read off the tokens' ends (the same running sums, filled from one encoding).

Rows: NULL text counts as the empty text (0 tokens, 0 bytes); empty texts have no prefixes.
Very long texts are handled in one pass; nothing is cut. Repeated rows get equal results.
All other columns stay; columns named like the outputs are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

#: White space that the word pre-tokenizer treats as a border (Unicode white space); fixed values.
#: Python's own white space adds the separators \x1c-\x1f, so texts with those are cut at ASCII
#: white space only.
SEPARATORS = "\x1c\x1d\x1e\x1f"
UNICODE_PIECES = re.compile(r"\S+")
ASCII_PIECES = re.compile(r"[^\t\n\x0b\x0c\r ]+")
ASCII_BLANKS = re.compile(r"[\t\n\x0b\x0c\r ]+")
#: A piece of ASCII letters between runs of ASCII signs other than the apostrophe and '<'
#: (which begin contractions and special tokens): the signs never join the letters in one token,
#: and the letters alone are one pre-token that the model encodes directly.
PLAIN = re.compile(r"([!-&(-/:-;=?-@\[-`{-~]*)([A-Za-z]+)([!-&(-/:-;=?-@\[-`{-~]*)")

#: The tokenizer file of the contract, by name in the installed tokenizer package.
DEFAULT = "word_bpe_49k.json"

_loaded: dict[str, object] = {}


def resolve(name: str) -> str:
    """The file of a tokenizer given by a path or by a name of the installed package."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _tokenizer(path: str):
    if path not in _loaded:
        if path.endswith(".model"):
            import sentencepiece

            _loaded[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            _loaded[path] = tokenizer
    return _loaded[path]


class PieceCounts:
    """Counts of distinct white-space pieces.

    Pieces of plain ASCII letters (with signs around them) go to the tokenizer's model directly;
    every other piece goes through the whole library pipeline, normaliser and added tokens included.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        self.model = self.tokenizer.model
        self.known: dict[str, int] = {}
        self.plain = _word_pipeline(path)

    def _full(self, piece: str) -> int:
        if piece not in self.known:
            self.known[piece] = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return self.known[piece]

    def count(self, piece: str) -> int:
        found = self.known.get(piece)
        if found is not None:
            return found
        match = PLAIN.fullmatch(piece) if self.plain else None
        if match is None:
            return self._full(piece)
        lead, letters, tail = match.groups()
        n = len(self.model.tokenize(letters.lower()))
        n += self._full(lead) if lead else 0
        n += self._full(tail) if tail else 0
        self.known[piece] = n
        return n


def _word_pipeline(path: str) -> bool:
    """Whether the file has the word pre-tokenizer whose pieces PLAIN relies on."""
    import json

    with open(path, encoding="utf-8") as handle:
        config = json.load(handle)
    steps = (config.get("pre_tokenizer") or {}).get("pretokenizers") or []
    split = [s for s in steps if s.get("type") == "Split"]
    return bool(split) and split[0].get("pattern", {}).get("Regex", "").startswith("'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|")


def pieces_of(text: str) -> list[str]:
    """The white-space pieces of a text."""
    if any(c in text for c in SEPARATORS):
        return [p for p in ASCII_BLANKS.split(text) if p]
    return text.split()


def ends_of(text: str) -> np.ndarray:
    """Code-point end of every piece, in the order of pieces_of."""
    pattern = ASCII_PIECES if any(c in text for c in SEPARATORS) else UNICODE_PIECES
    return np.fromiter((m.end() for m in pattern.finditer(text)), np.int64)


def prefix_counts(text: str, counts: PieceCounts) -> np.ndarray:
    """Tokens of the text up to the end of each piece: the running sum over pieces."""
    pieces = pieces_of(text)
    return np.cumsum(np.fromiter(map(counts.count, pieces), np.int64, len(pieces)))


def _whole_prefixes(text: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Prefix counts from one encoding of the whole text: code-point ends and tokens up to each."""
    tokenizer = _tokenizer(path)
    if path.endswith(".model"):
        proto = tokenizer.encode(text, out_type="immutable_proto")
        ends = np.fromiter((piece.end for piece in proto.pieces), np.int64)
        # Byte offsets to code points.
        starts = np.frombuffer(text.encode("utf-8"), np.uint8) & 0xC0 != 0x80
        points = np.concatenate([[0], np.cumsum(starts)])[ends]
    else:
        encoded = tokenizer.encode(text, add_special_tokens=False)
        points = np.fromiter((end for _, end in encoded.offsets), np.int64)
    # One count per distinct end, kept where the ends rise.
    points = np.maximum.accumulate(points) if len(points) else points
    if len(points) == 0:
        return points, points
    last = np.r_[points[1:] != points[:-1], True]
    return points[last], np.arange(1, len(points) + 1, dtype=np.int64)[last]


def _fit(ends: np.ndarray, tokens: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix that ends at a piece and has at most ``budget`` tokens."""
    k = int(np.searchsorted(tokens, budget, side="right"))
    return int(ends[k - 1]) if k else 0


def counter(path: str, budgets: tuple[int, ...], prefixes: bool) -> Column:
    """A struct column: n_tokens, fit_<B> for each budget, and optionally the prefix arrays."""
    fields = [pa.field("n_tokens", pa.int64())] + [pa.field(f"fit_{b}", pa.int64()) for b in budgets]
    if prefixes:
        fields += [pa.field("prefix_ends", pa.list_(pa.int64())), pa.field("prefix_tokens", pa.list_(pa.int64()))]
    ddl = ", ".join(
        [f"`{f.name}` bigint" if f.type == pa.int64() else f"`{f.name}` array<bigint>" for f in fields]
    )

    @F.arrow_udf(f"struct<{ddl}>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        whole = path.endswith(".model") or not _word_pipeline(path)
        pieces = None if whole else PieceCounts(path)
        for texts in batches:
            columns: dict[str, list] = {f.name: [] for f in fields}
            for text in texts.to_pylist():
                text = text or ""
                if whole:
                    ends, tokens = _whole_prefixes(text, path)
                else:
                    if len(pieces.known) > 1_000_000:
                        pieces.known.clear()
                    tokens = prefix_counts(text, pieces)
                total = int(tokens[-1]) if len(tokens) else 0
                if not whole and (prefixes or total > min(budgets, default=total)):
                    ends = ends_of(text)
                columns["n_tokens"].append(total)
                for b in budgets:
                    columns[f"fit_{b}"].append(len(text) if total <= b else _fit(ends, tokens, b))
                if prefixes:
                    columns["prefix_ends"].append(ends)
                    columns["prefix_tokens"].append(tokens)
            yield pa.StructArray.from_arrays([pa.array(columns[f.name], f.type) for f in fields], fields=fields)

    return count


def token_counts(
    docs: DataFrame,
    *,
    tokenizer: str = DEFAULT,
    text: str = "text",
    budgets: tuple[int, ...] = (2048,),
    prefixes: bool = False,
) -> DataFrame:
    """Add n_bytes, n_tokens, fit_<B> (code points of the longest prefix ending at white space
    that has at most B tokens; the whole length when the text fits) and, with ``prefixes``, the
    arrays prefix_ends (code-point end of each piece) and prefix_tokens (tokens up to it).

    ``tokenizer`` is a path or a file name of the installed tokenizer package. No begin or end
    tokens are added, special strings inside texts are treated as the library does by default,
    and nothing is truncated or padded. The per-task cache of piece counts is emptied when it
    holds a million pieces, so memory stays bounded whatever the texts.
    """
    ship(docs.sparkSession)
    path = resolve(tokenizer)
    body = F.coalesce(F.col(text), F.lit(""))
    made = ["n_bytes", "n_tokens", *(f"fit_{b}" for b in budgets)] + (["prefix_ends", "prefix_tokens"] if prefixes else [])
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in made]
    counted = docs.select(*kept, counter(path, tuple(budgets), prefixes)(body).alias("_counted"), F.octet_length(body).cast("bigint").alias("n_bytes"))
    return counted.select(*[F.col(f"`{c}`") for c in docs.columns if c not in made], "n_bytes", "_counted.*")


def truncate(text: Column, ends: Column, tokens: Column, budget: int) -> Column:
    """The longest prefix of ``text`` that ends at white space and has at most ``budget`` tokens,
    read from stored prefix arrays without encoding anything again."""
    fitting = F.size(F.filter(tokens, lambda t: t <= F.lit(budget)))
    cut = F.when(fitting > 0, F.element_at(ends, fitting)).otherwise(F.lit(0))
    return F.substring(F.coalesce(text, F.lit("")), 1, cut.cast("int"))
