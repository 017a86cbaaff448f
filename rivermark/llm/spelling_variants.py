"""Spelling variants: words one edit apart, found through a variable-length gram index.

Words: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased. Let h be the unsigned
crc32 of the UTF-8 text ``<doc_id>:<run>``; when 97 divides h, the run loses its code point
h % length (a NULL doc_id gives no h and no deletion). Words are the distinct results of at
least MIN_LENGTH code points that occur at least MIN_COUNT times in all documents.

The method (variable-length grams):

* Dictionary: the frequency of every gram of QMIN..QMAX-1 code points over all positions of all
  words; a gram is extended by one more code point where it occurs more than ``threshold`` times
  (a share of the words, so that the dictionary behaves alike at every size). Because only
  frequent grams grow, the dictionary is prefix-closed and its size is bounded by the alphabet
  (90 code points, so at most 90^2 + 90^3 extendable grams), whatever the corpus.
* Decomposition: at every position the longest dictionary gram that starts there.
* Affected-gram bound: one edit at position i changes exactly the grams whose match reads i (the
  gram and, for grams shorter than QMAX, the next code point). The largest number of grams one
  insertion, deletion or replacement can change is the word's bound NAG; a word one edit away
  keeps at least c = |grams| - NAG of its grams.
* List merging by prefixes: grams are ordered globally by rarity, then by position; a word is
  listed under its NAG + 1 rarest grams with their positions. One edit aligns the positions of
  two words in order, and their aligned equal grams are at least |grams| - NAG of either word; the
  first of these in the order is listed by both. So two words one edit apart share a listed gram,
  at the same position where they are as long, at the same or the next position of the longer
  one where it has a code point more. Pairs that share one so are verified exactly with an edit
  distance, before they are shuffled.
* The rest: where both words have c <= 0 the count filter says nothing, so those words are
  also matched exactly by their one-deletion variants.

A word's form is its near word of largest n (ties: smallest in code-point order) if that n is at
least twice the word's own n; its root follows forms to the end (the word itself when it has
none). Counts grow at least twofold along a chain, so chains are short; roots are found by
pointer jumping.

Rows: NULL text has no runs; repeated rows count again; empty tables give no rows. Only doc_id
and text are read, so other columns never clash. Very long texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import UPPER

#: The word rule and its constants; fixed values.
RUNS = "[A-Za-zÀ-ÿ]+"
DIVISOR = 97
MIN_LENGTH = 5
MIN_COUNT = 3
FORM_FACTOR = 2

#: Gram lengths of the index and the share of words above which a gram grows by one.
QMIN = 2
QMAX = 4
GROW_SHARE = 0.01


def words_of(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words as the rule above makes them, counted over all documents."""
    runs = docs.select(
        F.col(doc_id).cast("string").alias("id"),
        F.explode(F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, UPPER.lower()), F.lit(RUNS), 0)).alias("run"),
    )
    h = F.crc32(F.concat(F.col("id"), F.lit(":"), F.col("run")).cast("binary"))
    cut = (h % F.length("run")).cast("int")
    word = F.when(
        (h % DIVISOR) == 0,
        F.concat(F.substring(F.col("run"), F.lit(1), cut), F.substring(F.col("run"), cut + 2, F.lit(1 << 30))),
    ).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.length("word") >= MIN_LENGTH) & (F.col("n") >= MIN_COUNT))


def gram_counts(words: DataFrame) -> DataFrame:
    """(gram, freq): occurrences of every gram of QMIN..QMAX-1 code points over all word positions."""
    grams = []
    for q in range(QMIN, QMAX):
        grams.append(
            words.select(
                F.explode(
                    F.transform(
                        F.sequence(F.lit(1), F.greatest(F.length("word") - q + 1, F.lit(0))),
                        lambda p: F.substring(F.col("word"), p, F.lit(q)),
                    )
                ).alias("gram")
            ).where(F.length("gram") == q)
        )
    union = grams[0]
    for more in grams[1:]:
        union = union.unionByName(more)
    return union.groupBy("gram").agg(F.count(F.lit(1)).alias("freq"))


def decompose(word: str, grows: set) -> list[tuple[int, str]]:
    """(position, gram) of the word's grams: the longest dictionary gram at every position."""
    out = []
    for p in range(len(word) - QMIN + 1):
        q = QMIN
        while q < QMAX and p + q < len(word) and word[p : p + q] in grows:
            q += 1
        out.append((p, word[p : p + q]))
    return out


def affected_bound(word: str, grams: list[tuple[int, str]]) -> int:
    """The most grams that one insertion, deletion or replacement can change.

    A gram of length q at p reads p..p+q-1, and also p+q when q < QMAX (whether it grows).
    Replacing or deleting i changes the grams that read i; inserting before i changes those
    that read i and start before i.
    """
    size = len(word)
    edit = [0] * (size + 2)
    insert = [0] * (size + 2)
    for p, g in grams:
        last = p + len(g) - (1 if len(g) == QMAX else 0)
        edit[p] += 1
        edit[min(last, size - 1) + 1] -= 1
        insert[p + 1] += 1
        insert[last + 1] -= 1
    most = running_e = running_i = 0
    for i in range(size + 1):
        running_e += edit[i]
        running_i += insert[i]
        most = max(most, running_e if i < size else 0, running_i)
    return most


def _listing(grows: set, freq: dict):
    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, places, rest = [], [], []
            for word in batch["word"]:
                grams = decompose(word, grows)
                bound = affected_bound(word, grams)
                order = sorted((freq.get(g[: QMAX - 1], 0), g, p) for p, g in grams)[: bound + 1]
                texts.append([g for _, g, _ in order])
                places.append([p for _, _, p in order])
                rest.append(len(grams) - bound <= 0)
            yield pd.DataFrame({"word": batch["word"], "grams": texts, "places": places, "rest": rest})

    return listed


def gram_candidates(listed: DataFrame) -> DataFrame:
    """(a, b): words (``word, len, keys``) that share a listed gram where one edit could leave it.

    b is as long as a and greater, or longer by one. A pair comes once per shared gram; keys
    are hashes, so a pair without a shared gram may be among them.
    """
    entries = listed.select("word", "len", F.explode("keys").alias("key")).select(
        F.col("word").alias("b"), F.col("len").alias("len_b"), F.xxhash64("key.grams", "len", "key.places").alias("key")
    )
    # Words as long (each pair found from its lesser word), or longer by one: the key of the partner.
    probes = listed.select("word", "len", F.explode("keys").alias("key")).select(
        F.col("word").alias("a"),
        F.col("len").alias("len_a"),
        F.explode(
            F.array(
                F.xxhash64("key.grams", "len", "key.places"),
                F.xxhash64("key.grams", F.col("len") + 1, "key.places"),
                F.xxhash64("key.grams", F.col("len") + 1, F.col("key.places") + 1),
            )
        ).alias("key"),
    )
    return probes.join(entries, "key").where((F.col("len_a") < F.col("len_b")) | (F.col("a") < F.col("b"))).select("a", "b")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b) with a < b for every two words one edit apart."""
    spark = words.sparkSession
    counts = gram_counts(words)
    n_words = words.count()
    threshold = max(1, math.ceil(GROW_SHARE * n_words))
    # At most 90^2 + 90^3 grams of two and three code points exist: a bound of the alphabet.
    freq = {r["gram"]: int(r["freq"]) for r in counts.toLocalIterator()}
    grows = {g for g, f in freq.items() if f > threshold}
    listed = words.select("word").mapInPandas(_listing(grows, freq), "word string, grams array<string>, places array<int>, rest boolean")
    # Read three times below: listed once, kept in the shared folder.
    listed = _stored(listed.select("word", F.length("word").alias("len"), F.arrays_zip("grams", "places").alias("keys"), "rest"), "spelling-lists")
    by_grams = gram_candidates(listed).where(F.levenshtein("a", "b", 1) == 1).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # The rest: words whose bound gives no count filter, matched by one-deletion variants.
    rest = listed.where("rest").select("word", F.length("word").alias("len"))
    variants = rest.select(
        "word",
        F.explode(
            F.array_union(
                F.array(F.col("word")),
                F.transform(
                    F.sequence(F.lit(1), F.col("len")),
                    lambda p: F.concat(F.substring(F.col("word"), F.lit(1), p - 1), F.substring(F.col("word"), p + 1, F.lit(1 << 30))),
                ),
            )
        ).alias("variant"),
    )
    other = variants.select(F.col("word").alias("b"), F.col("variant"))
    by_rest = variants.join(other, "variant").where((F.col("word") < F.col("b")) & (F.levenshtein("word", "b", 1) == 1))
    return by_grams.unionByName(by_rest.select(F.col("word").alias("a"), "b")).distinct()


def spelling_variants(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n for every word (see the module's rules)."""
    # The documents are read and split once; the words and their pairs are each used several times.
    words = _stored(words_of(docs, doc_id=doc_id, text=text), "spelling-words")
    pairs = _stored(near_pairs(words), "spelling-pairs")
    n = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"))
    ).join(n, "other")
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("neg"), F.col("other"))).alias("top")
    )
    table = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(-F.col("top.neg") >= FORM_FACTOR * F.col("n"), F.col("top.other")).alias("form"),
        F.when(-F.col("top.neg") >= FORM_FACTOR * F.col("n"), -F.col("top.neg")).cast("bigint").alias("form_n"),
    )
    return with_roots(table)


def with_roots(table: DataFrame) -> DataFrame:
    """Add root: forms followed to the end, by pointer jumping over the (word, form) table."""
    step = table.select("word", F.coalesce("form", "word").alias("root"))
    while True:
        up = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = step.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("root").alias("was"))
        moved = _stored(moved, "spelling-roots")
        if moved.where(F.col("root") != F.col("was")).isEmpty():
            step = moved.select("word", "root")
            break
        step = moved.select("word", "root")
    return table.join(step, "word").select("word", "form", "root", F.col("n").cast("bigint").alias("n"), "n_near", "form_n")


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    from .common import stored

    return stored(df, purpose)
