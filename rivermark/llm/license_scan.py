"""Licence scan by the digests of canonical texts.

A text is made canonical (case, punctuation, copyright lines, equivalent spellings) and
cut into units: the whole text, its paragraphs and its lines. The digest of each whole
unit is looked up among those of known licence texts, their paragraphs and notices, made
canonical in the same way. The known texts are joined by a broadcast of measured size, in the scan of the
documents, so hits and one row per document are shuffled.
"""

from __future__ import annotations

import pkgutil
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.barrier import computed
from .common import BROADCAST_BYTES, lower_ascii, row_key

# Known texts by licence; fixed values.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the Software."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies."
)
_ISC_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:"
)
_BSD_1 = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
)
_BSD_2 = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_3 = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
# Licences whose full texts are files beside this module.
FULL_TEXTS = ("Apache-2.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0")
# Words that a paragraph of a full text has at least to stand for its licence.
PARAGRAPH_WORDS = 12


def _plain(text: str) -> str:
    return " ".join(re.findall(r"\w+", text.lower()))


def _full_texts() -> Iterator[tuple[str, str]]:
    """Full texts, with and without the advice after their terms, and the paragraphs by
    which a licence is known inside a longer text.

    A paragraph in the texts of several licences says nothing. Paragraphs of the GNU
    licences also have to name them, as others (AGPL) repeat the rest.
    """
    names, paragraphs = defaultdict(set), []
    for name in FULL_TEXTS:
        text = pkgutil.get_data(__package__, f"licenses/{name}.txt").decode()
        yield name, text
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        if end:
            yield name, terms + end
            yield name, terms
        for part in re.split(r"\n\s*\n", text):
            names[_plain(part)].add(name)
            paragraphs.append((name, part))
    for name, part in paragraphs:
        plain = _plain(part)
        gnu = "GPL" not in name or "general public license" in plain
        if len(names[plain]) == 1 and len(plain.split()) >= PARAGRAPH_WORDS and gnu:
            yield name, part


def _short_texts() -> Iterator[tuple[str, str]]:
    """MIT, ISC and BSD: whole texts with the usual titles, and paragraphs."""
    grant, keep = _MIT[: _MIT.index("The above")], _MIT[_MIT.index("The above") :]
    for part in (grant, keep, _AS_IS):
        yield "MIT", part
    for title in ("The MIT License", "The MIT License (MIT)"):
        yield "MIT", f"{title} {_MIT} {_AS_IS}"
    for disclaimer in (_ISC_AS_IS, _ISC_AS_IS.replace("SOFTWARE INCLUDING", "SOFTWARE, INCLUDING")):
        for title in ("", "ISC License", "The ISC License"):
            yield "ISC", f"{title} {_ISC} {disclaimer}"
    for first, second, third in (("", "", ""), ("1.", "2.", "3.")):
        for holder in ("HOLDER", "OWNER", "HOLDERS"):
            two = f"{_BSD} {first} {_BSD_1} {second} {_BSD_2}"
            for title in ("", "BSD 2-Clause License", 'The 2-Clause BSD License', 'BSD 2-Clause "Simplified" License'):
                yield "BSD-2-Clause", f"{title} {two} {_BSD_AS_IS.format(holder)}"
            for title in ("", "BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License'):
                yield "BSD-3-Clause", f"{title} {two} {third} {_BSD_3} {_BSD_AS_IS.format(holder)}"
        yield "BSD-3-Clause", f"{third} {_BSD_3}"


KNOWN: tuple[tuple[str, str], ...] = (
    ("MIT", f"MIT License {_MIT} {_AS_IS}"),
    ("MIT", f"{_MIT} {_AS_IS}"),
    ("MIT", _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    *_short_texts(),
    *_full_texts(),
)

# Spellings that mean the same; fixed values. Applied in order, on lower case.
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-infringement", "noninfringement"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("&", " and "),
    ("https:", "http:"),
)
# Lines that name a holder: copyright with a year, (c), a blank to fill in or a kind of holder, (c) with a year. Others
# that begin with the word are parts of sentences.
COPYRIGHT_LINE = (
    r"(?m)^[^\n\p{L}\p{N}(©]*(?:copyright[: ]*(?:\(c\)|©|[\[<{]|by\b)|copyright\b[^\n]*\b(?:19|20)[0-9]{2}\b"
    r"|copyright\b[^\n]*\b(?:inc|ltd|llc|gmbh|corp|corporation|foundation|authors)\.?[ \t]*$"
    r"|\(c\)[^\n]*\b(?:19|20)[0-9]{2}\b|©|all rights reserved\b)[^\n]*$"
)
MARKS = r"[^\p{L}\p{N}\n]+"
# Different lengths of known texts up to which they are listed in the plan.
LENGTHS = 2_000
GAPS = r"\n(?: ?\n)+"


def canonical_lines(text: Column) -> Column:
    """Canonical text in which line ends still stand."""
    plain = lower_ascii(F.coalesce(text, F.lit("")))
    plain = F.regexp_replace(plain, COPYRIGHT_LINE, "")
    for other, one in SPELLINGS:
        plain = F.replace(plain, F.lit(other), F.lit(one))
    return F.regexp_replace(plain, MARKS, " ")


def _flat(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def scan_licenses(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    known: Sequence[tuple[str, str]] | DataFrame = KNOWN,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Licences whose known texts are a document's text, a paragraph or a line of it.

    Returns ``doc_id, licenses, whole``, one row per input row: the names sorted, and
    whether the whole text is a licence. ``known`` is a list of name and text, or a frame
    with ``license`` and ``text``. A known text over several paragraphs is found as the
    whole text only; cut paragraphs into entries of their own to find them inside.

    NULL and empty texts have no licence, and so has a known text that is empty when
    canonical. Equal known texts of several licences give all names. Repeated rows get
    equal results; empty tables are fine on either side; other columns are ignored.
    """
    spark = docs.sparkSession
    if not isinstance(known, DataFrame):
        known = spark.createDataFrame(list(known), "license string, text string")
    texts = (
        known.select(F.col("license"), _flat(canonical_lines(F.col("text"))).alias("unit"))
        .filter("unit <> '' AND license IS NOT NULL")
        .select("license", F.md5("unit").alias("digest"), F.length("unit").alias("n"))
    )
    facts = texts.agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.collect_set("n").alias("lengths"), F.sum(F.length("license") + 200).alias("bytes")
    ).first()
    digests = texts.select("license", "digest").unionByName(
        spark.range(1).select(F.lit(None).cast("string").alias("license"), F.lit("").alias("digest"))
    )
    small = (facts["bytes"] or 0) <= broadcast_bytes
    rows = computed(
        docs.select(F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("key"), F.col(text).alias("_text")),
        ["doc_id", "key"],
        lines=canonical_lines(F.col("_text")),
    )
    # Each paragraph and line is made single-spaced once, inside the array, before the explode;
    # the whole text comes as one more unit with a flag. Equal digests have equal lengths, so
    # other units aren't hashed. The empty unit (flag false) is each document's own row.
    cleaned = F.array_distinct(
        F.transform(F.concat(F.split("lines", GAPS), F.split("lines", r"\n")), lambda part: _flat(part))
    )
    units = F.array_distinct(
        F.concat(
            F.array(F.struct(_flat(F.col("lines")).alias("unit"), F.lit(True).alias("is_whole"))),
            F.transform(cleaned, lambda u: F.struct(u.alias("unit"), F.lit(False).alias("is_whole"))),
            F.array(F.struct(F.lit("").alias("unit"), F.lit(False).alias("is_whole"))),
        )
    )
    unit, lengths = F.col("u.unit"), facts["lengths"]
    possible = F.length(unit).between(F.lit(facts["least"] or 0), F.lit(facts["most"] or -1))
    if 0 < len(lengths) <= LENGTHS:
        possible &= F.length(unit).isin(lengths)
    digest = F.when(unit == "", F.when(~F.col("u.is_whole"), F.lit(""))).when(possible, F.md5(unit))
    found = rows.select("doc_id", "key", F.explode(units).alias("u")).select(
        "doc_id", "key", F.col("u.is_whole").alias("is_whole"), digest.alias("digest")
    )
    hits = found.join(F.broadcast(digests) if small else digests, "digest")
    named = F.col("license").isNotNull()
    return (
        hits.groupBy("doc_id", "key")
        .agg(
            F.array_sort(F.collect_set("license")).alias("licenses"),
            F.coalesce(F.max(F.when(named, F.col("is_whole"))), F.lit(False)).alias("whole"),
            F.count_if(~named).alias("copies"),
        )
        .select("doc_id", "licenses", "whole", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .drop("copy")
    )
