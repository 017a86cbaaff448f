"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree of elements (tag, classes, id), as counts:
per element, how often each arrangement of children (presentation) and each text
outside links (content) occurs. The entropy of these counts, against that of as many
different pages, is the element's importance. Branches of low importance, which look
and read alike on every page, are removed from each page.

Hosts with few pages say nothing about what repeats, and some branches differ on every
page though they aren't the article. So an element's role (navigation, footer, form,
advert, comments ...) also removes it, and an article or main element, where there is
one, bounds the text. A class or id names a role as a whole, not by one of its words,
and removes no element that holds an article, other than replies to another one. Inside,
branches are judged against their article, so boxes that all articles share are removed,
but not the text of articles that are copies. An article that is alike on all pages gives
way to others, or to a longer text outside that differs.

Counts are summed in the tasks first, then by a shuffle of narrow rows; a host with
any share of the pages is one row per element and text. The pages meet their host's
low elements by a broadcast of measured size, or by a join on the host beyond it.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, ship, stored
from .url_filter import split_url

# Importance below which a branch is removed, share of content in it, and the pages an
# element must be on before it is judged.
LOW = 0.2
CONTENT_SHARE = 0.9
LEAST_PAGES = 8

# Element names with a meaning here, and words in class, id or role that tell what
# isn't article text; fixed values.
BLOCKS = frozenset(
    "html body div article main section nav header footer aside form ul ol li dl dt dd table caption thead tbody "
    "tfoot tr td th p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption address details summary fieldset hr "
    "center menu dialog hgroup search".split()
)
SKIPPED = frozenset("script style noscript template iframe object svg math canvas audio video textarea title select button".split())
BREAKS = frozenset(("br", "wbr", "img", "input"))
ROLE_TAGS = frozenset("nav footer aside form menu dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
ROLE_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar ad ads adv advert adverts advertisement "
    "advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay newsletter subscribe subscription signup login comment comments commentlist reply "
    "replies respond disqus share sharing social related recommended recommendations widget toolbar pagination "
    "pager skip copyright masthead".split()
)
# A class or id names a role if it is made of role words and these.
ROLE_PLACES = frozenset("site top bottom global primary secondary list area bar block box item items links container wrapper wrap unit slot inner".split())
# Roles of articles that are no main text where the page has another one.
REPLIES = frozenset("comment comments commentlist reply replies respond disqus related recommended recommendations".split())
CONTENT_TAGS = frozenset(("article", "main"))
# The path up to the innermost article or main.
BOUND = r"(?s)^(.*/(?:article|main)(?:[.#][^/]*)?)(?=/|$)"
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What an opening element ends if it is still open, up to the elements that enclose it.
ENDS = {name: {"p"} for name in BLOCKS} | {
    "li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "tr": {"p", "tr", "td", "th"},
    "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "tbody": {"p", "tr", "td", "th", "thead", "tbody"},
}
FENCES = frozenset("ul ol dl table div section article main aside nav footer header form body blockquote td th".split())

_MARK = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
    re.DOTALL,
)
_NAMED = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_NUMBER = re.compile(r"\d+")


@dataclass
class Element:
    """An open element: its path in the tree, and what its place says about text.
    ``content`` is the depth of the innermost article or main, 0 without one. ``named``
    is the role its class or id names: 2 for replies, 1 for another; ``wraps``, whether
    it is or holds an article or main."""

    name: str
    path: str
    dropped: bool
    content: int
    named: int = 0
    wraps: bool = False
    children: list[str] = field(default_factory=list)


@dataclass
class Block:
    """A block's text with the open elements, and the part of it outside links."""

    text: str
    own: bool
    dropped: bool
    content: int
    heading: bool
    paths: tuple[str, ...]


def _named(value: str) -> int:
    """The role that a whole class or id names: 2 for replies, 1 for another, 0 for none."""
    most = 0
    for token in value.split():
        words = {w.lower() for w in _WORDS.findall(token)}
        if words & ROLE_WORDS and words <= ROLE_WORDS | ROLE_PLACES:
            most = max(most, 2 if words & REPLIES else 1)
    return most


def _role(name: str, attributes: str) -> tuple[str, bool, int]:
    """An element's key in the tree, whether its tag or role removes it, and the role it names."""
    dropped, key, named = name in ROLE_TAGS, name, 0
    if attributes.strip():
        for attribute, *values in _NAMED.findall(attributes):
            attribute, value = attribute.lower(), "".join(values)
            if attribute == "hidden":
                dropped = True
            elif attribute == "role":
                dropped |= value.strip().lower() in ROLES
            else:
                named = max(named, _named(value))
                key += ("." if attribute == "class" else "#") + _NUMBER.sub("0", ".".join(value.split())).replace("/", "|")
    page = name in ("html", "body")
    return key, dropped and not page, 0 if page else named


def parse(page: str) -> tuple[list[Block], dict[str, str]]:
    """Blocks in page order, and per element of the tree its arrangement of children.

    Unclosed and wrongly nested elements are closed as a browser would, roughly: a block
    ends an open paragraph, an item the item before it, an end tag all that is open
    inside. Elements within a line (``b``, ``a``, ...) don't end a block.
    """
    root = Element("", "", False, 0)
    stack, blocks, arranged = [root], [], {}
    named_above: list[tuple[Block, list[Element]]] = []
    pieces: list[str] = []
    links, link_chars, chars, at, size = 0, 0, 0, 0, len(page)

    def close(depth: int) -> None:
        for element in stack[depth:]:
            arranged[element.path] = arranged.get(element.path, "") + ">" + ",".join(element.children)
        del stack[depth:]

    def flush() -> None:
        nonlocal chars, link_chars
        if pieces:
            raw = "".join(pieces)
            text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if text:
                top = stack[-1]
                heading = any(e.name in HEADINGS for e in stack)
                blocks.append(
                    Block(text, chars > link_chars, top.dropped, top.content, heading, tuple(e.path for e in stack[1:]))
                )
                if not top.dropped and (named := [e for e in stack if e.named]):
                    named_above.append((blocks[-1], named))
            pieces.clear()
        chars = link_chars = 0

    def add(text: str) -> None:
        nonlocal chars, link_chars
        if text:
            pieces.append(text)
            n = len(text.strip())
            chars += n
            link_chars += n if links else 0

    while at < size:
        mark = _MARK.search(page, at)
        if mark is None:
            rest = page[at:]
            # A tag that the page ends in is not text.
            torn = rest.rfind("<")
            add(rest[:torn] if torn >= 0 and re.match(r"</?[a-zA-Z!]", rest[torn:]) and ">" not in rest[torn:] else rest)
            break
        add(page[at : mark.start()])
        at, name = mark.end(), (mark[2] or "").lower()
        if not name:
            continue
        if mark[1]:
            if name == "a":
                links = max(0, links - 1)
            elif name in BLOCKS:
                flush()
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].name == name:
                        close(depth)
                        links = 0
                        break
        elif name in SKIPPED:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
        elif name == "a":
            links += 1
        elif name in BREAKS:
            add(" ")
        elif name in BLOCKS:
            flush()
            links = 0
            ended = ENDS[name]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name in ended:
                    close(depth)
                    break
                if stack[depth].name in FENCES:
                    break
            if name == "hr":
                continue
            above = stack[-1]
            key, dropped, named = _role(name, mark[3])
            content = len(stack) if name in CONTENT_TAGS else above.content
            if name == "header" and not any(e.name in CONTENT_TAGS for e in stack):
                dropped = True
            above.children.append(key)
            stack.append(Element(name, f"{above.path}/{key}", above.dropped or dropped, content, named))
            if name in CONTENT_TAGS:
                for element in stack:
                    element.wraps = True
    flush()
    close(1)
    # Named roles remove elements without an article; articles only as replies to another one.
    replies = []
    for block, named in named_above:
        block.dropped = any(not e.wraps for e in named)
        if not block.dropped and any(e.named == 2 for e in named):
            replies.append(block)
    apart = {id(block) for block in replies}
    if replies and any(b.content and not b.dropped and id(b) not in apart for b in blocks):
        for block in replies:
            block.dropped = True
    return blocks, arranged


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def style_rows(page: str) -> Iterator[tuple[str, int, int]]:
    """Per element of the page's tree: path, digest of its presentation and of its
    content (the text below it, in articles also that of links; 0 without any)."""
    blocks, arranged = parse(page)
    content: dict[str, int] = dict.fromkeys(arranged, 0)
    for block in blocks:
        if block.own or block.content:
            value = _digest(block.text)
            for path in set(block.paths):
                content[path] = (content[path] * 1_000_003 + value) & 0x7FFFFFFFFFFFFFFF
    for path, children in arranged.items():
        yield path, _digest(children), content[path]


def main_text(page: str | None, low: Iterable[str] = ()) -> str:
    """The article's blocks, joined by an empty line, without the ``low`` branches.

    Elements around an article or main are never low for it. Where each one on the page
    is low itself, a longer text outside of them is taken.
    """
    if not page:
        return ""
    blocks, _ = parse(page)
    kept = [b for b in blocks if not b.dropped]
    low = set(low)
    inside = [b for b in kept if b.content]
    outside = [b for b in kept if not b.content and not low.intersection(b.paths)]
    chosen = [b for b in inside if not low.intersection(b.paths[b.content - 1 :])]
    if not inside:
        chosen = outside
    elif all(b.paths[b.content - 1] in low for b in inside):
        chosen = [b for b in inside if not low.intersection(b.paths[b.content :])]
        if sum(len(b.text) for b in outside) > sum(len(b.text) for b in inside):
            chosen = outside
    return "\n\n".join(b.text for b in chosen)


def _count_styles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("host", "path", "kind", "value", "n")
    for batch in batches:
        counts: Counter = Counter()
        for host, page in zip(batch["host"], batch["html"], strict=True):
            host, page = host.as_py(), page.as_py()
            if page:
                for path, style, content in style_rows(page):
                    counts[host, path, 0, style] += 1
                    if content:
                        counts[host, path, 1, content] += 1
        if counts:
            columns = list(zip(*[(*key, n) for key, n in counts.items()], strict=True))
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def importance(pages: DataFrame) -> DataFrame:
    """Importance of the elements of each host: ``host, path, pages, importance``.

    An element's entropies are divided by that of as many pages that all differ; content
    weighs ``CONTENT_SHARE``, presentation the rest. ``pages`` are those with content,
    where there are any.
    """
    styles = pages.select("host", "html").mapInArrow(
        _count_styles, "host string, path string, kind int, value bigint, n bigint"
    )
    each = styles.groupBy("host", "path", "kind", "value").agg(F.sum("n").alias("n"))
    entropy = F.log(F.sum("n").cast("double")) - F.sum(F.col("n") * F.log(F.col("n").cast("double"))) / F.sum("n")
    kinds = each.groupBy("host", "path", "kind").agg(F.sum("n").alias("pages"), entropy.alias("entropy"))
    share = F.when(F.col("kind") == 1, CONTENT_SHARE).otherwise(1 - CONTENT_SHARE)
    most = F.log(F.greatest(F.col("pages"), F.lit(2)).cast("double"))
    return kinds.groupBy("host", "path").agg(
        F.coalesce(F.max(F.when(F.col("kind") == 1, F.col("pages"))), F.max("pages")).alias("pages"),
        F.sum(share * F.col("entropy") / most).alias("importance"),
    )


def low_branches(judged: DataFrame, low: float) -> DataFrame:
    """``host, path`` of the elements whose importance is low.

    What is inside an article or main is compared with that element's importance, and
    such an element with the greatest of its host; all else with 1.
    """
    rows = judged.withColumn("bound", F.regexp_extract("path", BOUND, 1))
    bounds = rows.filter("path = bound").select("host", "bound", F.col("importance").alias("whole"))
    tops = rows.groupBy("host").agg(F.max("importance").alias("top"))
    weak = rows.filter(F.col("importance") < low).join(bounds, ["host", "bound"], "left").join(tops, "host")
    against = F.when(F.col("bound") == "", 1.0).otherwise(
        F.coalesce(F.when(F.col("path") != F.col("bound"), F.col("whole")), F.col("top"))
    )
    return weak.filter(F.col("importance") < low * against).select("host", "path")


def extract_text(
    pages: DataFrame,
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    low: float = LOW,
    least_pages: int = LEAST_PAGES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Main text of every page: ``page_id, url, text``, one row per input row.

    NULL, empty and text-free pages give an empty text; plain text without markup is
    itself the text. A NULL URL, or one without a host, belongs to the host ``''``.
    Repeated rows get equal texts; empty tables give no rows; other columns are ignored.
    """
    ship(pages.sparkSession)
    host, _ = split_url(F.coalesce(F.col("url"), F.lit("")))
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")
    ).withColumn("host", host)
    judged = stored(importance(rows).filter(F.col("pages") >= least_pages), "style-importance")
    weak = stored(
        low_branches(judged, low)
        .groupBy("host")
        .agg(F.array_sort(F.collect_list("path")).alias("low")),
        "style-trees",
    )
    size = weak.agg(F.sum(F.length("host") + F.length(F.concat_ws(" ", "low")) * 2 + 100)).first()[0] or 0

    @F.arrow_udf("string")
    def text(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for markup, branches in batches:
            yield pa.array(
                [main_text(m.as_py(), b.as_py() or ()) for m, b in zip(markup, branches, strict=True)], pa.string()
            )

    joined = rows.join(F.broadcast(weak) if size <= broadcast_bytes else weak, "host", "left")
    return joined.select("page_id", "url", text("html", "low").alias("text"))
