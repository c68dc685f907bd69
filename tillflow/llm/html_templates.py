"""Main text of web pages by equivalence classes of template tokens.

A page is read as tokens: each block element with its path, and each block's text at its
path.  A token's occurrence vector says how often each page of the host has it; it is
reduced to a checksum that adds up before the shuffle, so a host with a third of all pages
costs one row for each token and task.  Tokens with equal vectors are an equivalence class.
Classes on ``SUPPORT`` of a host's pages (``MIN_PAGES`` or more) are valid; they nest into
the host's template by the places of their tokens, and a class that crosses a larger one is
dropped.  What the template doesn't fix are its slots.  Slots in parts that are no article by their
element, role or class names (menus, page headers, footers, sidebars, notices, adverts,
forms, comments) are left out; of the rest the article's slots are the text, or all slots
where no element says which is the article.

Text that the template fixes inside an article ("share this") goes, too, unless that is half
of the article or more: then the pages are copies of one article and not a template.  Where
no element says which is the article, it stays only if there is no other text.

Defined results: null pages have no text.  A null or odd url is a host of its own.  Hosts
with few pages have no template and go by names alone.  Repeated rows count as pages.  An
empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import col, stored

SUPPORT, MIN_PAGES = 0.8, 5
MOST_FIXED = 0.5

# Names of the HTML standard and of common page parts.
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_RAW = set("script style textarea title iframe noembed noframes xmp".split())
#: Elements whose content is no text of the page; markup inside them is read as such.
_HIDDEN = set("head noscript template svg math select optgroup option datalist object canvas audio "
              "video button".split())  # fmt: skip
_BLOCK = set("html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre "
             "blockquote table thead tbody tfoot tr td th figure figcaption header footer nav "
             "aside form fieldset address details summary hr".split())  # fmt: skip
_AWAY = {"nav", "footer", "aside", "form", "dialog"}
_ROLES = set("navigation banner contentinfo complementary search alert dialog menu menubar form".split())
_PARTS = set("ad ads advert adverts advertisement adverts sponsor sponsored promo promotion nav "
             "navbar navigation menu sidebar footer cookie cookies consent notice banner popup "
             "modal overlay newsletter subscribe signup comment comments commentlist discussion "
             "replies disqus share sharing social related recommended breadcrumb breadcrumbs "
             "widget toolbar masthead topbar login".split())  # fmt: skip
_WHOLE = set("content main article post entry body layout page wrapper container".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
#: What a start tag closes when it is still open.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}}
_KEEPS = set("article main section div ul ol dl table blockquote nav aside form body".split())


@dataclass
class Block:
    path: str  # a hash of all elements down to the block's own
    text: str
    away: bool
    article: bool


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    elements: list[str] = field(default_factory=list)


def _is_part(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in ("html", "body", "article", "main"):
        return False
    if tag in _AWAY or (tag == "header" and not in_article):
        return True
    if attributes.get("role", "").lower() in _ROLES:
        return True
    for name in ("class", "id"):
        for value in attributes.get(name, "").split():
            words = set(re.split(r"[-_]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower()))
            if words & _PARTS and not words & _WHOLE:
                return True
    return False


def _closed(attributes: str) -> bool:
    """Whether a start tag ends with a slash that is not part of an unquoted value."""
    rest = attributes.rstrip()
    last = rest[:-1].split()[-1:]
    return rest.endswith("/") and not (last and "=" in last[0] and rest[-2] not in "\"' \t\r\n\f")


def read(source: str | None) -> Page:
    """The blocks and block elements of a page, in their order.

    A hidden element lasts until its end tag; without one before the end of its parent, until
    the next block.
    """
    endless: set[int] = set()
    while True:
        page, more = _read(source or "", endless)
        if not more:
            return page
        endless |= more


def _read(text: str, endless: set[int]) -> tuple[Page, set[int]]:
    """The page, and where hidden elements begin that turn out to have no end tag; those in
    ``endless`` are known not to have one."""
    page, more = Page(), set()
    stack: list[tuple[str, str, bool, bool, int]] = []  # tag, path, away, in article, where if hidden or -1
    here: list[str] = []
    at = hidden = 0
    position = ("", False, False)
    raw_ends: dict[str, int] = {}

    def flush() -> None:
        nonlocal here
        value = " ".join(html.unescape("".join(here)).split())
        if value:
            page.blocks.append(Block(position[0], value, position[1], position[2]))
        here = []

    def say(piece: str) -> None:
        if not hidden:
            here.append(piece)

    def cut(k: int) -> None:
        """Close what is open from place ``k`` of the stack on; its own end tag closes the first."""
        nonlocal hidden
        for x in stack[k:]:
            if x[4] >= 0:
                hidden -= 1
                if x[4] not in endless:
                    more.add(x[4])
        del stack[k:]

    while at < len(text):
        found = _TOKEN.search(text, at)
        if found is None:
            say(text[at:])
            break
        if found.start() > at:
            say(text[at : found.start()])
        at = found.end()
        closing, tag = found[1] or found[4], (found[2] or found[5] or "").lower()
        if not tag:
            continue
        source = found[3] or found[6] or ""
        if tag in _RAW:
            if not closing and not _closed(source):
                if raw_ends.get(tag, 0) != len(text) + 1:
                    end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(text, at)
                    if end:
                        at = end.end()
                        continue
                    raw_ends[tag] = len(text) + 1
                if tag in ("script", "style"):
                    at = len(text)
                elif not hidden:  # never closed: the next block ends it
                    endless.add(found.start())
                    stack.append((tag, *(stack[-1][1:4] if stack else ("", False, False)), found.start()))
                    hidden += 1
            continue
        if tag in _HIDDEN:
            if closing:
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
                if k is not None:
                    cut(k + 1)
                    hidden -= 1
                    del stack[k]
            elif not _closed(source) and not (tag == "head" and found.start() in endless):
                stack.append((tag, *(stack[-1][1:4] if stack else ("", False, False)), found.start()))
                hidden += 1
            continue
        if tag == "br":
            say(" ")
        if tag not in _BLOCK:
            continue
        while stack and stack[-1][4] in endless:
            cut(len(stack) - 1)
        if not hidden:
            flush()
        if closing:
            open_at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if open_at is not None:
                cut(open_at)
        else:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][4] >= 0:
                    break
                if stack[k][0] in _CLOSES.get(tag, ()) or (stack[k][0] == "p" and tag not in _VOID):
                    cut(k)
                    break
                if stack[k][0] in _KEEPS:
                    break
            attributes = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(source)}
            parent = stack[-1] if stack else ("", "", False, False, -1)
            label = ".".join([tag, *sorted(attributes.get("class", "").split())])
            path = xxhash.xxh3_128_hexdigest(f"{parent[1]}>{label}".encode("utf-8", "replace"))
            if not hidden:
                page.elements.append(path)
            if tag not in _VOID:
                inside = parent[3] or tag in ("article", "main")
                away = parent[2] or _is_part(tag, attributes, parent[3])
                stack.append((tag, path, away, inside, -1))
        if not hidden:
            position = stack[-1][1:4] if stack else ("", False, False)
    cut(0)
    flush()
    return page, more


def _key(kind: str, *parts: str) -> int:
    return xxhash.xxh64_intdigest("\x00".join((kind, *parts)).encode("utf-8", "replace")) - (1 << 63)


def tokens(page: Page) -> tuple[list[int], list[int], list[int]]:
    """The distinct tokens of a page, how often they occur, and their first places."""
    found = [_key("<", x) for x in page.elements] + [_key("T", b.path, b.text) for b in page.blocks]
    place: dict[int, int] = {}
    for k, x in enumerate(found):
        place.setdefault(x, k)
    counts = Counter(found)
    return list(place), [counts[x] for x in place], list(place.values())


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list] = [[], [], [], [], []]
        for host, row_no, source in zip(*(batch.column(x) for x in ("host", "row_no", "html"))):
            keys, counts, places = tokens(read(source.as_py()))
            for x, y in zip(columns, ([host.as_py()] * len(keys), [row_no.as_py()] * len(keys), keys, counts, places)):
                x += y
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
        yield pa.record_batch(
            [pa.array(x, k) for x, k in zip(columns, kinds)],
            names=["host", "row_no", "token", "n", "place"],
        )


def templates(pages: DataFrame) -> DataFrame:
    """host, classes (first, last, tokens of each valid class) for ``pages`` (host, row_no, html)."""
    seen = pages.mapInArrow(_occurrences, "host string, row_no long, token long, n int, place int")
    vectors = stored(
        seen.groupBy("host", "token").agg(
            F.count("*").alias("pages"),
            F.bit_xor(F.xxhash64("row_no", "n")).alias("vector"),
            F.avg("place").alias("place"),
        ).where(F.col("pages") >= MIN_PAGES),
        "html-vectors",
    )
    hosts = pages.groupBy("host").agg(F.count("*").alias("of_host"))
    valid = vectors.join(hosts, "host").where(F.col("pages") >= SUPPORT * F.col("of_host"))
    classes = valid.groupBy("host", "vector", "pages").agg(
        F.min("place").alias("first"), F.max("place").alias("last"),
        F.collect_list("token").alias("tokens"),
    )
    return stored(
        classes.groupBy("host").agg(
            F.collect_list(F.struct("first", "last", "pages", "tokens")).alias("classes")
        ),
        "html-templates",
    )


def nested(classes: list[dict] | None) -> set[int]:
    """The tokens of a template: classes that nest, the larger ones first."""
    kept: list[dict] = []
    order = sorted(classes or [], key=lambda c: (-c["pages"], c["first"] - c["last"], c["first"]))
    for c in order:
        crosses = any(
            k["first"] < c["first"] < k["last"] < c["last"] or c["first"] < k["first"] < c["last"] < k["last"]
            for k in kept
            if len(k["tokens"]) > len(c["tokens"])
        )
        if not crosses:
            kept.append(c)
    return {x for c in kept for x in c["tokens"]}


def main_text(page: Page, template: set[int]) -> str:
    """The text of a page's content slots."""
    free = [b for b in page.blocks if not b.away]
    inside = [b for b in free if b.article]
    article, inside = bool(inside), inside or free
    fixed = [_key("T", b.path, b.text) in template for b in inside]
    size = sum(len(b.text) for b in inside)
    most = MOST_FIXED * size if article else size
    if sum(len(b.text) for b, f in zip(inside, fixed) if f) < most:
        inside = [b for b, f in zip(inside, fixed) if not f]
    return "\n".join(b.text for b in inside)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, set[int]] = {}
    for batch in batches:
        texts = []
        for host, source, classes in zip(*(batch.column(x) for x in ("host", "html", "classes"))):
            name = host.as_py()
            if name not in known:
                if len(known) > 1000:
                    known.clear()
                known[name] = nested(classes.as_py())
            texts.append(main_text(read(source.as_py()), known[name]))
        yield pa.record_batch({
            "page_id": batch.column("page_id"), "url": batch.column("url"),
            "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64()),
        })


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for each row."""
    host = F.lower(F.regexp_extract(F.coalesce(col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row_no"), host.alias("host"),
        col(page_id).alias("page_id"), col(url).alias("url"), col(source).alias("html"),
    )
    found = templates(rows.select("host", "row_no", "html"))
    kinds = [rows.schema[x].dataType.simpleString() for x in ("page_id", "url")]
    return (
        rows.join(found, "host", "left").select("host", "page_id", "url", "html", "classes")
        .mapInArrow(_extract, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
    )
