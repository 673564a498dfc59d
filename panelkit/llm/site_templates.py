"""Main text of web pages by removing what a site's pages share.

Every page is read into its element subtrees. Subtrees that hold text are hashed and
counted per host, by the number of different other contents beside which they stand,
so copies of a page count once. What stands beside many contents of a host is its
template and is deleted. Inside an article the rest of the article is the other content,
so copies of an article do not count, however their surroundings vary; as articles share
passages, a template must be in half of the host's pages there. Lists of links inside an
article count by page.

Elements whose tag, class or role says what they are (menus, adverts, forms, comments
...) go with them, but not when they hold the article. What is left is the text of the
articles if they have a good part of it, else of the main element, else of the page.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.names import free_names
from panelkit.llm.workers import tidy
from panelkit.session import materialise

# A subtree is a template's when it stands beside this many different contents of its host, and beside this share of
# them or enough; inside an article beside that share.
LEAST_PAGES, LEAST_SHARE, ENOUGH_PAGES, INSIDE_SHARE = 5, 0.05, 100, 0.5
# Articles are the page's text when they have this share of the main element's or the page's.
ROOT_SHARE = 1 / 3
# Rows of a subtree that very many pages have are dealt by this many salts.
SALTS = 64
# Templates of all hosts go to the tasks when there are no more than this; else pages meet them in a join.
SHARED_ROWS = 200_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
CUT_OFF = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
NAMED = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
PART = re.compile(r"[a-z]+|[0-9]+")

# Names of elements and of common classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe xmp noembed noframes template svg math".split())
DROPPED = frozenset("head nav aside form button select footer menu dialog object audio video canvas".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
# An element that starts closes an open one of these, up to the nearest container.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
CONTAINERS = frozenset("table ul ol dl select body html".split())
COMMENTS = frozenset("comment comments reply replies disqus".split())
MARKED = COMMENTS | frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar aside complementary footer contentinfo cookie cookies consent gdpr notice notices popup modal "
    "newsletter subscribe subscription signup share sharing social related recommended search pagination pager toolbar skip".split())
MARKED_OUTSIDE = MARKED | frozenset("header masthead banner topbar alert".split())
# Words that say nothing of their own in a class such as "cookie-box"; with any other word the class is another thing.
PLACES = frozenset(
    "top bottom left right main primary secondary site page global box block bar wrap wrapper container section area list link "
    "links button buttons widget item items inner group row col column banner content form icon icons form thread post".split())
# Elements that go by their tag unless they hold the article.
LOOSE = frozenset("form dialog menu header".split())


def number_of(text: str) -> int:
    """A signed 64-bit hash."""
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def marks_of(attributes: str, marked: frozenset[str]) -> set[str]:
    """The marked words of classes, ids and roles that consist of marked words and places only."""
    found: set[str] = set()
    for value in NAMED.findall(attributes):
        for name in value.strip("\"'").lower().split():
            parts = [p for p in PART.findall(name) if not p.isdigit()]
            words = marked.intersection(parts)
            if words and all(p in marked or p in PLACES for p in parts):
                found |= words
    return found


class _Element:
    __slots__ = ("above", "attributes", "chars", "dropped", "end", "first", "hash", "level", "link_chars", "parts", "root", "tag")

    def __init__(self, tag: str, attributes: str, above: int, level: int, first: int) -> None:
        self.tag, self.attributes, self.above, self.level = tag, attributes, above, level
        # Segments of the element, and the first article or main element that it holds.
        self.first, self.end, self.root = first, first, -1
        self.parts: list[str] = []
        self.chars = self.link_chars = self.hash = 0
        self.dropped = False


class Page:
    """The text of one page and its subtrees that can be a template's; ``template`` holds the hashes to leave out."""

    def __init__(self, html: str, template: frozenset[int] | set[int] = frozenset()) -> None:
        self.elements = [_Element("", "", -1, 0, 0)]
        # Texts with their elements; no text is the end of a block.
        self.segments: list[tuple[str | None, int]] = []
        self._stack = [0]
        self._read(html)
        self._close_to(1)
        self._break()
        self.elements[0].end = len(self.segments)
        self._drop(template)
        self.blocks = list(self._blocks())

    @property
    def text(self) -> str:
        """The blocks of articles if they have a good part of what is around them, else of the main element or the page."""
        sizes = [0, 0, 0]
        for level, block, _, _ in self.blocks:
            for i in range(level + 1):
                sizes[i] += len(block)
        around = 1 if any(level == 1 for level, *_ in self.blocks) else 0
        level = 2 if sizes[2] and sizes[2] >= ROOT_SHARE * sizes[around] else around
        return "\n\n".join(block for at, block, _, _ in self.blocks if at >= level)

    def candidates(self, page: int) -> set[tuple[int, int]]:
        """Hashes of subtrees, the last bit set for those of prose inside an article, and of what stands beside them.

        ``page`` tells pages apart, for lists of links inside an article.
        """
        out = set()
        begins, ends = [first for *_, first, _ in self.blocks], [end for *_, end in self.blocks]
        # Sums of the hashes of the first blocks, all of them and those inside an article or main element.
        every, within = [0], [0]
        for level, block, _, _ in self.blocks:
            number = number_of(block)
            every.append(every[-1] + number)
            within.append(within[-1] + (number if level else 0))
        for e in self.elements[1:]:
            if e.dropped or not e.chars or e.tag in ("html", "body", "head", "article", "main"):
                continue
            inside = e.level > 0
            if inside and e.tag not in BLOCK:
                continue
            if inside and 2 * e.link_chars >= e.chars:
                out.add((e.hash & -2, page))
                continue
            sums = within if inside else every
            covered = sums[bisect_left(begins, e.end)] - sums[min(bisect_right(ends, e.first), bisect_left(begins, e.end))]
            beside = (sums[-1] - covered + (1 << 63)) % (1 << 64) - (1 << 63)
            out.add((e.hash | 1 if inside else e.hash & -2, beside))
        return out

    def _read(self, html: str) -> None:
        at = 0
        while True:
            found = TOKEN.search(html, at)
            if found is None:
                rest = html[at:]
                cut = CUT_OFF.search(rest)
                self._text(rest[:cut.start()] if cut else rest)
                return
            if found.start() > at:
                self._text(html[at:found.start()])
            at = found.end()
            if found[2] is None:
                continue
            tag = found[2].lower()
            if found[1]:
                self._end(tag)
            elif tag in RAW:
                if not found[3].endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                    at = end.end() if end else len(html)
            else:
                self._start(tag, found[3])

    def _text(self, raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        if not text:
            return
        top = self.elements[self._stack[-1]]
        plain = " ".join(text.split())
        if plain:
            top.parts.append(plain)
            top.chars += len(plain)
        self.segments.append((text, self._stack[-1]))

    def _break(self) -> None:
        if self.segments and self.segments[-1][0] is not None:
            self.segments.append((None, self._stack[-1]))

    def _start(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag == "hr":
                self._break()
            elif tag == "br":
                self.segments.append(("\n", self._stack[-1]))
            return
        if tag in CLOSES:
            self._imply(CLOSES[tag], CONTAINERS)
        if tag in BLOCK:
            self._imply({"p"}, CONTAINERS | {"button"})
            self._break()
        above = self._stack[-1]
        level = max(self.elements[above].level, 2 if tag == "article" else 1 if tag == "main" else 0)
        self._stack.append(len(self.elements))
        self.elements.append(_Element(tag, attributes, above, level, len(self.segments)))
        if attributes.endswith("/") and tag not in BLOCK:
            self._close()

    def _imply(self, tags: set[str], barrier: frozenset[str]) -> None:
        for i in range(len(self._stack) - 1, 0, -1):
            tag = self.elements[self._stack[i]].tag
            if tag in tags:
                self._close_to(i)
            elif tag in barrier:
                return

    def _end(self, tag: str) -> None:
        for i in range(len(self._stack) - 1, 0, -1):
            if self.elements[self._stack[i]].tag == tag:
                self._close_to(i)
                return

    def _close_to(self, depth: int) -> None:
        while len(self._stack) > depth:
            self._close()

    def _close(self) -> None:
        number = self._stack[-1]
        done = self.elements[number]
        if done.tag in BLOCK:
            self._break()
        self._stack.pop()
        done.end = len(self.segments)
        done.hash = number_of(f"{done.tag}({''.join(done.parts)})")
        done.parts = []
        if done.tag == "a":
            done.link_chars = done.chars
        if done.tag in ("article", "main"):
            done.root = number
        above = self.elements[done.above]
        above.parts.append(f"[{done.hash}]")
        above.chars += done.chars
        above.link_chars += done.link_chars
        if done.root >= 0 and (above.root < 0 or done.root < above.root):
            above.root = done.root

    def _drop(self, template: frozenset[int] | set[int]) -> None:
        """Mark what is no part of the text, from the outermost elements on."""
        whole = self.elements[0].chars - sum(e.chars for e in self.elements[1:] if e.tag in DROPPED and e.tag not in LOOSE)
        first_root = self.elements[0].root
        # Without an article or main element the largest part of the text stays, whatever it is called.
        most = 0.5 * whole if first_root < 0 else float("inf")
        for e in self.elements[1:]:
            e.dropped = self.elements[e.above].dropped
            if e.dropped or e.tag in ("html", "body", "article", "main"):
                continue
            if e.tag in DROPPED or e.tag == "header" and not e.level:
                e.dropped = e.tag not in LOOSE or not (e.root >= 0 or e.chars > most)
            elif e.attributes and (marks := marks_of(e.attributes, MARKED if e.level else MARKED_OUTSIDE)):
                # Comments may be articles themselves, and longer than the article.
                if marks <= COMMENTS:
                    e.dropped = e.root < 0 or e.root != first_root
                else:
                    e.dropped = e.root < 0 and e.chars <= most
            if not e.dropped and template:
                inside = e.level > 0 and 2 * e.link_chars < e.chars
                e.dropped = (e.hash | 1 if inside else e.hash & -2) in template and (not e.level or e.tag in BLOCK)

    def _blocks(self) -> Iterator[tuple[int, str, int, int]]:
        """Level, text and segments of every block."""
        texts: list[str] = []
        level = first = 0
        for i, (text, at) in enumerate(self.segments):
            e = self.elements[at]
            if text is None:
                block = " ".join("".join(texts).split())
                if block:
                    yield level, block, first, i
                texts, level, first = [], 0, i + 1
            elif not e.dropped:
                texts.append(text)
                level = max(level, e.level)


def host_of(url: Column) -> Column:
    """The host name of a URL in lower case without login and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _page_key(url: Column, html: Column) -> Column:
    return F.xxhash64(url, html)


def subtrees(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Rows ``host`` (its hash), ``hash``, ``beside`` and ``page``: the different subtrees of each page, and what they stand beside."""
    page, source = F.col(f"`{html}`"), F.col(f"`{url}`")
    rows = pages.select(F.xxhash64(host_of(source)).alias("host"), _page_key(source, page).alias("page"), page.alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = [], []
            for key, html in zip(batch.column("page").to_pylist(), batch.column("html").to_pylist()):
                own = Page(html).candidates(key) if html else ()
                found.extend(own)
                sizes.append(len(own))
            both = np.array(found, np.int64).reshape(len(found), 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("host").to_numpy(), sizes)), pa.array(both[:, 0]), pa.array(both[:, 1]),
                 pa.array(np.repeat(batch.column("page").to_numpy(), sizes))], ["host", "hash", "beside", "page"])
        tidy()

    return rows.mapInArrow(run, "host long, hash long, beside long, page long")


def site_templates(nodes: DataFrame, hosts: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE,
                   inside_share: float = INSIDE_SHARE) -> DataFrame:
    """Rows ``host`` and ``hash`` of subtrees beside many different contents; ``hosts`` has ``host`` and its number ``pages``.

    Equal rows are merged in the tasks and by a shuffle, then counts are summed in the
    tasks before they are shuffled.
    """
    different = nodes.select("host", "hash", "beside").distinct()
    often = different.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages)
    inside = F.col("hash").bitwiseAND(F.lit(1)) == 1
    needed = F.when(inside, F.col("pages") * inside_share).otherwise(F.least(F.col("pages") * least_share, F.lit(float(ENOUGH_PAGES))))
    return often.join(hosts, "host").where(F.col("n") >= needed).select("host", "hash")


def _texts(rows: DataFrame, html: str, host: str, out: str, shared: dict[int, frozenset[int]]) -> DataFrame:
    """Add the texts of pages; the templates of all hosts are in ``shared``, whose size was looked at."""
    templates = rows.sparkSession.sparkContext.broadcast(shared)
    schema = T.StructType([f for f in rows.schema.fields if f.name != host] + [T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none: frozenset[int] = frozenset()
        for batch in batches:
            texts = [Page(h, templates.value.get(at, none)).text if h else ""
                     for at, h in zip(batch.column(host).to_pylist(), batch.column(html).to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in schema.names[:-1]), pa.array(texts, pa.string())], schema.names)
        tidy()

    return rows.mapInArrow(run, schema)


@F.pandas_udf(T.StringType())
def _main_text(html: pd.Series, template: pd.Series) -> pd.Series:
    return pd.Series([Page(h, frozenset(t) if t is not None else frozenset()).text if h else "" for h, t in zip(html, template)], dtype=object)


def extract(pages: DataFrame, url: str = "url", html: str = "html", out: str = "text", least_pages: int = LEAST_PAGES,
            least_share: float = LEAST_SHARE, inside_share: float = INSIDE_SHARE, shared_rows: int = SHARED_ROWS) -> DataFrame:
    """Add the main text ``out`` of every page.

    Blocks are joined by an empty line in page order; white space inside a block
    is one space. A null or empty page has an empty text, a page without a URL
    counts for the host ''. Equal rows stay separate rows, an empty frame stays
    empty. Other columns pass through, whatever their names; one named ``out`` is refused.

    Up to ``shared_rows`` templates of all hosts are sent to the tasks, which read the
    pages where they are; when there are more, every page meets its own in a join.
    """
    if out in pages.columns:
        raise ValueError(f"the frame already has a column {out}")
    source, page = F.col(f"`{url}`"), F.col(f"`{html}`")
    nodes = subtrees(pages, url, html)
    host = F.xxhash64(host_of(source))
    hosts = pages.select(host.alias("host"), F.xxhash64(page).alias("content")).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    shared = materialise(site_templates(nodes, hosts, least_pages, least_share, inside_share), "templates")
    key, found = free_names([*pages.columns, out], "_page", "_template")
    if shared.count() <= shared_rows:
        known: dict[int, set[int]] = {}
        for row in shared.toLocalIterator():
            known.setdefault(row.host, set()).add(row.hash)
        return _texts(pages.withColumn(key, host), html, key, out, {h: frozenset(t) for h, t in known.items()})
    # Pages with one key have the same rows, or get the other's templates as well, of which they hold none.
    salted = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = nodes.withColumn("salt", F.pmod("page", F.lit(SALTS)).cast("int")).join(salted, ["host", "hash", "salt"])
    per_page = own.groupBy(F.col("page").alias(key)).agg(F.collect_set("hash").alias(found))
    joined = pages.withColumn(key, _page_key(source, page)).join(per_page, key, "left")
    return joined.select(*[F.col(f"`{c}`") for c in pages.columns], _main_text(page, F.col(found)).alias(out))
