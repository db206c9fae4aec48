"""Main text of web pages, with the site's templates removed.

A page is parsed once into text blocks.  Elements that never belong to an
article (menus, footers, asides, forms, scripts, adverts, notices, comments
...) are left out by tag, role or class.  Of what remains, the blocks of the
page's ``article`` count, else of its ``main``, else of its body.

Around each block stay the hashes of the element subtrees that may be template:
containers and classed elements (in a page without article or main, any
element).  Spark counts them per host, over pages of different content; a subtree
that stands on ``MANY_PAGES`` of them is deleted from every page of its host,
whatever its share of the host's pages or of a page's text.  Plain paragraphs of
an article are never template, however often they recur.

A class, id or role marks what is no article only by one of its whole names
(``share-price-table`` is not ``share``), and inside an article only by names that
mean one thing (comments, adverts, menus, forms of subscription): text that may be
the article's stays.

Null or empty html gives an empty text; a null or odd url has no host and only
the first step; markup that ends early or nests wrongly is closed the way
browsers do it, roughly; repeated rows give equal rows and count as one page of
their host; very long pages are parsed whole; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, read

#: A template stands on so many different pages of its host.
MANY_PAGES = 5

# Names of HTML elements.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
DROPPED = RAW | frozenset("head nav footer aside form button select option input dialog menu object "
                          "canvas audio video map label legend fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr br nobr".split())
CELLS = frozenset(("td", "th", "br"))
CONTAINERS = frozenset("div section ul ol dl table figure details center header".split())
CLOSES_ITSELF = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",)}
# Names in a class, id or role that mark what is never article ...
ALWAYS = frozenset("ad ads advert adverts advertisement advertising ad-box ad-slot ad-banner sponsored cookie cookies "
                   "cookie-notice cookie-banner cookie-consent gdpr popup modal navbar nav menu navigation breadcrumb "
                   "breadcrumbs sidebar comment comments comment-list respond disqus disqus_thread footer masthead "
                   "social share sharing share-buttons social-share newsletter newsletter-signup subscribe pagination "
                   "contentinfo complementary dialog search related related-posts promo".split())
# ... and those that mark it outside an article or a main element only.
OUTSIDE = frozenset("sponsor banner consent notice notices alert overlay login widget toolbar pager subscription form "
                    "side-bar left-sidebar right-sidebar main-menu top-menu site-footer page-footer site-nav main-nav "
                    "site-notice site-banner".split())
PAGE_HEADS = frozenset(("header", "topbar"))

TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|!\[CDATA\[(.*?)(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)"
                 r"|(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class _Element:
    __slots__ = ("tag", "dropped", "article", "main", "candidate", "begin")

    def __init__(self, tag: str, parent: _Element | None):
        self.tag = tag
        self.dropped = parent is not None and parent.dropped
        self.article = parent is not None and parent.article
        self.main = parent is not None and parent.main
        self.candidate = self.begin = 0


def _marked(tag: str, attributes: str, element: _Element) -> tuple[bool, bool, bool]:
    """Whether the element is to be dropped, is a main element, has a class."""
    drop = is_main = classed = False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id", "role"):
            classed = True
            names = set(value.split())
            is_main |= name == "role" and value == "main"
            drop |= not ALWAYS.isdisjoint(names)
            drop |= not (element.article or element.main) and not (OUTSIDE | PAGE_HEADS).isdisjoint(names)
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            drop = True
        elif name == "style" and "display:none" in value.replace(" ", ""):
            drop = True
    return drop and tag not in ("html", "body", "article", "main"), is_main, classed


def parse(html: str | None) -> tuple[list[tuple[str, list[int]]], int]:
    """Blocks of a page's main text, each with the hashes of its candidate
    subtrees, and a hash of that text."""
    html = html or ""
    root = _Element("", None)
    stack, blocks, tokens = [root], [], []
    hashes: dict[int, int] = {}     # candidate -> hash
    inside: dict[int, bool] = {}    # candidate -> may count in a page with an article
    buffer: list[str] = []

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                top = stack[-1]
                tokens.append(text)
                blocks.append((text, 2 if top.article else 1 if top.main else 0,
                               [e.candidate for e in stack if e.candidate]))

    def close(depth: int) -> None:
        """Close all elements above ``depth``."""
        flush()
        while len(stack) > depth:
            e = stack.pop()
            if e.candidate:
                hashes[e.candidate] = xxhash.xxh3_64_intdigest("\x00".join(tokens[e.begin:])) - (1 << 63)

    def depth_of(tag: str, until: tuple[str, ...] = ()) -> int:
        """Where the innermost open element of that name is; 0: nowhere."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == tag:
                return i
            if stack[i].tag in until:
                return 0
        return 0

    at, end = 0, len(html)
    while at < end:
        m = TAG.search(html, at)
        text = html[at:m.start()] if m else html[at:]
        if text and not stack[-1].dropped:
            buffer.append(unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        if m[1] is not None and not stack[-1].dropped:
            buffer.append(m[1])
        if not m[3]:
            continue
        tag = m[3].lower()
        if m[2]:
            if tag in INLINE:
                i = depth_of(tag, ("p", "div", "li", "tr", "article", "section"))
                if i:
                    del stack[i]
                continue
            if tag in CELLS:
                if not stack[-1].dropped:
                    buffer.append(" ")
                continue
            i = depth_of(tag)
            if i:
                close(i)
            elif tag == "p":
                flush()
            continue
        if tag in RAW:
            if not (tag in ("svg", "math") and m[4].endswith("/")):
                done = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                at = done.end() if done else end
            continue
        if tag in INLINE and not (m[4] and ("class" in m[4] or "id" in m[4] or "hid" in m[4] or "style" in m[4])):
            if tag == "br" and not stack[-1].dropped:
                buffer.append(" ")
            continue
        if tag not in INLINE:
            i = depth_of("p", ("table", "article", "body"))
            if i:
                close(i)
            if tag in CLOSES_ITSELF:
                i = depth_of(tag, CLOSES_ITSELF[tag])
                if i:
                    close(i)
            if tag == "body" or tag == "article":
                i = depth_of("head")
                if i:
                    close(i)
            if tag in CELLS:        # cells of a row stay in one block
                if not stack[-1].dropped:
                    buffer.append(" ")
                continue
            flush()
        if tag in VOID:
            continue
        parent = stack[-1]
        e = _Element(tag, parent)
        drop, is_main, classed = _marked(tag, m[4], e) if m[4] else (False, False, False)
        e.dropped |= drop or tag in DROPPED or (tag == "header" and not (e.article or e.main))
        e.article |= tag == "article" and not e.dropped
        e.main |= (tag == "main" or is_main) and not e.dropped
        if not e.dropped and tag not in ("html", "body", "article", "main") and tag not in INLINE:
            e.candidate, e.begin = len(inside) + 1, len(tokens) + 1
            inside[e.candidate] = classed or tag in CONTAINERS
            tokens.append(tag)
        elif not e.dropped and tag not in INLINE:
            tokens.append(tag)
        stack.append(e)
    close(1)
    best = max((kind for _, kind, _ in blocks), default=0)
    chosen = [(text, own) for text, kind, own in blocks if kind == best]
    out = [(text, [hashes[c] for c in own if best == 0 or inside[c]]) for text, own in chosen]
    return out, xxhash.xxh3_64_intdigest("\n".join(t for t, _ in out)) - (1 << 63)


BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("subtrees", pa.list_(pa.int64()))]))


def _parser(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), 200):
            part = batch.slice(start, 200)
            parsed = [parse(h) for h in part.column(2).to_pylist()]
            blocks = [[{"text": t, "subtrees": s} for t, s in b] for b, _ in parsed]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([c for _, c in parsed], pa.int64()), pa.array(blocks, BLOCKS)],
                names=["page_id", "url", "content", "blocks"])


def host(url: Column) -> Column:
    name = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(name != "", F.lower(name))


def main_text(pages: DataFrame, many: int = MANY_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages (page_id, url, html)``."""
    parsed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        _parser, "page_id long, url string, content long, blocks array<struct<text:string,subtrees:array<long>>>")
    table = keep(parsed.withColumn("host", host(F.col("url"))).withColumn("row", F.monotonically_increasing_id()), "pages")

    trees = F.array_distinct(F.flatten(F.col("blocks.subtrees")))
    found = keep(table.where("host is not null").select("row", "host", "content", F.explode(trees).alias("tree")), "trees")
    templates = (found.select("host", "tree", "content").distinct().groupBy("host", "tree").agg(F.count("*").alias("n"))
                 .where(F.col("n") >= many).select("host", "tree"))
    hits = keep(found.join(templates, ["host", "tree"]).groupBy("row").agg(F.collect_set("tree").alias("gone")), "hits")
    left = F.filter("blocks", lambda b: F.col("gone").isNull() | ~F.arrays_overlap(b["subtrees"], F.col("gone")))
    text = F.concat_ws("\n", F.transform(left, lambda b: b["text"]))
    return (table.join(hits, "row", "left").select("page_id", "url", text.alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read(spark, sf_dir, "pages"))
