"""Main text of web pages by a site style tree.

Whole pages of a host, articles and furniture too, are merged into a style tree: a node is a chain of tags with
their classes. For each node the entropy of its presentation (which child styles it has) and of its content (which texts it has) over the
host's distinct pages gives its importance: a branch that says the same, in the same form, on all pages of a
site is furniture. Branches of low importance are cut from each page; so are branches that are furniture
by their tag, role, class or id (menus, headers, footers, sidebars, notices, adverts, forms, comments). Such a
branch has a node of its own, but counts as a child and not by its texts in the content of the node above.
Inside an <article> or <main> the style tree cuts nothing, because a page that many pages copy is no menu, and no
branch that holds one is cut as a whole; there a
class or id counts only if all of its parts are words of furniture or of position (`ad-box`, not `share-price`),
never on headings, and on paragraphs only as one whole word; what is `hidden` there stays.

Statistics are taken over all pages. Node and content counts are pre-aggregated per (host, node, content),
so a host with a third of all pages is never gathered in one task. The table of cut branches has one short
array per (host, node); it is broadcast if it has been counted to be small and joined by (host, salt) if not.

Defined cases: null or empty html gives an empty text; pages without a host are a site of their own kind
and only the tag and class rules apply; broken and unclosed markup is read as browsers do (an open <p> ends
where a block begins); very long and very deep pages are read whole, with a key of fixed size for each element; rows that repeat are extracted each; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, require, settle

MIN_PAGES = 8
LOW_IMPORTANCE = 0.2
BROADCAST_BRANCHES = 100_000
SALT = 32

#: Element kinds of HTML. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe textarea title xmp".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCK - frozenset(("td", "th", "tr", "tbody", "thead", "tfoot", "body", "html"))
FURNITURE_TAGS = frozenset("nav header footer aside form menu button select dialog head".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
#: Words of class and id attributes that mark furniture. Fixed values.
FURNITURE_WORDS = frozenset((
    "ad ads adv advert adverts advertisement advertising advertorial adsbygoogle banner banners sponsor sponsored sponsors promo promos promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toc header masthead topbar footer foot colophon copyright "
    "sidebar sidebars aside rail widget widgets related recommended recommendations more-links social share sharing follow "
    "cookie cookies consent gdpr notice notices notification alert disclaimer popup modal overlay newsletter subscribe subscription signup login "
    "form search searchbox comment comments commentlist disqus respond reply replies reader-comments discussion"
).split())
#: Parts of class names that say where something stands or what holds it. Fixed values.
POSITION_WORDS = frozenset("area bar block bottom box container content group inner item items left link links list main outer page panel post posts right section site slot text title top unit wrap wrapper".split())
TITLES = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A child of these lists ends an open one of the same list.
SIBLINGS = ({"li"}, {"dt", "dd"}, {"tr"}, {"td", "th"}, {"option"}, {"thead", "tbody", "tfoot"})
KIN = {tag: kin for kin in SIBLINGS for tag in kin}
HOLDERS = frozenset("ul ol dl table select article main section div nav header footer aside form menu button dialog".split())
#: A paragraph around one of these is not ended from inside it.
KEEPS_P = frozenset(("button", "select"))
HTML_TAGS = BLOCK | frozenset("a abbr b bdi bdo cite code data del dfn em i ins kbd label mark q s samp small span strong sub sup time u var font".split())

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
MARKED = re.compile("class|id|role|hidden|style", re.I)
WORDS = re.compile(r"[a-z]+(?:-[a-z]+)*")


class Node:
    """An element of a page; style is a key of its chain of tags and classes."""

    __slots__ = ("tag", "style", "furniture", "main", "holds", "children", "parent")

    def __init__(self, tag: str, style: int, furniture: bool, parent: Node | None):
        self.tag, self.style, self.parent = tag, style, parent
        self.furniture = furniture or (parent is not None and parent.furniture)
        self.main = tag in ("article", "main") or (parent is not None and parent.main)
        self.holds = False  # an article or main that is no furniture
        self.children: list[Node | str] = []


def key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


@lru_cache(1 << 14)
def _style(above: int, own: str) -> int:
    """The key of a chain, from that of the element above."""
    return key(f"{above}>{own}")


def _marked(marks: str, tag: str, inside: bool) -> bool:
    """Whether class and id words mark furniture."""
    if not inside:
        return not FURNITURE_WORDS.isdisjoint((*re.split(r"[^a-z]+", marks), *WORDS.findall(marks)))
    if tag in TITLES:
        return False
    if tag == "p":
        return not FURNITURE_WORDS.isdisjoint(marks.split())
    for mark in marks.split():
        parts = [x for x in re.split(r"[^a-z]+", mark) if x]
        if parts and any(x in FURNITURE_WORDS for x in parts) and all(x in FURNITURE_WORDS or x in POSITION_WORDS for x in parts):
            return True
    return False


def _furniture(tag: str, attrs: str, inside: bool) -> tuple[bool, str]:
    """Whether an element is furniture by itself, and its style; inside: it is part of an article or main."""
    if not attrs or not MARKED.search(attrs):
        return tag in FURNITURE_TAGS, tag
    named = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attrs)}
    hidden = not inside and ("hidden" in named or re.search(r"display\s*:\s*none", named.get("style", ""), re.I) is not None)
    whole = tag in ("body", "html", "article", "main")  # page-wide classes say nothing about the page itself
    bad = tag in FURNITURE_TAGS or named.get("role", "").lower() in FURNITURE_ROLES or hidden or (not whole and _marked(f"{named.get('class', '')} {named.get('id', '')}".lower(), tag, inside))
    return bad, f"{tag}.{'.'.join(sorted(set(named.get('class', '').split())))}" if named.get("class") else tag


def parse(html: str) -> Node:
    """The whole page's tree, furniture and articles too; text is kept as decoded strings among the children."""
    root = Node("#", 0, False, None)
    now, at, size, search = root, 0, len(html), TOKEN.search
    while at < size:
        m = search(html, at)
        if m is None:
            now.children.append(unescape(html[at:]))
            break
        start, end = m.span()
        if start > at:
            now.children.append(unescape(html[at:start]))
        at = end
        cdata, close, tag, attrs = m.groups()
        if tag is None:
            if cdata:
                now.children.append(cdata)
            continue
        tag = tag.lower()
        if close:
            up = now
            while up is not root and up.tag != tag and not (tag == "p" and up.tag in KEEPS_P):
                up = up.parent
            if up.tag == tag:
                now = up.parent
            elif tag in ("p", "br"):
                now.children.append("\n" if tag == "p" else " ")
            continue
        if tag in ENDS_P:
            up = now
            while up is not root and up.tag not in BLOCK and up.tag not in KEEPS_P:
                up = up.parent
            if up.tag == "p":
                now = up.parent
        if tag in KIN:
            kin, up = KIN[tag], now
            while up is not root and up.tag not in kin and up.tag not in HOLDERS:
                up = up.parent
            if up.tag in kin:
                now = up.parent
        bad, style = _furniture(tag, attrs, now.main)
        node = Node(tag, _style(now.style, style), bad or tag in RAW, now)
        now.children.append(node)
        if tag in ("article", "main") and not node.furniture:
            up = now
            while up is not None and not up.holds:
                up.holds, up = True, up.parent
        if tag in VOID:
            continue
        if tag in RAW:
            over = re.compile(rf"</{re.escape(tag)}\s*(?:>|$)", re.I).search(html, at)
            at = over.end() if over else size
        elif not attrs.endswith("/") or tag in HTML_TAGS:  # only unknown elements close themselves
            now = node
    return root


def blocks(root: Node, cut: frozenset[int] = frozenset(), whole: bool = False) -> Iterator[tuple[Node, str]]:
    """(block element, text) in page order, without furniture and cut branches; whole: nothing is left out."""
    stack, owner, parts = [(root, 0)], root, []

    def flush():
        text = " ".join("".join(parts).split())
        parts.clear()
        return text

    while stack:
        node, i = stack.pop()
        if i == 0 and node.tag in BLOCK:
            if text := flush():
                yield owner, text
            owner = node
        if i < len(node.children):
            stack.append((node, i + 1))
            child = node.children[i]
            if isinstance(child, str):
                parts.append(child)
            elif child.tag == "br" or (child.tag == "hr"):
                parts.append(" ")
            elif whole or (not child.furniture and not (cut and not child.main and not child.holds and child.style in cut)):
                stack.append((child, 0))
            elif child.tag in BLOCK:
                if text := flush():
                    yield owner, text
        elif node.tag in BLOCK:
            if text := flush():
                yield owner, text
            up = node.parent
            while up is not None and up.tag not in BLOCK and up.parent is not None:
                up = up.parent
            owner = up or root
    if text := flush():
        yield owner, text


def extract(html: str | None, cut: frozenset[int] = frozenset()) -> str:
    """The main text: blocks joined by line feeds."""
    if not html:
        return ""
    root = parse(html)
    found = list(blocks(root, cut))
    # Where the page marks its article, what stands outside it is not part of it.
    inside = [text for node, text in found if node.main]
    return "\n".join(inside or [text for _, text in found])


def _observe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """host, node, presentation, content, page for branches that could be furniture; one row for each."""
    for pdf in batches:
        for at in range(0, len(pdf), 500):
            part, out = pdf.iloc[at : at + 500], []
            for host, html, page in zip(part["host"], part["html"], part["page"], strict=True):
                if html:
                    out += [(host, *row, page) for row in _branches(parse(html))]
            yield pd.DataFrame(out, columns=["host", "node", "shown", "said", "page"])


def _branches(root: Node) -> list[tuple[int, int, int]]:
    """Of every branch of the whole page that has text: keys of style, child styles and content.

    Content is that of the element's own blocks and of its children, without furniture where the element is none.
    """
    own: dict[Node, list[int]] = {}
    for node, text in blocks(root, whole=True):
        own.setdefault(node, []).append(key(text))
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        inner = [c for c in node.children if c.__class__ is Node]
        order.append((node, inner))
        stack += inner
    said: dict[Node, int] = {}
    found, texts = {}, {}
    for node, inner in reversed(order):  # children first, in page order
        told = own.get(node, [])
        if inner:
            told = told + [said[c] for c in inner if c in said and (node.furniture or not c.furniture)]
        if not told:
            continue
        said[node] = content = hash(tuple(told))  # of integers, so the same in every process
        if node is not root and node.tag not in ("html", "body"):
            style = node.style
            if style not in texts:
                texts[style], found[style] = [], set()
            texts[style].append(content)
            if inner:
                found[style].update([c.style for c in inner])
    return [(style, hash(tuple(sorted(found[style]))), hash(tuple(ts))) for style, ts in texts.items()]


def style_tree(df: DataFrame, host_col: str = "host", html_col: str = "html") -> DataFrame:
    """host, node for branches of low importance.

    Importance is the larger of two entropies, each divided by the log of the number of pages that have the
    node: of its child styles and of its texts. Pages of equal html count once.
    """
    seen = df.filter(F.col(host_col) != "").select(F.col(host_col).alias("host"), F.col(html_col).alias("html"), F.xxhash64(html_col).alias("page"))
    seen = seen.mapInPandas(_observe, "host string, node long, shown long, said long, page long").distinct()
    seen = settle(seen.groupBy("host", "node", "shown", "said").agg(F.count(F.lit(1)).alias("n")))
    total = seen.groupBy("host", "node").agg(F.sum("n").alias("pages")).filter(F.col("pages") >= MIN_PAGES)

    def entropy(feature: str) -> DataFrame:
        counts = seen.groupBy("host", "node", feature).agg(F.sum("n").alias("n"))
        return counts.groupBy("host", "node").agg((F.log(F.sum("n")) - F.sum(F.col("n") * F.log("n")) / F.sum("n")).alias(f"h_{feature}"))

    tree = total.join(entropy("shown"), ["host", "node"]).join(entropy("said"), ["host", "node"])
    return tree.filter(F.greatest("h_shown", "h_said") < LOW_IMPORTANCE * F.log("pages")).select("host", "node")


def _extractor(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for html, cut in batches:
        # A page that is furniture throughout keeps its text.
        yield pd.Series([(c is not None and extract(h, frozenset(c))) or extract(h) for h, c in zip(html, cut, strict=True)], dtype=object)


def main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars of every page."""
    require(df, id_col, url_col, html_col)
    rest = F.substring_index(F.col(url_col), "://", -1)
    host = F.when(F.contains(F.col(url_col), F.lit("://")), lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)))
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), F.coalesce(host, F.lit("")).alias("host"))
    low = settle(style_tree(pages))
    cut = low.groupBy("host").agg(F.collect_set("node").alias("cut"))
    if low.count() <= BROADCAST_BRANCHES:
        pages = pages.join(F.broadcast(cut), "host", "left")
    else:
        cut = cut.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        pages = pages.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALT)).cast("int")).join(cut, ["host", "salt"], "left")
    text = F.pandas_udf(_extractor, "string")("html", "cut")
    return pages.select(F.col("id").alias(id_col), F.col("url").alias(url_col), text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
