"""Pages as trees: text, links and titled sections. Plain Python, applied per Arrow batch by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

from .. import catalogue as C

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")


class Element:
    __slots__ = ("name", "attrs", "children", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Element | None):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def walk(self, dropped: tuple[str, ...] = ()) -> Iterator[Element | Text]:
        """Descendants in document order, without dropped elements."""
        stack = [iter(self.children)]
        while stack:
            for child in stack[-1]:
                if isinstance(child, Element):
                    if child.name in dropped:
                        continue
                    yield child
                    stack.append(iter(child.children))
                    break
                yield child
            else:
                stack.pop()

    def text(self, dropped: tuple[str, ...] = ()) -> str:
        """Pieces of text, comments left out, stripped and joined by a space."""
        parts = (t.value.strip() for t in self.walk(dropped) if isinstance(t, Text) and not t.comment)
        return " ".join(p for p in parts if p)


class Text:
    __slots__ = ("value", "comment")

    def __init__(self, value: str, comment: bool = False):
        self.value, self.comment = value, comment


class _Builder(HTMLParser):
    """An end tag closes the nearest open element of its name; nothing else is closed."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.now = Element("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Element(tag, {k: v or "" for k, v in attrs}, self.now)
        self.now.children.append(node)
        if tag not in VOID:
            self.now = node

    def handle_startendtag(self, tag, attrs):
        self.now.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.now))

    def handle_endtag(self, tag):
        node = self.now
        while node.parent is not None and node.name != tag:
            node = node.parent
        if node.parent is not None:
            self.now = node.parent

    def handle_data(self, data):
        self.now.children.append(Text(data))

    def handle_comment(self, data):
        self.now.children.append(Text(data, True))


def parse(html: str | None) -> Element:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def squeeze(text: str) -> str:
    return " ".join(text.split())


def page_text(html: str | None) -> str:
    return squeeze(parse(html).text(C.DROPPED_TAGS))[: C.PAGE_CHARS]


def clean_url(url: str) -> str:
    """Without query, fragment and trailing slashes; ValueError for a broken host."""
    urlsplit(url)
    return url.strip().split("#")[0].split("?")[0].rstrip("/")


def domain(url: str) -> str:
    return urlsplit(url).netloc.lower().strip().removeprefix("www.")


def same_site(url: str, home: str) -> bool:
    return domain(url) == domain(home) or domain(url).endswith(f".{domain(home)}")


def path_of(url: str) -> str:
    return urlsplit(url).path or "/"


def links(html: str | None, base: str, home: str, excluded=None) -> list[tuple[str, str, str, str]]:
    """(raw_link, internal_url, url_path, anchor_text) of a page's links inside the site, the first of each url.

    excluded: a test for urls that are left out. Links that cannot be resolved are skipped.
    """
    out: dict[str, tuple[str, str, str, str]] = {}
    for node in parse(html).walk():
        if not isinstance(node, Element) or node.name != "a" or not node.attrs.get("href"):
            continue
        raw = node.attrs["href"]
        try:
            url = clean_url(urljoin(base, raw))
            inside = url.startswith(("http://", "https://")) and same_site(url, home)
        except ValueError:
            continue
        if inside and url not in out and not (excluded and excluded(url)):
            out[url] = (raw, url, path_of(url), squeeze(" ".join(t.value for t in node.walk() if isinstance(t, Text) and not t.comment))[:300])
    return list(out.values())


def headings(html: str | None) -> list[tuple[str, int, str]]:
    """(heading, level, section text) for every heading of a usable length; see section_of."""
    root = parse(html)
    flow = list(root.walk(C.DROPPED_TAGS))
    out = []
    for at, node in enumerate(flow):
        if isinstance(node, Element) and node.name in HEADINGS:
            title = squeeze(node.text())
            if title and len(title) <= C.HEADING_CHARS:
                out.append((title, int(node.name[1]), section_of(flow, at, title)))
    return out


def section_of(flow: list[Element | Text], at: int, title: str) -> str:
    """What follows a heading up to one of its level or above: new texts and image labels, at most 30."""
    level, parts, seen = int(flow[at].name[1]), [title], {title}
    for node in flow[at + 1 :]:
        if isinstance(node, Element):
            if node.name in HEADINGS and int(node.name[1]) <= level:
                break
            if node.name != "img":
                continue
            text = squeeze(" ".join(v.strip() for v in (node.attrs.get(k, "") for k in ("alt", "title", "aria-label")) if v.strip()))
        else:
            text = squeeze(node.value)
        if text and text not in seen:
            parts.append(text)
            seen.add(text)
            if len(parts) > C.SECTION_ITEMS:
                break
    return squeeze(" ".join(parts))[: C.SECTION_CHARS]
