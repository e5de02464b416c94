"""Pages: HTML to typed blocks and page-level values, in one Arrow-batched function at the edge of the plan.

A small tree is built with the standard library's parser. Elements are not closed by what follows
them: an end tag closes the nearest open element of its name and all inside it, void elements close
at once, stray end tags are ignored. What the tree gives is one struct a page:

title, categories, published_raw, apply_url, had_images, blocks (kind, text) and links (url, categories).

Defined results: null and empty pages have no blocks and the title that stands for none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from pagewright.functions import rules
from pagewright.functions.rules import compiled, full_py
from pagewright.functions.text import bullet_text_py, clean_text_py, decoration_only_py
from pagewright.functions.vocabulary import CATEGORY_WHITELIST, NOISE_SELECTORS
from pagewright.plans.repeats import without_repeated_renderings

#: How many pages a worker holds as parsed at a time.
TOGETHER = 64
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TITLE = "제목 미기재"
BLOCKS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("text", T.StringType())]))
LINKS = T.ArrayType(T.StructType([T.StructField("href", T.StringType()), T.StructField("categories", T.ArrayType(T.StringType()))]))
PAGE = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("published_raw", T.StringType()),
        T.StructField("apply_url", T.StringType()),
        T.StructField("had_images", T.BooleanType()),
        T.StructField("blocks", BLOCKS),
        T.StructField("links", LINKS),
        T.StructField("next_href", T.StringType()),
    ]
)


class Node:
    """An element: name, attributes, parent and children (nodes and strings)."""

    __slots__ = ("name", "attrs", "parent", "children")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def nodes(self) -> Iterator[Node]:
        """Elements below, in document order."""
        todo = self.children[::-1]
        while todo:
            x = todo.pop()
            if isinstance(x, Node):
                yield x
                todo.extend(x.children[::-1])

    def strings(self) -> Iterator[str]:
        todo = self.children[::-1]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                yield x
            elif x.name not in ("script", "style", "template"):
                todo.extend(x.children[::-1])

    def text(self, sep: str) -> str:
        return sep.join(s for s in map(str.strip, self.strings()) if s)

    def has(self, cls: str) -> bool:
        named = self.attrs.get("class")
        return named is not None and cls in named.split()

    def above(self) -> Iterator[Node]:
        x = self.parent
        while x is not None:
            yield x
            x = x.parent


class Tree(HTMLParser):
    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.top = self.at = Node("", {}, None)
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        x = self.at
        while x.parent is not None:
            if x.name == tag:
                self.at = x.parent
                return
            x = x.parent

    def handle_data(self, data: str) -> None:
        last = self.at.children[-1:]
        if last and isinstance(last[0], str):
            self.at.children[-1] += data
        else:
            self.at.children.append(data)


Step = tuple[str, tuple[str, ...]]


@lru_cache(maxsize=512)
def steps(selector: str) -> tuple[Step, ...]:
    """Name and classes of each step of a descendant selector: name, .class, name.class."""
    return tuple((name, tuple(cls.split(".")) if cls else ()) for name, _, cls in (s.partition(".") for s in selector.split()))


def matches(node: Node, step: Step) -> bool:
    name, classes = step
    return (not name or node.name == name) and (not classes or ("class" in node.attrs and all(map(node.has, classes))))


def select(nodes: list[Node], selector: str) -> Iterator[Node]:
    """Those of nodes that match a descendant selector; its earlier steps match their ancestors."""
    *outer, last = steps(selector)
    for node in nodes:
        if matches(node, last):
            rest = list(outer)
            for x in node.above():
                if rest and matches(x, rest[-1]):
                    rest.pop()
            if not rest:
                yield node


def meta(nodes: list[Node], *keys: str) -> str:
    metas = [n for n in nodes if n.name == "meta"]
    for key in keys:
        for attr in ("property", "name"):
            found = next((n for n in metas if n.attrs.get(attr) == key), None)
            if found:
                if found.attrs.get("content"):
                    return clean_text_py(found.attrs["content"])
                break
    return ""


def page_title(nodes: list[Node], site: str) -> str:
    """The first usable of: meta titles, h1 in this order, the document's title. Section headings are no titles."""

    # Fixed values below: the meta names, selectors and classes that are looked at, in their order.
    def without_site(t: str) -> str:
        return compiled(rf"\s*[–|-]\s*{rules.loose(site).replace(chr(92) + 's*', ' ')}\s*$").sub("", t) if site else t

    for key in ("og:title", "twitter:title"):
        t = without_site(meta(nodes, key))
        if t and not full_py(rules.SECTION_TITLE, t):
            return t
    for selector in ("h1.entry-title", "h1.fusion-post-title", "h1.post-title", "article h1", "main h1", "h1"):
        node = next(select(nodes, selector), None)
        t = clean_text_py(node.text(" ")) if node else ""
        if t and not full_py(rules.SECTION_TITLE, t):
            return t
    node = next(select(nodes, "title"), None)
    t = without_site(clean_text_py(node.text(" "))) if node else ""
    return t if t and not full_py(rules.SECTION_TITLE, t) else NO_TITLE


def published_raw(nodes: list[Node]) -> str | None:
    found = meta(nodes, "article:published_time", "date", "datePublished")
    if not found:
        found = next((n.attrs["datetime"] for n in nodes if n.name == "time" and "datetime" in n.attrs), "")
    return found or None


def is_category_link(a: Node, rel: bool, href: bool) -> bool:
    rels, to = a.attrs.get("rel", "").split(), a.attrs.get("href", "")
    return (rel and ("category" in rels or "tag" in rels)) or (href and ("/category/" in to or "/tag/" in to))


def page_categories(nodes: list[Node]) -> list[str]:
    anchors = [n for n in nodes if n.name == "a"]
    by_rel = [clean_text_py(a.text(" ")) for a in anchors if is_category_link(a, True, False)]
    # Classes of the boxes that name categories.
    boxes = ("fusion-meta-tb-categories", "fusion-post-cards-meta-tb", "fusion-post-meta")
    later = [clean_text_py(a.text(" ")) for a in anchors if is_category_link(a, False, True) or any(x.has(c) for x in a.above() for c in boxes)]
    return [c for c in dict.fromkeys([*by_rel, meta(nodes, "article:section"), *later]) if c in CATEGORY_WHITELIST]


def content_root(top: Node, nodes: list[Node]) -> Node:
    """The candidate with the most distinct useful texts; specific containers come before article and main."""
    # Containers of the content, the specific ones first.
    selectors = (
        ".fusion-content-tb", ".fusion-post-content-wrapper .post-content", "article .post-content", "article .entry-content",
        "article .fusion-post-content", ".single-post .post-content", ".entry-content", ".post-content", "article", "main",
    )
    found = list({id(n): n for s in selectors for n in select(nodes, s)}.values())
    if len(found) == 1:
        return found[0]  # the only one needs no comparison
    useful_names = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "tr"}

    def worth(node: Node) -> tuple[int, int, int]:
        texts = [t for n in node.nodes() if n.name in useful_names and (t := clean_text_py(n.text(" ")))]
        return len(set(texts)), sum(map(len, set(texts))), len(texts)

    scored = [(worth(n), n) for n in found]
    specific = [x for x in scored if x[1].name not in ("article", "main", "body") and x[0][0] > 0]
    if scored:
        return max(specific or scored, key=lambda x: x[0])[1]
    return next(select(nodes, "body"), top)


NOISE_NAMES = frozenset(s for s in NOISE_SELECTORS if "." not in s)
NOISE_CLASSES = frozenset(s[1:] for s in NOISE_SELECTORS if s.startswith(".") and "." not in s[1:])
NOISE_OTHERS = [step for s in NOISE_SELECTORS if s not in NOISE_NAMES and s[1:] not in NOISE_CLASSES for step in steps(s)]


def is_noise(node: Node) -> bool:
    return node.name in NOISE_NAMES or not NOISE_CLASSES.isdisjoint(node.attrs.get("class", "").split()) or any(matches(node, s) for s in NOISE_OTHERS)


def drop_noise(root: Node) -> None:
    todo = [root]
    while todo:
        node = todo.pop()
        node.children = [c for c in node.children if isinstance(c, str) or not is_noise(c)]
        todo += [c for c in node.children if isinstance(c, Node)]


class Blocks:
    """Collects the typed blocks of a content root."""

    def __init__(self) -> None:
        self.found: list[tuple[str, str]] = []
        self.ended = False

    def add(self, kind: str, text: str = "") -> None:
        t = clean_text_py(text)
        if kind == "divider" or (t and not decoration_only_py(t) and not full_py(rules.APPLY_LABEL, t)):
            self.found.append((kind, t))

    def add_lines(self, text: str, kind: str) -> None:
        lines = [t for t in map(clean_text_py, text.splitlines()) if t]
        for t in lines if len(lines) > 1 else [text]:
            bullet = bullet_text_py(t)
            self.add("bulleted_list_item" if bullet is not None else kind, bullet or t)

    def add_paragraph(self, text: str, kind: str = "paragraph") -> None:
        t = once(text)
        noise = compiled(rules.TRAILING_NOISE).search(t)
        for what, part in sections_of(t[: noise.start()] if noise else t):
            if what == "heading":
                self.add("heading_3", part)
            else:
                self.add_lines(part, kind)

    def heading(self, node: Node, kind: str) -> None:
        t = clean_text_py(node.text(" "))
        if compiled(rules.TRAILING_NOISE).search(t):
            self.ended = True
        else:
            self.add(kind, t)

    def paragraph(self, node: Node) -> None:
        t = node.text("\n")
        strong = next((n for n in node.nodes() if n.name in ("strong", "b")), None)
        if strong and clean_text_py(strong.text(" ")) == clean_text_py(t) and full_py(rules.SECTION_TITLE, t):
            self.add("heading_3", t)
        else:
            self.add_paragraph(t)

    def items(self, node: Node) -> None:
        kind = "bulleted_list_item" if node.name == "ul" else "numbered_list_item"
        for li in (c for c in node.children if isinstance(c, Node) and c.name == "li"):
            parts = [c if isinstance(c, str) else c.text(" ") for c in li.children if isinstance(c, str) or c.name not in ("ul", "ol")]
            self.add_paragraph(" ".join(parts), kind)
            for c in li.children:
                if isinstance(c, Node) and c.name in ("ul", "ol") and not self.ended:
                    self.items(c)

    def rows(self, node: Node) -> None:
        for tr in (n for n in node.nodes() if n.name == "tr"):
            cells = [t for n in tr.nodes() if n.name in ("th", "td") and (t := clean_text_py(n.text(" ")))]
            self.add("paragraph", " | ".join(cells))

    def walk(self, top: Node) -> None:
        todo = [top]
        while todo and not self.ended:
            node = todo.pop()
            match node.name:
                case "h1" | "h2":
                    self.heading(node, "heading_2")
                case "h3" | "h4" | "h5" | "h6":
                    self.heading(node, "heading_3")
                case "p":
                    self.paragraph(node)
                case "blockquote":
                    self.add("quote", node.text("\n"))
                case "hr":
                    self.add("divider")
                case "ul" | "ol":
                    self.items(node)
                case "table":
                    self.rows(node)
                case "img":
                    pass
                case _:
                    todo.extend(c for c in reversed(node.children) if isinstance(c, Node))


def once(text: str) -> str:
    """text without its second half where that repeats the first, line by line or within three characters of the middle."""
    t = clean_text_py(text)
    lines = [x for x in t.splitlines() if x.strip()]
    half = len(lines) // 2
    if lines and len(lines) % 2 == 0 and lines[:half] == lines[half:]:
        return "\n".join(lines[:half])
    for mid in range(max(1, len(t) // 2 - 3), len(t) // 2 + 4):
        if (left := clean_text_py(t[:mid])) == clean_text_py(t[mid:]):
            return left
    return t


def sections_of(text: str) -> Iterator[tuple[str, str]]:
    """text cut at section titles that are bracketed or fill their line; words inside sentences and bullets are none."""
    at = 0
    for m in compiled(rules.INLINE_TITLE).finditer(text):
        word = clean_text_py(m[0])
        end = text.find("\n", m.end())
        line = text[text.rfind("\n", 0, m.start()) + 1 : end if end >= 0 else len(text)]
        alone = rules.section_kind_py(line) is not None and clean_text_py(line) == word
        if bullet_text_py(line) is not None or not (word.startswith("[") or alone):
            continue
        if before := clean_text_py(text[at : m.start()]):
            yield "content", before
        yield "heading", word.strip("[] ")
        at = m.end()
    rest = clean_text_py(text[at:]) if at else text
    if rest or not at:
        yield "content", rest


def apply_url(nodes: list[Node], url: str) -> str | None:
    """An external link labelled as the way to apply, else the first to a host that takes applications."""
    # Fixed values below: labels of the way to apply, and hosts that take applications.
    own, second = urlparse(url).netloc.replace("www.", ""), None
    for a in (n for n in nodes if n.name == "a" and "href" in n.attrs):
        try:
            href = urljoin(url, a.attrs["href"].strip())
            to = urlparse(href)
            host = (to.hostname or "").lower()
        except ValueError:
            continue
        if to.scheme not in ("http", "https") or to.netloc.replace("www.", "") == own:
            continue
        if compiled(r"지원하러\s*가기|지원하기|신청하기|접수하기|apply").search(clean_text_py(a.text(" "))):
            return href
        if second is None and any(x in host for x in ("recruit", "career", "jobs", "forms", "google")):
            second = href
    return second


BOXES = ("article", "li", "div")


def links(nodes: list[Node], url: str) -> list[tuple[str, list[str]]]:
    """Absolute link targets in page order, each with the categories named in its nearest article, li or div."""
    every = [n for n in nodes if n.name == "a"]
    # each category link is told to all boxes around it once, so the work follows the links and their depth
    named: dict[int, dict[str, None]] = {}
    for a in every:
        if ("category" in a.attrs.get("rel", "").split() or is_category_link(a, False, True)) and (text := clean_text_py(a.text(" "))) in CATEGORY_WHITELIST:
            for x in a.above():
                if x.name in BOXES:
                    named.setdefault(id(x), {})[text] = None
    out = []
    for a in every:
        if "href" in a.attrs:
            try:
                to = urljoin(url, a.attrs["href"])
            except ValueError:
                continue
            box = next((x for x in a.above() if x.name in BOXES), None)
            out.append((to, list(named.get(id(box), ()))))
    return out


def next_link(nodes: list[Node], url: str) -> str | None:
    tests = (lambda n: n.name == "a" and n.attrs.get("rel") == "next", lambda n: n.name == "a" and n.has("next"), lambda n: n.name == "a" and any(x.has("pagination-next") for x in n.above()), lambda n: n.has("next") and n.has("page-numbers"))
    for test in tests:
        node = next((n for n in nodes if test(n)), None)
        if node and node.attrs.get("href"):
            return urljoin(url, node.attrs["href"])
    return None


def parse_page(html: str | None, url: str | None, site: str = "", fields: tuple[str, ...] = tuple(PAGE.names)) -> dict:
    """The named fields of PAGE; only what they need is worked out."""
    top, url = Tree(html or "").top, url or ""
    nodes = list(top.nodes())
    made = {
        "title": lambda: page_title(nodes, site),
        "categories": lambda: page_categories(nodes),
        "published_raw": lambda: published_raw(nodes),
        "apply_url": lambda: apply_url(nodes, url),
        "links": lambda: [{"href": h, "categories": c} for h, c in links(nodes, url)],
        "next_href": lambda: next_link(nodes, url),
    }
    out = {n: made[n]() for n in made if n in fields or (n == "title" and "blocks" in fields)}
    if "blocks" in fields or "had_images" in fields:
        root = content_root(top, nodes)
        drop_noise(root)  # last, as it changes the tree
        out["had_images"] = any(n.name == "img" for n in root.nodes())
        if "blocks" in fields:
            found = Blocks()
            found.walk(root)
            blocks = without_repeated_renderings(found.found)
            if blocks and blocks[0][0].startswith("heading") and blocks[0][1] == clean_text_py(out["title"]):
                blocks = blocks[1:]
            out["blocks"] = [{"kind": k, "text": t} for k, t in blocks]
    for n in nodes:
        n.parent = None  # no cycles: the tree goes at once, not when the collector comes by
    return {n: out[n] for n in fields}


def in_parts(pages: pd.Series, urls: pd.Series, site: str, fields: tuple[str, ...]) -> Iterator[pd.DataFrame]:
    """The named fields of each page, TOGETHER pages at a time, so that a worker's memory doesn't follow Spark's batches of rows."""
    for i in range(0, len(pages), TOGETHER):
        some = zip(pages.iloc[i : i + TOGETHER], urls.iloc[i : i + TOGETHER], strict=True)
        yield pd.DataFrame([parse_page(h, u, site, fields) for h, u in some], columns=list(fields))


def parsed(html: Column, url: Column, site: str = "", fields: tuple[str, ...] = tuple(PAGE.names)) -> Column:
    """The page struct of each row, its named fields. site: the site's name, cut from the end of titles.

    Declared not deterministic, so that no filter made from what follows runs it a second time.
    """

    @F.pandas_udf(T.StructType([PAGE[n] for n in fields]))
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for pages, urls in parts:
            yield from in_parts(pages, urls, site, fields)

    return run.asNondeterministic()(html, url)
