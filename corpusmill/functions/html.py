"""HTML to Markdown and index pages to rows, over the standard library's parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.frames import frame
from corpusmill.functions.text import clean_title

# What is no content of a page.
DROPPED_TAGS = "head style script img svg meta link iframe noscript footer nav ps-header".split()
DROPPED_CLASSES = "sr-only navbar breadcrumb btn-toolbar skip-link".split()
DROPPED_CLASS_PARTS = "menu Menu".split()
DROPPED_ROLES = "region dialog".split()
DROPPED_LABELS, DROPPED_LABEL_PARTS = ["Search Filter"], ["menu", "Menu"]
VOID = "area base br col embed hr img input link meta param source track wbr".split()
# End of fixed values.
EMPTY = "Error parsing."
_BLOCKS = set("address article aside blockquote dd details div dl dt fieldset figure form h1 h2 h3 h4 h5 h6 hr li main ol p pre section table tr ul".split())


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)

    def find(self, tag: str) -> Node | None:
        return next((n for n in self.walk() if n.tag == tag), None)

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack += [c for c in reversed(n.children) if isinstance(c, Node)]

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            else:
                stack += reversed(n.children)
        return "".join(out)

    def has_class(self, name: str) -> bool:
        return name in self.attrs.get("class", "").split()


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        n = Node(tag, {k: v or "" for k, v in attrs})
        if tag in ("li", "p", "tr", "td", "th", "option"):  # end tags that may be left out
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag == tag or (tag in ("td", "th") and self.open[i].tag in ("td", "th")):
                    del self.open[i:]
                    break
                if self.open[i].tag in ("ul", "ol", "table", "div", "body", "blockquote") or (tag == "p" and self.open[i].tag in ("li", "td")):
                    break
        self.open[-1].children.append(n)
        if tag not in VOID:
            self.open.append(n)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse_html(html: str) -> Node:
    t = _Tree()
    t.feed(html)
    t.close()
    return t.root


def _dropped(n: Node) -> bool:
    a = n.attrs
    cls, label = a.get("class", ""), a.get("aria-label", "")
    return (
        n.tag in DROPPED_TAGS or any(p in cls for p in DROPPED_CLASS_PARTS) or any(n.has_class(c) for c in DROPPED_CLASSES)
        or a.get("role") in DROPPED_ROLES or label in DROPPED_LABELS or any(p in label for p in DROPPED_LABEL_PARTS)
    )


def _prune(n: Node) -> None:
    stack = [n]
    while stack:
        x = stack.pop()
        x.children = [c for c in x.children if isinstance(c, str) or not _dropped(c)]
        stack += [c for c in x.children if isinstance(c, Node)]


def content_of(root: Node, narrow: str | None = None) -> tuple[Node, str | None]:
    """The page's content without chrome (main, else body, else all; with `narrow` the first element of that class), and its title."""
    title = root.find("title")
    text = title.text() if title else None
    if narrow and (own := next((n for n in root.walk() if n.has_class(narrow)), None)):
        root = own
    _prune(root)
    return root.find("main") or root.find("body") or root, text


def _inline(n: Node | str) -> str:
    if isinstance(n, str):
        return re.sub(r"\s+", " ", n)
    inner = "".join(map(_inline, n.children))
    if n.tag == "br":
        return "  \n"
    if n.tag in ("b", "strong", "i", "em", "code") and inner.strip():
        mark = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`"}[n.tag]
        lead, tail = inner[: len(inner) - len(inner.lstrip())], inner[len(inner.rstrip()) :]
        return f"{lead}{mark}{inner.strip()}{mark}{tail}"
    if n.tag == "a" and n.attrs.get("href") and inner.strip():
        return f"[{inner.strip()}]({n.attrs['href']})"
    return inner


def _table(n: Node) -> str:
    rows = [[_inline(c).strip().replace("\n", " ").replace("|", "\\|") for c in r.children if isinstance(c, Node) and c.tag in ("td", "th")] for r in n.walk() if r.tag == "tr"]
    rows = [r for r in rows if r]
    if not rows:
        return ""
    width = max(map(len, rows))
    lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
    return "\n".join([lines[0], "|" + " --- |" * width, *lines[1:]])


def _list(n: Node, depth: int) -> str:
    out, k = [], int(n.attrs.get("start", "1") or 1) if n.attrs.get("start", "1").isdigit() else 1
    for c in n.children:
        if isinstance(c, Node) and c.tag == "li":
            own = [x for x in c.children if isinstance(x, str) or x.tag not in ("ul", "ol")]
            nested = [x for x in c.children if isinstance(x, Node) and x.tag in ("ul", "ol")]
            mark = f"{k}. " if n.tag == "ol" else "* "
            out.append("  " * depth + mark + re.sub(r"\s*\n\s*", " ", "\n\n".join(_blocks(own, depth))).strip())
            out += [_list(x, depth + 1) for x in nested]
            k += 1
    return "\n".join(out)


def _blocks(nodes: list, depth: int = 0) -> list[str]:
    out: list[str] = []
    run: list = []

    def close() -> None:
        text = re.sub(r" *\n *", lambda m: "  \n" if m.group().startswith("  ") else "\n", "".join(map(_inline, run))).strip()
        run.clear()
        if text:
            out.append(text)

    for n in nodes:
        if isinstance(n, str) or (n.tag not in _BLOCKS and not any(isinstance(c, Node) and c.tag in _BLOCKS for c in n.children)):
            run.append(n)
            continue
        close()
        if re.fullmatch("h[1-6]", n.tag):
            text = "".join(map(_inline, n.children)).strip().replace("\n", " ")
            if text:
                out.append("#" * int(n.tag[1]) + " " + text)
        elif n.tag in ("ul", "ol"):
            out.append(_list(n, depth))
        elif n.tag == "table":
            out.append(_table(n))
        elif n.tag == "pre":
            out.append("```\n" + n.text().strip("\n") + "\n```")
        elif n.tag == "hr":
            out.append("---")
        elif n.tag == "blockquote":
            out.append("\n".join("> " + x if x else ">" for x in "\n\n".join(_blocks(n.children, depth)).split("\n")))
        else:
            out += _blocks(n.children, depth)
    close()
    return [b for b in out if b]


def html_to_markdown(html: str, narrow: str | None = None) -> tuple[str, str]:
    """(Markdown with ATX headings, title). A page without content gives `Error parsing.`"""
    content, title = content_of(parse_html(html or ""), narrow)
    text = re.sub(r"\n{2,}", "\n\n", "\n\n".join(_blocks(content.children)))
    return (text if text.strip() else EMPTY), " ".join((title or "").split())


def convert_pages(df: DataFrame, id_col: str, html_col: str, narrow_col: str | None = None) -> DataFrame:
    """(id_col, markdown, title) of each page, one Arrow batch at a time; null pages give the empty mark. narrow_col: what `content_of` narrows each page to (null: nothing)."""

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            to = b[narrow_col] if narrow_col else [None] * len(b)
            done = [html_to_markdown(h if isinstance(h, str) else "", n if isinstance(n, str) else None) for h, n in zip(b[html_col], to)]
            yield frame({id_col: b[id_col], "markdown": [m for m, _ in done], "title": [t for _, t in done]})

    return df.select(id_col, html_col, *([narrow_col] if narrow_col else [])).mapInPandas(convert, f"{id_col} {df.schema[id_col].dataType.simpleString()}, markdown string, title string")


def html_title(c: Column) -> Column:
    return clean_title(F.regexp_extract(c, r"(?is)<title[^>]*>(.*?)</title>", 1))


def index_entries(html: str, container: str = "WordSection1") -> list[tuple[str, str, str, str]]:
    """(section, subsection, title, url) of an index page: headings h1/h2 open a section, h3 and on a subsection, the first link of any other element is an entry."""
    root = parse_html(html or "")
    box = next((n for n in root.walk() if n.has_class(container)), None)
    rows, section, sub = [], "", ""
    for n in (c for c in (box.children if box else []) if isinstance(c, Node)):
        text = " ".join(n.text().split())
        if re.fullmatch("h[3-6]", n.tag):
            sub = text
        elif n.tag in ("h1", "h2"):
            section, sub = text, ""
        elif link := n.find("a"):
            rows.append((section, sub, text or " ".join(link.text().split()), link.attrs.get("href", "")))
    return rows


def handbook_entries(html: str) -> list[tuple[str, str, str]]:
    """(chapter, title, url) of a handbook index: a chapter is named by its title's span, else its anchor."""
    rows = []
    for chapter in (n for n in parse_html(html or "").walk() if n.has_class("Chapter")):
        head = next((n for n in chapter.walk() if n.tag == "div" and n.has_class("Chapter-title")), None)
        if head is None:
            continue
        named = [next((n for n in head.walk() if n.tag == tag and n.has_class("Link")), None) for tag in ("span", "a")]
        name = next((n.text().strip() for n in named if n), None)
        for link in (n for n in chapter.walk() if n.tag == "a" and n.has_class("Link")):
            title = next((n for n in link.walk() if n.tag == "span" and n.has_class("Link-span")), None)
            rows.append((name, title.text().strip() if title else "", link.attrs.get("href", "")))
    return rows


def navigation_entries(html: str, base: str) -> list[tuple[str, str]]:
    """(title, url) of each list entry's link, addresses put behind `base`."""
    return [(" ".join(a.text().split()), base + a.attrs.get("href", "")) for li in parse_html(html or "").walk() if li.tag == "li" and (a := li.find("a"))]


def index_tables(df: DataFrame, id_col: str, html_col: str, kind: str, base: str = "") -> DataFrame:
    """(id_col, pos, section, subsection, title, url) of index pages; kind: `sections`, `handbook` or `navigation`. Null pages give no rows."""

    def read(page: str) -> list[tuple]:
        if kind == "sections":
            return index_entries(page)
        if kind == "handbook":
            return [(chapter, None, title, url) for chapter, title, url in handbook_entries(page)]
        return [(None, None, title, url) for title, url in navigation_entries(page, base)]

    if kind not in ("sections", "handbook", "navigation"):
        raise ValueError(kind)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(key, i, *row) for key, page in zip(b[id_col].tolist(), b[html_col]) if isinstance(page, str) for i, row in enumerate(read(page), 1)]
            yield frame(rows, [id_col, "pos", "section", "subsection", "title", "url"])

    return df.select(id_col, html_col).mapInPandas(run, f"{id_col} {df.schema[id_col].dataType.simpleString()}, pos int, section string, subsection string, title string, url string")
