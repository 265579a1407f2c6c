"""A page as markdown: blocks under headings, infoboxes, and whether it has mathematics."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

from . import classify as K
from .dom import Element, parse
from .infobox import infoboxes
from .render import Page, list_text, paragraph, table

BLOCK_TAGS = frozenset("table ul ol p dl blockquote pre".split())
LEAD = "_Lead"
Block = tuple[str, int, str]  # heading, level, text


def base_host(url: str | None = None, wikiname: str | None = None, reader: str | None = None) -> str:
    """The host that relative links of a page belong to."""
    if url:
        try:
            if host := urlparse(url).netloc:
                return host
        except ValueError:
            pass
    for name in (wikiname or "", (reader or "").removesuffix("_namespace_0") if (reader or "").endswith("_namespace_0") else ""):
        if name.endswith("wiki") and len(name) > 4:
            return f"{name[:-4]}.wikipedia.org"
    return "wikipedia.org"


def ensure_base(root: Element, host: str) -> Element:
    """Give the page a <base href> if it has none."""
    if not any(b.get("href") for b in root.all("base")):
        top = root.first("html")
        if top is None:
            top = Element("html", parent=root)
            root.children.insert(0, top)
        head = root.first("head")
        if head is None:
            head = Element("head", parent=top)
            top.children.insert(0, head)
        head.children.insert(0, Element("base", {"href": f"//{host}"}, head))
    return root


def title_of(root: Element) -> str:
    t = root.first("title")
    return t.text().strip() if t else ""


def blocks(root: Element, page: Page, exclude: frozenset[str] = K.BODY_EXCLUDED) -> Iterator[Block]:
    """Blocks in document order with the heading that they stand under.

    Text outside block tags is left out. A heading appears once something follows it; a heading of the same or a higher
    level replaces those pending, so sections without content vanish and their parents stay.
    """
    heading, level = LEAD, 2
    waiting: list[tuple[str, int]] = []
    stack = root.elements()[::-1]
    while stack:
        c = stack.pop()
        page.check()
        if K.not_printed(c) or (c.name == "table" and K.table_hidden(c)):
            continue  # ancestors were judged on the way down
        if len(c.name) == 2 and c.name[0] == "h" and c.name[1] in "23456":
            new = int(c.name[1])
            while waiting and waiting[-1][1] >= new:
                waiting.pop()
            waiting.append((c.text().strip(), new))
        elif c.name in BLOCK_TAGS:
            text = _block(c, page, exclude)
            if not text.strip():
                continue
            while waiting:
                heading, level = waiting.pop(0)
                if waiting:
                    yield heading, level, ""
            yield heading, level, text
        else:
            stack += c.elements()[::-1]


def _block(e: Element, page: Page, exclude: frozenset[str]) -> str:
    if e.name == "table":
        return table(e, page, exclude)
    if e.name in ("ul", "ol"):
        return list_text(e, page, exclude)
    if e.name == "pre":
        return f"```\n{e.text(chr(10))}\n```\n"
    return paragraph(e, page, exclude)


def assembled(found: Iterator[Block], title: str = "", ref_words: frozenset[str] | set[str] = frozenset()) -> str:
    """Markdown of blocks; blocks under a heading among ref_words are left out, sections below it are not."""
    out = [f"# {title}\n"] if title else []
    before, fresh = (LEAD, 2), False
    for heading, level, text in found:
        if heading in ref_words:
            continue
        if (heading, level) != before:
            out.append(f"\n{'#' * max(2, min(6, level))} {heading}\n")
            before, fresh = (heading, level), True
        if text.strip():
            out.append((text.lstrip() if fresh else text) + "\n")
            fresh = False
    return "".join(out)


@dataclass
class Document:
    text: str
    infoboxes: list[dict]
    has_math: bool

    def infoboxes_json(self) -> str:
        return json.dumps(self.infoboxes, ensure_ascii=False)


def extract(html: str | None, ref_words: set[str] | frozenset[str] = frozenset(), seconds: float | None = None, **base: str | None) -> Document:
    """Everything that is read from a page, from one parse. Raises OutOfTime after `seconds`."""
    page = Page.within(seconds)
    root = parse(html, page.deadline)
    try:
        return read(root, page, ref_words, **base)
    finally:
        root.release()


def read(root: Element, page: Page, ref_words: set[str] | frozenset[str] = frozenset(), **base: str | None) -> Document:
    ensure_base(root, base_host(**base))
    boxes = infoboxes(root, page)
    text = assembled(blocks(root, page), title_of(root), ref_words)
    return Document(text, boxes, page.has_math)
