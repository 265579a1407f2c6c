"""Infobox data: ordered keys with one or more values, in titled sections."""

from __future__ import annotations

import re

from . import classify as K
from .dom import Element
from .render import DOT, Page, cell_text, clean, direct_rows, span

Box = dict  # {"title": str, "data": {key: str | list[str]}}
SKIPPED = frozenset({"infobox-below", "noprint"})


def assign(store: dict, key: str, value: str) -> None:
    """Add a value to a key; another value makes a list; empty or repeated ones change nothing."""
    if key and value:
        old = store.get(key)
        if old is None:
            store[key] = value
        elif isinstance(old, list):
            if value not in old:
                old.append(value)
        elif old != value:
            store[key] = [old, value]


def clean_key(s: str) -> str:
    return s.strip().removesuffix(":").strip()


def clean_value(s: str) -> str:
    return re.sub(r"(?:\s*[·•/,:;])+\s*$", "", clean(s))


def text_of(cell: Element, page: Page) -> str:
    """The cell's text; a reading without citations and hidden parts where that drops brackets, or finds text at all."""
    main = cell_text(cell, page, K.CELL_EXCLUDED).strip()
    if main and not ("[" in main and "]" in main):
        return main

    def parts():
        stack: list[Element | str] = cell.children[::-1]
        while stack:
            c = stack.pop()
            page.check()
            if isinstance(c, str):
                yield c
            elif c.name == "br":
                yield DOT
            elif not K.hidden(c) and not (c.name == "sup" and "reference" in c.classes):
                stack += c.children[::-1]

    other = clean_value(" ".join(t for t in (p.strip() for p in parts()) if t))
    brackets = "[" in main and "]" in main and "[" not in other
    return other if brackets or (not main and other) else main


def _skipped(*elements: Element) -> bool:
    return any(not SKIPPED.isdisjoint(e.classes) for e in elements)


def _values(cells: list[Element], page: Page) -> str:
    return clean_value(DOT.join(t for t in (text_of(c, page) for c in cells) if t))


def _first_row(table: Element) -> Element | None:
    for c in table.own("tbody", "tr"):
        if c.name == "tr":
            return c
        if inner := c.own("tr"):
            return inner[0]
    return None


def _opens_section(th: Element, table: Element) -> bool:
    """A heading across columns, unless it labels its row or stands in the table's first row."""
    return th.get("scope").lower() != "row" and span(th, "colspan") >= 2 and th.parent is not _first_row(table)


def _heading(tr: Element, page: Page) -> str:
    return text_of(tr.first("th") or tr, page)


def _other_title(table: Element, page: Page) -> str:
    """A title from the caption, the first row, or a heading before the row of the table around."""
    if (cap := table.first("caption")) and (t := text_of(cap, page)):
        return t
    if (tr := _first_row(table)) and (th := tr.first("th")):
        return text_of(th, page)
    outer = next((x for x in table.lineage() if x.name == "tr"), None)
    if outer and outer.parent:
        rows = outer.parent.own("tr")
        for tr in reversed(rows[: next(k for k, x in enumerate(rows) if x is outer)]):
            if tr.own("th") and (t := _heading(tr, page)):
                return t
    return ""


def _plain(table: Element, page: Page) -> dict:
    """Rows of a table without headings: the first cell is the key."""
    data: dict = {}
    for tr in direct_rows(table):
        cells = tr.own("td")
        if len(cells) >= 2 and not _skipped(tr, *cells):
            assign(data, clean_key(text_of(cells[0], page)), _values(cells[1:], page))
    return data


def _sections(table: Element, page: Page, done: set[int]) -> list[Box]:
    out: list[Box] = []
    title, data, headed = "", {}, False
    for tr in direct_rows(table):
        cells = tr.own("th", "td")
        heads = [c for c in cells if c.name == "th"]
        if _skipped(tr, *cells):
            continue
        if any(_opens_section(th, table) for th in heads):
            if data and (name := title or _other_title(table, page)):
                out.append({"title": name, "data": data})
            title, data, headed = _heading(tr, page), {}, True
        elif len(cells) == 1:
            inner = cells[0].first("table")
            if inner:
                done.add(id(inner))
                for row in direct_rows(inner):
                    pair = row.own("td", "th")
                    if len(pair) >= 2:
                        assign(data, clean_key(text_of(pair[0], page)), _values(pair[1:], page))
            else:
                assign(data, title, text_of(cells[0], page))
        elif cells:
            label = next((c for c in heads if c.get("scope").lower() == "row" or "infobox-label" in c.classes), None)
            label = label or next((c for c in cells if c.name == "td" and "infobox-label" in c.classes), cells[0])
            assign(data, clean_key(text_of(label, page)), _values(cells[1:], page))
    if data and title:
        out.append({"title": title, "data": data})
    elif data and not headed:
        out.append({"title": _other_title(table, page), "data": data})
    if not out:  # rows that stand directly in the table, as two columns
        simple: dict = {}
        for tr in table.own("tr"):
            pair = tr.own("td", "th")
            if len(pair) >= 2:
                assign(simple, clean_key(text_of(pair[0], page)), clean_value(text_of(pair[1], page)))
        if simple:
            out.append({"title": _other_title(table, page), "data": simple})
    return out


def infoboxes(root: Element, page: Page) -> list[Box]:
    """All infoboxes of a page; if there are none, tables that only a looser reading takes for infoboxes."""
    out: list[Box] = []
    done: set[int] = set()
    for table in root.all("table"):
        if id(table) in done or not K.infobox_to_read(table):
            continue
        if table.first("th"):
            out += _sections(table, page, done)
        elif data := _plain(table, page):
            out.append({"title": _other_title(table, page), "data": data})
    return out or _loose(root)


def _loose(root: Element) -> list[Box]:
    out: list[Box] = []
    say = lambda e: e.text(" ", strip=True) if e else ""
    for table in root.all("table"):
        if not K.has_part(table, K.INFOBOX_READ_AGAIN):
            continue
        data: dict = {}
        for tr in table.all("tr"):
            cells = tr.own("th", "td")
            if not cells or (len(cells) == 1 and span(cells[0], "colspan") <= 1):
                continue
            at = next((k for k, c in enumerate(cells) if (c.name == "th" and c.get("scope").lower() == "row") or "infobox-label" in c.classes), 0)
            assign(data, say(cells[at]), DOT.join(t for t in map(say, cells[at + 1 :]) if t))
        if data:
            out.append({"title": say(table.first("caption")) or say(table.first("th")), "data": data})
    return out


def ordered(boxes: list[Box]) -> list[dict]:
    """Boxes with data as ordered lists of keys and values: hashable columns instead of maps."""
    return [{"title": b["title"], "data": [{"key": k, "values": v if isinstance(v, list) else [v]} for k, v in b["data"].items()]} for b in boxes]
