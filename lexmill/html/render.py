"""Tokens, lists, tables and cells as text."""

from __future__ import annotations

import re
import time
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

from . import classify as K
from .dom import Element, OutOfTime

DOT = " · "
NONE: frozenset[str] = frozenset()


@dataclass
class Page:
    """State of one document: whether mathematics was met, and when its time is up."""

    has_math: bool = False
    deadline: float | None = None
    seen: int = 0

    @classmethod
    def within(cls, seconds: float | None) -> Page:
        return cls(deadline=time.monotonic() + seconds if seconds else None)

    def check(self) -> None:
        self.seen += 1
        if self.deadline and not self.seen % 64 and time.monotonic() > self.deadline:
            raise OutOfTime


Token = tuple[str, frozenset[str]]  # text, types of the elements around it


def clean(s: str) -> str:
    return s if s.isalnum() else " ".join(s.split())  # these are blanks too: \xa0


def depth(e: Element) -> int:
    """Lists around a list, itself included."""
    return sum(x.name in ("ul", "ol") for x in e.lineage())


def tokens(node: Element, page: Page, around: frozenset[str] = NONE, exclude: frozenset[str] = NONE) -> Iterator[Token]:
    """The text below a node, piece by piece. `exclude` acts on the node's own children and isn't handed down.

    The way down is a stack, so that nesting has no limit.
    """
    unseen = lambda e: K.hidden(e) and not e.first("math")
    if unseen(node):
        return
    stack = [(iter(node.children), node, around | K.kinds(node))]
    while stack:
        children, e, here = stack[-1]
        c = next(children, None)
        if c is None:
            stack.pop()
            continue
        page.check()
        drop = exclude if e is node else NONE
        if isinstance(c, str):
            yield c, here
        elif K.banner(c) or (c.name != "math" and unseen(c)):
            continue
        elif e.name == "section" and c.name == "section":
            yield "\n", here | {"Section"}
        elif c.name == "math":
            page.has_math = True
            yield c.get("alttext"), here
        elif c.name == "table":
            yield table(c, page, drop), here | _table_kinds(c)
        elif c.name in ("ul", "ol"):
            yield from _list_tokens(c, page, here)
        elif c.name == "br":
            yield (DOT if c.inside("table") else "\n"), here
        elif c.name == "div" and c.inside("caption") and not c.text(strip=True):
            yield DOT, here
        elif c.name == "div" and "Citation" in drop and not {"reflist", "mw-references-wrap"}.isdisjoint(c.classes):
            continue
        elif c.name not in ("script", "style"):
            stack.append((iter(c.children), c, here | K.kinds(c)))


def _table_kinds(e: Element) -> frozenset[str]:
    out = set(K.kinds(e))
    if K.inside_part(e, K.INFOBOX_INLINE) or K.boxed(e, K.WIDTHS_HIDDEN, align=False):
        out.add("Infobox")
    if K.navigation(e):
        out.add("Navigation")
    return frozenset(out)


def _list_tokens(e: Element, page: Page, around: frozenset[str]) -> Iterator[Token]:
    here = around | {"List"} | (K.kinds(e) & {"nomobile", "noprint"})
    if K.navigation(e):
        here |= {"Navigation"}
    n = 0
    for li in e.own("li"):
        item = list(tokens(li, page, here))
        if re.search(r"\w", "".join(t for t, _ in item)):
            n += 1
            yield "  " * (depth(e) - 1) + ("- " if e.name == "ul" else f"{n}. "), here
            yield from item
            yield "\n", here


def list_text(e: Element, page: Page, exclude: frozenset[str]) -> str:
    """A list in the body. Types aren't filtered here: citations in items stay."""
    lines: list[str] = []
    for li in e.own("li"):
        text = "".join(t for t, _ in tokens(li, page, exclude=exclude))
        if re.search(r"\w", text):
            lines.append("  " * (depth(e) - 1) + ("- " if e.name == "ul" else f"{len(lines) + 1}. ") + text.strip())
    return "\n".join(lines) + "\n" if lines else ""


def paragraph(e: Element, page: Page, exclude: frozenset[str]) -> str:
    if any(x.name == "table" and K.table_hidden(x) for x in e.lineage()):
        return ""
    drop = exclude | {"noprint", "Navigation", "Infobox"}
    return "".join(t for t, types in tokens(e, page, exclude=exclude) if drop.isdisjoint(types))


def cell_text(cell: Element, page: Page, exclude: frozenset[str] = NONE) -> str:
    """A cell on one line: alternative texts if it shows nothing but images; repeated neighbours once."""
    if cell.bare:
        page.check()
        text = cell.children[0]
        shown = not K.hidden(cell) and exclude.isdisjoint(K.kinds(cell))
        return (clean(text) if shown else "") or text.strip()
    images = [i for i in cell.all("img") if not any(K.hidden(x) for x in _up_to(i, cell))]
    if images and not clean(cell.text(skip=K.hidden)):
        alts = [a for a in (i.get("alt").strip() for i in images) if a]
        if alts:
            return DOT.join(alts)
    parts: list[str] = []
    last = ""
    for text, types in tokens(cell, page):
        if not exclude.isdisjoint(types):
            continue
        text = " " if text == "\n" else text
        if text.strip():
            if text == last:
                continue
            last = text
        parts.append(text)
    return clean("".join(parts)) or cell.text(" ", strip=True)


def _up_to(e: Element, top: Element) -> Iterator[Element]:
    for x in e.lineage():
        if x is top:
            return
        yield x


def direct_rows(e: Element) -> list[Element]:
    """Rows of a table itself, not of tables inside it; those of a head are not among them."""
    return [tr for c in e.own("tbody", "tr") for tr in ([c] if c.name == "tr" else c.own("tr"))]


def span(cell: Element, name: str) -> int:
    if not cell.attrs:
        return 1
    m = re.match(r"\s*\+?(\d+)\s*$", cell.get(name))
    return max(1, int(m[1])) if m else 1


def _table_cell(cell: Element, page: Page, exclude: frozenset[str]) -> str:
    """Cell text without images; their alternative texts only if there is nothing else."""
    if cell.bare or not cell.elements():
        return cell_text(cell, page, exclude)
    alts = [a for a in (i.get("alt").strip() for i in cell.all("img")) if a]
    bare = _without(cell, lambda x: x.name in ("img", "figure") or (x.name == "span" and "mw:file" in x.get("typeof").lower()))
    text = cell_text(bare, page, exclude)
    bare.release()
    return text if text.strip() else DOT.join(alts)


def _row_texts(row: list[Element], page: Page, exclude: frozenset[str]) -> list[str]:
    """Texts of a row's td and th. Most cells are one text without attributes, which gives it no types and doesn't hide it."""
    out = []
    for c in row:
        below = c.children
        if len(below) == 1 and type(below[0]) is str and not c.attrs:
            out.append(clean(below[0]))
        else:
            out.append(_table_cell(c, page, exclude))
    page.check()
    return out


def _without(e: Element, drop) -> Element:
    """A copy without the elements below that are to be dropped."""
    out = Element(e.name, e.attrs, e.parent)
    todo = [(e, out)]
    while todo:
        old, new = todo.pop()
        for c in old.children:
            if isinstance(c, str):
                new.children.append(c)
            elif not drop(c):
                new.children.append(Element(c.name, c.attrs, new))
                todo.append((c, new.children[-1]))
    return out


class _Grid:
    """Rows of cell texts, in which spans are written out."""

    def __init__(self):
        self.rows: list[list[str]] = []
        self.down: dict[int, tuple[str, int]] = {}  # column -> text and rows that it still covers

    def add_plain(self, texts: list[str]) -> None:
        """Cells of one column and one row each."""
        if self.down:
            self.add([(t, 1, 1) for t in texts])
        else:
            self.rows.append(texts)

    def add(self, cells: list[tuple[str, int, int]]) -> None:
        """cells: (text, columns, rows); a cell with 0 columns is no cell but a gap of `rows` columns."""
        row: list[str] = []
        for col in sorted(self.down):
            text, left = self.down.pop(col)
            row += [""] * (col + 1 - len(row))
            row[col] = text
            if left > 1:
                self.down[col] = (text, left - 1)
        at = 0
        for text, columns, rows in cells:
            if not columns:
                at += rows
                continue
            while at < len(row) and row[at]:
                at += 1
            row += [""] * (at + columns - len(row))
            for col in range(at, at + columns):
                row[col] = text
                if rows > 1:
                    self.down[col] = (text, rows - 1)
            at += columns
        self.rows.append(row)


def _wide(s: str) -> int:
    """Columns on a terminal: wide characters take two, combining ones none."""
    if s.isascii():
        return len(s)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in s)


def _shown(s: str) -> str:
    return clean(s.replace("​", "")).replace("|", "\\|")


def table(e: Element, page: Page, exclude: frozenset[str] = NONE) -> str:
    """A table as a padded pipe table."""
    rows = direct_rows(e)
    cells_of = {id(tr): tr.own("td", "th") for tr in rows}
    inner = [t for tr in rows for c in cells_of[id(tr)] if not c.bare for t in c.all("table")]
    if len(inner) == 1 and len(rows) == 1 and len(cells_of[id(rows[0])]) == 1:
        around = [c for c in cells_of[id(rows[0])][0].children if not (isinstance(c, Element) and c.name == "table")]
        if not any((c if isinstance(c, str) else c.text()).strip() for c in around):
            return table(inner[0], page, exclude)
    if len(inner) >= 2:
        return "\n\n".join(t for t in (table(x, page, exclude) for x in inner) if t.strip())

    parts = e.all("thead", "tbody")
    head_part = next((p for p in parts if p.name == "thead"), None)
    heads = [c for tr in (head_part.own("tr") if head_part else []) if (c := tr.own("th", "td"))]
    bodies = [p for p in parts if p.name == "tbody"]
    body = [c for part in (bodies or [e]) for tr in part.own("tr") if (c := cells_of.get(id(tr)) or tr.own("th", "td"))]
    if not heads:
        first = next((k for k, row in enumerate(body) if any(c.name != "th" for c in row)), len(body))
        heads, body = body[:first], body[first:]
    heads = [row for row in heads if any(cell_text(c, page, exclude).strip() for c in row)]
    spread = {id(row) for part in (heads, body) for row in part if any(c.attrs for c in row)}  # rows whose cells may have spans
    if heads and body:
        columns = lambda part: max(sum(span(c, "colspan") for c in row) if id(row) in spread else len(row) for row in part)
        if abs(columns(heads) - columns(body)) >= 2:
            heads = []

    grid = _Grid()
    for row in heads:
        grid.add([(t, span(c, "colspan"), span(c, "rowspan")) for c, t in zip(row, _row_texts(row, page, exclude), strict=True)])
    for row in body:
        texts = _row_texts(row, page, exclude)
        full = [t.isalnum() or bool(t.replace("\xa0", " ").replace("​", "").strip()) for t in texts]
        if sum(full) == 1:  # a lone cell isn't spread over its span
            grid.add([(t, 1, 1) if f else ("", 0, span(c, "colspan")) for c, t, f in zip(row, texts, full, strict=True)])
        elif id(row) not in spread:
            grid.add_plain(texts)
        else:
            grid.add([(t, span(c, "colspan"), span(c, "rowspan")) for c, t in zip(row, texts, strict=True)])
    if not grid.rows:
        return ""
    n = max(map(len, grid.rows))
    shown = [[t if t.isalnum() else _shown(t) for t in row] + [""] * (n - len(row)) for row in grid.rows]
    if all(map(str.isascii, map("".join, shown))):
        widths = [max(map(len, column)) for column in zip(*shown, strict=True)]
        lines = ["| " + " | ".join(map(str.ljust, row, widths)) + " |" for row in shown]
    else:
        widths = [max(_wide(row[k]) for row in shown) for k in range(n)]
        lines = ["| " + " | ".join(t + " " * (w - _wide(t)) for t, w in zip(row, widths, strict=True)) + " |" for row in shown]
    if heads:
        lines.insert(len(heads), "| " + " | ".join("-" * w for w in widths) + " |")
    return "\n".join(lines)
