"""A small document tree with HTML's implied end tags, built by the standard tokenizer."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Start tag -> (open elements it ends, elements at which the search stops).
_ENDS: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "th": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "tbody": (frozenset({"thead", "tbody", "tfoot"}), frozenset({"table"})),
    "tfoot": (frozenset({"thead", "tbody"}), frozenset({"table"})),
    **{t: (frozenset({"p"}), frozenset({"td", "th", "li", "table", "div", "section", "caption", "dd", "blockquote"})) for t in _CLOSES_P},
}


#: Tags as most are written: lower-case names, attributes in double quotes or of plain letters, no references, nothing else. The others are
#: left to the standard tokenizer, as are those whose content isn't mark-up.
_START = re.compile(r'<([a-z][a-z0-9]*)((?: [a-z][a-z-]*=(?:"[^"&]*"|[A-Za-z0-9_-]+))*)>')
_ATTRIBUTE = re.compile(r' ([a-z][a-z-]*)=(?:"([^"]*)"|([A-Za-z0-9_-]+))')
_END = re.compile(r"</([a-z][a-z0-9]*)>")
_OWN_CONTENT = frozenset((*HTMLParser.CDATA_CONTENT_ELEMENTS, *getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ()), "plaintext"))


class _Tags(dict):
    """What stands between < and > -> name, and attributes of a start tag; None if the tag isn't plain. The last few thousand are kept."""

    def __missing__(self, inner: str) -> tuple[str, dict[str, str] | None] | None:
        if m := _END.fullmatch(f"<{inner}>"):
            found = m[1], None
        elif (m := _START.fullmatch(f"<{inner}>")) and m[1] not in _OWN_CONTENT:
            found = m[1], {k: a or b for k, a, b in reversed(_ATTRIBUTE.findall(m[2]))}
        else:
            return None
        if len(inner) < 200:
            if len(self) >= 4096:
                self.clear()
            self[inner] = found
        return found


_TAGS = _Tags()


class OutOfTime(BaseException):
    """A record took longer than its budget; not an Exception, so that no handler on the way swallows it."""


class Element:
    __slots__ = ("name", "attrs", "parent", "children", "_classes", "_known")

    def __init__(self, name: str, attrs: dict[str, str] | None = None, parent: Element | None = None):
        self.name = name
        self.attrs = attrs or {}
        self.parent = parent
        self.children: list[Element | str] = []
        self._classes: tuple[str, ...] | None = None
        self._known: dict[str, bool] | None = None

    def get(self, name: str) -> str:
        return self.attrs.get(name) or ""

    @property
    def classes(self) -> tuple[str, ...]:
        if self._classes is None:
            self._classes = tuple(self.get("class").lower().split())
        return self._classes

    def lineage(self) -> Iterator[Element]:
        """The element and its ancestors."""
        at: Element | None = self
        while at is not None:
            yield at
            at = at.parent

    def within(self, name: str, test: Callable[[Element], bool]) -> bool:
        """Whether the element or one around it passes the test. The answer is kept under a name with all that were asked, so that deep
        nesting isn't walked again from each element; parents and attributes must not change afterwards."""
        asked: list[Element] = []
        at: Element | None = self
        while at is not None and (at._known is None or name not in at._known):
            asked.append(at)
            at = at.parent
        found = at is not None and at._known[name]
        for e in reversed(asked):
            found = found or test(e)
            if e._known is None:
                e._known = {}
            e._known[name] = found
        return found

    def inside(self, *names: str) -> bool:
        return any(e.name in names for e in self.lineage() if e is not self)

    @property
    def bare(self) -> bool:
        """Whether it has nothing but one text in it."""
        return len(self.children) == 1 and type(self.children[0]) is str

    def elements(self) -> list[Element]:
        return [c for c in self.children if type(c) is not str]

    def release(self) -> None:
        """Take the tree apart once it has been read: elements that know their parents would stay until the next garbage collection."""
        todo = [self]
        for e in todo:
            e.parent = None
            below = e.children
            if len(below) != 1 or type(below[0]) is not str:
                todo += [c for c in below if type(c) is not str]

    def own(self, *names: str) -> list[Element]:
        """Child elements with one of the names."""
        return [c for c in self.children if type(c) is not str and c.name in names]

    def walk(self) -> Iterator[Element]:
        """Descendant elements in document order."""
        stack = self.elements()[::-1]
        while stack:
            e = stack.pop()
            yield e
            stack += e.elements()[::-1]

    def all(self, *names: str) -> list[Element]:
        out, stack = [], self.elements()[::-1]
        while stack:
            e = stack.pop()
            if e.name in names:
                out.append(e)
            below = e.children
            if len(below) != 1 or type(below[0]) is not str:
                stack += e.elements()[::-1]
        return out

    def first(self, *names: str) -> Element | None:
        stack = self.elements()[::-1]
        while stack:
            e = stack.pop()
            if e.name in names:
                return e
            stack += e.elements()[::-1]
        return None

    def strings(self, skip: Callable[[Element], bool] | None = None) -> Iterator[str]:
        """Text below in document order, without what lies in skipped elements."""
        stack: list[Element | str] = self.children[::-1]
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                yield c
            elif not (skip and skip(c)):
                stack += c.children[::-1]

    def text(self, separator: str = "", strip: bool = False, skip: Callable[[Element], bool] | None = None) -> str:
        parts = self.strings(skip)
        return separator.join(t for t in (s.strip() for s in parts) if t) if strip else separator.join(parts)


class _Builder(HTMLParser):
    def __init__(self, deadline: float | None):
        super().__init__(convert_charrefs=True)
        self.root = Element("#document")
        self.at, self.deadline, self.seen = self.root, deadline, 0

    def updatepos(self, i: int, j: int) -> int:
        return j  # lines aren't counted

    def goahead(self, end: bool) -> None:
        """Text and plain tags up to the first thing that only the standard tokenizer reads."""
        if self.cdata_elem is None:
            text, *pieces = self.rawdata.split("<")
            at, read = self.at, 0
            for piece in pieces:
                tag, closed, after = piece.partition(">")
                if not closed or (plain := _TAGS[tag]) is None:
                    break
                if text:
                    at.children.append(unescape(text) if "&" in text else text)
                read += len(text) + len(tag) + 2
                text, (name, attrs) = after, plain
                if attrs is not None:
                    at = self._opened(at, name, attrs.copy() if attrs else None)
                elif at.name == name:
                    at = at.parent
                else:
                    self.at = at
                    self.handle_endtag(name)
                    at = self.at
            self.at = at
            self.rawdata = self.rawdata[read:]
        if self.rawdata:
            super().goahead(end)

    def _plain(self, raw: str, at: int) -> int:
        """Read the plain tag that stands here; where it ends, or -1 if it isn't plain."""
        m = _START.match(raw, at)
        if m is None or m[1] in _OWN_CONTENT:
            m, start = _END.match(raw, at), False
            if m is None:
                return -1
        else:
            start = True
        if start:
            self.lasttag = m[1]
            self.handle_starttag(m[1], [(k, a or b) for k, a, b in _ATTRIBUTE.findall(m[2])] if m[2] else [])
        else:
            self.handle_endtag(m[1])
        return m.end()

    def parse_starttag(self, i: int) -> int:
        k = self._plain(self.rawdata, i)
        return k if k > 0 else super().parse_starttag(i)

    def parse_endtag(self, i: int) -> int:
        k = self._plain(self.rawdata, i) if self.cdata_elem is None else -1
        return k if k > 0 else super().parse_endtag(i)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at = self._opened(self.at, tag, {k: v or "" for k, v in reversed(attrs)} if attrs else None)

    def _opened(self, at: Element, tag: str, attrs: dict[str, str] | None) -> Element:
        """Put in a new element; where the next one goes."""
        self.seen += 1
        if self.deadline and not self.seen % 256 and time.monotonic() > self.deadline:
            raise OutOfTime
        if found := _ENDS.get(tag):
            ends, stops = found
            e, root = at, self.root
            while e is not root and (name := e.name) not in stops:
                if name in ends:
                    at = e.parent
                    break
                e = e.parent
        new = Element(tag, attrs, at)
        at.children.append(new)
        return at if tag in VOID else new

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.at.name == tag:
            self.at = self.at.parent

    def handle_endtag(self, tag: str) -> None:
        e = self.at
        while e is not self.root:
            if e.name == tag:
                self.at = e.parent
                return
            if e.name in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "html", "body"):
                return  # a stray end tag doesn't leave its cell
            e = e.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None, deadline: float | None = None) -> Element:
    """The tree of a page. Unclosed elements end with their parent; comments and declarations are dropped."""
    b = _Builder(deadline)
    b.feed(html or "")
    b.close()
    return b.root
