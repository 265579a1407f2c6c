"""Main-text extraction by a recurrent block labeller.

A page is cut into leaf blocks (text between block tags). Each block has hashed features of its tag path (tags, classes,
ids and roles of all ancestors), hashes of all its words, and a few measures; a bidirectional LSTM in numpy reads the whole
sequence of a page, so every block is labelled with the page before and after it in view. It is trained on generated
pages of many layouts and on at most SAMPLE pages of the corpus whose mark-up itself says what is article (an `article`
or `main` element), each also with that mark-up made plain. Blocks labelled as main text are joined by line feeds.

Defined cases: null or empty html gives an empty text; unclosed and stray tags, comments, and pages without a body are
read as far as they go; pages of any length and depth are read whole; blocks without a visible character are none; repeated rows are extracted each; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import trimmed

#: Pages of the corpus that training reads at most, and generated pages.
SAMPLE, GENERATED = 150, 2400
PATH, WORDS, MEASURES, HIDDEN = 1024, 256, 8, 24
EPOCHS, BATCH, RATE = 9, 25, 0.01
#: Blocks labelled together, at most (a longer page goes alone, in parts), and of a page learned together.
STEPS, WINDOW = 3000, 400

# The element names of HTML by how they are laid out.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead tr ul".split()
)
HIDDEN_TEXT = frozenset("head script style noscript template iframe object svg math canvas audio video textarea select title".split())
RAW_TEXT = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag ends these open elements, up to the nearest of the second set.
IMPLIED = {
    **{t: ({"p"}, {"body", "td", "th", "li", "div", "section", "article", "button"}) for t in BLOCKS - {"body", "html", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}},
    "li": ({"li", "p"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"table", "tr"}),
    "th": ({"td", "th", "p"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
_TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTR = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PART = re.compile(r"[a-z]+|[^\W_]+")
_SPACE = re.compile(r"\s+")


class Block:
    """A leaf block: parts, the hashed parts of all elements around it; last, the innermost two of their names; inside,
    those of MARKS around it; text; and how many characters of its source lie in links."""

    __slots__ = ("parts", "last", "inside", "text", "linked")

    def __init__(self, parts: np.ndarray, last: tuple[str, ...], inside: frozenset[str], text: str, linked: int):
        self.parts, self.last, self.inside, self.text, self.linked = parts, last, inside, text, linked


#: Elements of which a block knows by name whether it is inside.
MARKS = ("article", "main", "nav", "aside", "footer", "form")


def _hashed(name: str, count: int, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(name, seed) % count


class _Open:
    """The open elements, and how many of them have each hashed part. An element's parts are counted once, when it opens,
    so that depth costs no more memory than the elements themselves."""

    def __init__(self):
        self.stack: list[tuple[str, tuple[str, ...], np.ndarray, bool, bool]] = []  # tag, names, parts, hidden, in a link
        self.counts = np.zeros(PATH, np.int64)
        self.marks = dict.fromkeys(MARKS, 0)
        self.known: tuple[np.ndarray, tuple[str, ...], frozenset[str]] | None = None

    def push(self, tag: str, names: list[str], hidden: bool) -> None:
        parts = np.array([_hashed(n, PATH, 1) for n in names], np.int64)
        np.add.at(self.counts, parts, 1)
        if tag in self.marks:
            self.marks[tag] += 1
        self.stack.append((tag, tuple(names), parts, hidden or self.hidden, tag == "a" or self.linked))
        self.known = None

    def cut(self, k: int) -> None:
        """Close the elements from the k-th on."""
        for tag, _, parts, _, _ in self.stack[k:]:
            np.subtract.at(self.counts, parts, 1)
            if tag in self.marks:
                self.marks[tag] -= 1
        del self.stack[k:]
        self.known = None

    @property
    def hidden(self) -> bool:
        return bool(self.stack) and self.stack[-1][3]

    @property
    def linked(self) -> bool:
        return bool(self.stack) and self.stack[-1][4]

    def here(self) -> tuple[np.ndarray, tuple[str, ...], frozenset[str]]:
        if self.known is None:
            last: list[str] = []
            for _, names, *_ in reversed(self.stack):
                last = [*names, *last][-2:]
                if len(last) == 2:
                    break
            self.known = np.flatnonzero(self.counts).astype(np.int16), tuple(last), frozenset(m for m, n in self.marks.items() if n)
        return self.known


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order, with the tags, classes, ids and roles of all elements around them."""
    page = page or ""
    out: list[Block] = []
    open_ = _Open()
    stack = open_.stack
    parts: list[str] = []
    where = open_.here()
    linked = at = 0

    def close() -> None:
        nonlocal parts, linked
        if parts:
            text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                out.append(Block(*where, text, linked))
            parts, linked = [], 0

    while at < len(page):
        m = _TAG.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text and not open_.hidden:
            if not parts:
                where = open_.here()
            parts.append(text)
            if open_.linked:
                linked += len(text)
        if not m:
            break
        at = m.end()
        slash, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ") if parts else None
            continue
        if tag in BLOCKS:
            close()
        if slash:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    open_.cut(k)
                    break
                if tag not in BLOCKS and stack[k][0] in BLOCKS:
                    break  # a stray end of an inline element
            continue
        if tag in IMPLIED:
            ends, stop = IMPLIED[tag]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    open_.cut(k)
                elif stack[k][0] in stop:
                    break
        if tag in VOID:
            continue
        hidden = tag in HIDDEN_TEXT
        names = [tag] if tag in BLOCKS or tag == "a" else []
        if attrs and tag in BLOCKS | {"span", "a"}:
            for name, value in _ATTR.findall(attrs):
                name = name.lower()
                if name in ("class", "id", "role", "itemprop"):
                    names += ["." + p for p in _PART.findall(value.strip("\"'").lower())]
                elif name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", value)):
                    hidden = True
        if tag in RAW_TEXT:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        open_.push(tag, names, hidden)
    close()
    return out


class Vectors:
    """Blocks to input rows: hashed path parts, hashed words, measures. Hashes of words are remembered."""

    def __init__(self):
        self.words: dict[str, int] = {}

    def word(self, w: str) -> int:
        i = self.words.get(w)
        if i is None:
            i = _hashed(w.lower().strip(".,:;!?()[]\"'"), WORDS)
            if len(self.words) < 100_000:
                self.words[w] = i
        return i

    def __call__(self, page: list[Block], start: int = 0, end: int | None = None) -> np.ndarray:
        """Rows of the blocks from start to end."""
        some = page[start:end]
        x = np.zeros((len(some), PATH + WORDS + MEASURES), np.float32)
        for k, b in enumerate(some):
            x[k, b.parts] = 1.0
            for p in b.last:
                x[k, _hashed("last " + p, PATH, 1)] = 1.0
            words = b.text.split()
            x[k, PATH : PATH + WORDS] = np.bincount([*map(self.word, words)], minlength=WORDS) / math.sqrt(len(words))
            n = len(b.text)
            x[k, PATH + WORDS :] = (
                math.log1p(n) / 8, min(1.0, b.linked / n), sum(c in ".!?" for c in b.text[-3:]) / 3, math.log1p(len(words)) / 6,
                b.text[0].isupper(), (start + k) / len(page), ("©" in b.text) + 0.0, min(1.0, 5 * b.text.count(",") / n),
            )
        return x


def _sig(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


class Labeller:
    """Bidirectional LSTM with a logistic output per block. Sequences are padded at their end; mask tells real steps."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 7):
        if weights is None:
            r = np.random.default_rng(seed)
            d = PATH + WORDS + MEASURES
            weights = {"v": r.normal(0, 0.2, 2 * HIDDEN), "c": np.zeros(1)}
            for s in "fb":
                weights[f"{s}x"] = r.normal(0, 0.08, (d, 4 * HIDDEN))
                weights[f"{s}h"] = r.normal(0, 0.15, (HIDDEN, 4 * HIDDEN))
                weights[f"{s}c"] = np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]
        self.w = {k: v.astype(np.float32) for k, v in weights.items()}

    def run(self, side: str, x: np.ndarray, mask: np.ndarray, state: tuple | None = None, taped: bool = True) -> tuple[np.ndarray, list, tuple]:
        """x: steps x pages x features in reading order of the side. Gives the outputs, a tape for `back`, and the state."""
        steps, n, d = x.shape
        a = (x.reshape(-1, d) @ self.w[side + "x"] + self.w[side + "c"]).reshape(steps, n, -1)
        h, c = state or (np.zeros((n, HIDDEN), np.float32),) * 2
        out, tape = np.zeros((steps, n, HIDDEN), np.float32), []
        for t in range(steps):
            z = a[t] + h @ self.w[side + "h"]
            i, f, o = _sig(z[:, :HIDDEN]), _sig(z[:, HIDDEN : 2 * HIDDEN]), _sig(z[:, 2 * HIDDEN : 3 * HIDDEN])
            g, m = np.tanh(z[:, 3 * HIDDEN :]), mask[t][:, None]
            new = f * c + i * g
            tc = np.tanh(new)
            if taped:
                tape.append((h, c, i, f, o, g, tc))
            h, c = np.where(m, o * tc, h), np.where(m, new, c)
            out[t] = h
        return out, tape, (h, c)

    def back(self, side: str, x: np.ndarray, mask: np.ndarray, tape: list, dout: np.ndarray) -> dict[str, np.ndarray]:
        steps, n, d = x.shape
        dz = np.zeros((steps, n, 4 * HIDDEN), np.float32)
        dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        gh = np.zeros_like(self.w[side + "h"])
        for t in range(steps - 1, -1, -1):
            h, c, i, f, o, g, tc = tape[t]
            m = mask[t][:, None]
            dh = dh + dout[t]
            dn = np.where(m, dh, 0)
            dcell = np.where(m, dc, 0) + dn * o * (1 - tc * tc)
            z = np.concatenate([dcell * g * i * (1 - i), dcell * c * f * (1 - f), dn * tc * o * (1 - o), dcell * i * (1 - g * g)], 1)
            dz[t] = z
            gh += h.T @ z
            dh, dc = np.where(m, z @ self.w[side + "h"].T, dh), np.where(m, dcell * f, dc)
        flat = dz.reshape(-1, 4 * HIDDEN)
        return {side + "x": x.reshape(-1, d).T @ flat, side + "h": gh, side + "c": flat.sum(0)}

    @staticmethod
    def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(forward, backward, mask), each steps x pages."""
        steps = max(map(len, pages))
        x = np.zeros((2, steps, len(pages), PATH + WORDS + MEASURES), np.float32)
        mask = np.zeros((steps, len(pages)), bool)
        for k, p in enumerate(pages):
            x[0, : len(p), k], x[1, : len(p), k], mask[: len(p), k] = p, p[::-1], True
        return x[0], x[1], mask

    def outputs(self, pages: list[np.ndarray], taped: bool = False):
        xf, xb, mask = self.padded(pages)
        hf, tf, _ = self.run("f", xf, mask, taped=taped)
        hb, tb, _ = self.run("b", xb, mask, taped=taped)
        turned = np.zeros_like(hb)
        for k, p in enumerate(pages):
            turned[: len(p), k] = hb[: len(p), k][::-1]
        p = _sig(np.concatenate([hf, turned], 2) @ self.w["v"] + self.w["c"])
        return p, (xf, xb, mask, hf, turned, tf, tb)

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        p, _ = self.outputs(pages)
        return [p[: len(x), k] for k, x in enumerate(pages)]

    def label_long(self, page: list[Block], vectors: Vectors) -> np.ndarray:
        """As label, for one page of any length: its rows are made STEPS at a time, the state is carried on."""
        cuts = [(a, min(a + STEPS, len(page))) for a in range(0, len(page), STEPS)]
        both = np.zeros((len(page), 2 * HIDDEN), np.float32)
        for side, order in (("f", cuts), ("b", cuts[::-1])):
            state = None
            for a, b in order:
                x = vectors(page, a, b)[:: 1 if side == "f" else -1, None]
                out, _, state = self.run(side, x, np.ones((b - a, 1), bool), state, taped=False)
                both[a:b, :HIDDEN] = out[:, 0] if side == "f" else both[a:b, :HIDDEN]
                both[a:b, HIDDEN:] = out[::-1, 0] if side == "b" else both[a:b, HIDDEN:]
        return _sig(both @ self.w["v"] + self.w["c"])

    def gradient(self, pages: list[np.ndarray], truth: list[np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
        p, (xf, xb, mask, hf, turned, tf, tb) = self.outputs(pages, taped=True)
        y = np.zeros_like(p)
        for k, t in enumerate(truth):
            y[: len(t), k] = t
        n = mask.sum()
        d = np.where(mask, p - y, 0).astype(np.float32) / n
        both = np.concatenate([hf, turned], 2)
        grad = {"v": (both * d[:, :, None]).sum((0, 1)), "c": np.array([d.sum()], np.float32)}
        dboth = d[:, :, None] * self.w["v"]
        df, dt = dboth[:, :, :HIDDEN], dboth[:, :, HIDDEN:]
        db = np.zeros_like(dt)
        for k, t in enumerate(truth):
            db[: len(t), k] = dt[: len(t), k][::-1]
        grad |= self.back("f", xf, mask, tf, df) | self.back("b", xb, mask, tb, db)
        q = np.clip(np.where(y > 0.5, p, 1 - p), 1e-7, 1)
        return float(-(np.log(q) * mask).sum() / n), grad

    def fit(self, pages: list[np.ndarray], truth: list[np.ndarray], epochs: int = EPOCHS, seed: int = 3) -> None:
        """Adam over batches of pages of similar length."""
        r = np.random.default_rng(seed)
        order = np.argsort([len(p) for p in pages], kind="stable")
        groups = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        m, v, t = {k: 0.0 for k in self.w}, {k: 0.0 for k in self.w}, 0
        for e in range(epochs):
            for g in r.permutation(len(groups)):
                t += 1
                _, grad = self.gradient([pages[i] for i in groups[g]], [truth[i] for i in groups[g]])
                norm = math.sqrt(sum(float((x * x).sum()) for x in grad.values()))
                for k, x in grad.items():
                    x = x * min(1.0, 5 / (norm + 1e-9))
                    m[k], v[k] = 0.9 * m[k] + 0.1 * x, 0.999 * v[k] + 0.001 * x * x
                    step = m[k] / (1 - 0.9**t) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
                    self.w[k] = (self.w[k] - RATE * 0.7**e * step).astype(np.float32)

    def dump(self) -> bytes:
        return b"".join(self.w[k].tobytes() for k in sorted(self.w))

    @classmethod
    def load(cls, raw: bytes) -> Labeller:
        out, at = cls(), 0
        for k in sorted(out.w):
            n = out.w[k].size
            out.w[k] = np.frombuffer(raw, np.float32, n, at).reshape(out.w[k].shape)
            at += 4 * n
        return out


def generated(count: int, seed: int = 11) -> list[tuple[str, list[int]]]:
    """Pages of many layouts with a label for each block: 1 for main text."""
    r = np.random.default_rng(seed)
    pick = lambda xs: xs[int(r.integers(len(xs)))]
    syllables = [c + v + e for c in "b c d f g h l m n p r s t v th st ch".split() for v in "aeiouéäü" for e in ("", "n", "r", "s", "nt")]
    lexicon = ["the", "of", "and", "de", "la", "der", "die", "und", "que", "el", "a", "to", "in", "is"] + ["".join(pick(syllables) for _ in range(int(r.integers(1, 4)))) for _ in range(3000)]
    chance = lambda p: r.random() < p

    def words(n: int) -> str:
        return " ".join(pick(lexicon) for _ in range(max(1, n)))

    def sentence() -> str:
        s = words(int(r.integers(3, 18))).split(" ")
        if chance(0.4) and len(s) > 4:
            s[len(s) // 2] += ","
        return " ".join(s).capitalize() + pick([".", ".", ".", "!", "?", "***", "&amp;&amp;"])

    def para() -> str:
        return " ".join(sentence() for _ in range(int(r.integers(1, 6))))

    def page() -> tuple[str, list[int]]:
        out: list[str] = []
        y: list[int] = []

        def add(text: str, label: int, tag: str = "p", attrs: str = "", inner: bool = False) -> None:
            text = pick([text, text, f"<b>{text}</b>", f"<span>{text}</span>"]) if inner else text
            end = "" if tag in ("p", "li") and chance(0.15) else f"</{tag}>"
            out.append(f"<{tag}{attrs}>{text}{end}")
            y.append(label)

        def attr(names: list[str]) -> str:
            n = pick(names)
            return pick([f' class="{n}"', f' class="{n} {pick(lexicon)}"', f' id="{n}"', f" class={n}", f' class="{n}-{pick(["box", "wrap", "inner", "area"])}"', f' class="{pick(["site", "page", "top", "js"])}-{n}"'])

        def links(n: int, label: int = 0, tag: str = "li") -> None:
            for _ in range(n):
                add(f'<a href="/{pick(lexicon)}">{words(int(r.integers(1, 4)))}</a>', label, tag)

        def within(tag: str, attrs: str, body) -> None:
            out.append(f"<{tag}{attrs}>")
            body()
            out.append(f"</{tag}>")

        def menu() -> None:
            tag, a = pick([("nav", ""), ("nav", attr(["menu", "navbar", "nav"])), ("div", attr(["menu", "navbar", "navigation", "topnav"])), ("div", ' role="navigation"')])
            within(tag, a, lambda: within("ul", pick(["", attr(["menu", "links"])]), lambda: links(int(r.integers(2, 9)))))

        def header() -> None:
            tag, a = pick([("header", ""), ("header", attr(["site-header", "masthead"])), ("div", attr(["header", "masthead", "topbar", "branding"])), ("div", ' role="banner"')])

            def body() -> None:
                add(words(2), 0, pick(["h1", "div", "p"]), pick(["", attr(["logo", "site-title", "tagline"])]))
                if chance(0.5):
                    add(sentence(), 0)
                if chance(0.4):
                    menu()

            within(tag, a, body)

        def footer() -> None:
            tag, a = pick([("footer", ""), ("footer", ""), ("footer", attr(["footer"])), ("div", attr(["footer", "site-footer", "copyright", "colophon", "bottom", "printfooter", "credits"])), ("div", ' role="contentinfo"')])

            def body() -> None:
                if chance(0.3):
                    add(f"&copy; {words(2)} &middot; {sentence()}", 0, pick(["p", "div"]))
                else:
                    out.append(f"&copy; {words(1)}.example.com &middot; {sentence()}")
                    y.append(0)
                if chance(0.4):
                    within("ul", "", lambda: links(int(r.integers(1, 6))))
                if chance(0.3):
                    add(para(), 0)

            within(tag, a, body)

        def side() -> None:
            tag, a = pick([("aside", ""), ("aside", attr(["sidebar"])), ("div", attr(["sidebar", "widget", "related", "trending", "popular", "recommended", "rail"])), ("section", attr(["related", "more", "widget"])), ("div", ' role="complementary"')])

            def body() -> None:
                if chance(0.7):
                    add(words(2), 0, pick(["h2", "h3", "h4", "div"]))
                if chance(0.6):
                    within("ul", "", lambda: links(int(r.integers(2, 7))))
                for _ in range(int(r.integers(0, 3))):
                    add(pick([sentence, para])(), 0, pick(["p", "div"]))

            within(tag, a, body)

        def notice() -> None:
            a = pick([attr(["cookie", "notice", "alert", "banner", "gdpr", "consent", "newsletter", "subscribe", "paywall", "message", "warning", "popup", "modal", "disclaimer", "cookie-notice", "consent-banner", "cookie-message"]), ' role="alert"', ' role="dialog"'])

            def body() -> None:
                for _ in range(int(r.integers(1, 3))):
                    add(pick([sentence, para])(), 0, pick(["p", "div"]))
                if chance(0.2):
                    add(words(1), 0, "button")

            if chance(0.15):
                return add(pick([sentence, para])(), 0, "div", a)
            within(pick(["div", "div", "section"]), a, body)

        def advert() -> None:
            a = attr(["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "sponsor", "adsense", "commercial"])
            if chance(0.6):
                add(pick([sentence, para])(), 0, pick(["div", "div", "aside", "p"]), a)
            else:
                within(pick(["div", "aside", "section"]), a, lambda: [add(pick([sentence, para])(), 0, pick(["p", "div"])) for _ in range(int(r.integers(1, 3)))])

        def form() -> None:
            def body() -> None:
                add(words(2), 0, pick(["legend", "p", "div"]))
                out.append('<input type="text" name="q">')
                if chance(0.6):
                    out.append(f"<button>{words(1)}</button>")
                    y.append(0)
                if chance(0.3):
                    add(sentence(), 0)

            within("form", pick(["", attr(["search", "login", "contact", "signup"]), ' action="/search"']), body)

        def comments() -> None:
            plain = chance(0.25)
            tag, a = pick([("section", attr(["comments", "responses", "discussion"])), ("div", attr(["comments", "comment-list", "disqus", "replies", "thread"])), ("ol", attr(["commentlist", "comments"]))])

            def one() -> None:
                if plain:
                    return add(pick([sentence, para])(), 0, "div")
                if chance(0.6):
                    add(words(int(r.integers(1, 3))), 0, pick(["div", "h4", "p"]), attr(["author", "meta", "comment-meta", "user"]))
                for _ in range(int(r.integers(1, 3))):
                    add(para(), 0)
                if chance(0.3):
                    add(words(1), 0, "div", attr(["reply", "actions"]))

            def body() -> None:
                if chance(0.6) and tag != "ol":
                    add(f"{int(r.integers(1, 99))} {words(1)}", 0, pick(["h2", "h3", "p"]))
                for _ in range(int(r.integers(1, 6))):
                    if plain and tag != "ol":
                        one()
                        continue
                    within("li" if tag == "ol" else pick(["div", "article", "li"]), attr(["comment", "reply", "comment-body", "post-comment"]), one)

            within(tag, a, body)

        def small() -> None:
            a = attr(["breadcrumb", "breadcrumbs", "share", "social", "tags", "pagination", "pager", "toolbar", "byline-links", "skip"])
            if chance(0.4):  # in one line
                line = pick([" ", " | ", " &gt; ", ", "]).join(f'<a href="/{pick(lexicon)}">{words(int(r.integers(1, 3)))}</a>' for _ in range(int(r.integers(1, 5))))
                return add(pick(["", "", words(2) + ": "]) + line, 0, pick(["div", "div", "p"]), a)
            within(pick(["div", "nav"]), a, lambda: links(int(r.integers(1, 5)), tag=pick(["span-li", "li", "div"]).replace("span-li", "li")))

        def article() -> None:
            def piece() -> None:
                k = r.random()
                if k < 0.07:
                    add(pick([words(int(r.integers(1, 4))).capitalize() + pick([".", "!", "?"]), sentence()]), 1, "p")
                elif k < 0.62:
                    add(pick([para, para, sentence])(), 1, text_tag, pick(["", "", "", attr(["lead", "intro", "text", "first"])]), inner=True)
                elif k < 0.72:
                    add(words(int(r.integers(1, 8))), 1, pick(["h2", "h3", "h4"]))
                elif k < 0.80:
                    within(pick(["ul", "ol"]), "", lambda: [add(pick([words(4), sentence()]), 1, "li") for _ in range(int(r.integers(1, 6)))])
                elif k < 0.85:
                    within("blockquote", "", lambda: add(para(), 1))
                elif k < 0.88:
                    add(words(12), 1, "pre")
                elif k < 0.92:
                    within("table", "", lambda: [within("tr", "", lambda: [add(pick([words(2), str(int(r.integers(1, 3000)))]), 1, pick(["td", "th"])) for _ in range(3)]) for _ in range(int(r.integers(1, 4)))])
                elif k < 0.935:
                    within("dl", "", lambda: [add(words(2), 1, "dt") or add(pick([words(6), sentence()]), 1, "dd") for _ in range(int(r.integers(1, 4)))])
                elif k < 0.95:
                    within("figure", "", lambda: add(sentence(), 1, "figcaption"))
                else:
                    out.append(f"<p><b>{sentence()}<br>")
                    y.append(1)

            text_tag = "div" if chance(0.08) else "p"

            def body() -> None:
                if chance(0.12):
                    pick([notice, notice, menu, small])()  # within the article's own element
                if chance(0.65):
                    add(pick([words(int(r.integers(1, 9))), sentence()]), 1, pick(["h1", "h1", "h2"]))
                if chance(0.1):
                    pick([notice, advert, small])()
                if chance(0.45):  # a short article
                    for _ in range(int(r.integers(1, 4))):
                        add(pick([para, sentence])(), 1, text_tag, inner=True)
                    return
                for _ in range(int(r.integers(1, 16)) if chance(0.9) else int(r.integers(0, 2))):
                    piece()
                    if chance(0.09):
                        pick([advert, notice, notice, small, form, side])()

            if chance(0.2):
                return body()  # right in the page
            a = attr(["content", "post", "entry-content", "article", "story", "main", "post-body", "text", "story", "body"])
            tag, a = pick([("article", ""), ("article", ""), ("article", a), ("main", ""), ("div", a), ("div", a), ("section", a), ("section", ""), ("div", ' role="main"'), ("div", "")])
            wrap = pick([None, None, "main", "div"])
            if wrap:
                within(wrap, pick(["", attr(["wrapper", "page", "container", "content"])]), lambda: within(tag, a, body))
            else:
                within(tag, a, body)

        def columns() -> None:
            """A table for layout: a menu or side bar, the article, a last row."""

            def row() -> None:
                first = chance(0.7)
                if first:
                    within("td", pick(["", attr(["nav", "menu", "left", "sidebar"])]), pick([menu, side, lambda: links(int(r.integers(1, 5)), tag="div")]))
                within("td", pick(["", attr(["content", "main", "body"])]), article)
                if not first:
                    within("td", pick(["", attr(["sidebar", "right"])]), side)

            def body() -> None:
                within("tr", "", row)
                if chance(0.5):
                    within("tr", "", lambda: add(pick([f"Copyright {words(2)}", f"&copy; {words(3)}.", sentence()]), 0, "td", attr(["footer", "copyright", "bottom"])))

            within("table", "", body)

        def before() -> None:
            for step in [s for s, p in ((notice, 0.35), (header, 0.45), (menu, 0.6), (small, 0.2), (advert, 0.3), (side, 0.15), (form, 0.15)) if chance(p * busy)]:
                step()

        busy = pick([1.0, 1.0, 0.6])
        out.append(f"<!DOCTYPE html><html><head><title>{words(4)}</title><style>p{{margin:0}}</style></head><body>")
        k = r.random()
        if k < 0.12:  # one element around all that comes first
            within("div", pick(["", attr(["page", "wrapper", "container"])]), lambda: (before(), article()))
        else:
            before()
            columns() if k < 0.2 else article()
        for step in [s for s, p in ((small, 0.25), (advert, 0.25), (comments, 0.35), (side, 0.3), (form, 0.2), (notice, 0.15), (menu, 0.1), (footer, 0.75)) if chance(p * busy)]:
            step()
        if chance(0.8):
            out.append("</body></html>")
        return "".join(out), y

    return [page() for _ in range(count)]


def self_labelled(page: list[Block]) -> np.ndarray | None:
    """Labels from mark-up that names the article, or None if a page has no such element."""
    y = np.array([bool({"article", "main"} & b.inside) and not {"nav", "aside", "footer", "form"} & b.inside for b in page], float)
    return y if len(y) and 0 < y.sum() else None


def plainer(page: str) -> str:
    """The page with its telling elements as divs: those of the article without attributes, others named by a class."""
    page = re.sub(r"(?i)<(article|main)\b[^>]*>", "<div>", page)
    page = re.sub(r"(?i)<(nav|aside|footer|header)\b([^>]*)>", lambda m: f'<div class="{m[1].lower()}">' if "class=" not in m[2] else f"<div{m[2]}>", page)
    return re.sub(r"(?i)</(article|main|nav|aside|footer|header)\s*>", "</div>", page)


def trained(samples: list[str]) -> Labeller:
    """A model of generated pages and of those samples whose mark-up labels them, as they are and `plainer`."""
    vectors, xs, ys = Vectors(), [], []

    def add(found: list[Block], y: np.ndarray) -> None:
        for a in range(0, len(found), WINDOW):
            xs.append(vectors(found, a, a + WINDOW))
            ys.append(y[a : a + WINDOW])

    for page, y in generated(GENERATED):
        found = blocks(page)
        if len(found) == len(y):
            add(found, np.array(y, float))
    for page in samples:
        found = blocks(page)
        y = self_labelled(found)
        if y is not None:
            add(found, y)
            bare = blocks(plainer(page))
            if [b.text for b in bare] == [b.text for b in found]:
                add(bare, y)
    model = Labeller()
    model.fit(xs, ys)
    return model


def extracted(model: Labeller, pages: list[str | None]) -> list[str]:
    vectors, found = Vectors(), [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if found[k]), key=lambda k: len(found[k]))
    while order and len(found[order[-1]]) > STEPS:
        k = order.pop()
        out[k] = "\n".join(b.text for b, q in zip(found[k], model.label_long(found[k], vectors), strict=True) if q >= 0.5)
    while order:
        n = len(found[order[0]])
        take = 1
        while take < len(order) and len(found[order[take]]) * (take + 1) <= STEPS and len(found[order[take]]) <= 2 * n + 8:
            take += 1
        now, order = order[:take], order[take:]
        for k, p in zip(now, model.label([vectors(found[k]) for k in now]), strict=True):
            out[k] = "\n".join(b.text for b, q in zip(found[k], p, strict=True) if q >= 0.5)
    return out


def train(pages: DataFrame, sample: int = SAMPLE) -> bytes:
    """Weights from generated pages and the `sample` pages with the lowest hashes (equal pages count once)."""
    turns = pages.where("html is not null").select(F.xxhash64("page_id", "html").alias("turn"), "html")
    # the hashes alone are sorted; then the pages up to the last of them are read
    last = turns.select("turn").distinct().orderBy("turn").limit(sample).agg(F.max("turn")).first()[0]
    drawn = turns.where(F.col("turn") <= F.lit(last)).dropDuplicates(["turn"]).repartition(1)

    def run(batches):
        got = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array([trained([h for _, h in got]).dump()], pa.binary())], names=["w"])

    row = drawn.mapInArrow(trimmed(run), "w binary").first()
    return row["w"] if row else trained([]).dump()


def main_text(pages: DataFrame, weights: bytes | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    there = pages.sparkSession.sparkContext.broadcast(weights or train(pages))  # 1 MB

    def run(batches):
        model = Labeller.load(there.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                b = batch.slice(a, 500)
                texts = extracted(model, b.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(trimmed(run), "page_id long, url string, text string, n_chars long")
