"""What an element is, judged by its name, classes and styles."""

from __future__ import annotations

from .dom import Element

# Class names, widths and words that must equal those of the data's producers.
INFOBOX_READ = ("infobox", "sinottico", "vcard", "infocaseta")
INFOBOX_READ_AGAIN = ("infobox", "taxobox", "vcard")
INFOBOX_HIDDEN = ("infobox", "taxobox", "sinottico", "vcard", "infocaseta")
INFOBOX_INLINE = ("infobox", "taxobox")
WIDTHS_READ = ("160", "180", "200", "220", "240", "260", "280", "300")
WIDTHS_HIDDEN = ("180", "200", "220", "240", "260", "280")
NAVIGATION = (
    "navbox", "vertical-navbox", "navbar", "sidebar", "navbox-inner", "navbox-list", "navbox-title", "navbox-subgroup", "hlist",
    "navigation-not-searchable", "navframe", "navhead",
)
NO_PRINT = frozenset(
    (
        "noprint toccolours fmbox fmbox-editnotice stub mbox-small messagebox ambox tmbox imbox cmbox pmbox navframe navhead navbox "
        "vertical-navbox navbar sisterproject sistersitebox commonscat catlinks authority-control"
    ).split()
)
NO_PRINT_IDS = frozenset({"toc", "stub"})
KINDS = {
    "nomobile": ("nomobile",),
    "noprint": ("noprint", "fmbox", "fmbox-editnotice", "stub", "authority-control"),
    "Navigation": ("navframe", "navhead", "navbox", "vertical-navbox", "navbar", "sisterproject", "sistersitebox", "commonscat"),
    "Messagebox": ("mbox-small", "messagebox", "ambox", "tmbox", "imbox", "cmbox", "pmbox"),
    "Category": ("catlinks",),
}
ID_KINDS = {"toc": "Navigation", "stub": "noprint"}
STUBS = (
    "stub", "ébauche", "esbozo", "esboço", "esborrany", "ciot", "zaląż", "pahýl", "taslak", "заготов", "mrva", "клица", "μικρ", "بذر",
    "קצרמר", "خرد", "अधूर", "rintisan", "sơ khai", "โครง", "토막글", "スタブ", "小作品",
)
BANNERS = frozenset({"hatnote", "dablink", "rellink", "homonymie"})
BODY_EXCLUDED = frozenset({"Heading", "Citation", "Reference", "Infobox", "Navigation", "noprint", "Messagebox", "Category", "Media-audio", "Media-img", "Media-video"})
CELL_EXCLUDED = frozenset({"Citation", "Reference", "noprint", "Navigation", "Category", "Media-audio", "Media-img", "Media-video"})


def has_part(e: Element, parts: tuple[str, ...]) -> bool:
    return bool(e.attrs) and any(p in c for c in e.classes for p in parts)


def inside_part(e: Element, parts: tuple[str, ...]) -> bool:
    """Whether the element or one around it has a class with one of the parts."""
    return e.within(" ".join(parts), lambda x: has_part(x, parts))


def hidden(e: Element) -> bool:
    return bool(e.attrs) and "display:none" in "".join(e.get("style").split()).lower()


def banner(e: Element) -> bool:
    return bool(e.attrs) and any(c in BANNERS or c.startswith("bandeau") for c in e.classes)


def stub(e: Element) -> bool:
    return bool(e.attrs) and "mw:transclusion" in e.get("typeof").lower() and any(s in e.get("data-mw").lower() for s in STUBS)


def boxed(e: Element, widths: tuple[str, ...], align: bool = True, float_classes: bool = False) -> bool:
    """A table that floats right or is narrow, as fact boxes are; tables of data (wikitable) are not."""
    if not e.attrs or has_part(e, ("wikitable",)):
        return False
    style, width = e.get("style").lower(), e.get("width").lower()
    right = "float:right" in "".join(style.split()) or (align and e.get("align").lower() == "right")
    floats = float_classes and ("float-right" in e.classes or "floatright" in e.classes)
    return right or floats or any(w in width or f"width:{w}" in style for w in widths)


def infobox_to_read(e: Element) -> bool:
    """A table from which infobox data is taken."""
    return e.name == "table" and (inside_part(e, INFOBOX_READ) or boxed(e, WIDTHS_READ))


def navigation(e: Element) -> bool:
    return e.within("navigation", lambda x: bool(x.attrs) and (x.get("role").lower() == "navigation" or has_part(x, NAVIGATION)))


def table_hidden(e: Element) -> bool:
    """A navigation or infobox table that is left out of the text."""
    if inside_part(e, INFOBOX_HIDDEN) or navigation(e):
        return True
    if any((x.name == "th" and has_part(x, ("navbox-title",))) or has_part(x, ("navhead", "navbox-list")) for x in e.walk()):
        return True
    return boxed(e, WIDTHS_HIDDEN, float_classes=True)


def not_printed(e: Element) -> bool:
    return bool(e.attrs) and (not NO_PRINT.isdisjoint(e.classes) or e.get("id").lower() in NO_PRINT_IDS or stub(e))


def element_type(e: Element) -> str | None:
    """The public Parsoid mark-up's name of an element, as far as the exclusions need it."""
    n, kind = e.name, e.get("typeof").lower()
    if n in ("h1", "h2", "h3", "h4", "h5", "h6"):
        return "Heading"
    if n == "section":
        return "Section"
    if n == "sup" and ("reference" in e.classes or "mw-ref" in e.classes or "mw:extension/ref" in kind):
        return "Citation"
    if (n in ("ol", "div") and ("references" in e.classes or "mw:extension/references" in kind)) or "reflist" in e.classes:
        return "Reference"
    if n == "table" and "infobox" in e.classes:
        return "Infobox"
    if n == "table" and "navbox" in e.classes:
        return "Navigation"
    if n == "link" and "mw:pageprop/category" in e.get("rel").lower():
        return "Category"
    if n == "audio" or "mw:audio" in kind:
        return "Media-audio"
    if n == "video" or "mw:video" in kind:
        return "Media-video"
    if n in ("img", "figure", "figure-inline") or "mw:file" in kind or "mw:image" in kind:
        return "Media-img"
    return "List" if n in ("ul", "ol", "dl") else None


def kinds(e: Element) -> frozenset[str]:
    """All types that an element gives to the text below it."""
    if not e.attrs:
        return _BARE.get(e.name, NOTHING)
    out = {k for k, names in KINDS.items() if not set(names).isdisjoint(e.classes)}
    if e.get("id").lower() in ID_KINDS:
        out.add(ID_KINDS[e.get("id").lower()])
    if stub(e):
        out.add("noprint")
    if t := element_type(e):
        out.add(t)
    return frozenset(out)


NOTHING: frozenset[str] = frozenset()
#: The types of elements without attributes; other names give none.
_BARE = {n: frozenset({t}) for n in ("h1 h2 h3 h4 h5 h6 section audio video img figure figure-inline ul ol dl").split() if (t := element_type(Element(n)))}
