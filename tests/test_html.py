"""Hand-written pages, one for each branch."""

import pytest

from lexmill.html import classify
from lexmill.html.document import assembled, base_host, blocks, ensure_base, extract
from lexmill.html.dom import OutOfTime, parse
from lexmill.html.infobox import infoboxes, ordered
from lexmill.html.render import Page, list_text, table


def body(html, words=()):
    return extract(html, set(words)).text


def boxes(html):
    return infoboxes(parse(html), Page())


def md(html):
    return table(parse(html).first("table"), Page())


def test_tree():
    root = parse("<p>a<p>b<b>c<ul><li>x<li>y</ul><table><tr><td>1<td>2<tr><td>3</table>d<br>e")
    assert [p.text() for p in root.all("p")] == ["a", "bc"]
    assert [x.text() for x in root.all("li")] == ["x", "y"]
    assert [[c.text() for c in r.own("td")] for r in root.all("tr")] == [["1", "2"], ["3"]]
    for n in range(0, 120, 7):  # never fails on truncated pages
        extract("<html><body><table class=infobox><tr><th>a</th><td>b</td></tr></table><ul><li>x<p>y</body>"[:n])


def test_stray_text_and_divs():
    assert body("<body>bare<div>text</div><h1>no</h1><div><p>kept</p></div></body>") == "kept\n"


def test_empty_sections():
    html = "<h2>Empty</h2><h2>Outer</h2><h3>Inner</h3><p>x</p><h2>Last</h2>"
    assert body(html) == "\n## Outer\n\n### Inner\nx\n"


def test_reference_words():
    html = "<p>lead</p><h2>Notes</h2><p>gone</p><h3>Other</h3><p>stays</p>"
    assert body(html, ["Notes"]) == "lead\n\n### Other\nstays\n"


def test_title():
    assert body("<head><title> T </title></head><p>x</p>") == "# T\nx\n"


def test_lists():
    html = "<ol><li>one<ul><li>in</li></ul></li><li><img alt=i></li><li>two</li></ol>"
    text = list_text(parse(html).first("ol"), Page(), classify.BODY_EXCLUDED)
    assert text == "1. one  - in\n2. two\n"


def test_citations_go_from_paragraphs_and_stay_in_lists():
    ref = '<sup class="reference">[1]</sup>'
    assert body(f"<p>a{ref}b</p><ul><li>c{ref}</li></ul>") == "ab\n- c[1]\n\n"


def test_table_grid():
    html = "<table><tr><th>k</th><th colspan=2>v|w</th></tr><tr><td rowspan=2>1</td><td>2</td><td>日本</td></tr><tr><td>5</td><td>6</td></tr><tr><td></td><td colspan=2>lone</td></tr></table>"
    assert md(html).split("\n") == ["| k | v\\|w | v\\|w |", "| - | ---- | ---- |", "| 1 | 2    | 日本 |", "| 1 | 5    | 6    |", "|   | lone |      |"]


def test_table_headers():
    assert md("<table><tr><th>a</th></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>") == "| 1 | 2 | 3 |"  # widths differ by two
    assert md("<table><tr><th></th><th></th></tr><tr><td>1</td><td>2</td></tr></table>") == "| 1 | 2 |"
    assert md("<table><thead><tr><td>h</td></tr></thead><tbody><tr><td>1</td></tr></tbody></table>") == "| h |\n| - |\n| 1 |"


def test_wrapper_tables():
    inner = "<table><tr><td>x</td><td>y</td></tr></table>"
    assert md(f"<table><tr><td>{inner}</td></tr></table>") == "| x | y |"
    assert md(f"<table><tr><td>{inner}</td><td>{inner}</td></tr></table>") == "| x | y |\n\n| x | y |"


def test_cells():
    assert md("<table><tr><td><img alt=A><img alt=B></td><td>a<br>b</td></tr></table>") == "| A · B | a · b |"
    assert md("<table><tr><td><img alt=A>text</td></tr></table>") == "| text |"
    assert md("<table><tr><td></td></tr></table>") == "|  |"


def test_infobox_sections():
    html = """<table class="infobox"><caption>Cap</caption><tr><th colspan=2>Top</th></tr><tr><th>Born:</th><td>1900<br>Paris</td></tr>
    <tr><th colspan=2>Career</th></tr><tr><th>Job</th><td>x</td></tr><tr><th>Job</th><td>y</td></tr><tr><th>Job</th><td>x</td></tr>
    <tr class=noprint><th>no</th><td>no</td></tr><tr><td>alone</td></tr></table>"""
    assert boxes(html) == [{"title": "Cap", "data": {"Born": "1900 · Paris"}}, {"title": "Career", "data": {"Job": ["x", "y"], "Career": "alone"}}]
    assert ordered(boxes(html))[1]["data"][0] == {"key": "Job", "values": ["x", "y"]}


def test_infobox_without_headings_and_nested():
    assert boxes("<table class=vcard><tr><td>k</td><td>a</td><td>b,</td></tr><tr><td>only</td></tr></table>") == [{"title": "", "data": {"k": "a · b"}}]
    html = "<table class=infobox><tr><th>Name</th></tr><tr><td><table><tr><td>in</td><td>1</td></tr></table></td></tr><tr><th>k</th><td>v</td></tr></table>"
    assert boxes(html) == [{"title": "Name", "data": {"in": "1", "k": "v"}}]


def test_infobox_by_width():
    t = "<table width={}><tr><td>k</td><td>v</td></tr></table>"
    assert boxes(t.format(160)) and md(t.format(160)) in body(t.format(160))  # read and shown
    assert boxes(t.format(200)) and body(t.format(200)) == ""  # read and hidden
    assert not boxes(t.format(500))
    assert not boxes("<table class=wikitable align=right><tr><td>k</td><td>v</td></tr></table>")


def test_loose_infobox():
    assert boxes("<table class=taxobox><caption>C</caption><tr><th scope=row>k</th><td>v</td><td>w</td></tr><tr><td>x</td></tr></table>") == [{"title": "C", "data": {"k": "v · w"}}]


def test_infobox_citations():
    assert boxes('<table class=infobox><tr><td>k</td><td>v<sup class="reference">[1]</sup></td></tr></table>')[0]["data"] == {"k": "v"}


def test_math():
    d = extract('<p>a <span style="display: none"><math alttext="x^2"></math></span><math></math></p><p style="display:none">no</p>')
    assert d.text == "a x^2\n" and d.has_math
    assert not extract("<p>a</p>").has_math


def test_hidden_parts():
    html = '<p>a</p><div class="navbox"><p>no</p></div><div class="hlist"><table><tr><td>no</td></tr></table></div><p class=noprint>no</p><p>b<span class=hatnote>no</span></p>'
    assert body(html) == "a\nb\n"
    assert body('<div typeof="mw:Transclusion" data-mw="{stub}"><p>no</p></div>') == ""
    assert body("<table role=navigation><tr><td>x</td></tr></table>") == ""


def test_pre_and_breaks():
    assert body("<pre>a\nb</pre>") == "```\na\nb\n```\n\n"
    assert body("<p>a<br>b</p>") == "a\nb\n"


def test_base():
    assert base_host("https://x.org:8/a") == "x.org:8"
    assert base_host(None, "dewiki") == "de.wikipedia.org"
    assert base_host("", None, "frwiki_namespace_0") == "fr.wikipedia.org"
    assert base_host("http://[bad", "wiki") == "wikipedia.org"
    assert ensure_base(parse("<p>x"), "h").first("base").get("href") == "//h"
    assert len(ensure_base(parse("<base href=//z>"), "h").all("base")) == 1


def test_out_of_time():
    with pytest.raises(OutOfTime):
        extract("<div><p>x</p></div>" * 3000, seconds=1e-9)


def test_assembled_levels():
    assert assembled(iter([("_Lead", 2, "a"), ("H", 9, " b"), ("H", 9, " c")]), "T") == "# T\na\n\n###### H\nb\n c\n"
    assert list(blocks(parse("<section><h2>A</h2><section><p>x</p></section></section>"), Page())) == [("A", 2, "x")]


def test_deep_pages():
    deep = "<div>" * 5000 + "<p>" + "<span>" * 5000 + "x" + "</span>" * 5000 + "</p>" + "</div>" * 5000
    assert body(deep) == "x\n"
    cell = "<table><tr><td>" + "<b>" * 4000 + "y<img alt=no>" + "</b>" * 4000 + "</td></tr></table>"
    assert md(cell) == "| y |"
    assert boxes(cell.replace("<table>", "<table class=infobox>").replace("<td>", "<td>k</td><td>", 1)) == [{"title": "", "data": {"k": "y"}}]


def test_time_in_tables_and_lists():
    page = Page.within(-1)
    with pytest.raises(OutOfTime):
        table(parse("<table><tr>" + "<td>x<b>y</b></td>" * 200 + "</tr></table>").first("table"), page)
    with pytest.raises(OutOfTime):
        list_text(parse("<ul>" + "<li>x<b>y</b></li>" * 200 + "</ul>").first("ul"), page, classify.BODY_EXCLUDED)
