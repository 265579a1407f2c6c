"""What a task gets to do at size: work is dealt out by rows or bytes, and deep nesting costs no more than its length."""

import gc
import random
import uuid
from html.parser import HTMLParser

import pyarrow as pa
import pytest

from lexmill import file_queries, html_queries
from lexmill import queries as own
from lexmill.html import classify as K
from lexmill.html import dom, render
from lexmill.operators import parse
from lexmill.plans import calls
from lexmill.sources import archives
from tests.conftest import DATA, oracle, same


def _tasks(df) -> int:
    return df.rdd.getNumPartitions()


def test_deep_nesting_asks_each_element_once(monkeypatch):
    asked = []
    monkeypatch.setattr(K, "has_part", lambda e, parts, real=K.has_part: asked.append(e) or real(e, parts))
    deep = dom.parse('<div class="a"><ul class="b">' * 300).all("div", "ul")
    assert not any(K.navigation(e) for e in deep)
    assert len(asked) <= 2 * len(deep)
    inner = dom.parse('<div class="navbox"><p><b>x</b></p></div><p>y</p>')
    assert [K.navigation(e) for e in inner.all("b", "p")] == [True, True, False]


def test_plain_tags_are_read_as_the_standard_tokenizer_does(monkeypatch):
    r = random.Random(1)
    bits = ['<p>', '</p>', '<td class="a b">', '<td class=a>', "<td class='a'>", '<a href="x?a&amp;b">', "</TD >", "<br/>", "<td a=1 a=2>", "a &lt b", "<", "<!-- <p> -->", "<script>", "</script>", "<td nowrap>", '<a b="c"d="e">', "&nbsp;", "\n"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(1, 25))) for _ in range(2000)]

    def trees():
        out = []
        for t in texts:
            todo = [dom.parse(t)]
            for e in todo:
                out.append((e.name, tuple(e.attrs.items()), [c if isinstance(c, str) else c.name for c in e.children]))
                todo += e.elements()
        return out

    got = trees()
    for name in ("goahead", "parse_starttag", "parse_endtag", "updatepos"):
        monkeypatch.setattr(dom._Builder, name, getattr(HTMLParser, name))
    assert got == trees()


def test_failing_pages_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(file_queries, "PAGES_PER_TASK", 2)
    found = own.QUERIES["failing_pages"](spark, f"{DATA}/sf0.001")
    assert _tasks(found) == 5
    same(found.toPandas(), oracle(own.SQL["failing_pages"]))


@pytest.mark.parametrize("name", ["wiki_blocks", "wiki_parsed", "wiki_forwarded", "wiki_lists", "wiki_markdown"])
def test_supplier_pages_are_dealt_out(spark, monkeypatch, name):
    monkeypatch.setattr(html_queries, "PAGES_PER_TASK", 2)
    assert _tasks(own.QUERIES[name](spark, f"{DATA}/sf0.001")) == 5


@pytest.mark.parametrize("name", ["infobox_kv", "html_tables", "infobox_loose"])
def test_orders_are_dealt_out(spark, monkeypatch, name):
    monkeypatch.setattr(html_queries, "ORDERS_PER_TASK", 100)
    assert _tasks(own.QUERIES[name](spark, f"{DATA}/sf0.001")) == 15


def test_reference_words_are_broadcast(spark):
    found = spark.range(5).selectExpr("id as page_id", "if(id = 1, 'References', null) as heading")
    words = spark.createDataFrame([("References",)], "heading string")
    kept = parse.blocks_without(found, words, ["heading"])
    assert "BroadcastHashJoin" in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.page_id for r in kept.collect()) == [0, 2, 3, 4]


@pytest.mark.parametrize("name", ["archived_documents", "archives_stream"])
def test_archives_grow_in_number(spark, monkeypatch, name):
    monkeypatch.setattr(archives, "ARCHIVE_BYTES", 50_000)
    sizes = []
    monkeypatch.setattr(archives, "write_tar_jsonl", lambda lines, *a, real=archives.write_tar_jsonl: sizes.extend(lines.rdd.glom().map(lambda rows: sum(len(r.value.encode()) for r in rows)).collect()) or real(lines, *a))
    same(own.QUERIES[name](spark, f"{DATA}/sf0.001").toPandas(), oracle(own.SQL[name]))
    assert len(sizes) >= 5 and max(sizes) <= 150_000


def test_workers_hold_few_pages_at_a_time(spark):
    class Taken:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    run = parse.html_lists(Taken())
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(["<ul><li>a</ul>"] * 1000)], names=["page_id", "html"])
    sizes = [b.num_rows for b in run(iter([batch]))]
    assert sum(sizes) == 1000 and max(sizes) <= parse.AT_ONCE


@pytest.mark.parametrize("name", ["html_tables", "html_blocks", "html_lists", "html_markdown", "infobox_values"])
def test_trees_do_not_wait_for_the_garbage_collection(spark, name):
    class Taken:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    page = "<h2>x</h2><table class=infobox><tr><th>a</th><td>b<br>c</td></tr></table><ul><li>d</ul><table><tr><td>e</td></tr></table>"
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array([page] * 50)], names=["page_id", "html"])
    run = getattr(parse, name)(Taken())
    gc.collect()
    gc.disable()
    try:
        found = list(run(iter([batch])))
        assert sum(b.num_rows for b in found) >= 50
        assert sum(type(x) is dom.Element for x in gc.get_objects()) <= 20  # those of one page at most
    finally:
        gc.enable()


def test_plain_rows_of_tables_keep_gaps_spans_and_padding():
    page = "<table><tr><th>a|b<th>c</th></tr><tr><td rowspan=2>1</td><td>\u4e2d</td></tr><tr><td>2</td><td> </td></tr><tr><td>x</td><td></td></tr></table>"
    got = render.table(dom.parse(page).first("table"), render.Page())
    assert got == "| a\\|b | c  |\n| ---- | -- |\n| 1    | \u4e2d |\n| 1    | 2  |\n| x    |    |"


@pytest.mark.parametrize("name", ["html_blocks", "html_markdown", "html_reassembled", "html_lists", "parsed_pages"])
def test_pages_come_in_small_batches(spark, name):
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    try:
        spark.conf.set(rows, "10000")
        own.QUERIES[name](spark, f"{DATA}/sf0.001")
        assert int(spark.conf.get(rows)) <= 1000
        spark.conf.set(rows, "3000")
        own.QUERIES[name](spark, f"{DATA}/sf0.001")
        assert spark.conf.get(rows) == "3000"  # the session's own
    finally:
        spark.conf.set(rows, before)


def test_a_failed_page_is_no_empty_text(spark, tmp_path):
    pages = [(1, "<p>a</p><h2>References</h2><p>b</p>"), (2, "<p>a</p>" + "<ul><li>" * 3000), (3, "<h2>References</h2><h2>H</h2><table></table>")]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.text, (r.error or "").split(":")[0]) for r in own.QUERIES["html_reassembled"](spark, str(tmp_path)).collect()}
    assert got[1] == ("a\n", "") and got[2] == (None, "RecursionError")
    late = parse._each(spark.createDataFrame(pages[:1], "page_id long, html string"), "page_id", "html", lambda root, page: 1 / 0, "seq int, heading string, level int, text string")
    assert [(r.text, r.error) for r in parse.reassembled(late).collect()] == [(None, "ZeroDivisionError: division by zero")]


def test_calls_go_by_rounds(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(k, f"t{k}" * 50) for k in range(300)], "doc_id long, text string")
    made = tmp_path / "made"
    made.mkdir()

    def call(text):
        (made / uuid.uuid4().hex).write_text(text)
        return len(text)

    run = lambda: calls.called(rows, call, str(tmp_path / "journal"), at_once=4, threads=2)
    monkeypatch.setattr(calls, "LANE_BYTES", 6_000)
    found = run()
    assert found.rdd.getNumPartitions() > 2 and len(list(made.iterdir())) == 300  # rounds of two lanes, made one after another
    want = sorted((k, str(len(f"t{k}") * 50)) for k in range(300))
    assert sorted((r.doc_id, r.answer) for r in found.collect()) == want
    monkeypatch.setattr(calls, "LANE_BYTES", 1 << 30)
    assert sorted((r.doc_id, r.answer) for r in run().collect()) == want  # one round finds the journals of several
    assert len(list(made.iterdir())) == 300
