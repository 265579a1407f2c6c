"""Queries over the given pages, and over encyclopedia-like pages that are made of the suppliers, nations, regions, orders and line items; the SQL
makes the expected text from the tables' columns, without any HTML."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import pages, parse
from .queries import query, table
from .session import DEFAULTS
from .sql_surface import register

#: Suppliers and orders that make the pages of a task: some seconds of work.
PAGES_PER_TASK, ORDERS_PER_TASK = 2000, 25_000

# One page per supplier: k its key, name, n its nation, r its region, bal its balance.
_PAGE = [
    '<html><head><title> {name} </title></head><body><table class="infobox"><caption>{name}</caption><tr><th colspan=2>Trade</th></tr>',
    '<tr><th>Nation:</th><td>{n}<br>{r}</td></tr><tr><th colspan="2">Account</th></tr><tr><th scope="row">Balance</th><td>{bal}<sup class="reference">[1]</sup></td></tr>',
    "<tr><th>Mark</th><td>a{k}</td></tr><tr><th>Mark</th><td>b{k}&nbsp;,</td></tr><tr><th>Mark</th><td>a{k}</td></tr><tr class=noprint><th>no</th><td>no</td></tr>",
    '<tr><td><table><tr><td>In:</td><td>{k}</td><td>{n};</td></tr></table></td></tr><tr><td>alone {k}</td></tr><tr><td class="infobox-below">no</td><td>no</td></tr></table>',
    "<table width=300><tr><td>Side</td><td>{k}</td></tr></table>",
    '<p>Lead of <b>{name}</b><sup class="reference">[1]</sup>.</p>stray<h1>no</h1><p>Kept<span class="hatnote">no</span> {k}</p><h2>Empty</h2><h2>Trade</h2><h3>Places</h3>',
    '<ul><li>{n}<ul><li>{r}</li></ul></li><li><img alt="x"></li><li>third<sup class="reference">[2]</sup></li></ul><ol><li>one {k}</li><li> </li><li>two</li></ol><h3>Nothing</h3>',
    '<h2>Numbers</h2><p style="display : none">hidden</p><p>{n}<br>{r}{math}</p><div class="navbox"><p>no</p></div><p class="noprint">no</p>',
    '<div typeof="mw:Transclusion" data-mw="a stub"><p>no</p></div><div role="navigation"><table><tr><td>no</td></tr></table></div><div id=toc><ul><li>no</li></ul></div>',
    '<blockquote>Quoted {k}</blockquote><pre>a {k}\nb</pre><table class="wikitable"><tr><th>k</th><th colspan=2>v|w</th></tr>',
    "<tr><td rowspan=2>{k}</td><td>2</td><td>{n}</td></tr><tr><td>5</td><td><img alt=A>six</td></tr><tr><td></td><td colspan=2>lone</td></tr></table>",
    '<h2>References</h2><p>gone</p><ol class="references"><li>gone too</li></ol><h3>Other</h3><section><h4>Deep</h4><section><p>stays {k}</p></section></section></body></html>',
]


def supplier_pages(spark, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    s = parse.spread(s.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"), "s_suppkey", PAGES_PER_TASK)
    rows = s.join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("s_suppkey").cast("bigint")
    value = {"name": F.col("s_name"), "n": F.col("n_name"), "r": F.col("r_name"), "k": k.cast("string"), "bal": F.floor("s_acctbal").cast("string")}
    value["math"] = F.when(k % 3 == 0, F.concat(F.lit(' <span style="display: none"><math alttext="x_'), value["k"], F.lit('"></math></span>'))).otherwise("")
    html = F.lit("".join(_PAGE))
    for name, v in value.items():
        html = F.replace(html, F.lit(f"{{{name}}}"), v)
    return rows.select(k.alias("page_id"), html.alias("html"))


_P = """p AS (SELECT CAST(s_suppkey AS BIGINT) AS page_id, CAST(s_suppkey AS VARCHAR) AS k, s_name AS name, n_name AS n, r_name AS r, CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR) AS bal,
  CASE WHEN s_suppkey % 3 = 0 THEN ' x_' || s_suppkey ELSE '' END AS math FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _lines(rows: list[list[str]], widths: list[str]) -> str:
    """SQL for a pipe table: each cell an expression, padded to its column's width."""
    return " || chr(10) || ".join("'| ' || " + " || ' | ' || ".join(f"rpad({c}, CAST({w} AS INTEGER), ' ')" for c, w in zip(row, widths, strict=True)) + " || ' |'" for row in rows)


_W3 = "greatest(4, length(n))"
_SPANS = _lines(
    [["'k'", "'v\\|w'", "'v\\|w'"], ["repeat('-', length(k))", "'----'", f"repeat('-', {_W3})"], ["k", "'2'", "n"], ["k", "'5'", "'six'"], ["''", "'lone'", "''"]], ["length(k)", "4", _W3]
)
_W1, _W2 = "greatest(8, length('In: ' || k || ' ' || n || ';'))", "greatest(5, length(n || ' · ' || r), length(bal), length('b' || k || ' ,'))"
_BOX = _lines(
    [
        ["'Trade'", "'Trade'"], [f"repeat('-', {_W1})", f"repeat('-', {_W2})"], ["'Nation:'", "n || ' · ' || r"], ["'Account'", "''"], ["'Balance'", "bal"], ["'Mark'", "'a' || k"],
        ["'Mark'", "'b' || k || ' ,'"], ["'Mark'", "'a' || k"], ["'no'", "'no'"], ["'In: ' || k || ' ' || n || ';'", "''"], ["'alone ' || k", "''"], ["'no'", "'no'"],
    ], [_W1, _W2],
)
_SIDE = "'| Side | ' || k || ' |'"
_FOUND = [
    ("_Lead", 2, _SIDE), ("_Lead", 2, "'Lead of ' || name || '.'"), ("_Lead", 2, "'Kept ' || k"), ("Trade", 2, "''"),
    ("Places", 3, "'- ' || n || '  - ' || r || chr(10) || '- third[2]' || chr(10)"), ("Places", 3, "'1. one ' || k || chr(10) || '2. two' || chr(10)"), ("Numbers", 2, "n || chr(10) || r || math"),
    ("Numbers", 2, "'Quoted ' || k"), ("Numbers", 2, "'```' || chr(10) || 'a ' || k || chr(10) || 'b' || chr(10) || '```' || chr(10)"), ("Numbers", 2, _SPANS), ("References", 2, "'gone'"),
    ("References", 2, "'1. gone too' || chr(10)"), ("Other", 3, "''"), ("Deep", 4, "'stays ' || k"),
]
_BLOCKS = f"{_P}, b AS (" + " UNION ALL ".join(f"SELECT page_id, CAST({i} AS INTEGER) AS seq, '{h}' AS heading, CAST({v} AS INTEGER) AS level, {t} AS text FROM p" for i, (h, v, t) in enumerate(_FOUND)) + ")"


def _markdown(keep: str = "true") -> str:
    return f"""m AS (SELECT page_id, string_agg(piece, '' ORDER BY seq) AS text FROM (SELECT page_id, seq,
  CASE WHEN heading <> lag(heading, 1, '_Lead') OVER w OR level <> lag(level, 1, 2) OVER w THEN chr(10) || repeat('#', level) || ' ' || heading || chr(10) ELSE '' END
  || CASE WHEN text = '' THEN '' ELSE text || chr(10) END AS piece FROM b WHERE {keep} WINDOW w AS (PARTITION BY page_id ORDER BY seq)) GROUP BY page_id)"""


@query(f"WITH {_BLOCKS} SELECT page_id, seq, heading, level, text FROM b")
def wiki_blocks(spark, sf_dir):
    return parse.html_blocks(supplier_pages(spark, sf_dir)).drop("error")


@query(f"WITH {_BLOCKS}, {_markdown()} SELECT page_id, '# ' || name || chr(10) || text AS text, CAST(3 AS INTEGER) AS n_infoboxes, math <> '' AS has_math FROM m JOIN p USING (page_id)")
def wiki_markdown(spark, sf_dir):
    return parse.html_markdown(supplier_pages(spark, sf_dir)).drop("error")


_NO_REFERENCES = _markdown("heading <> 'References'")


@query(f"WITH {_BLOCKS}, {_NO_REFERENCES} SELECT page_id, text FROM m")
def wiki_reassembled(spark, sf_dir):
    words = spark.createDataFrame([("References",)], "heading string").coalesce(1)
    return parse.reassembled(parse.blocks_without(parse.html_blocks(supplier_pages(spark, sf_dir)), words, ["heading"])).drop("error")


_LISTS = f"""WITH {_BLOCKS} SELECT page_id, CAST(CASE seq WHEN 4 THEN 0 WHEN 5 THEN 1 ELSE 3 END AS INTEGER) AS list_no, text FROM b WHERE seq IN (4, 5, 11)
UNION ALL SELECT page_id, CAST(2 AS INTEGER), '- no' || chr(10) FROM p"""


@query(_LISTS)
def wiki_lists(spark, sf_dir):
    return parse.html_lists(supplier_pages(spark, sf_dir)).drop("error")


_SPANNED = f"""WITH {_P}, t AS (SELECT page_id, 0 AS table_no, {_BOX} AS markdown, 12 AS n_rows, 2 AS n_cols FROM p UNION ALL SELECT page_id, 1, {_SIDE}, 1, 2 FROM p
UNION ALL SELECT page_id, 2, '| no |', 1, 1 FROM p UNION ALL SELECT page_id, 3, {_SPANS}, 5, 3 FROM p)
SELECT page_id, CAST(table_no AS INTEGER) AS table_no, markdown, CAST(n_rows AS INTEGER) AS n_rows, CAST(n_cols AS INTEGER) AS n_cols FROM t"""


@query(_SPANNED)
def html_table_spans(spark, sf_dir):
    return parse.html_tables(supplier_pages(spark, sf_dir)).drop("error")


_FACTS = [
    (0, "name", 0, "Nation", 0, "n || ' · ' || r"), (1, "'Account'", 0, "Balance", 0, "bal"), (1, "'Account'", 1, "Mark", 0, "'a' || k"), (1, "'Account'", 1, "Mark", 1, "'b' || k"),
    (1, "'Account'", 2, "In", 0, "k || ' · ' || n"), (1, "'Account'", 3, "Account", 0, "'alone ' || k"), (2, "''", 0, "Side", 0, "k"),
]


_FACTED = f"WITH {_P} " + " UNION ALL ".join(
        f"SELECT page_id, CAST({b} AS INTEGER) AS box_no, {t} AS title, CAST({e} AS INTEGER) AS entry, '{name}' AS name, CAST({i} AS INTEGER) AS value_no, {v} AS value FROM p"
        for b, t, e, name, i, v in _FACTS
    )


@query(_FACTED)
def infobox_sections(spark, sf_dir):
    return parse.infobox_values(supplier_pages(spark, sf_dir)).drop("error")


# Every third order's page has its fact box only as the looser reading knows it: rows in a taxobox.
_LOOSE = """SELECT page_id, CAST(0 AS INTEGER) AS box_no, title, CAST(e.entry AS INTEGER) AS entry, e.name, CAST(0 AS INTEGER) AS value_no,
  CASE e.entry WHEN 0 THEN status || ' · ' || CAST(page_id % 9 AS VARCHAR) ELSE priority END AS value
FROM (SELECT CAST(o_orderkey AS BIGINT) AS page_id, CASE WHEN o_orderkey % 2 = 0 THEN 'Order ' || o_orderkey ELSE 'Status' END AS title, o_orderstatus AS status, o_orderpriority AS priority FROM orders)
CROSS JOIN (VALUES (0, 'Status'), (1, 'Priority')) e(entry, name)"""


@query(_LOOSE)
def infobox_loose(spark, sf_dir):
    k = F.col("o_orderkey")
    cap = F.when(k % 2 == 0, F.concat(F.lit("<caption>Order "), k, F.lit("</caption>"))).otherwise("")
    html = F.concat(
        F.lit('<table class="taxobox">'), cap, F.lit("<tr><th scope=row>Status</th><td>"), "o_orderstatus", F.lit("</td><td>"), k % 9, F.lit("</td></tr><tr><td>alone</td></tr><tr><td>x</td>"
        '<td class="infobox-label">Priority</td><td>'), "o_orderpriority", F.lit("</td></tr></table><p>text</p>"),
    )
    orders = parse.spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), "o_orderkey", ORDERS_PER_TASK)
    return parse.infobox_values(orders.select(k.cast("bigint").alias("page_id"), html.alias("html"))).drop("error")


_HOLD = "greatest(2, max(length(CAST(l_linenumber AS VARCHAR)))) AS w1, greatest(3, max(length(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)))) AS w2"


@query(
    f"""WITH i AS (SELECT l_orderkey, {_HOLD} FROM lineitem GROUP BY 1),
lines AS (SELECT l_orderkey, '| ' || rpad('no', CAST(w1 AS INTEGER), ' ') || ' | ' || rpad('qty', CAST(w2 AS INTEGER), ' ') || ' | flag |' || chr(10) || '| ' || repeat('-', w1) || ' | ' || repeat('-', w2) || ' | ---- |' || chr(10)
  || string_agg('| ' || rpad(CAST(l_linenumber AS VARCHAR), CAST(w1 AS INTEGER), ' ') || ' | ' || rpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), CAST(w2 AS INTEGER), ' ') || ' | ' || rpad(l_returnflag, 4, ' ') || ' |',
    chr(10) ORDER BY l_linenumber, l_quantity, l_returnflag) AS markdown, count(*) AS n FROM lineitem JOIN i USING (l_orderkey) GROUP BY l_orderkey, w1, w2),
box AS (SELECT o_orderkey, greatest(length(o_orderstatus), length(o_orderpriority)) AS w, o_orderstatus AS s, o_orderpriority AS q FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
SELECT CAST(l_orderkey AS BIGINT) AS page_id, CAST(1 AS INTEGER) AS table_no, markdown, CAST(n + 2 AS INTEGER) AS n_rows, CAST(3 AS INTEGER) AS n_cols FROM lines
WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT CAST(o_orderkey AS BIGINT), CAST(0 AS INTEGER), '| Status:  | ' || rpad(s, CAST(w AS INTEGER), ' ') || ' |' || chr(10) || '| Priority | ' || rpad(q, CAST(w AS INTEGER), ' ') || ' |', CAST(2 AS INTEGER), CAST(2 AS INTEGER) FROM box"""
)
def html_tables(spark, sf_dir):
    return parse.html_tables(order_pages(spark, sf_dir)).drop("error")


def order_pages(spark, sf_dir) -> DataFrame:
    """Orders as pages with a data table and an infobox."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    n = parse.tasks_for(orders, ORDERS_PER_TASK)
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    o = orders.repartition(n, "o_orderkey").join(items.repartition(n, "l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    row = F.concat(F.lit("<tr><td>"), "l_linenumber", F.lit("</td><td>"), F.col("l_quantity").cast("int"), F.lit("</td><td>"), "l_returnflag", F.lit("</td></tr>"))
    rows = o.groupBy("o_orderkey", "o_orderstatus", "o_orderpriority").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_quantity", row.alias("r")))).alias("rows"))
    html = F.concat(
        F.lit('<table class="infobox"><caption>Order '), "o_orderkey", F.lit("</caption><tr><th>Status:</th><td>"), "o_orderstatus", F.lit("</td></tr><tr><th>Priority</th><td>"),
        "o_orderpriority", F.lit("</td></tr></table><table class=wikitable><tr><th>no</th><th>qty</th><th>flag</th></tr>"), F.array_join(F.transform("rows", lambda x: x["r"]), ""), F.lit("</table>"),
    )
    return rows.select(F.col("o_orderkey").cast("bigint").alias("page_id"), html.alias("html"))


@query(
    """SELECT DISTINCT CAST(o_orderkey AS BIGINT) AS page_id, 0 AS box_no, 'Order ' || o_orderkey AS title, e.entry, e.name, 0 AS value_no, CASE e.entry WHEN 0 THEN o_orderstatus ELSE o_orderpriority END AS value
FROM orders JOIN lineitem ON o_orderkey = l_orderkey CROSS JOIN (VALUES (0, 'Status'), (1, 'Priority')) e(entry, name)"""
)
def infobox_kv(spark, sf_dir):
    return parse.infobox_values(order_pages(spark, sf_dir)).drop("error")


@query(
    f"""WITH {_BLOCKS}, {_NO_REFERENCES}, r AS (SELECT p.page_id, CASE WHEN p.page_id % 23 = 11 THEN '' ELSE '# ' || name || chr(10) || text END AS text, math, p.page_id % 23 AS z FROM p JOIN m USING (page_id))
SELECT 'enwiki/' || page_id AS id, text, CAST(CASE z WHEN 11 THEN 0 ELSE 3 END AS INTEGER) AS n_infoboxes, z <> 11 AND math <> '' AS has_math, CASE z WHEN 11 THEN 'dropped' ELSE 'extracted' END AS outcome
FROM r WHERE z NOT IN (1, 2, 3, 4, 5, 7, 8) AND (page_id % 29 <> 0 OR page_id >= 10000 OR z = 10)"""
)
def wiki_parsed(spark, sf_dir):
    """The whole first stage: records are judged, and the kept ones parsed; one in 23 has nothing to show."""
    from .queries import disambiguations, raw_pages

    p = supplier_pages(spark, sf_dir)
    html = F.when(F.col("page_id") % 23 == 11, "<body>stray</body>").otherwise(F.col("html"))
    p = p.select("page_id", F.concat(F.lit("https://en.wikipedia.org/wiki/"), "page_id").alias("url"), html.alias("html"))
    docs = pages.documents(pages.judged(raw_pages(p), disambiguations(spark)))
    return parse.parsed(docs, {"enwiki": ["References"]}).select("id", "text", F.size("infoboxes").alias("n_infoboxes"), "has_math", "outcome")


# The same by SQL texts -----------------------------------------------------------------------------------------------


def _by_sql(spark, sf_dir, text: str) -> DataFrame:
    register(spark)
    view = f"wiki_{uuid.uuid4().hex}"
    supplier_pages(spark, sf_dir).createOrReplaceTempView(view)
    return spark.sql(text.format(pages=view))


@query(f"WITH {_BLOCKS} SELECT page_id, seq, heading, level, text FROM b")
def sql_blocks(spark, sf_dir):
    return _by_sql(spark, sf_dir, "SELECT p.page_id, b.seq, b.heading, b.level, b.text FROM {pages} p, LATERAL page_blocks(p.html) b")


@query(_LISTS)
def sql_lists(spark, sf_dir):
    return _by_sql(spark, sf_dir, "SELECT page_id, list_no, text FROM page_lists(TABLE(SELECT page_id, html FROM {pages}) PARTITION BY page_id)")


@query(_SPANNED)
def sql_tables(spark, sf_dir):
    return _by_sql(spark, sf_dir, "SELECT page_id, table_no, markdown, n_rows, n_cols FROM page_tables(TABLE({pages}) PARTITION BY page_id)")


@query(_FACTED)
def sql_infoboxes(spark, sf_dir):
    return _by_sql(spark, sf_dir, "SELECT page_id, box_no, title, entry, name, value_no, value FROM page_infoboxes(TABLE({pages}) PARTITION BY page_id)")


# The given pages ----------------------------------------------------------------------------------------------------


def given_pages(spark, sf_dir) -> DataFrame:
    """Pages are long, and both sides hold whole Arrow batches: they are made smaller if the session has no size of its own for them."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, DEFAULTS[rows])
    return table(spark, sf_dir, "pages")


@query()
def html_blocks(spark, sf_dir):
    return parse.html_blocks(given_pages(spark, sf_dir))


@query()
def html_markdown(spark, sf_dir):
    return parse.html_markdown(given_pages(spark, sf_dir))


@query()
def html_reassembled(spark, sf_dir):
    words = spark.createDataFrame([("References",)], "heading string").coalesce(1)
    return parse.reassembled(parse.blocks_without(parse.html_blocks(given_pages(spark, sf_dir)), words, ["heading"]))


@query()
def html_lists(spark, sf_dir):
    return parse.html_lists(given_pages(spark, sf_dir))


@query()
def parsed_pages(spark, sf_dir):
    """The whole first stage on the given pages."""
    from .queries import disambiguations, raw_pages

    docs = pages.documents(pages.judged(raw_pages(given_pages(spark, sf_dir)), disambiguations(spark)))
    return parse.parsed(docs, {"enwiki": ["References"]}).select("id", "text", F.size("infoboxes").alias("n_infoboxes"), "has_math", "outcome")
