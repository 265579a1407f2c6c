"""Page functions for SQL texts: table functions with a static `analyze`.

    SELECT p.page_id, b.* FROM pages p, LATERAL page_blocks(p.html) b
    SELECT * FROM page_tables(TABLE(SELECT page_id, html FROM pages) PARTITION BY page_id)

Given a table, its first column is passed through under its own name and type, and its `html` is read; a table without that
column, or html that isn't a string, is an error of the analysis, before anything runs. A page that fails or takes too long
is one row with its error.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from .html import classify
from .html.document import blocks
from .html.dom import OutOfTime, parse
from .html.infobox import infoboxes, ordered
from .html.render import Page, list_text, table
from .operators.parse import SECONDS


def _blocks(html: str | None, page: Page):
    return [(k, *b) for k, b in enumerate(blocks(parse(html, page.deadline), page))]


def _lists(html: str | None, page: Page):
    tops = [e for e in parse(html, page.deadline).all("ul", "ol") if not e.inside("ul", "ol")]
    return [(k, list_text(e, page, classify.BODY_EXCLUDED)) for k, e in enumerate(tops)]


def _tables(html: str | None, page: Page):
    out = []
    for k, e in enumerate(t for t in parse(html, page.deadline).all("table") if not t.inside("table")):
        md = table(e, page, classify.BODY_EXCLUDED)
        lines = md.split("\n") if md else []
        out.append((k, md, len(lines), lines[0].replace("\\|", "").count("|") - 1 if lines else 0))
    return out


def _infoboxes(html: str | None, page: Page):
    boxes = ordered(infoboxes(parse(html, page.deadline), page))
    return [(n, b["title"], e, d["key"], v, x) for n, b in enumerate(boxes) for e, d in enumerate(b["data"]) for v, x in enumerate(d["values"])]


FUNCTIONS = {
    "page_blocks": (_blocks, "seq int, heading string, level int, text string"),
    "page_lists": (_lists, "list_no int, text string"),
    "page_tables": (_tables, "table_no int, markdown string, n_rows int, n_cols int"),
    "page_infoboxes": (_infoboxes, "box_no int, title string, entry int, name string, value_no int, value string"),
}


def _function(read: Callable, ddl: str):
    columns = T.StructType.fromDDL(f"{ddl}, error string")

    class Function:
        @staticmethod
        def analyze(page: AnalyzeArgument) -> AnalyzeResult:
            if not page.isTable:
                html, passed = page.dataType, []
            else:
                fields = {f.name: f for f in page.dataType}
                if "html" not in fields:
                    raise ValueError("the table has no column html")
                html, first = fields["html"].dataType, page.dataType.fields[0]
                passed = [first] if first.name != "html" else []
            if not isinstance(html, (T.StringType, T.NullType)):
                raise ValueError(f"html is {html.simpleString()}, not string")
            return AnalyzeResult(schema=T.StructType([*passed, *columns]))

        def eval(self, page):
            passed, html = (), page
            if isinstance(page, T.Row):
                html = page["html"]
                passed = (page[0],) if page.__fields__[0] != "html" else ()
            try:
                for row in read(html, Page.within(SECONDS)):
                    yield (*passed, *row, None)
            except OutOfTime:
                yield (*passed, *[None] * (len(columns) - 1), "timeout")
            except Exception as e:  # noqa: BLE001  a record's failure is a result
                yield (*passed, *[None] * (len(columns) - 1), f"{type(e).__name__}: {e}")

    return udtf(Function)


def register(spark: SparkSession) -> None:
    """Make the functions known to SQL texts of the session."""
    for name, (read, ddl) in FUNCTIONS.items():
        spark.udtf.register(name, _function(read, ddl))
