"""Parsing pages: one parse gives text, infoboxes, whether there is mathematics, and the outcome."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..html import classify
from ..html.document import base_host, blocks, ensure_base, extract
from ..html.document import read as read_document
from ..html.dom import Element, OutOfTime, parse
from ..html.infobox import infoboxes, ordered
from ..html.render import Page, list_text, table
from ..schemas import INFOBOXES

SECONDS = 5.0
#: Pages that a worker holds as Python objects at a time.
AT_ONCE = 256


def tasks_for(rows: DataFrame, per_task: int) -> int:
    return max(1, -(-rows.count() // per_task))


def spread(rows: DataFrame, key: str, per_task: int) -> DataFrame:
    """Rows dealt out by key, so many to a task. A small file makes few tasks, however long the work on its rows takes: deal them out
    before they become pages, while they are small."""
    return rows.repartition(tasks_for(rows, per_task), key)


def parsed(docs: DataFrame, ref_words: dict[str, list[str]] | None = None, seconds: float = SECONDS) -> DataFrame:
    """Documents (id, text, metadata) with parsed text, infoboxes, has_math and outcome; metadata passes as it is.

    outcome: extracted, dropped (no text), timeout or clean_error; a bad record never fails its task.
    ref_words: wiki -> headings left out.
    """
    words = {k: frozenset(v) for k, v in (ref_words or {}).items()}
    read = T.StructType.fromDDL(f"text string, infoboxes {INFOBOXES}, has_math boolean, outcome string, error string")

    def one(html, url, wiki) -> dict:
        try:
            d = extract(html, words.get(wiki or "", frozenset()), seconds, url=url, wikiname=wiki)
            return {"text": d.text, "infoboxes": ordered(d.infoboxes), "has_math": d.has_math, "outcome": "extracted" if d.text else "dropped"}
        except OutOfTime:
            return {"outcome": "timeout"}
        except Exception as e:  # noqa: BLE001  a record's failure is a result
            return {"outcome": "clean_error", "error": f"{type(e).__name__}: {e}"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            meta = b.column("metadata")
            url, wiki = meta.field("url").to_pylist(), meta.field("wikiname").to_pylist()
            rows = pa.array([one(h, u, w) for h, u, w in zip(b.column("text").to_pylist(), url, wiki, strict=True)], pa.struct(list(to_arrow_schema(read))))
            yield pa.RecordBatch.from_arrays([b.column("id"), *rows.flatten(), meta], names=["id", *read.names, "metadata"])

    out = T.StructType([docs.schema["id"], *read, docs.schema["metadata"]])
    return docs.select("id", "text", "metadata").mapInArrow(run, out)


def forwarded(rows: DataFrame) -> DataFrame:
    return rows.where((F.col("outcome") == "extracted") & (F.col("text") != ""))


OUTCOMES = ("extracted", "dropped", "timeout", "clean_error")


def _each(pages: DataFrame, key: str, html: str, read: Callable, schema: str, seconds: float | None = SECONDS) -> DataFrame:
    """Rows (key, schema, error) of read(tree, page state); a record that fails or takes too long is one row with its error."""
    names = [key, *(x.split()[0] for x in schema.split(", ")), "error"]

    out = T.StructType.fromDDL(f"{key} bigint, {schema}, error string")
    kinds = list(to_arrow_schema(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, AT_ONCE):
                part, rows = batch.slice(a, AT_ONCE), []
                for k, h in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    root = None
                    try:
                        root = parse(h, (page := Page.within(seconds)).deadline)
                        rows += [(k, *row, None) for row in read(root, page)]
                    except OutOfTime:
                        rows.append((k, *[None] * (len(names) - 2), "timeout"))
                    except Exception as e:  # noqa: BLE001  a record's failure is a result
                        rows.append((k, *[None] * (len(names) - 2), f"{type(e).__name__}: {e}"))
                    finally:
                        if root is not None:
                            root.release()
                columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], names=names)

    return pages.select(key, html).mapInArrow(run, out)


def html_blocks(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Rows (key, seq, heading, level, text, error)."""
    return _each(pages, key, html, lambda root, page: [(k, *b) for k, b in enumerate(blocks(root, page))], "seq int, heading string, level int, text string")


def html_lists(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Rows (key, list_no, text, error) of top-level lists."""

    def read(root: Element, page: Page):
        tops = [e for e in root.all("ul", "ol") if not e.inside("ul", "ol")]
        return [(k, list_text(e, page, classify.BODY_EXCLUDED)) for k, e in enumerate(tops)]

    return _each(pages, key, html, read, "list_no int, text string")


def html_tables(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Rows (key, table_no, markdown, n_rows, n_cols, error) of top-level tables."""

    def read(root: Element, page: Page):
        out = []
        for k, e in enumerate(t for t in root.all("table") if not t.inside("table")):
            md = table(e, page, classify.BODY_EXCLUDED)
            lines = md.split("\n") if md else []
            out.append((k, md, len(lines), lines[0].replace("\\|", "").count("|") - 1 if lines else 0))
        return out

    return _each(pages, key, html, read, "table_no int, markdown string, n_rows int, n_cols int")


def infobox_values(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Rows (key, box_no, title, entry, name, value_no, value, error)."""

    def read(root: Element, page: Page):
        boxes = ordered(infoboxes(root, page))
        return [(n, b["title"], e, d["key"], v, x) for n, b in enumerate(boxes) for e, d in enumerate(b["data"]) for v, x in enumerate(d["values"])]

    return _each(pages, key, html, read, "box_no int, title string, entry int, name string, value_no int, value string")


def html_markdown(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Rows (key, text, n_infoboxes, has_math, error)."""
    return _each(pages, key, html, lambda root, page: [((d := read_document(root, page)).text, len(d.infoboxes), d.has_math)], "text string, n_infoboxes int, has_math boolean")


def base_hosts(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """The <base href> that each page gets, by page address."""
    return pages.select(key, "url").mapInPandas(
        lambda it: (pd.DataFrame({key: p[key], "base": [ensure_base(parse(""), base_host(u)).first("base").get("href") for u in p["url"]]}) for p in it), f"{key} bigint, base string"
    )


def blocks_without(found: DataFrame, ref_words: DataFrame, on: list[str]) -> DataFrame:
    """Blocks whose heading is not a reference word of their wiki: an anti-join on (wiki, heading). The words are a short list and are
    broadcast: by a shuffle, all blocks under one heading would meet in one task."""
    return found.join(F.broadcast(ref_words), on, "left_anti")


def reassembled(found: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, text, error): markdown from blocks by window and aggregate, a heading where (heading, level) changes. A page that failed has
    its error and no text; an empty text is that of a page whose blocks are empty."""
    from pyspark.sql.window import Window

    w = Window.partitionBy(key).orderBy("seq")
    before = lambda c, start: F.coalesce(F.lag(c).over(w), F.lit(start))
    changed = (F.col("heading") != before("heading", "_Lead")) | (F.col("level") != before("level", 2))
    marks = F.repeat(F.lit("#"), F.greatest(F.lit(2), F.least(F.lit(6), F.col("level"))))
    head = F.when(changed, F.concat(F.lit("\n"), marks, F.lit(" "), F.col("heading"), F.lit("\n"))).otherwise("")
    body = F.when(F.trim("text") == "", "").otherwise(F.concat(F.when(changed, F.regexp_replace("text", r"^\s+", "")).otherwise(F.col("text")), F.lit("\n")))
    piece = found.withColumn("piece", F.concat(head, body))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "piece"))), lambda x: x["piece"]), "")
    return piece.groupBy(key).agg(F.when(F.max("error").isNull(), text).alias("text"), F.max("error").alias("error"))
