"""Queries that write a table through a sink, to a folder that the cluster shares, and read it back through its source."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .html_queries import _BLOCKS, _NO_REFERENCES, PAGES_PER_TASK, supplier_pages
from .operators import catalog, filter_docs, pages, parse
from .plans import calls, lengths
from .queries import _HISTOGRAM, _PRICES, _SAMPLE, _SNAP, _snapshots, disambiguations, docs_of, query, raw_pages, table
from .schemas import METADATA
from .sources import archives, files, growing
from .staging import shared_dir
from .streaming import sampling


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/lexmill-{name}-{uuid.uuid4().hex}"


def _mounted(path: str) -> str:
    return re.sub("^file:/+", "/", path)


def _records(spark, sf_dir) -> DataFrame:
    """Documents as (text, id, metadata)."""
    m = {"wikiname": F.concat("lang", F.lit("wiki")), "page_id": F.col("doc_id"), "in_language": F.col("lang"), "bytes_html": F.octet_length("text"), "version": F.lit(1)}
    kinds = dict(x.strip().split(" ", 1) for x in files._fields(METADATA))
    fields = [m.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()]
    return docs_of(spark, sf_dir).select("text", F.col("doc_id").cast("string").alias("id"), F.struct(*fields).alias("metadata"))


@query("SELECT CAST(doc_id AS VARCHAR) AS id, md5(text) AS md5, lang || 'wiki' AS wikiname, doc_id AS page_id FROM documents")
def documents_json(spark, sf_dir):
    path = _folder(spark, "json")
    files.write_documents(_records(spark, sf_dir), path)
    return files.read_documents(spark, path).select("id", F.md5("text").alias("md5"), "metadata.wikiname", "metadata.page_id")


@query("SELECT CAST(doc_id AS VARCHAR) AS id, md5(text) AS md5, lang AS language_code, CAST(strlen(text) AS BIGINT) AS bytes_html, '' AS wikitext, CAST(1 AS BIGINT) AS version, false AS has_math FROM documents")
def published_files(spark, sf_dir):
    """The fixed schema as Parquet by language, in files of some megabytes, and back."""
    path = _folder(spark, "published")
    files.write_published(filter_docs.published(_records(spark, sf_dir)), path, by_language=True, bytes_per_file=8 << 20)
    return files.read_published(spark, path).select("id", F.md5("text").alias("md5"), "language_code", "bytes_html", "wikitext", "version", "has_math")


@query("SELECT DISTINCT lang AS subset, CASE WHEN lang = 'en' THEN 'Latn' ELSE 'Latn,Hani' END AS scripts FROM documents WHERE lang IS NOT NULL")
def script_csv(spark, sf_dir):
    path = _folder(spark, "csv")
    rows = docs_of(spark, sf_dir).where("lang is not null").select(F.col("lang").alias("subset"), F.when(F.col("lang") == "en", "Latn").otherwise("Latn/Hant").alias("scripts")).distinct()
    rows.write.option("header", True).csv(path)
    return filter_docs.script_map(files.read_script_map(spark, path)).select("subset", F.array_join("scripts", ",").alias("scripts"))


@query("SELECT 'Q' || c_custkey AS item FROM customer")
def entity_ids(spark, sf_dir):
    """Entity addresses from JSON arrays, one per nation."""
    path = _folder(spark, "ids")
    item = F.struct(F.concat(F.lit("http://x/entity/Q"), "c_custkey").alias("item"))
    rows = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.to_json(F.collect_list(item)).alias("value"))
    rows.write.partitionBy("c_nationkey").text(path)
    return files.read_disambiguation_ids(spark, path).select("item")


@query(
    f"""WITH {_SAMPLE} SELECT CAST(doc_id AS VARCHAR) AS article_id, CAST(len AS INTEGER) AS article_length, bucket, len // 4 AS prompt_tokens, CAST(7 AS BIGINT) AS completion_tokens FROM sample"""
)
def sample_results_json(spark, sf_dir):
    """Nested results of sampled documents as JSON, read tolerantly."""
    path = _folder(spark, "results")
    s = lengths.sample_first(docs_of(spark, sf_dir))
    tokens = F.struct(F.floor(F.col("len") / 4).alias("prompt_tokens"), F.lit(7).alias("completion_tokens"))
    r = F.struct(F.col("doc_id").cast("string").alias("article_id"), F.col("len").alias("article_length"), "bucket", F.struct(tokens.alias("tokens")).alias("extraction"))
    s.agg(F.to_json(F.collect_list(r)).alias("value")).write.text(path)  # PER_BUCKET rows of each bucket at most
    raw = files.read_sample_results(spark, path).where("corrupt is null")
    return lengths.flat_results(raw)


@query(f"WITH {_HISTOGRAM} SELECT bucket, n FROM histogram")
def histogram_json(spark, sf_dir):
    path = _folder(spark, "histogram")
    files.to_json_object(lengths.bucket_histogram(docs_of(spark, sf_dir)), "bucket").write.text(path)
    return files.from_json_object(spark, path, "bigint")


@query("SELECT doc_id AS id, CAST(length(text) AS INTEGER) AS n FROM documents")
def resumed_rows(spark, sf_dir):
    """A keyed table that a first run fills in part and a second one completes."""
    path, schema = _folder(spark, "resumed"), "id long, n int"
    rows = docs_of(spark, sf_dir).select(F.col("doc_id").alias("id"), "text")
    compute = lambda todo: todo.select("id", F.char_length("text").alias("n"))
    middle = rows.agg(F.expr("percentile_approx(id, 0.5)")).first()[0]
    for part in (rows.where(F.col("id") <= (middle or 0)), rows):
        files.append_missing(part, path, "id", compute, schema)
    return spark.read.schema(schema).json(path)


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def cached_stage(spark, sf_dir):
    path = _folder(spark, "cached")
    for _ in range(2):  # the second one reads
        out = files.cached(spark, path, lambda: docs_of(spark, sf_dir).groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    return out


@query("SELECT doc_id, md5(text) AS md5 FROM documents")
def archived_documents(spark, sf_dir):
    """Documents as archives of JSON lines, read as streams."""
    path = _folder(spark, "archives")
    archives.write_tar_jsonl(archives.dealt_by_size(docs_of(spark, sf_dir).select(F.to_json(F.struct("doc_id", "text")).alias("value"))), path, 100)
    lines = archives.read_tar_jsonl(spark, path)
    return lines.select(F.from_json("value", "doc_id long, text string").alias("d")).select("d.doc_id", F.md5("d.text").alias("md5"))


@query("SELECT doc_id, md5(text) AS md5 FROM documents")
def archives_stream(spark, sf_dir):
    """The same from a folder that grows while a stream follows it; each archive once."""
    spark.dataSource.register(growing.GrowingArchives)
    path, sink, check, log = (_folder(spark, x) for x in ("growing", "followed", "follow-state", "follow-log"))
    docs = docs_of(spark, sf_dir)
    middle = docs.agg(F.expr("percentile_approx(doc_id, 0.5)")).first()[0] or 0
    for k, part in enumerate((docs.where(F.col("doc_id") <= middle), docs.where(F.col("doc_id") > middle))):
        archives.write_tar_jsonl(archives.dealt_by_size(part.select(F.to_json(F.struct("doc_id", "text")).alias("value"))), f"{path}/{k}", 100)
        lines = spark.readStream.format("growing-tarjsonl").option("log", log).load(path)
        rows = lines.select(F.from_json("value", "doc_id long, text string").alias("d")).select("d.*")
        rows.writeStream.format("parquet").option("path", sink).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("doc_id long, text string").parquet(sink).select("doc_id", F.md5("text").alias("md5"))


@query(f"WITH {_SAMPLE} SELECT bucket, rn, doc_id, len FROM sample")
def sample_stream(spark, sf_dir):
    """The first documents of each bucket by a stateful stream."""
    source, sink, check = (_folder(spark, x) for x in ("sample-in", "sample-out", "sample-state"))
    docs_of(spark, sf_dir).select("doc_id", "text").write.parquet(source)
    sampling.sample_until_full(spark, source, sink, check, files=1_000_000)
    return spark.read.schema(sampling.ROW).parquet(sink).select("bucket", "rn", "doc_id", "len")


@query("""SELECT doc_id, '{"chars": ' || length(text) || '}' AS answer, CAST(1 AS INTEGER) AS tries FROM documents""")
def bounded_calls(spark, sf_dir):
    """A call for each document, eight at once at most, with a journal."""
    found = calls.called(docs_of(spark, sf_dir), lambda text: {"chars": len(text)}, _mounted(_folder(spark, "journal")), at_once=8, threads=2)
    return found.select("doc_id", "answer", "tries")


# Selections and failures --------------------------------------------------------------------------------------------


@query(f"WITH {_SNAP}, n AS (SELECT path, CAST(row_number() OVER (ORDER BY path) - 1 AS INTEGER) AS task_id FROM paths) SELECT task_id, path FROM n WHERE task_id IN (0, 3, 5)")
def task_files(spark, sf_dir):
    return pages.selected_files(catalog.chunk_paths(_snapshots(spark, sf_dir)).select("path"), [5, 0, 3])


@query(f"WITH {_PRICES} SELECT model, input, output FROM prices WHERE model IN (SELECT DISTINCT CASE WHEN lang = 'en' THEN 'gpt-5' ELSE 'gpt-5-nano-' || CASE lang WHEN 'fr' THEN 'minimal' ELSE 'medium' END END FROM documents)")
def priced_models(spark, sf_dir):
    nano = F.concat(F.lit("gpt-5-nano-"), F.when(F.col("lang") == "fr", "minimal").otherwise("medium"))
    estimated = docs_of(spark, sf_dir).select(F.when(F.col("lang") == "en", "gpt-5").otherwise(nano).alias("model")).distinct()
    return lengths.priced_models(lengths.prices(spark), estimated)


@query(
    f"""WITH {_BLOCKS}, {_NO_REFERENCES} SELECT 'enwiki/' || page_id AS id, '# ' || name || chr(10) || text AS text FROM p JOIN m USING (page_id)
WHERE page_id % 23 NOT IN (1, 2, 3, 4, 5, 7, 8, 11) AND (page_id % 29 <> 0 OR page_id >= 10000 OR page_id % 23 = 10)"""
)
def wiki_forwarded(spark, sf_dir):
    """Parsed pages that have any text."""
    p = supplier_pages(spark, sf_dir)
    html = F.when(F.col("page_id") % 23 == 11, "<body>stray</body>").otherwise(F.col("html"))
    p = p.select("page_id", F.concat(F.lit("https://en.wikipedia.org/wiki/"), "page_id").alias("url"), html.alias("html"))
    docs = pages.documents(pages.judged(raw_pages(p), disambiguations(spark)))
    return parse.forwarded(parse.parsed(docs, {"enwiki": ["References"]})).select("id", "text")


@query(
    """SELECT CAST(s_suppkey AS BIGINT) AS page_id, CAST(CASE WHEN s_suppkey % 10 = 0 THEN -1 ELSE 0 END AS INTEGER) AS list_no,
  CASE WHEN s_suppkey % 10 <> 0 THEN '- ' || s_name || chr(10) END AS text, s_suppkey % 10 = 0 AS failed FROM supplier"""
)
def failing_pages(spark, sf_dir):
    """Lists of pages of which one in ten is nested too deeply: a row with an error, and its neighbours unharmed."""
    k = F.col("s_suppkey")
    html = F.when(k % 10 == 0, F.repeat(F.lit("<ul><li>"), F.lit(3000))).otherwise(F.concat(F.lit("<ul><li>"), "s_name", F.lit("</li></ul>")))
    suppliers = parse.spread(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "s_suppkey", PAGES_PER_TASK)
    found = parse.html_lists(suppliers.select(k.cast("bigint").alias("page_id"), html.alias("html")))
    return found.select("page_id", F.coalesce("list_no", F.lit(-1)).alias("list_no"), "text", F.col("error").isNotNull().alias("failed"))


@query(
    """SELECT CAST(s_suppkey AS BIGINT) AS page_id, CAST(0 AS INTEGER) AS table_no, '| ' || s_suppkey || ' | ' || s_name || ' |' AS markdown, CAST(1 AS INTEGER) AS n_rows, CAST(2 AS INTEGER) AS n_cols FROM supplier"""
)
def wrapped_tables(spark, sf_dir):
    """A table alone in the only cell of another one takes its place."""
    html = F.concat(F.lit("<table><tr><td><table><tr><td>"), "s_suppkey", F.lit("</td><td>"), "s_name", F.lit("</td></tr></table></td></tr></table>"))
    return parse.html_tables(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("bigint").alias("page_id"), html.alias("html"))).drop("error")
