"""Queries over the driver's tables, and the same in DuckDB SQL where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .functions.scalar import GRID, any_date, closest_bucket, host_of, is_wiki, page_key, rounded_bucket, wiki_language
from .operators import catalog, filter_docs, pages, parse
from .plans import graphs, lengths, sketches, standing
from .sources import shards
from .staging import shared_dir, stage

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


# Buckets, costs, statistics ------------------------------------------------------------------------------------------

_GRID = f"[{', '.join(map(str, GRID))}]"
_CLOSEST = f"list_sort(list_transform({_GRID}, lambda b: {{'d': abs(b - least(100000, greatest(500, n))), 'b': b}}))[1].b"
_ROUNDED = "CAST(greatest(500, CASE WHEN n <= 15000 THEN round_even(n / 500.0, 0) * 500 WHEN n <= 100000 THEN round_even(n / 5000.0, 0) * 5000 ELSE 100000 END) AS INTEGER)"
_HISTOGRAM = f"""g AS (SELECT unnest({_GRID}) AS bucket),
k AS (SELECT {_CLOSEST} AS bucket, count(*) AS n FROM (SELECT length(coalesce(text, '')) AS n FROM documents) GROUP BY 1),
histogram AS (SELECT g.bucket, coalesce(k.n, 0) AS n FROM g LEFT JOIN k USING (bucket))"""
_SAMPLE = f"""near AS (SELECT doc_id, n AS len, {_CLOSEST} AS bucket FROM (SELECT doc_id, length(text) AS n FROM documents)),
sample AS (SELECT bucket, rn, doc_id, len FROM (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY doc_id) AS rn FROM near WHERE abs(len - bucket) <= 50) WHERE rn <= 2)"""
_RESULTS = """results AS (SELECT CAST(d.doc_id AS VARCHAR) AS article_id, length(d.text) AS n, CASE WHEN d.doc_id % 3 = 0 THEN 0 ELSE s.bucket END AS bucket,
  CAST(ceil(length(d.text) / 4.0) AS BIGINT) AS p, CAST(len(string_split(d.text, ' ')) AS BIGINT) AS c FROM documents d JOIN sample s USING (doc_id))"""
_AVERAGES = f"""averages AS (SELECT CASE WHEN coalesce(bucket, 0) = 0 THEN {_ROUNDED} ELSE bucket END AS bucket, round_even(avg(p), 2) AS avg_prompt_tokens,
  round_even(avg(c), 2) AS avg_completion_tokens, count(*) AS article_count FROM results WHERE n > 0 AND (p <> 0 OR c <> 0) GROUP BY 1)"""
_PRICES = "prices(model, input, output) AS (VALUES " + ", ".join(f"('{m}', {i}, {o})" for m, i, o in lengths.PRICES) + ")"


@query(f"WITH {_HISTOGRAM} SELECT bucket, n FROM histogram")
def bucket_histogram(spark, sf_dir):
    return lengths.bucket_histogram(docs_of(spark, sf_dir))


@query(
    f"""WITH {_HISTOGRAM}, {_SAMPLE}, {_RESULTS}, {_AVERAGES}, {_PRICES},
sums AS (SELECT CAST(sum(n) AS BIGINT) AS articles, sum(n * avg_prompt_tokens) AS i, sum(n * avg_completion_tokens) AS o FROM histogram JOIN averages USING (bucket))
SELECT model, articles, round(i, 2) AS input_tokens, round(o, 2) AS output_tokens, round(i / 1e6 * input, 4) AS input_usd, round(o / 1e6 * output, 4) AS output_usd,
  round(i / 1e6 * input + o / 1e6 * output, 4) AS usd, round((i / 1e6 * input + o / 1e6 * output) / articles, 8) AS usd_per_article FROM prices CROSS JOIN sums"""
)
def bucket_cost(spark, sf_dir):
    """The flagship: lengths to buckets, a sample's token averages, and what the corpus would cost per model."""
    docs = docs_of(spark, sf_dir)
    estimates = lengths.token_averages(lengths.simulated_results(docs)).drop("article_count")
    return lengths.cost(lengths.bucket_histogram(docs), estimates, lengths.prices(spark))


@query(f"WITH {_SAMPLE}, {_RESULTS}, {_AVERAGES} SELECT bucket, avg_prompt_tokens, avg_completion_tokens, article_count FROM averages")
def bucket_token_averages(spark, sf_dir):
    return lengths.token_averages(lengths.simulated_results(docs_of(spark, sf_dir)))


@query(
    f"""SELECT closest, rounded, count(*) AS n FROM (SELECT {_CLOSEST} AS closest, {_ROUNDED} AS rounded FROM (SELECT n_chars AS n FROM documents)) GROUP BY ALL"""
)
def bucket_functions(spark, sf_dir):
    both = docs_of(spark, sf_dir).select(closest_bucket(F.col("n_chars")).alias("closest"), rounded_bucket(F.col("n_chars")).alias("rounded"))
    return both.groupBy("closest", "rounded").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH l AS (SELECT length(coalesce(text, '')) AS len FROM documents),
s AS (SELECT count(len) AS n, avg(len) AS mean, quantile_cont(len, 0.5) AS median, stddev_pop(len) AS std, CAST(min(len) AS INTEGER) AS min, CAST(max(len) AS INTEGER) AS max,
  CAST(sum(len) AS BIGINT) AS total, quantile_cont(len, 0.25) AS p25, quantile_cont(len, 0.75) AS p75, quantile_cont(len, 0.95) AS p95, quantile_cont(len, 0.99) AS p99 FROM l)
SELECT n, round(mean, 6) AS mean, round(median, 6) AS median, round(std, 6) AS std, min, max, total, round(p25, 6) AS p25, round(p75, 6) AS p75, round(p95, 6) AS p95,
  round(p99, 6) AS p99, round(p75 - p25, 6) AS iqr, round(total / 4.0, 6) AS tokens FROM s"""
)
def length_stats(spark, sf_dir):
    return lengths.length_stats(docs_of(spark, sf_dir))


@query(
    """SELECT count(*) AS n, round(avg(length(coalesce(text, ''))), 6) AS mean, round(stddev_pop(length(coalesce(text, ''))), 6) AS std, CAST(min(length(coalesce(text, ''))) AS BIGINT) AS min,
  CAST(max(length(coalesce(text, ''))) AS BIGINT) AS max, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS total FROM documents"""
)
def length_sketches(spark, sf_dir):
    """Statistics from the files' stored rows; their quantiles are approximate and tested by rank."""
    s = sketches.stats(stage(sketches.file_sketches(docs_of(spark, sf_dir)), "sketches"))
    return s.select("n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max", "total")


@query("SELECT doc_id, CAST(length(text) AS BIGINT) AS len, md5(text) AS md5 FROM documents")
def sharded_documents(spark, sf_dir):
    """Documents written as shards of 4 MB with a manifest, and read back."""
    path = f"{shared_dir(spark)}/lexmill-shards-{uuid.uuid4().hex}"
    shards.write_shards(docs_of(spark, sf_dir).select("doc_id", "text"), path, 4 << 20)
    return spark.read.schema("doc_id long, text string").parquet(path).select("doc_id", F.char_length("text").cast("long").alias("len"), F.md5("text").alias("md5"))


@query(
    """WITH l AS (SELECT length(coalesce(text, '')) AS len FROM documents), t AS (SELECT quantile_cont(len, 0.95) AS p95 FROM l),
low AS (SELECT len FROM l, t WHERE len <= p95), e AS (SELECT min(len) AS lo, max(len) AS hi FROM low),
k AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least((len - lo) * 100 // (hi - lo), 99) END AS INTEGER) AS bin, count(*) AS n FROM low, e GROUP BY 1)
SELECT CAST(r.bin AS INTEGER) AS bin, coalesce(k.n, 0) AS n FROM (SELECT unnest(range(100)) AS bin) r LEFT JOIN k ON r.bin = k.bin"""
)
def length_histogram_p95(spark, sf_dir):
    return lengths.length_histogram(docs_of(spark, sf_dir))


@query(f"WITH {_SAMPLE} SELECT bucket, rn, doc_id, len FROM sample")
def sample_first_k(spark, sf_dir):
    return lengths.sample_first(docs_of(spark, sf_dir))


@query(
    f"""WITH {_SAMPLE}, per AS (SELECT bucket, count(*) AS n FROM sample GROUP BY 1)
SELECT CAST(coalesce(sum(CASE WHEN n >= 2 THEN 1 ELSE 0 END), 0) AS BIGINT) AS filled, CAST(coalesce(sum(n), 0) AS BIGINT) AS sampled,
  CAST({2 * len(GRID)} - coalesce(sum(n), 0) AS BIGINT) AS shortfall FROM per"""
)
def sample_filled(spark, sf_dir):
    return lengths.filled_buckets(lengths.sample_first(docs_of(spark, sf_dir)))


@query(
    """SELECT conv_id, CAST(sum(CASE WHEN role = 'assistant' THEN 0 ELSE length(text) END) AS BIGINT) AS prompt_tokens,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS completion_tokens, CAST(sum(length(text)) AS BIGINT) AS total_tokens
FROM conversations GROUP BY conv_id"""
)
def token_usage(spark, sf_dir):
    n = F.char_length("text").cast("bigint")
    use = F.struct(
        F.when(F.col("role") != "assistant", n).alias("prompt_tokens"), F.when(F.col("role") == "assistant", n).alias("completion_tokens"), n.alias("total_tokens")
    )
    none = F.lit(None).cast("struct<prompt_tokens: bigint, completion_tokens: bigint, total_tokens: bigint>")
    calls = table(spark, sf_dir, "conversations").select(
        "conv_id", F.when(F.col("turn") % 2 == 0, use).otherwise(none).alias("usage"), F.when(F.col("turn") % 2 == 1, use).otherwise(none).alias("response_usage")
    )
    return lengths.token_usage(calls, "conv_id")


# Filters ------------------------------------------------------------------------------------------------------------

_SCRIPTS = [("en", "Latn"), ("fr", "Latn/Hans"), ("de", "Latn"), ("zh", "Hant/Hani"), ("cr", None), ("pih", ""), ("es", "Cyrl/ /Latn")]
_MAP = "m(subset, scripts) AS (VALUES " + ", ".join(f"('{a}', {'NULL' if b is None else repr(b)})" for a, b in _SCRIPTS) + ")"
_MAPPED = "mapped AS (SELECT subset, list_filter(string_split(regexp_replace(scripts, 'Han[st]', 'Hani', 'g'), '/'), lambda x: x <> '') AS scripts FROM m WHERE scripts IS NOT NULL)"
_VERDICT = f"""{_MAP}, {_MAPPED},
rows AS (SELECT d.*, mapped.scripts, doc_id % 10 AS box, CASE WHEN doc_id % 7 = 0 THEN 'Cyrl' ELSE 'Latn' END AS script, CASE WHEN doc_id % 5 = 0 THEN 'eng' ELSE lang END AS guess,
  (doc_id % 11) / 10.0 AS score FROM documents d JOIN mapped ON d.lang = mapped.subset WHERE len(mapped.scripts) > 0),
verdict AS (SELECT *, CASE WHEN (length(text) < 20 OR length(text) - length(replace(text, chr(10), '')) < 2) AND box <> 0 THEN 'short'
  WHEN NOT list_contains(scripts, script) THEN 'script' WHEN lang NOT IN ('en', 'simple') AND guess = 'eng' AND score > 0.7 THEN 'eng' ELSE 'kept' END AS reason FROM rows)"""


def _script_rows(spark):
    return spark.createDataFrame(_SCRIPTS, "subset string, scripts string").coalesce(1)


def _verdicts(spark, sf_dir):
    d = docs_of(spark, sf_dir)
    rows = d.select(
        "doc_id", "text", F.col("lang").alias("wiki"), F.when(F.col("doc_id") % 10 == 0, 1).otherwise(0).alias("n_infoboxes"),
        F.when(F.col("doc_id") % 5 == 0, "eng").otherwise(F.col("lang")).alias("lang"), F.when(F.col("doc_id") % 7 == 0, "Cyrl").otherwise("Latn").alias("script"),
        ((F.col("doc_id") % 11) / 10.0).alias("score"),
    )
    return filter_docs.verdict(rows, filter_docs.script_map(_script_rows(spark)))


@query(
    """SELECT lang || k AS subset, CASE k WHEN 0 THEN 'Latn' WHEN 1 THEN 'Hani,Hani,Latn' ELSE ' ,Cyrl' END AS scripts FROM (SELECT DISTINCT lang, CAST(doc_id % 5 AS INTEGER) AS k FROM documents) WHERE k < 3"""
)
def script_map(spark, sf_dir):
    """Maps of the documents' languages, in five spellings; blank ones are no mapping."""
    k = (F.col("doc_id") % 5).cast("int")
    spelled = F.when(k == 0, "Latn").when(k == 1, "Hans/Hant//Latn").when(k == 2, " /Cyrl").when(k == 3, "")
    rows = docs_of(spark, sf_dir).select(F.concat("lang", k).alias("subset"), spelled.alias("scripts")).distinct()
    return filter_docs.script_map(rows).select("subset", F.array_join("scripts", ",").alias("scripts"))


@query(f"WITH {_VERDICT} SELECT reason, count(*) AS n FROM verdict GROUP BY reason")
def filter_reasons(spark, sf_dir):
    return _verdicts(spark, sf_dir).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_VERDICT} SELECT doc_id, lang AS wiki FROM verdict WHERE reason = 'kept'")
def filter_kept(spark, sf_dir):
    return _verdicts(spark, sf_dir).where("reason = 'kept'").select("doc_id", "wiki")


@query(
    f"""WITH {_VERDICT} SELECT count(*) AS total, """
    + ", ".join(f"CAST(sum(CASE WHEN reason = '{r}' THEN 1 ELSE 0 END) AS BIGINT) AS {r}" for r in filter_docs.REASONS)
    + " FROM verdict"
)
def filter_counters(spark, sf_dir):
    return pages.counters(_verdicts(spark, sf_dir), "reason", filter_docs.REASONS)


_STOPS = ", ".join(f"('{lang}', '{w}')" for lang, words in filter_docs.STOP_WORDS.items() for w in dict.fromkeys(words))


@query(
    rf"""WITH stops(lang, w) AS (VALUES {_STOPS}),
words AS (SELECT doc_id, lower(trim(w, '.,;:!?')) AS w, count(*) AS c FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS w FROM documents) GROUP BY ALL),
hits AS (SELECT doc_id, lang, CAST(sum(c) AS BIGINT) AS h FROM words JOIN stops USING (w) GROUP BY ALL),
best AS (SELECT doc_id, lang, h, sum(h) OVER (PARTITION BY doc_id) AS total, row_number() OVER (PARTITION BY doc_id ORDER BY h DESC, lang DESC) AS rn FROM hits)
SELECT d.doc_id, coalesce(best.lang, 'und') AS lang, CASE WHEN regexp_matches(text, '\p{{Latin}}') THEN 'Latn' ELSE 'Zyyy' END AS script, coalesce(round(h / total, 6), 0) AS score
FROM documents d LEFT JOIN best ON best.doc_id = d.doc_id AND rn = 1"""
)
def language_prediction(spark, sf_dir):
    return filter_docs.with_predictions(docs_of(spark, sf_dir).select("doc_id", "text")).select("doc_id", "lang", "script", F.round("score", 6).alias("score"))


# Page records -------------------------------------------------------------------------------------------------------


def raw_pages(p: DataFrame) -> DataFrame:
    """Page records made of pages (page_id, url, html), with redirects, disambiguations and other namespaces at fixed ids."""
    i = F.col("page_id")
    at = lambda k: i % 23 == k
    html = (
        F.when(at(3), F.concat(F.lit('<link rel="mw:PageProp/redirect">'), "html"))
        .when(at(5), F.concat(F.lit('<meta property="mw:PageProp/disambiguation">'), "html"))
        .when(at(7), "")
        .when(at(8), F.lit(None).cast("string"))
        .when(at(9), F.concat(F.lit('<div class="mw-redirect"></div>'), "html"))
        .otherwise(F.col("html"))
    )
    one = lambda c, k="identifier": F.struct(c.alias(k))
    return p.select(
        i.alias("identifier"), F.concat(F.lit("Page "), i).alias("name"), "url", F.lit("2025-11-21T00:00:00.123456789Z").alias("date_modified"),
        F.when(at(1), F.lit(None)).otherwise(one(F.when(at(2), 1).otherwise(0))).alias("namespace"), one(i * 10).alias("version"),
        F.when(at(10), F.lit(None)).otherwise(one(F.concat(F.lit("Q"), i))).alias("main_entity"), one(F.lit("enwiki")).alias("is_part_of"), one(F.lit("en")).alias("in_language"),
        F.struct(html.alias("html"), F.when(at(4), "  #ReDirect [[x]]").when(at(6), "text #redirect").alias("wikitext")).alias("article_body"),
    )


def disambiguations(spark):
    return spark.range(0, 10_000, 29).select(F.concat(F.lit("Q"), "id").alias("item"))


_RAW = """raw AS (SELECT page_id, url, CASE page_id % 23 WHEN 3 THEN '<link rel="mw:PageProp/redirect">' || html WHEN 5 THEN '<meta property="mw:PageProp/disambiguation">' || html
  WHEN 7 THEN '' WHEN 8 THEN '' WHEN 9 THEN '<div class="mw-redirect"></div>' || html ELSE html END AS html,
  CASE page_id % 23 WHEN 4 THEN '  #ReDirect [[x]]' WHEN 6 THEN 'text #redirect' ELSE '' END AS wikitext FROM pages),
judged AS (SELECT *, CASE WHEN page_id % 23 IN (1, 2) THEN 'ns' WHEN regexp_matches(wikitext, '(?i)^\\s*#redirect\\b') OR contains(html, 'rel="mw:PageProp/redirect"') THEN 'redirect'
  WHEN contains(html, 'mw:PageProp/disambiguation') OR (page_id % 29 = 0 AND page_id < 10000 AND page_id % 23 <> 10) THEN 'disamb' WHEN html = '' THEN 'no_html' ELSE 'kept' END AS drop_reason FROM raw)""".replace("\\\\", "\\")


@query(f"WITH {_RAW} SELECT page_id, drop_reason FROM judged")
def page_drop_reasons(spark, sf_dir):
    return pages.judged(raw_pages(table(spark, sf_dir, "pages")), disambiguations(spark)).select(F.col("identifier").alias("page_id"), "drop_reason")


@query(
    f"""WITH {_RAW} SELECT count(*) AS total, """ + ", ".join(f"CAST(sum(CASE WHEN drop_reason = '{r}' THEN 1 ELSE 0 END) AS BIGINT) AS {r}" for r in pages.REASONS) + " FROM judged"
)
def page_counters(spark, sf_dir):
    return pages.counters(pages.judged(raw_pages(table(spark, sf_dir, "pages")), disambiguations(spark)))


@query(
    f"""WITH {_RAW} SELECT 'enwiki/' || page_id AS id, page_id, 'Page ' || page_id AS title, url, CASE WHEN page_id % 23 = 10 THEN NULL ELSE 'Q' || page_id END AS wikidata_id,
  CAST(strlen(html) AS BIGINT) AS bytes_html, wikitext, page_id * 10 AS version FROM judged WHERE drop_reason = 'kept'"""
)
def page_documents(spark, sf_dir):
    d = pages.documents(pages.judged(raw_pages(table(spark, sf_dir, "pages")), disambiguations(spark)))
    return d.select("id", "metadata.page_id", "metadata.title", "metadata.url", "metadata.wikidata_id", "metadata.bytes_html", "metadata.wikitext", "metadata.version")


@query(
    f"""WITH {_RAW} SELECT url, 'Page ' || page_id AS title, 'enwiki/' || page_id AS id, 'en' AS language_code, CASE WHEN page_id % 23 = 10 THEN NULL ELSE 'Q' || page_id END AS wikidata_id,
  CAST(strlen(html) AS BIGINT) AS bytes_html, wikitext, page_id * 10 AS version, '[]' AS infoboxes, false AS has_math FROM judged WHERE drop_reason = 'kept'"""
)
def published_schema(spark, sf_dir):
    d = pages.documents(pages.judged(raw_pages(table(spark, sf_dir, "pages")), disambiguations(spark)))
    from .schemas import INFOBOXES

    d = d.withColumn("metadata", F.col("metadata").withField("infoboxes", F.array().cast(INFOBOXES)).withField("has_math", F.lit(None).cast("boolean")))
    return filter_docs.published(d).drop("text")


@query("SELECT page_id, coalesce(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), ''), 'wikipedia.org') AS host FROM pages")
def url_host(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", host_of(F.col("url"), F.lit(None).cast("string")).alias("host"))


@query("SELECT page_id, '//' || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS base FROM pages")
def base_hrefs(spark, sf_dir):
    return parse.base_hosts(table(spark, sf_dir, "pages"))


@query("SELECT lang || 'wiki_namespace_0' AS folder, lang AS language, coalesce(lang, 'None') || '/' || doc_id AS id FROM documents WHERE doc_id % 4 <> 3")
def wiki_folders(spark, sf_dir):
    name = F.concat("lang", F.when(F.col("doc_id") % 4 == 3, "wiktionary_namespace_0").otherwise("wiki_namespace_0"))
    rows = docs_of(spark, sf_dir).select(name.alias("folder"), "lang", "doc_id").where(is_wiki(F.col("folder")))
    return rows.select("folder", wiki_language(F.col("folder")).alias("language"), page_key(F.col("lang"), F.col("doc_id")).alias("id"))


# Catalogue ----------------------------------------------------------------------------------------------------------


def _snapshots(spark, sf_dir) -> DataFrame:
    """Suppliers as snapshots: some with a time, some with a compact or unreadable version."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("wiki"), k).alias("identifier"),
        F.when(k % 3 == 0, F.concat(F.lit("2025-11-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit("T10:00:00.123456789Z"))).alias("date_modified"),
        F.when(k % 3 == 1, F.concat(F.lit("202511"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))).otherwise("a1b2c3").alias("version"),
        F.transform(F.sequence(F.lit(0), k % 4), lambda i: F.concat(F.lit("chunk_"), i)).alias("chunks"),
    )


_SNAP = """snap AS (SELECT 'wiki' || s_suppkey AS identifier, s_suppkey AS k, CASE WHEN s_suppkey % 3 IN (0, 1) THEN make_date(2025, 11, CAST(s_suppkey % 28 + 1 AS INTEGER)) END AS day FROM supplier),
paths AS (SELECT identifier, 'chunk_' || i AS chunk, identifier || '/' || identifier || '_chunk_' || i || '.json.tar.gz' AS path FROM (SELECT identifier, unnest(range(k % 4 + 1)) AS i FROM snap))"""


@query(f"WITH {_SNAP} SELECT identifier FROM snap WHERE day = (SELECT max(day) FROM snap)")
def snapshot_latest(spark, sf_dir):
    return catalog.latest_snapshots(_snapshots(spark, sf_dir)).select("identifier")


@query(f"WITH {_SNAP} SELECT identifier, chunk, path FROM paths")
def chunk_paths(spark, sf_dir):
    return catalog.chunk_paths(_snapshots(spark, sf_dir))


@query(f"WITH {_SNAP} SELECT path, identifier, chunk FROM paths WHERE NOT chunk = 'chunk_0'")
def pending_chunks(spark, sf_dir):
    paths = catalog.chunk_paths(_snapshots(spark, sf_dir))
    return catalog.pending(paths, paths.where("chunk = 'chunk_0'"))


@query(f"WITH {_SNAP} SELECT path, identifier, chunk FROM paths ORDER BY path LIMIT 7")
def first_files(spark, sf_dir):
    return catalog.first_files(catalog.chunk_paths(_snapshots(spark, sf_dir)), 7).select("path", "identifier", "chunk")


@query(f"WITH {_SNAP} SELECT identifier, CAST(day AS VARCHAR) AS day FROM snap")
def snapshot_dates(spark, sf_dir):
    return _snapshots(spark, sf_dir).select("identifier", F.to_date(any_date(F.col("date_modified"), F.col("version"))).cast("string").alias("day"))


# Graphs -------------------------------------------------------------------------------------------------------------

_REL = """lines AS (SELECT doc_id AS graph_id, string_split(trim(l, ' '), ' ') AS w FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents)),
rel AS (SELECT DISTINCT graph_id, w[1] AS subject, 'to' AS predicate, w[len(w)] AS object FROM lines WHERE len(w) > 1),
ent AS (SELECT DISTINCT graph_id, unnest([subject, object]) AS entity FROM rel)"""
_KEY = r"lower(regexp_replace({}, '[^\p{{L}}\p{{N}}]+', '', 'g'))"
_CLUSTER = f"""clusters AS (SELECT graph_id, entity AS member, min(entity) OVER (PARTITION BY graph_id, {_KEY.format("entity")}) AS representative FROM ent),
after AS (SELECT DISTINCT r.graph_id, s.representative AS subject, predicate, o.representative AS object FROM rel r
  JOIN clusters s ON s.graph_id = r.graph_id AND s.member = subject JOIN clusters o ON o.graph_id = r.graph_id AND o.member = object)"""


def _relations(spark, sf_dir):
    """The relations of all documents; the documents are read once, however often these are used."""
    return stage(graphs.rule_extractor(docs_of(spark, sf_dir)), "kg-relations")


def _clusters(r):
    return stage(graphs.exact_clusters(graphs.entities(r)), "kg-clusters")


@query(f"WITH {_REL} SELECT doc_group AS graph_id, count(*) AS relations FROM (SELECT DISTINCT graph_id // 100 AS doc_group, subject, predicate, object FROM rel) GROUP BY 1")
def kg_aggregate(spark, sf_dir):
    g = graphs.aggregated(_relations(spark, sf_dir), F.floor(F.col("graph_id") / 100))
    return g.groupBy("graph_id").agg(F.count(F.lit(1)).alias("relations"))


@query(f"WITH {_REL}, {_CLUSTER} SELECT graph_id, member, representative FROM clusters")
def kg_dedup_exact(spark, sf_dir):
    return graphs.exact_clusters(graphs.entities(_relations(spark, sf_dir)))


@query(
    f"""WITH RECURSIVE {_REL}, {_CLUSTER},
grams AS (SELECT graph_id, name, list_distinct(list_transform(range(1, greatest(length(k) - 2, 1) + 1), lambda i: k[i:i + 2])) AS g
  FROM (SELECT DISTINCT graph_id, representative AS name, {_KEY.format("representative")} AS k FROM clusters)),
like_ AS (SELECT x.graph_id, x.name AS a, y.name AS b FROM grams x JOIN grams y ON x.graph_id = y.graph_id AND x.name <> y.name AND 0.8 * len(x.g) <= len(y.g) AND 0.8 * len(y.g) <= len(x.g)
  WHERE len(list_intersect(x.g, y.g)) / (len(x.g) + len(y.g) - len(list_intersect(x.g, y.g))) >= 0.8),
reach(graph_id, name, r) AS (SELECT graph_id, name, name FROM grams UNION SELECT l.graph_id, reach.name, l.b FROM reach JOIN like_ l ON l.graph_id = reach.graph_id AND l.a = reach.r),
low AS (SELECT graph_id, name, min(r) AS r FROM reach GROUP BY ALL)
SELECT c.graph_id, member, low.r AS representative FROM clusters c JOIN low ON low.graph_id = c.graph_id AND low.name = c.representative"""
)
def kg_dedup_near(spark, sf_dir):
    return graphs.near_clusters(graphs.entities(_relations(spark, sf_dir)))


@query(f"WITH {_REL}, {_CLUSTER} SELECT graph_id, subject, predicate, object FROM after")
def kg_relabelled(spark, sf_dir):
    r = _relations(spark, sf_dir)
    return graphs.relabelled(r, _clusters(r))


@query(
    f"""WITH {_REL}, {_CLUSTER}, e2 AS (SELECT DISTINCT graph_id, unnest([subject, object]) AS entity FROM after),
b AS (SELECT graph_id, count(*) AS relations_before FROM rel GROUP BY 1), c AS (SELECT graph_id, count(*) AS entities_before FROM ent GROUP BY 1),
d AS (SELECT graph_id, count(*) AS relations_after FROM after GROUP BY 1), f AS (SELECT graph_id, count(*) AS entities_after FROM e2 GROUP BY 1),
m AS (SELECT graph_id, CAST(sum(CASE WHEN k > 1 THEN 1 ELSE 0 END) AS BIGINT) AS clusters FROM (SELECT graph_id, representative, count(*) AS k FROM clusters GROUP BY 1, 2) GROUP BY 1)
SELECT graph_id, entities_before, entities_after, relations_before, relations_after, round((1 - entities_after / entities_before) * 100, 6) AS entities_cleanup_percent,
  round((1 - relations_after / relations_before) * 100, 6) AS relations_cleanup_percent, clusters
FROM b JOIN c USING (graph_id) JOIN d USING (graph_id) JOIN f USING (graph_id) JOIN m USING (graph_id)"""
)
def kg_cleanup_pct(spark, sf_dir):
    r = _relations(spark, sf_dir)
    return graphs.cleanup(r, _clusters(r))


@query('SELECT "group", count(*) AS n, min(doc_id) AS from_id, max(doc_id) AS to_id FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS "group" FROM documents) GROUP BY 1')
def kg_groups_100(spark, sf_dir):
    g = catalog.pages_of_groups(docs_of(spark, sf_dir).select("doc_id"), 100, "doc_id")
    return g.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("from_id"), F.max("doc_id").alias("to_id"))


@query("SELECT doc_id, CAST(i AS INTEGER) AS chunk, text[i * 2000 + 1 : (i + 1) * 2000] AS text FROM (SELECT doc_id, text, unnest(range(CAST(greatest(1, ceil(length(text) / 2000.0)) AS BIGINT))) AS i FROM documents)")
def kg_chunks(spark, sf_dir):
    return graphs.chunks(docs_of(spark, sf_dir), 2000)


_MERGED = f"""WITH {_REL}, c AS (SELECT entity, min(entity) OVER (PARTITION BY {_KEY.format("entity")}) AS r FROM (SELECT DISTINCT entity FROM ent))
SELECT DISTINCT CAST(0 AS BIGINT) AS graph_id, s.r AS subject, predicate, o.r AS object FROM rel JOIN c s ON s.entity = subject JOIN c o ON o.entity = object"""


@query(_MERGED)
def kg_merged(spark, sf_dir):
    return graphs.merged(_relations(spark, sf_dir))


@query(_MERGED)
def kg_standing(spark, sf_dir):
    """The same graph, grown in four steps by ranges of ids."""
    docs, graph = docs_of(spark, sf_dir), standing.Standing(spark, f"{shared_dir(spark)}/lexmill-standing-{uuid.uuid4().hex}")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    r = _relations(spark, sf_dir)
    if low is not None:
        cuts = [low + (high + 1 - low) * k // 4 for k in range(5)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            graph.add(r.where((F.col("graph_id") >= a) & (F.col("graph_id") < b)), a, b)
    return graph.relations()


@query(f"WITH {_REL} SELECT graph_id, count(*) AS n_entities, array_to_string(list_sort(list(entity)), ' ') AS entities FROM ent GROUP BY graph_id")
def kg_lists(spark, sf_dir):
    g = graphs.as_lists(_relations(spark, sf_dir))
    return g.select("graph_id", F.size("entities").cast("bigint").alias("n_entities"), F.array_join("entities", " ").alias("entities"))


@query(
    """SELECT query, rn, neighbour, round(s, 6) AS similarity FROM (SELECT q.vec_id AS query, v.vec_id AS neighbour, s, row_number() OVER (PARTITION BY q.vec_id ORDER BY s DESC, v.vec_id) AS rn
FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id, LATERAL (SELECT list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])) AS s) WHERE q.vec_id % 100 = 0) WHERE rn <= 5"""
)
def title_knn(spark, sf_dir):
    return graphs.nearest(table(spark, sf_dir, "embeddings"))
