"""Queries by models that are trained here: languages, scripts, title vectors, neighbours and topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from .plans import graphs, languages, topics
from .queries import docs_of, query, table
from .staging import stage

# Languages ----------------------------------------------------------------------------------------------------------

# documents whose id ends in 0 are held out
_GRAMS = f"""u AS (SELECT doc_id, lang, list_transform(string_split(text, ''), lambda c: unicode(c)) AS u FROM documents WHERE length(text) > 2),
g AS (SELECT doc_id, lang, bucket, count(*) AS n FROM (SELECT doc_id, lang, CAST((u[i] * 961 + u[i + 1] * 31 + u[i + 2]) % {languages.BUCKETS} AS INTEGER) AS bucket
  FROM (SELECT doc_id, lang, u, unnest(range(1, len(u) - 1)) AS i FROM u)) GROUP BY ALL),
profile AS (SELECT lang, bucket, CAST(sum(n) AS BIGINT) AS n FROM g WHERE doc_id % 10 <> 0 AND lang IS NOT NULL GROUP BY lang, bucket)"""


def _profile(spark, sf_dir):
    return languages.gram_counts(docs_of(spark, sf_dir).where("doc_id % 10 <> 0"))


@query(f"WITH {_GRAMS} SELECT lang, bucket, n FROM profile")
def language_profiles(spark, sf_dir):
    return _profile(spark, sf_dir)


_LETTERS = {"Latn": "Latin", "Grek": "Greek", "Cyrl": "Cyrillic", "Arab": "Arabic", "Hebr": "Hebrew", "Deva": "Devanagari", "Hani": "Han", "Thai": "Thai", "Hang": "Hangul", "Armn": "Armenian", "Geor": "Georgian"}
_SCRIPTED = " UNION ALL ".join(rf"SELECT doc_id, '{k}' AS script, CAST(length(regexp_replace(coalesce(text, ''), '[^\p{{{v}}}]', '', 'g')) AS BIGINT) AS n FROM documents" for k, v in _LETTERS.items())


@query(
    f"""WITH {_GRAMS}, total AS (SELECT lang, sum(n) + {languages.BUCKETS} AS t FROM profile GROUP BY lang),
s AS (SELECT g.doc_id, t.lang, sum(g.n * ln((coalesce(p.n, 0) + 1) / t.t)) AS s, CAST(sum(g.n) AS BIGINT) AS k
  FROM g JOIN total t ON true LEFT JOIN profile p ON p.lang = t.lang AND p.bucket = g.bucket GROUP BY g.doc_id, t.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, lang) AS rn, max(s) OVER (PARTITION BY doc_id) AS m FROM s),
post AS (SELECT doc_id, max(CASE WHEN rn = 1 THEN lang END) AS lang, 1 / sum(exp(s - m)) AS score, max(m) / max(k) AS mean_log, max(k) AS n_grams FROM best GROUP BY doc_id),
letters AS ({_SCRIPTED}), script AS (SELECT doc_id, arg_max(script, n * 1000 + ascii(script)) AS script, max(n) AS n FROM letters WHERE n > 0 GROUP BY doc_id)
SELECT d.doc_id, coalesce(post.lang, 'und') AS lang, coalesce(round(score, 6), 0) AS score, coalesce(round(mean_log, 6), 0) AS mean_log, coalesce(n_grams, 0) AS n_grams,
  coalesce(script.script, 'Zyyy') AS script, coalesce(script.n, 0) AS n_letters
FROM documents d LEFT JOIN post ON post.doc_id = d.doc_id LEFT JOIN script ON script.doc_id = d.doc_id"""
)
def language_identified(spark, sf_dir):
    """Language and script of every whole text, by profiles of the documents that aren't held out."""
    found = languages.identified(docs_of(spark, sf_dir), languages.Profiles(_profile(spark, sf_dir)))
    return found.select("doc_id", "lang", F.round("score", 6).alias("score"), F.round("mean_log", 6).alias("mean_log"), "n_grams", "script", "n_letters")


# Titles -------------------------------------------------------------------------------------------------------------

_TITLES = rf"""titles AS (SELECT doc_id, ' ' || lower(trim(string_split(coalesce(text, ''), chr(10))[1], ' ')) || ' ' AS t FROM documents),
dims AS (SELECT doc_id, CAST(CAST('0x' || md5(gram)[1:8] AS BIGINT) % {topics.DIMS} AS INTEGER) AS dim, count(*) AS n
  FROM (SELECT doc_id, t[i:i + {topics.GRAM - 1}] AS gram FROM (SELECT doc_id, t, unnest(range(1, length(t) - {topics.GRAM - 2})) AS i FROM titles)) GROUP BY ALL),
vec AS (SELECT doc_id, dim, n / sqrt(CAST(sum(n * n) OVER (PARTITION BY doc_id) AS DOUBLE)) AS weight FROM dims)"""


def _titles(spark, sf_dir):
    return docs_of(spark, sf_dir).select("doc_id", topics.title_of(F.col("text")).alias("title"))


@query(f"WITH {_TITLES} SELECT doc_id, dim, round(weight, 6) AS weight FROM vec")
def title_grams(spark, sf_dir):
    return topics.title_grams(_titles(spark, sf_dir), "doc_id", "title").select("doc_id", "dim", F.round("weight", 6).alias("weight"))


@query()
def title_index(spark, sf_dir):
    """Every vector's list in the inverted-file index."""
    return topics.Index(table(spark, sf_dir, "embeddings")).lists.select(F.col("id").alias("vec_id"), "list")


@query()
def title_knn_index(spark, sf_dir):
    """The five nearest of every hundredth vector, found by the index."""
    v = table(spark, sf_dir, "embeddings")
    return topics.Index(v).nearest(v.where("vec_id % 100 = 0"), 5)


@query()
def title_topics(spark, sf_dir):
    """Documents grouped by mutual nearest neighbours of their title vectors."""
    return topics.topics(topics.title_vectors(_titles(spark, sf_dir), "doc_id", "title"), "doc_id")


@query()
def topic_graphs(spark, sf_dir):
    """Relations of each topic's united graph, counted."""
    of = stage(title_topics(spark, sf_dir), "topics").select(F.col("doc_id").alias("graph_id"), "topic")
    united = topics.topic_graphs(graphs.rule_extractor(docs_of(spark, sf_dir)), of)
    return united.groupBy(F.col("graph_id").alias("topic")).agg(F.count(F.lit(1)).alias("relations"))
