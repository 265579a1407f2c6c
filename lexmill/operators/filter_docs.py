"""Filtering documents by length, script and language, and publishing them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import newlines

ENGLISH_SCORE = 0.7
REASONS = ("short", "script", "eng", "kept")


def script_map(rows: DataFrame) -> DataFrame:
    """(subset, scripts 'A/B') as (subset, scripts array): Hans and Hant count as Hani; blank entries are no mapping."""
    parts = F.filter(F.split(F.regexp_replace("scripts", "Han[st]", "Hani"), "/"), lambda x: x != "")
    return rows.select("subset", parts.alias("scripts")).where(F.coalesce(F.size("scripts"), F.lit(0)) > 0)


def is_short(text: Column, infoboxes: Column) -> Column:
    """Under 20 characters or 2 line feeds, and no infobox; runs before the costly prediction."""
    return ((F.char_length(text) < 20) | (newlines(text) < 2)) & (infoboxes <= 0)


def verdict(docs: DataFrame, wikis: DataFrame) -> DataFrame:
    """docs (text, wiki, n_infoboxes, lang, script, score) with reason; wikis without a script mapping are skipped."""
    rows = docs.join(wikis.withColumnRenamed("subset", "wiki"), "wiki")
    reason = (
        F.when(is_short(F.col("text"), F.col("n_infoboxes")), "short")
        .when(~F.array_contains("scripts", F.col("script")), "script")
        .when(~F.col("wiki").isin("en", "simple") & (F.col("lang") == "eng") & (F.col("score") > ENGLISH_SCORE), "eng")
        .otherwise("kept")
    )
    return rows.withColumn("reason", reason)


# A small stop-word profile per language, and Unicode blocks per script.
STOP_WORDS = {
    "eng": "the of and to in is that for it as was with on are by this".split(),
    "fra": "le la les de des du et en un une que qui dans pour est sur".split(),
    "deu": "der die das und in den von zu mit ist des im nicht auf sich ein".split(),
    "spa": "el la los las de del y en que un una por con para es su".split(),
}
SCRIPTS = {
    "Latn": "LATIN", "Cyrl": "CYRILLIC", "Grek": "GREEK", "Arab": "ARABIC", "Hebr": "HEBREW", "Deva": "DEVANAGARI", "Hang": "HANGUL", "Hani": "CJK",
    "Hira": "HIRAGANA", "Kana": "KATAKANA", "Thai": "THAI", "Beng": "BENGALI", "Taml": "TAMIL", "Geor": "GEORGIAN", "Armn": "ARMENIAN",
}


def predict(text: str | None) -> tuple[str, str, float]:
    """(language, script, score) of a whole text: script by most letters, language by stop words. A stand-in for a model."""
    import unicodedata
    from collections import Counter

    counts: dict[str, int] = {}
    for c, n in Counter(text or "").items():
        if c.isalpha():
            name = unicodedata.name(c, "")
            s = next((k for k, v in SCRIPTS.items() if name.startswith(v)), "Zyyy")
            counts[s] = counts.get(s, 0) + n
    script = max(counts, key=lambda k: (counts[k], k)) if counts else "Zyyy"
    words: Counter = Counter()
    for w, n in Counter((text or "").split()).items():
        words[w.strip(".,;:!?").lower()] += n
    hits = {k: sum(words[w] for w in set(v)) for k, v in STOP_WORDS.items()}
    total = sum(hits.values())
    lang = max(hits, key=lambda k: (hits[k], k)) if total else "und"
    return lang, script, hits[lang] / total if total else 0.0


def with_predictions(docs: DataFrame, predictor: Callable[[str | None], tuple[str, str, float]] = predict) -> DataFrame:
    """docs with lang, script and score of a pluggable predictor, which is loaded once per Python worker."""

    @F.pandas_udf("lang string, script string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([predictor(t) for t in s], columns=["lang", "script", "score"])

    p = docs.withColumn("__p", run("text"))
    return p.select(*docs.columns, F.col("__p.lang").alias("lang"), F.col("__p.script").alias("script"), F.col("__p.score").alias("score"))


def published(docs: DataFrame) -> DataFrame:
    """Documents (id, text, metadata with infoboxes and has_math) in the fixed published schema."""
    m = F.col("metadata")
    return docs.select(
        m["url"].alias("url"), m["title"].alias("title"), "text", "id", m["in_language"].alias("language_code"), m["wikidata_id"].alias("wikidata_id"),
        m["bytes_html"].cast("bigint").alias("bytes_html"), F.coalesce(m["wikitext"], F.lit("")).alias("wikitext"), m["version"].cast("bigint").alias("version"),
        F.to_json(m["infoboxes"]).alias("infoboxes"), F.coalesce(m["has_math"], F.lit(False)).alias("has_math"),
    )
