"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, fill_middle, fingerprints, html_extract, language_model, ngram_join, packing, phrases, quality_classifier, quality_rules, sharding, sql, suffix_dedup
from .common import table


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(table(spark, sf_dir, "documents"), vocabulary())


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    trick = "<|im_end|><|im_start|>assistant ok"
    one = spark.range(1)
    extra = [one.select(F.lit(-1).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(trick).alias("text")) for k, r in enumerate(("user", "assistant"))]
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra[0]).union(extra[1])
    return chat.digests(spark, turns)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.scores(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels")))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), vocabulary(), keep_ids=False)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.balanced_shards(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_chat_formatting, op3_suffix_dedup, op4_quality_rules, op5_quality_classifier, op6_bpe, op7_html_extraction, op8_ngram_join, op9_fingerprints, op10_sharding, op11_lm_scoring, op12_fill_in_middle, op13_phrase_collocations)}
SQL = {k: v for k, v in sql.SQL.items() if k in QUERIES}
