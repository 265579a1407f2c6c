"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but the last return the columns
of docs, whatever further columns there are and however they are named. Defined cases, in any stage: null text counts as
empty; null doc_id, lang and source are values like others; texts may be of any length; repeated rows are rows of their
own, except that equal texts are one group of copies; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import ngram_join, packing, quality_classifier, quality_rules, suffix_dedup
from lexmill.llm.common import stage, table
from lexmill.llm.queries import vocabulary


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that score 0.7 or more. Empty texts score what the bias says; without labels all score 0.5 and go."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents within the base rules and the fences of their language and source. Texts without ten words go."""
    return quality_rules.quality_filter(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document (by doc_id, nulls last) of each group of near copies. Texts without words are in no group and stay."""
    return ngram_join.one_of_each(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every byte of a passage of 200 bytes that also starts elsewhere. A text may become empty; its row stays."""
    return suffix_dedup.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of pieces with their places in sequences of 2048 tokens. An empty text is a piece of its closing id."""
    return packing.best_fit_pack(docs, vocabulary())


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", drop_repeats),
    ("best_fit_packing", pack),
]

#: SQL can't express the classifier or the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; each is written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, f) in enumerate(STAGES):
        docs = f(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
