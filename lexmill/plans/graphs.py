"""Knowledge graphs: extraction, aggregation, de-duplication, grouping, chunks and nearest titles.

A graph set is two tables: entities (graph_id, entity) and relations (graph_id, subject, predicate, object).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalar import cleanup_percent
from ..staging import stage, unstage
from .calls import called

#: Up to so many query vectors (some kB each) are broadcast.
BROADCAST_QUERIES = 10_000


def chunks(docs: DataFrame, size: int = 100_000, key: str = "doc_id") -> DataFrame:
    """(key, chunk, text): articles in pieces of at most `size` characters; the key stays with each piece."""
    n = F.greatest(F.lit(1), F.ceil(F.char_length("text") / size).cast("int"))
    pieces = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("chunk"), F.substring(F.col("text"), i * size + 1, F.lit(size)).alias("text")))
    return docs.select(key, F.explode(pieces).alias("p")).select(key, "p.chunk", "p.text")


def rule_extractor(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Relations by a fixed rule instead of a model: per line, its first word, 'to', its last word."""
    line = F.explode(F.split("text", "\n"))
    rows = docs.select(F.col(key).alias("graph_id"), line.alias("line")).withColumn("w", F.split(F.trim("line"), " "))
    rows = rows.where(F.size("w") > 1)
    return rows.select("graph_id", F.col("w")[0].alias("subject"), F.lit("to").alias("predicate"), F.element_at("w", -1).alias("object")).distinct()


Extractor = Callable[[str], list[tuple[str, str, str]]]


def extracted(docs: DataFrame, extractor: Extractor, key: str = "doc_id", threads: int = 16) -> DataFrame:
    """Relations by a pluggable extractor (a model call); calls of a batch run at the same time, failures give a row with error."""
    from concurrent.futures import ThreadPoolExecutor

    def one(text: str) -> tuple[list[tuple[str, str, str]], str | None]:
        try:
            return extractor(text), None
        except Exception as e:  # noqa: BLE001
            return [], str(e)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for pdf in batches:
                rows = []
                for g, (found, error) in zip(pdf[key], pool.map(one, pdf["text"]), strict=True):
                    rows += [(g, *t, None) for t in found] or ([(g, None, None, None, error)] if error else [])
                yield pd.DataFrame(rows, columns=["graph_id", "subject", "predicate", "object", "error"])

    return docs.select(key, "text").mapInPandas(run, "graph_id bigint, subject string, predicate string, object string, error string")


def extracted_once(docs: DataFrame, extractor: Extractor, journal: str, key: str = "doc_id", at_once: int = 100, threads: int = 10) -> DataFrame:
    """As `extracted`, with at most `at_once` calls under way over the whole cluster, tries again, and a journal of finished calls."""
    found = called(docs, extractor, journal, key, at_once=at_once, threads=threads)
    rows = found.select(F.col(key).alias("graph_id"), F.explode_outer(F.from_json("answer", "array<array<string>>")).alias("t"), "error")
    return rows.select("graph_id", *[F.col("t")[k].alias(c) for k, c in enumerate(("subject", "predicate", "object"))], "error").where("subject is not null or error is not null")


def entities(relations: DataFrame) -> DataFrame:
    both = F.explode(F.array("subject", "object"))
    return relations.select("graph_id", both.alias("entity")).distinct()


def aggregated(relations: DataFrame, group: Column) -> DataFrame:
    """Graphs united by group: distinct relations."""
    return relations.select(group.alias("graph_id"), "subject", "predicate", "object").distinct()


def normal_key(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, r"[^\p{L}\p{N}]+", ""))


def exact_clusters(names: DataFrame, column: str = "entity") -> DataFrame:
    """(graph_id, member, representative): names with equal normal keys, under the smallest of them."""
    rows = names.select("graph_id", F.col(column).alias("member")).withColumn("k", normal_key(F.col("member")))
    low = rows.groupBy("graph_id", "k").agg(F.min("member").alias("representative"))
    return rows.join(low, ["graph_id", "k"]).select("graph_id", "member", "representative")


def near_clusters(names: DataFrame, column: str = "entity", similarity: float = 0.8) -> DataFrame:
    """As exact_clusters, and further names whose character trigrams have the given Jaccard similarity.

    Candidates share one of their rarest trigrams (a prefix that any similar pair must share), then the smallest name of
    each component spreads over the links until nothing changes.
    """
    exact = stage(exact_clusters(names, column), "kg-exact")
    reps = exact.select("graph_id", F.col("representative").alias("name")).distinct().withColumn("k", normal_key(F.col("name")))
    n = F.greatest(F.char_length("k") - 2, F.lit(1))
    grams = stage(reps.withColumn("grams", F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(F.col("k"), i, F.lit(3))))), "kg-grams")
    each = grams.select("graph_id", "name", F.explode("grams").alias("gram"), F.size("grams").alias("n"))
    often = each.groupBy("graph_id", "gram").agg(F.count(F.lit(1)).alias("df"))
    order = Window.partitionBy("graph_id", "name").orderBy("df", "gram")  # a name's own trigrams
    prefix = each.join(often, ["graph_id", "gram"]).withColumn("place", F.row_number().over(order)).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * similarity) + 1)
    pairs = candidates(stage(prefix.select("graph_id", "gram", "name", "n", "place"), "kg-prefix"), similarity)
    sets = grams.select("graph_id", "name", "grams")
    pairs = pairs.join(sets.toDF("graph_id", "a", "ga"), ["graph_id", "a"]).join(sets.toDF("graph_id", "b", "gb"), ["graph_id", "b"])
    like = F.size(F.array_intersect("ga", "gb")) / F.size(F.array_union("ga", "gb")) >= similarity
    labels = smallest_of_components(stage(pairs.where(like).select("graph_id", "a", "b"), "kg-links"))
    found = exact.join(labels.withColumnRenamed("name", "representative"), ["graph_id", "representative"], "left")
    return found.select("graph_id", "member", F.coalesce("label", "representative").alias("representative"))


def candidates(prefix: DataFrame, similarity: float) -> DataFrame:
    """(graph_id, a, b), a < b: names that can be similar, from their rarest trigrams (graph_id, gram, name, n, place).

    Sizes of similar sets differ by less than one class of sizes, so a trigram's names meet by class, each with its own
    and the next: a frequent trigram is split. Where a pair's first common trigram stands, what follows must suffice for
    the overlap; rows that fail that are none.
    """
    level = F.floor(F.log("n") / F.log(F.lit(1 / similarity)) + 1e-9)
    rows = prefix.withColumn("level", level)
    small = rows.select("graph_id", "gram", F.explode(F.array(F.col("level"), F.col("level") + 1)).alias("level"), F.col("name").alias("p"), F.col("n").alias("np"), F.col("place").alias("ip"))
    large = rows.select("graph_id", "gram", "level", F.col("name").alias("q"), F.col("n").alias("nq"), F.col("place").alias("iq"))
    once = (F.col("np") < F.col("nq")) | ((F.col("np") == F.col("nq")) & (F.col("p") < F.col("q")))
    sized = F.col("nq") * similarity <= F.col("np") + 1e-9
    enough = (1 + F.least(F.col("np") - F.col("ip"), F.col("nq") - F.col("iq"))) * (1 + similarity) >= (F.col("np") + F.col("nq")) * similarity - 1e-9
    met = small.join(large, ["graph_id", "gram", "level"]).where(once & sized & enough)
    return met.select("graph_id", F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def smallest_of_components(links: DataFrame) -> DataFrame:
    """(graph_id, name, label) of every name in the links (graph_id, a, b): the smallest name of its component.

    Labels are the smallest of the neighbours' labels; then each takes its label's label, so that long chains take a
    logarithm of rounds. Rounds go on until no label changes; each is staged.
    """
    both = stage(links.union(links.select("graph_id", "b", "a")).distinct(), "kg-links")
    labels = stage(both.groupBy("graph_id", F.col("a").alias("name")).agg(F.least(F.col("name"), F.min("b")).alias("label")), "kg-labels")
    while True:
        near = both.join(labels.withColumnRenamed("name", "b"), ["graph_id", "b"]).groupBy("graph_id", F.col("a").alias("name")).agg(F.min("label").alias("low"))
        low = labels.join(near, ["graph_id", "name"]).select("graph_id", "name", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        low = stage(low, "kg-low")
        hop = low.select("graph_id", F.col("name").alias("label"), F.col("label").alias("further"))
        new = stage(low.join(hop, ["graph_id", "label"]).select("graph_id", "name", "old", F.least("label", "further").alias("label")), "kg-labels")
        moved = not new.where("label <> old").isEmpty()
        unstage(labels), unstage(low)
        if not moved:
            unstage(both)
            return new.drop("old")
        labels = new


def relabelled(relations: DataFrame, clusters: DataFrame) -> DataFrame:
    """Relations between representatives, distinct."""
    to = lambda c: clusters.select("graph_id", F.col("member").alias(c), F.col("representative").alias(f"{c}_"))
    r = relations.join(to("subject"), ["graph_id", "subject"]).join(to("object"), ["graph_id", "object"])
    return r.select("graph_id", F.col("subject_").alias("subject"), "predicate", F.col("object_").alias("object")).distinct()


def cleanup(relations: DataFrame, clusters: DataFrame) -> DataFrame:
    """Per graph: entities and relations before and after, percent removed, and clusters of more than one entity."""
    size = lambda r, e, s: (
        r.groupBy("graph_id").agg(F.count(F.lit(1)).alias(f"relations_{s}")).join(e.groupBy("graph_id").agg(F.count(F.lit(1)).alias(f"entities_{s}")), "graph_id")
    )
    after = stage(relabelled(relations, clusters), "kg-after")
    merged = clusters.groupBy("graph_id", "representative").count().groupBy("graph_id").agg(F.sum((F.col("count") > 1).cast("bigint")).alias("clusters"))
    both = size(relations, entities(relations), "before").join(size(after, entities(after), "after"), "graph_id").join(merged, "graph_id")
    pct = lambda k: F.round(cleanup_percent(F.col(f"{k}_before"), F.col(f"{k}_after")), 6).alias(f"{k}_cleanup_percent")
    return both.select("graph_id", "entities_before", "entities_after", "relations_before", "relations_after", pct("entities"), pct("relations"), "clusters")


def as_lists(relations: DataFrame) -> DataFrame:
    """Per graph, its entities and relations as sorted arrays."""
    e = entities(relations).groupBy("graph_id").agg(F.sort_array(F.collect_set("entity")).alias("entities"))
    r = relations.groupBy("graph_id").agg(F.sort_array(F.collect_set(F.struct("subject", "predicate", "object"))).alias("relations"))
    return e.join(r, "graph_id")


def nearest(vectors: DataFrame, k: int = 5, every: int = 100, block: int = 512) -> DataFrame:
    """(query, rn, neighbour, similarity): the k nearest by cosine of each vector whose id is divisible by `every`.

    Queries and vectors are packed into blocks; each block of vectors meets each block of queries as one matrix product
    that keeps k per query. Up to BROADCAST_QUERIES queries are broadcast, more are joined by a shuffle.
    """
    pack = lambda rows, size, name: rows.groupBy(F.floor(F.col("vec_id") / size).alias(f"{name}_at")).agg(F.collect_list(F.struct("vec_id", "embedding")).alias(name))
    asked = vectors.where(F.col("vec_id") % every == 0).select("vec_id", "embedding")
    queries = pack(asked, every * block, "q").withColumn("one", F.lit(1))
    many = asked.count()
    if many > BROADCAST_QUERIES:  # every block of vectors is sent to each block of queries, not the other way
        at = stage(queries.select("q_at"), "knn-blocks")
        met = pack(vectors, block, "v").join(F.broadcast(at)).join(queries, "q_at")
    else:
        met = pack(vectors, block, "v").withColumn("one", F.lit(1)).join(F.broadcast(queries), "one")

    def run(batches):
        for batch in batches:
            for found, asked in zip(batch.column(0), batch.column(1), strict=True):
                ids, a = _matrix(asked)
                vid, v = _matrix(found)
                s = a @ v.T
                s[vid[None, :] == ids[:, None]] = -2
                out = []
                for i, row in enumerate(s):
                    near = np.flatnonzero(row >= np.partition(row, -k)[-k]) if len(row) > k else np.arange(len(row))
                    out += [(int(ids[i]), int(vid[t]), float(row[t])) for t in near[np.lexsort((vid[near], -row[near]))[:k]] if row[t] > -2]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64(), pa.int64(), pa.float64()], strict=True)], names=["query", "neighbour", "s"])

    best = met.select("v", "q").mapInArrow(run, "query bigint, neighbour bigint, s double")
    w = Window.partitionBy("query").orderBy(F.desc("s"), "neighbour")
    return best.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).select("query", F.col("rn").cast("bigint").alias("rn"), "neighbour", F.round("s", 6).alias("similarity"))


def _matrix(rows: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """Ids and unit vectors of an array<struct<vec_id, embedding>>."""
    ids, vectors = rows.values.field(0).to_numpy(), rows.values.field(1)
    m = vectors.flatten().to_numpy().astype(float).reshape(len(ids), -1)
    return ids, m / np.linalg.norm(m, axis=1, keepdims=True)


def merged(relations: DataFrame, size: int = 100, path: str | None = None) -> DataFrame:
    """One graph of all: groups of `size` graphs are united and de-duplicated, then the results at once.

    With a path, de-duplicated groups are kept there as a table by group, and groups that it has are not made again.
    """
    deduplicated = lambda g: relabelled(g, stage(exact_clusters(entities(g)), "kg-clusters"))
    grouped = stage(aggregated(relations, F.floor(F.col("graph_id") / size)), "kg-grouped")
    if path:
        spark = relations.sparkSession
        schema = "graph_id bigint, subject string, predicate string, object string"
        there = spark._jvm.org.apache.hadoop.fs.Path(path)
        if there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
            grouped = grouped.join(spark.read.schema(schema).parquet(path).select("graph_id").distinct(), "graph_id", "left_anti")
        deduplicated(grouped).write.mode("append").parquet(path)
        first = spark.read.schema(schema).parquet(path)
    else:
        first = deduplicated(grouped)
    return deduplicated(stage(aggregated(first, F.lit(0).cast("bigint")), "kg-whole"))
