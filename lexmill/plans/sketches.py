"""Length statistics from stored sketches: a file's texts are read once, ever.

Each file has a row with exact sums and a KLL sketch of its text lengths. Corpus statistics, of any choice of files, merge
these rows. Merging is by sums and sketch unions, so it doesn't depend on order or grouping; a quantile's rank is off by at most
the sketch's bound (about 1.7 / K ** 0.9 of the rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of a sketch: with 400, ranks are off by under one per cent.
K = 400
SCHEMA = "file string, n long, total long, squares decimal(38,0), low long, high long, sketch binary"
PROBABILITIES = (0.25, 0.5, 0.75, 0.95, 0.99)


def file_sketches(docs: DataFrame, text: str = "text", k: int = K) -> DataFrame:
    """One row per file of docs, which must be read from files."""
    length = F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("long")
    rows = docs.select(F.col("_metadata.file_path").alias("file"), length.alias("len"))
    return rows.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.sum("len").alias("total"), F.sum(F.col("len").cast("decimal(19,0)") * F.col("len").cast("decimal(19,0)")).cast("decimal(38,0)").alias("squares"),
        F.min("len").alias("low"), F.max("len").alias("high"), F.kll_sketch_agg_bigint("len", k).alias("sketch"),
    )


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def refresh(spark: SparkSession, source: str, path: str) -> int:
    """Add the sketches of Parquet files of source that the table at path lacks; the number of files read.

    Files that are gone stay in the table; `stats` may leave them out by its choice of rows.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(source).select(F.col("path").alias("file"))
    if _exists(spark, path):
        listed = listed.join(spark.read.schema(SCHEMA).parquet(path).select("file"), "file", "left_anti")
    new = [r["file"] for r in listed.collect()]  # names of new files
    if new:
        file_sketches(spark.read.parquet(*new)).coalesce(1).write.mode("append").parquet(path)
    return len(new)


def stats(sketches: DataFrame, probabilities: tuple[float, ...] = PROBABILITIES) -> DataFrame:
    """One row: n, mean, std, min, max, total (exact) and quantiles p25, … (from the merged sketch)."""
    m = sketches.agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.min("low").alias("min"), F.max("high").alias("max"), F.kll_merge_agg_bigint("sketch").alias("sketch")
    )
    mean = F.col("total") / F.col("n")
    spread = F.sqrt(F.greatest(F.lit(0.0), (F.col("squares") * F.col("n") - F.col("total").cast("decimal(38,0)") * F.col("total")).cast("double")) / F.col("n") / F.col("n"))
    q = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(p))).alias(f"p{p * 100:.0f}") for p in probabilities]
    return m.select("n", mean.alias("mean"), spread.alias("std"), "min", "max", "total", *q)


def share_up_to(sketch: Column, length: int) -> Column:
    """The estimated share of texts of at most that length."""
    return F.kll_sketch_get_rank_bigint(sketch, F.lit(length).cast("long"))
