"""Analytics over article lengths: statistics, histograms, samples, token averages and costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalar import GRID, closest_bucket, guarded, rounded_bucket

# USD per million tokens (input, output), in the order of the published table.
PRICES = [
    ("gpt-5-nano-minimal", 0.025, 0.20),
    ("gpt-5-nano-medium", 0.025, 0.20),
    ("gpt-5-mini", 0.125, 1.0),
    ("gpt-5", 0.625, 5.0),
    ("gpt-oss-20b-together", 0.05, 0.2),
    ("gpt-oss-20b-deepinfra", 0.03, 0.14),
]
TOLERANCE, PER_BUCKET = 50, 2


def lengths(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.select(F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("len"))


def length_stats(docs: DataFrame) -> DataFrame:
    """One row: counts, moments, exact interpolated quantiles, and tokens at four characters each."""
    p = lambda q: F.percentile("len", q)
    s = lengths(docs).agg(
        F.count("len").alias("n"), F.avg("len").alias("mean"), p(0.5).alias("median"), F.stddev_pop("len").alias("std"), F.min("len").alias("min"), F.max("len").alias("max"),
        F.sum("len").alias("total"), p(0.25).alias("p25"), p(0.75).alias("p75"), p(0.95).alias("p95"), p(0.99).alias("p99"),
    )
    r = lambda c: F.round(c, 6).alias(c)
    return s.select(
        "n", r("mean"), r("median"), r("std"), "min", "max", "total", r("p25"), r("p75"), r("p95"), r("p99"),
        F.round(F.col("p75") - F.col("p25"), 6).alias("iqr"), F.round(F.col("total") / 4.0, 6).alias("tokens"),
    )


def length_histogram(docs: DataFrame, bins: int = 100) -> DataFrame:
    """Equal bins over the lengths up to the 95th percentile; the last bin is closed. Empty bins are rows too."""
    rows = lengths(docs)
    top = rows.agg(F.percentile("len", 0.95).alias("p95"))
    low = rows.join(F.broadcast(top), F.col("len") <= F.col("p95")).select("len")  # one row
    ends = low.agg(F.min("len").alias("lo"), F.max("len").alias("hi"))
    at = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.floor((F.col("len") - F.col("lo")) * bins / F.nullif(F.col("hi") - F.col("lo"), F.lit(0))), F.lit(bins - 1)))
    counts = low.join(F.broadcast(ends)).select(at.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    every = docs.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def grid(spark: SparkSession, buckets: list[int] = GRID) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*map(F.lit, buckets))).alias("bucket"))


def bucket_histogram(docs: DataFrame, buckets: list[int] = GRID) -> DataFrame:
    """(bucket, n) of every bucket, zeros included."""
    counts = lengths(docs).select(closest_bucket(F.col("len"), buckets).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return grid(docs.sparkSession, buckets).join(counts, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def sample_first(docs: DataFrame, k: int = PER_BUCKET, tolerance: int = TOLERANCE, key: str = "doc_id") -> DataFrame:
    """(bucket, rn, key, len): the first k documents by key within the tolerance of each bucket."""
    rows = docs.select(key, F.char_length("text").alias("len")).withColumn("bucket", closest_bucket(F.col("len")))
    near = rows.where(F.abs(F.col("len") - F.col("bucket")) <= tolerance)
    w = Window.partitionBy("bucket").orderBy(key)  # limited per partition before the shuffle
    return near.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).select("bucket", F.col("rn").cast("bigint").alias("rn"), key, F.col("len").cast("bigint").alias("len"))


def filled_buckets(sample: DataFrame, k: int = PER_BUCKET, buckets: list[int] = GRID) -> DataFrame:
    """(filled, sampled, shortfall): buckets with k documents, and how many documents are missing."""
    per = sample.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.coalesce(F.sum((F.col("n") >= k).cast("bigint")), F.lit(0)).alias("filled"), F.coalesce(F.sum("n"), F.lit(0)).alias("sampled")
    ).select("filled", "sampled", (F.lit(k * len(buckets)) - F.col("sampled")).alias("shortfall"))


def token_averages(results: DataFrame) -> DataFrame:
    """(bucket, avg_prompt_tokens, avg_completion_tokens, article_count) of sample results.

    results: article_length, bucket, prompt_tokens, completion_tokens. Rows without a length or any tokens are skipped; a missing
    or zero bucket is computed from the length.
    """
    ok = results.where((F.coalesce("article_length", F.lit(0)) != 0) & ((F.col("prompt_tokens") != 0) | (F.col("completion_tokens") != 0)))
    bucket = F.coalesce(F.nullif(F.col("bucket"), F.lit(0)), rounded_bucket(F.col("article_length")))
    avg = lambda c: F.bround(F.avg(c), 2).alias(f"avg_{c}")
    return ok.withColumn("bucket", bucket).groupBy("bucket").agg(avg("prompt_tokens"), avg("completion_tokens"), F.count(F.lit(1)).alias("article_count"))


def flat_results(raw: DataFrame) -> DataFrame:
    """Nested sample results as token_averages reads them."""
    t = F.col("extraction.tokens")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return raw.select("article_id", "article_length", "bucket", zero(t["prompt_tokens"]).alias("prompt_tokens"), zero(t["completion_tokens"]).alias("completion_tokens"))


def simulated_results(docs: DataFrame) -> DataFrame:
    """Sample results of a rule instead of a model: a prompt of a token per four characters, a completion of one per word."""
    s = docs.join(F.broadcast(sample_first(docs).select("doc_id", "bucket")), "doc_id")  # PER_BUCKET rows of each bucket at most
    return s.select(
        F.col("doc_id").cast("string").alias("article_id"),
        F.char_length("text").alias("article_length"),
        F.when(F.col("doc_id") % 3 == 0, F.lit(0)).otherwise(F.col("bucket")).alias("bucket"),
        F.ceil(F.char_length("text") / 4).cast("bigint").alias("prompt_tokens"),
        F.size(F.split("text", " ")).cast("bigint").alias("completion_tokens"),
    )


def prices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRICES, "model string, input double, output double").coalesce(1)


def cost(histogram: DataFrame, estimates: DataFrame, price: DataFrame) -> DataFrame:
    """Per model: articles, tokens and USD. Buckets without an estimate drop out of all totals.

    estimates: bucket, avg_prompt_tokens, avg_completion_tokens, and model if they differ by model.
    """
    joined = histogram.join(estimates, "bucket")
    per_model = "model" in estimates.columns
    sums = joined.groupBy(*(["model"] if per_model else [])).agg(
        F.sum("n").alias("articles"), F.sum(F.col("n") * F.col("avg_prompt_tokens")).alias("input_tokens"), F.sum(F.col("n") * F.col("avg_completion_tokens")).alias("output_tokens")
    )
    rows = price.join(sums, "model") if per_model else price.join(F.broadcast(sums))  # else one row of sums
    usd = lambda tokens, rate: F.col(tokens) / 1e6 * F.col(rate)
    total = usd("input_tokens", "input") + usd("output_tokens", "output")
    r = lambda c, name, d=4: F.round(c, d).alias(name)
    return rows.select(
        "model", "articles", r(F.col("input_tokens"), "input_tokens", 2), r(F.col("output_tokens"), "output_tokens", 2), r(usd("input_tokens", "input"), "input_usd"),
        r(usd("output_tokens", "output"), "output_usd"), r(total, "usd"), r(guarded(total, F.col("articles")), "usd_per_article", 8),
    )


def priced_models(price: DataFrame, estimated: DataFrame) -> DataFrame:
    """Models of the price table that have estimates."""
    return price.join(estimated.select("model"), "model", "left_semi")


def token_usage(history: DataFrame, by: str) -> DataFrame:
    """Summed usage of model calls; usage lies in the call or in its response."""
    field = lambda k: F.coalesce(F.col(f"usage.{k}"), F.col(f"response_usage.{k}"), F.lit(0))
    keys = ("prompt_tokens", "completion_tokens", "total_tokens")
    return history.groupBy(by).agg(*[F.sum(field(k)).cast("bigint").alias(k) for k in keys])
