"""Stages as streams over growing folders: each file is read once, so finished work is not done again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalar import closest_bucket


def stage(spark: SparkSession, source: str, schema: str, step: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, form: str = "parquet", files: int = 100) -> StreamingQuery:
    """Run a narrow step on the files that are new since the last call, `files` at a time, and append to sink."""
    new = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(form).load(source)
    return step(new).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def bucket_counts(spark: SparkSession, source: str, checkpoint: str, name: str, form: str = "parquet") -> StreamingQuery:
    """A running histogram of text lengths over a growing folder, as the in-memory table `name`; its state is the grid."""
    new = spark.readStream.schema("text string").format(form).load(source)
    counts = new.select(closest_bucket(F.char_length(F.coalesce("text", F.lit("")))).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return counts.writeStream.format("memory").queryName(name).option("checkpointLocation", checkpoint).outputMode("complete").trigger(availableNow=True).start()
