"""Snapshots and their chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalar import any_date


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """Snapshots of the latest day; all of them if no date reads."""
    dates = [F.col(c) for c in ("date_modified", "date_created", "date_published", "version") if c in snapshots.columns]
    dated = snapshots.withColumn("__day", F.to_date(any_date(*dates)))
    # one row: a snapshot list is a catalogue, and the maximum is a partial aggregate
    last = dated.agg(F.max("__day").alias("__last"))
    return dated.join(F.broadcast(last), F.col("__last").isNull() | (F.col("__day") == F.col("__last"))).drop("__day", "__last")


def chunk_paths(snapshots: DataFrame) -> DataFrame:
    """(identifier, chunk, path) of every chunk."""
    return snapshots.select("identifier", F.explode("chunks").alias("chunk")).withColumn(
        "path", F.concat("identifier", F.lit("/"), "identifier", F.lit("_"), "chunk", F.lit(".json.tar.gz"))
    )


def pending(paths: DataFrame, present: DataFrame) -> DataFrame:
    """Paths that are not there yet."""
    return paths.join(present.select("path"), "path", "left_anti")


def first_files(files: DataFrame, n: int | None) -> DataFrame:
    """The first n files by name; 0 or None: all."""
    return files.orderBy("path").limit(n) if n else files


def pages_of_groups(rows: DataFrame, size: int, key: str = "id") -> DataFrame:
    """Rows with group: consecutive groups of `size` by key. Ranks are made inside ranges of keys, then shifted."""
    w = Window.partitionBy("__r").orderBy(key)
    ranged = rows.withColumn("__r", F.floor(F.col(key) / F.lit(10_000)))
    counts = ranged.groupBy("__r").agg(F.count(F.lit(1)).alias("__n"))
    starts = counts.select("__r", F.coalesce(F.sum("__n").over(Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__at"))
    out = ranged.withColumn("__i", F.row_number().over(w) - 1).join(starts, "__r")
    return out.withColumn("group", F.floor((F.col("__at") + F.col("__i")) / size).cast("bigint")).drop("__r", "__i", "__at")
