"""JSON, CSV and Parquet files of the stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import METADATA, PUBLISHED, SAMPLE_RESULT, SCRIPT_MAP
from ..functions.scalar import last_segment
from ..operators.catalog import first_files


def write_documents(docs: DataFrame, path: str, mode: str = "error") -> None:
    """Documents (text, id, metadata) as JSON lines."""
    docs.select("text", "id", "metadata").write.mode(mode).json(path)


def read_documents(spark: SparkSession, path: str, max_files: int = 0) -> DataFrame:
    """Documents from JSON lines; the first `max_files` files by name, 0: all."""
    if max_files:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
        path = [r["path"] for r in first_files(listed.where(~F.col("path").rlike("/[_.][^/]*$")), max_files).collect()]  # as many names as asked for
    meta = ", ".join(f"{x.split(' ', 1)[0]}: {x.split(' ', 1)[1]}" for x in _fields(METADATA))
    return spark.read.schema(f"text string, id string, metadata struct<{meta}>").json(path)


def _fields(ddl: str) -> list[str]:
    """Top-level fields of a DDL string."""
    out, depth, now = [], 0, ""
    for c in ddl:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(now.strip())
            now = ""
        else:
            now += c
    return [*out, now.strip()]


def read_script_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(SCRIPT_MAP).csv(path)


def read_disambiguation_ids(spark: SparkSession, path: str) -> DataFrame:
    """(item) from a JSON array of entity addresses."""
    return spark.read.schema("item string").option("multiLine", True).json(path).select(last_segment(F.col("item")).alias("item"))


def read_reference_words(spark: SparkSession, path: str) -> DataFrame:
    """(wiki, heading) from a JSON object wiki -> headings."""
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string, array<string>>")).alias("wiki", "words"))
    return raw.select("wiki", F.explode("words").alias("heading"))


def write_published(rows: DataFrame, path: str, by_language: bool = False, rows_per_file: int | None = None, mode: str = "error", bytes_per_file: int | None = None) -> None:
    """The fixed schema as Parquet, by language code if asked, with at most rows_per_file rows in a file, or about
    bytes_per_file bytes of text (before compression) by the mean size of a row."""
    if bytes_per_file:
        mean = rows.agg(F.avg(F.coalesce(F.octet_length("text"), F.lit(0)) + F.coalesce(F.octet_length("wikitext"), F.lit(0)) + F.coalesce(F.octet_length("infoboxes"), F.lit(0)))).first()[0]
        fitting = max(1, int(bytes_per_file / max(1.0, mean or 1.0)))
        rows_per_file = min(rows_per_file or fitting, fitting)
    w = rows.select(*[F.col(n).cast(t).alias(n) for n, t in PUBLISHED]).write.mode(mode)
    w = w.option("maxRecordsPerFile", rows_per_file) if rows_per_file else w
    (w.partitionBy("language_code") if by_language else w).parquet(path)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(", ".join(f"{n} {t}" for n, t in PUBLISHED)).parquet(path)


def capped(rows: DataFrame, max_items: int = 0) -> DataFrame:
    """At most so many rows; 0: all."""
    return rows.limit(max_items) if max_items else rows


def read_sample_results(spark: SparkSession, path: str) -> DataFrame:
    """Nested sample results, one file each; files that don't parse are marked by `corrupt`."""
    ddl = f"{SAMPLE_RESULT}, corrupt string"
    return spark.read.schema(ddl).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt").json(path)


def append_missing(rows: DataFrame, path: str, key: str, compute: Callable[[DataFrame], DataFrame], schema: str) -> int:
    """Compute and append the rows whose key isn't in the JSON table at path; corrupt entries are computed again. Count of new rows."""
    spark = rows.sparkSession
    try:
        have = spark.read.schema(schema).json(path).where(F.col(key).isNotNull()).select(key).distinct()
        todo = rows.join(have, key, "left_anti")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        todo = rows
    new = compute(todo).persist()
    n = new.count()
    if n:
        new.write.mode("append").json(path)
    new.unpersist()
    return n


def to_json_object(rows: DataFrame, key: str) -> DataFrame:
    """One row: a JSON object key -> other columns (a number, if there is one), by ascending key."""
    rest = [c for c in rows.columns if c != key]
    value = F.col(rest[0]) if len(rest) == 1 else F.struct(*rest)
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), value.alias("v"))))
    text = F.transform(entries, lambda e: F.struct(e["k"].cast("string").alias("key"), e["v"].alias("value")))
    return rows.agg(F.to_json(F.map_from_entries(text)).alias("json"))


def from_json_object(spark: SparkSession, path: str, value: str, key: str = "bucket") -> DataFrame:
    """Rows of a JSON object key -> value; value: DDL of a number or a struct."""
    raw = spark.read.text(path, wholetext=True)
    rows = raw.select(F.explode(F.from_json("value", f"map<string, {value}>")).alias(key, "v"))
    fields = ["v.*"] if value.startswith("struct") else [F.col("v").alias("n")]
    return rows.select(F.col(key).cast("int").alias(key), *fields)


def cached(spark: SparkSession, path: str, compute: Callable[[], DataFrame], fresh: bool = False) -> DataFrame:
    """A stage's table: read if it is there and whole, computed and written otherwise."""
    jvm = spark._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    fs = done.getFileSystem(spark._jsc.hadoopConfiguration())
    if fresh or not fs.exists(done):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_cached(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
