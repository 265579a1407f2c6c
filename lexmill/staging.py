"""Tables written to the cluster's shared folder and read back: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Bytes of a row group in staged tables.
ROW_GROUP = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir); a folder of our own only where that is unset and Spark is local."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="lexmill-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def home(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/lexmill/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{home(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)  # a task holds a row group
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def unstage(df: DataFrame | None) -> None:
    """Delete a staged table that nothing reads any more."""
    if path := getattr(df, "staged_at", None):
        _delete(df.sparkSession, path)


def clear(spark: SparkSession) -> None:
    """Delete all that this application has staged; results that still read from it must have been written."""
    _delete(spark, home(spark))
