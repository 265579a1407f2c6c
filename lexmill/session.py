"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # pages are large: small Arrow batches keep Python workers small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def session(master: str | None = None, name: str = "lexmill", **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(name)
    b = b.master(master) if master else b
    return b.config(map=DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()
