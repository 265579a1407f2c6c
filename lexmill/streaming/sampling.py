"""The first k documents of each length bucket, from a stream that stops as soon as every bucket is full.

State is one counter per bucket, so the grid bounds it. Within a micro-batch documents are taken in order of their key, so the
sample is that of a window over (batch, key). Each batch writes its own folder, anew if it is run again.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.scalar import GRID, closest_bucket
from ..plans.lengths import PER_BUCKET, TOLERANCE

ROW = "bucket int, rn long, doc_id long, len long"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _FirstK(StatefulProcessor):
    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.taken = handle.getValueState("taken", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        n = self.taken.get()[0] if self.taken.exists() else 0
        room = self.k - n
        best: list[tuple[int, int]] = []
        for pdf in rows:
            if room:
                best = heapq.nsmallest(room, [*best, *zip(pdf["doc_id"].tolist(), pdf["len"].tolist(), strict=True)])
        if best:
            self.taken.update((n + len(best),))
            yield pd.DataFrame([(key[0], n + 1 + i, d, length) for i, (d, length) in enumerate(best)], columns=["bucket", "rn", "doc_id", "len"])

    def close(self) -> None:
        pass


def sampled(docs: DataFrame, k: int = PER_BUCKET, tolerance: int = TOLERANCE) -> DataFrame:
    """(bucket, rn, doc_id, len) of a streaming table (doc_id, text)."""
    rows = docs.select("doc_id", F.char_length("text").cast("long").alias("len")).withColumn("bucket", closest_bucket(F.col("len")))
    near = rows.where(F.abs(F.col("len") - F.col("bucket")) <= tolerance)
    return near.groupBy("bucket").transformWithStateInPandas(_FirstK(k), ROW, "append", "none")


def sample_until_full(spark: SparkSession, source: str, sink: str, checkpoint: str, k: int = PER_BUCKET, buckets: list[int] = GRID, tolerance: int = TOLERANCE, files: int = 1) -> int:
    """Sample the Parquet files of a folder, `files` at a time by age, until every bucket has k documents; batches that were run.

    Started again with the same checkpoint, it goes on where it stopped.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    new = spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", files).parquet(source)
    seen = {"batches": 0, "full": False}

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")
        seen["batches"] += 1
        have = spark.read.schema(ROW).parquet(sink).groupBy("bucket").count().where(F.col("count") >= k)
        seen["full"] = have.count() >= len(buckets)  # rows of the grid

    q = sampled(new, k, tolerance).writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    while not q.awaitTermination(1):
        if seen["full"]:
            q.stop()
    return seen["batches"]
