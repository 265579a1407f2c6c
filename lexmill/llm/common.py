"""Helpers shared by the operators: tables, ranks and connected components."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from ..staging import stage, unstage
from .words import trimmed

#: ASCII white space that separates words (tab, LF, VT, FF, CR, space), as a Java regex class.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"


#: Rows of an Arrow batch where the session has Spark's default: texts are long, and both sides hold whole batches.
BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; the session's Arrow batches are made smaller if it has no size of its own for them."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A DataFrame of a few rows of the driver; by Arrow, so that no Python worker is started to read them."""
    schema = T.StructType.fromDDL(ddl)
    fields = to_arrow_schema(schema)
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields), schema)


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, group: list[str], order: list[Column], spread: Column, name: str, buckets: int) -> DataFrame:
    """Add `name`: the row's place from 0 in its group, in order of (bucket of `spread`, order).

    No task sees a whole group: rows are numbered inside (group, bucket) and shifted by the bucket's start, which
    comes from a small table of counts. df must be deterministic (staged), since it is read twice. `spread` must
    scatter the rows of a hot group.
    """
    b = df.withColumn("__b", F.pmod(spread, F.lit(buckets)).cast("int"))
    counts = b.groupBy(*group, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__at"))
    inside = Window.partitionBy(*group, "__b").orderBy(*order)
    return (
        b.withColumn("__i", F.row_number().over(inside) - 1)
        .join(starts, [*group, "__b"])
        .withColumn(name, (F.col("__at") + F.col("__i")).cast("long"))
        .drop("__b", "__at", "__i")
    )


#: Up to so many edges (16 bytes each), components are found in one task; beyond, by rounds of joins.
ONE_TASK_EDGES = 200_000


def _one_task(edges: DataFrame) -> DataFrame:
    """Components of at most ONE_TASK_EDGES edges by union-find in one task."""

    def run(batches):
        up: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := up.setdefault(x, x)) != x:
                up[x] = up[y]
                x = y
            return x

        for batch in batches:
            for x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = find(x), find(y)
                up[max(x, y)] = min(x, y)
        nodes = list(up)
        for k in range(0, len(nodes), 50_000):
            part = nodes[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())], names=["node", "root"])

    return stage(edges.select("u", "v").repartition(1).mapInArrow(trimmed(run), "node long, root long"), "components")


def components(edges: DataFrame, a: str = "a", b: str = "b", limit: int = 60) -> DataFrame:
    """Connected components of the edges (long ids): rows (node, root), root = smallest id reached.

    Alternating large-star and small-star (Kiveris et al. 2014), written to the shared folder each round, until the
    edges are few enough for one task. A hub's neighbours are never gathered: its minimum is a partial aggregate, which
    is joined back (AQE splits hot keys). Every node of an edge is returned. Raises if it has not converged after
    `limit` rounds.
    """
    cur = stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges"
    )
    state = None
    for _ in range(limit):
        if state is None and cur.count() <= ONE_TASK_EDGES:
            out = _one_task(cur)
            unstage(cur)
            return out
        # large star: every larger neighbour of u is linked to the smallest of u and its neighbours
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: smaller neighbours and u itself are linked to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        old, cur = cur, stage(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        unstage(old)
        new = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == new:
            break
        state = new
    else:
        raise RuntimeError("components did not converge")
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
