"""A standing graph that new graphs join step by step.

Entities are the normal keys of names. Three tables hold the graph: relations between keys, the smallest name of each key,
and a forest of keys that were found to be the same (root of a key). A step only appends to them: relations that aren't
there, names that are new or smaller, and roots of the keys that a new link moves. Of earlier steps just these keys are read,
never their graphs. Each step is a folder {from}_{to} in each table and is marked as done when all of it is written: a step
that failed is written anew, a step that is done is skipped.

Defined cases: a name without letters and digits has the empty key; relations with a null are skipped; a step without
relations is a step; links between names that no relation has are kept for later.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import stage
from .graphs import normal_key, smallest_of_components

_SCHEMAS = {"relations": "subject string, predicate string, object string", "names": "key string, name string", "forest": "key string, root string, turn int"}


class Standing:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def steps(self) -> list[str]:
        """Names of the steps that are done."""
        fs, at = self._fs(f"{self.path}/done")
        if not fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(at) if not s.getPath().getName().startswith((".", "_")))

    def _read(self, table: str) -> DataFrame:
        there = [f"{self.path}/{table}/{s}" for s in self.steps()]
        return self.spark.read.schema(_SCHEMAS[table]).parquet(*there) if there else self.spark.createDataFrame([], _SCHEMAS[table])

    def _roots(self) -> DataFrame:
        """(key, root) of the keys that aren't their own root: the last that was written."""
        return self._read("forest").groupBy("key").agg(F.max_by("root", "turn").alias("root"))

    def add(self, relations: DataFrame, first: int, last: int, links: DataFrame | None = None) -> bool:
        """One step: relations (subject, predicate, object) of graphs first to last, and links (a, b) of names that are the same."""
        step = f"{first}_{last}"
        if step in self.steps():
            return False
        r = relations.where("subject is not null and predicate is not null and object is not null")
        keyed = stage(r.select(normal_key(F.col("subject")).alias("ks"), "predicate", normal_key(F.col("object")).alias("ko"), "subject", "object"), "standing")
        rows = keyed.select(F.col("ks").alias("subject"), "predicate", F.col("ko").alias("object")).distinct().join(self._read("relations"), ["subject", "predicate", "object"], "left_anti")
        both = F.explode(F.array(F.struct(F.col("ks").alias("key"), F.col("subject").alias("name")), F.struct(F.col("ko").alias("key"), F.col("object").alias("name"))))
        names = keyed.select(both.alias("x")).groupBy("x.key").agg(F.min("x.name").alias("name"))
        known = self._read("names").groupBy("key").agg(F.min("name").alias("old"))
        names = names.join(known, "key", "left").where("old is null or name < old").select("key", "name")
        for table, new in (("relations", rows), ("names", names), ("forest", self._moved(links))):
            new.write.mode("overwrite").parquet(f"{self.path}/{table}/{step}")
        fs, at = self._fs(f"{self.path}/done/{step}")
        out = fs.create(at, True)
        out.write(bytearray(json.dumps({"first": first, "last": last}).encode()))
        out.close()
        return True

    def _moved(self, links: DataFrame | None) -> DataFrame:
        """The forest's new rows: keys whose root a link moves to a smaller one."""
        if links is None:
            return self.spark.createDataFrame([], _SCHEMAS["forest"])
        roots = stage(self._roots(), "standing-roots")
        pairs = links.select(normal_key(F.col("a")).alias("a"), normal_key(F.col("b")).alias("b"))
        for c in ("a", "b"):
            pairs = pairs.join(roots.select(F.col("key").alias(c), "root"), c, "left").withColumn(c, F.coalesce("root", c)).drop("root")
        edges = stage(pairs.where("a <> b").select(F.lit(0).alias("graph_id"), "a", "b").distinct(), "standing-links")
        to = stage(smallest_of_components(edges).where("name <> label").select(F.col("name").alias("root"), F.col("label").alias("new")), "standing-labels")
        below = roots.join(to, "root").select("key", F.col("new").alias("root"))
        return below.union(to.select("root", "new")).select("key", "root", F.lit(len(self.steps())).alias("turn"))

    def relations(self) -> DataFrame:
        """The graph as (graph_id 0, subject, predicate, object) between the smallest names of each entity."""
        roots = self._roots()
        root = lambda rows, c: rows.join(roots.select(F.col("key").alias(c), "root"), c, "left").withColumn(c, F.coalesce("root", c)).drop("root")
        names = stage(root(self._read("names").groupBy("key").agg(F.min("name").alias("name")), "key").groupBy("key").agg(F.min("name").alias("name")), "standing-names")
        out = root(root(self._read("relations"), "subject"), "object")
        for c in ("subject", "object"):
            out = out.join(names.select(F.col("key").alias(c), "name"), c).withColumn(c, F.col("name")).drop("name")
        return out.select(F.lit(0).cast("bigint").alias("graph_id"), "subject", "predicate", "object").distinct()
