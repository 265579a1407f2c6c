"""Sharding by balanced label propagation.

Documents with equal texts are linked; a linked document moves, round by round, to the shard where most of its group
is, as far as the target has room, counting what leaves it in the same round, until no fewer rows are apart from their
group. A last step places groups that are still apart into the room left, group by group, and makes the counts of rows
exact. Law `rows`: counts at most one apart.

Defined cases: null text counts as empty (size 16, linked with empty texts); repeated rows are rows of their own; an
empty table gives no rows; further columns are ignored; fewer rows than shards leave shards empty.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import local_rows, ranked, stage, unstage

#: Rounds at most; they end when the number of rows that want to move stops falling.
ROUNDS = 20
#: Rows that one task ranks at a time, about.
RANK_ROWS = 2000


def _unit(*cols) -> F.Column:
    """A number in [0, 1) from a hash of the columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def granted(wishes: np.ndarray, used: np.ndarray, room: int) -> np.ndarray:
    """The share of each wish (rows that want from shard i to shard j) so that no shard gets more than it has room for
    and gives away."""
    flow = wishes.astype(float)
    for _ in range(500):
        into = flow.sum(axis=0)
        fits = np.maximum(0, room - used + flow.sum(axis=1))
        if (into <= fits + 0.5).all():
            break
        flow *= np.minimum(1, fits / np.maximum(into, 1e-9))
    return flow / np.maximum(wishes, 1)


def balanced_shards(docs: DataFrame, shards: int = 40, rounds: int = ROUNDS) -> DataFrame:
    """Rows (doc_id, size, text_crc32, group, shard, slot); group is the digest of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = stage(
        docs.select("doc_id", text.alias("t")).select(
            "doc_id", F.unhex(F.md5("t")).alias("group"), (F.octet_length("t") + 16).cast("long").alias("size"), F.crc32("t").alias("text_crc32")
        ),
        "shard-base",
    )
    n = base.count()
    quota = F.lit(n // shards) + F.when(F.col("shard") < n % shards, 1).otherwise(0)
    buckets = max(1, n // RANK_ROWS // shards + 1)

    # tables that join by group are staged first: an aggregate right below a join keeps Spark from splitting a hot group
    groups = stage(base.groupBy("group").agg(F.count(F.lit(1)).alias("g")).where("g > 1"), "shard-groups")
    linked = base.join(groups, "group").withColumn("label", F.pmod(F.xxhash64("doc_id", "group"), F.lit(shards)).cast("int"))
    linked = stage(linked, "shard-labels")
    half = max(1, n // shards // 2)
    room, last = n // shards, None
    for k in range(rounds):
        # what each group has where; a group is a hyperedge, so its pairs are never formed
        votes = linked.groupBy("group", "label").agg(F.count(F.lit(1)).alias("c"))
        best = votes.groupBy("group").agg(F.max(F.struct(F.col("c"), F.xxhash64("group", "label").alias("h"), F.col("label"))).alias("w")).select("group", F.col("w.label").alias("to"))
        best = stage(best, "shard-votes")
        # a group larger than half a shard is dealt over as many shards as it needs, next to each other
        spread = F.floor(_unit("doc_id", "group") * F.ceil(F.col("g") / half)).cast("int")
        wish = linked.join(best, "group").withColumn("to", F.when(F.col("g") > half, F.pmod(F.xxhash64("group"), F.lit(shards)) + spread).otherwise(F.col("to")))
        wish = wish.withColumn("to", F.pmod(F.col("to"), F.lit(shards)).cast("int"))
        # at most shards x shards rows
        asked = wish.where("to <> label").groupBy("label", "to").agg(F.count(F.lit(1)).alias("n")).collect()
        apart = sum(r["n"] for r in asked)
        if not apart or (last is not None and apart >= last):
            break
        last = apart
        wishes, used = np.zeros((shards, shards), np.int64), np.zeros(shards, np.int64)
        for r in asked:
            wishes[r["label"], r["to"]] = r["n"]
        for r in linked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect():
            used[r["label"]] = r["n"]
        p = granted(wishes, used, room)
        share = local_rows(docs.sparkSession, [(r["label"], r["to"], float(p[r["label"], r["to"]])) for r in asked], "label int, to int, p double")
        moved = wish.join(F.broadcast(share), ["label", "to"], "left").withColumn(
            "label", F.when((F.col("to") != F.col("label")) & (_unit("group", "label", F.lit(k)) < F.col("p")), F.col("to")).otherwise(F.col("label"))
        )
        old, linked = linked, stage(moved.select(*linked.columns), "shard-labels")
        unstage(old), unstage(best)

    # groups that are still apart, for want of room, are placed anew as a whole with the free rows
    ends = linked.groupBy("group").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("g").alias("g"))
    ends = stage(ends.where((F.col("lo") != F.col("hi")) & (F.col("g") <= half)).select("group"), "shard-apart")
    loose = linked.join(ends, "group", "left_semi")
    linked = linked.join(ends, "group", "left_anti")

    # linked rows beyond a shard's quota join the free rows; free rows fill what is left
    salt = F.floor(_unit("doc_id") * F.ceil(F.col("g") / RANK_ROWS)).cast("long")
    at = ranked(linked.withColumnRenamed("label", "shard"), ["shard"], [F.col("group"), F.col("doc_id")], F.xxhash64("group") + salt, "slot", buckets)
    at = stage(at.withColumn("stays", F.col("slot") < quota), "shard-linked")
    sizes = [0] * shards
    for r in at.where("stays").groupBy("shard").count().collect():  # at most `shards` rows
        sizes[r["shard"]] = r["count"]
    free_of, start, rows = [n // shards + (s < n % shards) - sizes[s] for s in range(shards)], 0, []
    for s in range(shards):
        rows.append((s, start, start + free_of[s], sizes[s]))
        start += free_of[s]
    plan = local_rows(docs.sparkSession, rows, "shard int, lo long, hi long, taken long")
    out = ["doc_id", "size", "text_crc32", "group"]
    alone = base.join(groups, "group", "left_anti").withColumn("g", F.lit(1).cast("long"))
    free = at.where("not stays").select(*out, "g").union(loose.select(*out, "g")).union(alone.select(*out, "g")).withColumn("one", F.lit(0))
    free = ranked(stage(free, "shard-free"), ["one"], [F.col("group"), F.col("doc_id")], F.xxhash64("group") + salt, "r", buckets * shards)
    filled = free.join(F.broadcast(plan), (F.col("r") >= F.col("lo")) & (F.col("r") < F.col("hi"))).select(*out, "shard", (F.col("taken") + F.col("r") - F.col("lo")).alias("slot"))
    return at.where("stays").select(*out, "shard", "slot").union(filled)
