"""Chat formatting of reply trees, with DataFrame functions only.

Messages point to the message they answer. Root-to-leaf paths come from iterative self-joins that double their reach
(a path of n turns takes log2 n rounds); texts stay out of these joins. Each tree's leaves are ranked by the summed
score of their path, and every chosen path is written as one conversation:

    <|im_start|>role LF text <|im_end|> LF        for each turn

Inside texts `\\` becomes `\\\\` and `<|` becomes `<\\|`, so no control string can arise; in roles a line feed
becomes `<\\n>` too. Both are undone by `read_back`.

Defined cases: null text or role is empty; null conversation ids form one conversation; a parent that is missing makes
its child a root; messages in a cycle of parents are on no path; of repeated (conversation, message) ids the first by
parent (null first), score, role and text counts (`chain` numbers rows anew, ties in turn by role and text); an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("<\\n>")) if role else out


def unescape(text: Column, role: bool = False) -> Column:
    text = F.replace(text, F.lit("<\\n>"), F.lit("\n")) if role else text
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def chain(turns: DataFrame) -> DataFrame:
    """A table of turns as trees: each turn answers the turn before it, with score 1."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return turns.select(
        "conv_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.row_number().over(order).cast("long").alias("id")
    ).select("*", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), F.lit(1.0).alias("score"))


def chosen_paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """Rows (tree, path, id, depth) of the `keep` best root-to-leaf paths of every tree; path is its rank from 1.

    messages: tree (not null), id, parent, score. Depth counts from 1 at the root.
    """
    known = messages.select("tree", F.col("id").alias("parent"), F.lit(True).alias("found"))
    nodes = stage(
        messages.select("tree", "id", "parent", "score")
        .join(known, ["tree", "parent"], "left")
        .select("tree", "id", F.when(F.col("found"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("depth"), F.col("score").cast("double")),
        "chat-up",
    )
    total, levels, rounds = nodes.count(), [nodes], 0
    while levels[-1].where("up is not null").limit(1).count() and 2**rounds <= total:
        cur = levels[-1]
        far = cur.select("tree", F.col("id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("d2"), F.col("score").alias("s2"))
        done = cur.where("up is null")
        more = cur.where("up is not null").join(far, ["tree", "up"]).select("tree", "id", F.col("up2").alias("up"), (F.col("depth") + F.col("d2")).alias("depth"), (F.col("score") + F.col("s2")).alias("score"))
        levels.append(stage(done.union(more), "chat-up"))
        rounds += 1
    ends = levels[-1].where("up is null").select("tree", "id", "depth", "score")
    inner = nodes.where("up is not null").select("tree", F.col("up").alias("id")).distinct()
    best = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("depth"), "id")
    leaves = ends.join(inner, ["tree", "id"], "left_anti").withColumn("path", F.row_number().over(best)).where(F.col("path") <= keep)
    marks = leaves.select("tree", "path", "id")
    for level in reversed(levels[:-1]):
        jumps = level.where("up is not null").select("tree", "id", "up")
        marks = stage(marks.union(marks.join(jumps, ["tree", "id"]).select("tree", "path", F.col("up").alias("id"))), "chat-marks")
    return marks.distinct().join(ends.select("tree", "id", "depth"), ["tree", "id"])


def format_conversations(messages: DataFrame, keep: int = 1, key: str = "conv_id", numbered: bool = False) -> DataFrame:
    """Rows (key, path, formatted, loss array<struct<start, length>>): spans of code points with assistant text.

    messages: key, id, parent, score, role, text; numbered: no id is repeated in its tree. A loss span holds an
    assistant's escaped text, no markers.
    """
    if not numbered:
        row = F.struct("parent", "score", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        messages = messages.groupBy(key, "id").agg(F.min(row).alias("m")).select(key, "id", "m.*")
    m = stage(messages.withColumn("tree", F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null"))), "chat-messages")
    paths = chosen_paths(m, keep)
    head = F.concat(F.lit(START), escape(F.col("role"), role=True), F.lit("\n"))
    body = escape(F.col("text"))
    turns = paths.join(m.select("tree", "id", key, "role", "text"), ["tree", "id"]).select(
        "tree", key, "path", "depth", (F.col("role") == "assistant").alias("learn"), head.alias("head"), body.alias("body")
    )
    so_far = Window.partitionBy("tree", "path").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    turn_chars = F.char_length("head") + F.char_length("body") + len(END) + 1
    turns = turns.withColumn("at", F.coalesce(F.sum(turn_chars).over(so_far), F.lit(0)))
    piece = F.struct("depth", F.concat("head", "body", F.lit(END + "\n")).alias("s"), "learn", (F.col("at") + F.char_length("head")).alias("start"), F.char_length("body").cast("long").alias("length"))
    made = turns.groupBy("tree", "path").agg(F.first(key).alias(key), F.array_sort(F.collect_list(piece)).alias("t"))
    return made.select(
        key,
        "path",
        F.array_join(F.transform("t", lambda x: x["s"]), "").alias("formatted"),
        F.transform(F.filter("t", lambda x: x["learn"]), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"))).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Add `turns` array<struct<role, text>> and `learned` (texts under the loss mask), read from the output alone."""
    pieces = F.filter(F.split("formatted", r"<\|im_start\|>"), lambda p, i: i > 0)
    closed = F.transform(pieces, lambda p: F.substring_index(p, END, 1))
    turns = F.transform(
        closed,
        lambda p: F.struct(
            unescape(F.substring_index(p, "\n", 1), role=True).alias("role"),
            unescape(F.substr(p, F.instr(p, F.lit("\n")) + 1)).alias("text"),
        ),
    )
    learned = F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.withColumn("turns", turns).withColumn("learned", learned)


def digests(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """The digest columns of the formatted conversations of a table of turns."""
    back = read_back(format_conversations(chain(turns), numbered=True))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    heard = F.array_join("learned", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(heard).cast("long").alias("loss_chars"),
        F.sha2(heard, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
