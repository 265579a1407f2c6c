"""Quality rules with adaptive thresholds, with DataFrame functions only.

Every document's measures are put into integer bins. Counts per (lang, source, measure, bin) are a quantile sketch
that merges by adding counts: sources merge into languages and languages into the corpus. Sketches hold the documents
that pass the base rules. From a sketch come the median m, the percentile p of TAIL and that of FAR (and 100 minus these, for the lower fences).
The inner fence is as far from p as p from m. The outer one is as far from FAR's percentile as this is from m, or, if that
is nearer, OUTER times as far from m as p in logarithms (FAR's percentile may itself be junk). Neither lies nearer than
INNER and OUTER times, in logarithms, what one occurrence more adds to m in a document of the group's median size, so
that a fence is above 0 where nearly no document has the measure. Logarithms are those of odds, x / (maximum - x), for a
measure with a maximum, so fences stay below it. A group's fences are drawn towards those of its language, and a
language's towards the corpus's, as if SHRINK documents of the wider sketch were its own; no threshold is a fixed value.
Documents are joined with their group's fences and dropped if a measure lies beyond an outer fence, or two measures
beyond inner ones.

Bins are exact up to 127 and keep 7 significant bits above, so a sketch has at most a few hundred bins per measure and
a quantile is off by under 1 %. Sketches are sums, so results do not depend on partitions or order.

Defined cases: null text has no words (base_failed); null lang or source is a group of its own; ties and repeated rows
count each; an empty table gives no rows; further columns are kept by `quality_filter` and ignored by `verdicts`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACES, stage

#: Percentiles that the fences start from.
TAIL, FAR = 90, 98
#: Distances of the fences in logarithms: powers of two, so that they are made by squaring.
INNER, OUTER = 2, 4
#: Documents of the next wider sketch that count as a group's own.
SHRINK = 100
#: Measures beyond an inner fence that a document may have.
STRIKES = 1
#: Measures: the maximum of a document that passes the base rules, the size that counts what it is a share of, and what one
#: occurrence adds to size times measure. Shares are per mille, the length of words in hundredths of a character.
MEASURES = {
    "symbol_share": (1000, "word_chars", 1000),
    "upper_share": (1000, "word_chars", 1000),
    "bang_share": (1000, "word_chars", 1000),
    "dup_line_share": (1000, "n_lines", 1000),
    "repeat_share": (200, "n_words", 10_000),  # a window that comes twice has ten words
    "word_length": (None, "n_words", 100),  # by the square root: the error of a mean
}
#: Sizes of documents.
SIZES = ("word_chars", "n_lines", "n_words")
#: The fences of a measure: lower and upper of each pair.
SIDES = ("il", "ih", "ol", "oh")
#: More groups than this are joined by a shuffle; up to this the fences (under 300 bytes a group) are broadcast.
BROADCAST_GROUPS = 50_000


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def measured(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_lines, n_symbols, n_dup_lines, n_repeat_words, base_failed and the measures."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    less = lambda chars: (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("long")

    def repeated(hashes: Column) -> Column:
        """Words in windows that are found twice or more: starts in order, each covers up to the next start or 5."""

        def starts(pairs: Column) -> Column:
            twin = lambda x, i: ((i > 0) & (F.get(pairs, i - 1)["h"] == x["h"])) | F.coalesce(F.get(pairs, i + 1)["h"] == x["h"], F.lit(False))
            return F.array_sort(F.transform(F.filter(pairs, twin), lambda x: x["i"]))

        cover = lambda at: F.aggregate(F.transform(at, lambda p, i: F.least(F.lit(5), F.coalesce(F.get(at, i + 1) - p, F.lit(5)))), F.lit(0), lambda a, x: a + x)
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(let(pairs, starts), cover)).otherwise(F.lit(0))

    def of_words(w: Column) -> Column:
        n = F.size(w)
        windows = F.when(n >= 5, F.transform(F.sequence(F.lit(1), F.greatest(n - 4, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, 5)))).otherwise(F.array().cast("array<bigint>"))
        return F.struct(n.alias("n"), let(windows, repeated).alias("r"))

    out = docs.select(
        "*",
        F.struct(
            let(words, of_words).alias("w"),
            (F.char_length(text) - F.char_length(F.translate(text, SPACES, ""))).cast("long").alias("space"),
            F.char_length(text).cast("long").alias("chars"),
            less("#*$%&|<>").alias("symbols"),
            less("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("upper"),
            less("!").alias("bang"),
            let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("l"),
        ).alias("__m"),
    )
    m = lambda name: F.col(f"__m.{name}")
    chars = m("chars") - m("space")
    share = lambda part, whole: F.when(whole > 0, F.floor(part * 1000 / whole)).otherwise(0).cast("long")
    n, r = m("w.n").cast("long"), m("w.r").cast("long")
    return out.select(
        *docs.columns,
        n.alias("n_words"),
        chars.alias("word_chars"),
        m("symbols").alias("n_symbols"),
        m("l.dup").cast("long").alias("n_dup_lines"),
        r.alias("n_repeat_words"),
        ((n < 10) | (100 * r > 20 * n)).alias("base_failed"),
        share(m("symbols"), chars).alias("symbol_share"),
        share(m("upper"), chars).alias("upper_share"),
        share(m("bang"), chars).alias("bang_share"),
        m("l.n").cast("long").alias("n_lines"),
        share(m("l.dup"), m("l.n")).alias("dup_line_share"),
        share(r, n).alias("repeat_share"),
        F.when(n > 0, F.floor(chars * 100 / n)).otherwise(0).cast("long").alias("word_length"),
    )


def binned(v: Column) -> Column:
    """v with its 7 highest bits kept."""
    drop = F.greatest(F.char_length(F.bin(v)) - 7, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, drop), drop)


def sketches(rows: DataFrame) -> DataFrame:
    """Counts per (lang, source, measure or size, bin) of rows that pass the base rules; lang and source are never null here
    ('' stands for null, '=x' for x)."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), binned(F.col(k)).alias("bin")) for k in (*MEASURES, *SIZES)]))
    return rows.where(~F.col("base_failed")).select(*groups_of(), each.alias("e")).groupBy("lang_", "source_", "e.measure", "e.bin").agg(F.count(F.lit(1)).alias("n"))


def groups_of() -> list[Column]:
    return [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")).alias(f"{c}_") for c in ("lang", "source")]


def _quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Per group and measure or size: documents t, and the percentiles lo, mid, hi, fl, fh: each the lowest bin that reaches its share."""
    merged = sketch.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*by, "measure").orderBy("bin")
    whole = Window.partitionBy(*by, "measure")
    run = merged.withColumn("c", F.sum("n").over(upto)).withColumn("t", F.sum("n").over(whole))
    q = lambda num: F.min(F.when(F.col("c") * 100 >= F.col("t") * num, F.col("bin"))).cast("double")
    at = {"lo": 100 - TAIL, "mid": 50, "hi": TAIL, "fl": 100 - FAR, "fh": FAR}
    return run.groupBy(*by, "measure").agg(F.max("t").alias("t"), *[q(x).alias(name) for name, x in at.items()])


def _power(x: Column, times: int) -> Column:
    return x if times == 1 else _power(x * x, times // 2)


def _fences(sketch: DataFrame, by: list[str], tag: str) -> DataFrame:
    """Per group and measure: documents t<tag> and fences <side><tag>."""
    q, group = _quantiles(sketch, by), Window.partitionBy(*by)  # nine rows a group
    q = q.select("*", *[F.max(F.when(F.col("measure") == k, F.col("mid"))).over(group).alias(k) for k in SIZES])
    of = lambda value: F.coalesce(*[F.when(F.col("measure") == k, value(*x)) for k, x in MEASURES.items()])
    q = q.where(F.col("measure").isin(*MEASURES)).select(
        "*",
        of(lambda top, size, unit: F.lit(top).cast("double")).alias("top"),
        of(lambda top, size, unit: unit / (F.col(size) if top else F.sqrt(size))).alias("one"),  # what one occurrence counts
    )
    lo, mid, hi, fl, fh, top, one, at = (F.col(x) for x in ("lo", "mid", "hi", "fl", "fh", "top", "one", "at"))
    below_top = lambda bounded, free: F.when(top.isNotNull(), bounded).otherwise(free)
    odds = lambda x: below_top((x + one) / (top + one - x), x)
    least = lambda x: odds(F.greatest(x - one, F.lit(0.0))) / odds(mid)
    most = lambda x: odds(F.least(x + one, top)) / odds(mid)  # noqa: E731  (least ignores a missing top)
    q = q.select("*", odds(mid).alias("at"), least(lo).alias("l"), least(mid).alias("l1"), most(hi).alias("h"), most(mid).alias("h1"))

    def fence(ratio: str, times: int) -> Column:
        x = at * _power(F.col(ratio), times)
        return below_top((x * (top + one) - one) / (x + 1), x)

    ends = (
        F.least(2 * lo - mid, fence("l1", INNER), lo),
        F.greatest(2 * hi - mid, fence("h1", INNER), hi),
        F.least(F.greatest(2 * fl - mid, fence("l", OUTER)), fence("l1", OUTER), lo),
        F.greatest(F.least(2 * fh - mid, fence("h", OUTER)), fence("h1", OUTER), hi),
    )
    # a fence at the maximum would drop nothing
    return q.select(*by, "measure", F.col("t").alias(f"t{tag}"), *[F.least(x, top - 1).alias(f"{side}{tag}") for side, x in zip(SIDES, ends, strict=True)])


def fences(sketch: DataFrame) -> DataFrame:
    """One row per (lang_, source_) with columns <measure>_<side>."""
    fine = _fences(sketch, ["lang_", "source_"], "0")
    lang = _fences(sketch, ["lang_"], "1")
    every = _fences(sketch, [], "2")
    q = fine.join(lang, ["lang_", "measure"]).join(every, "measure")
    drawn = lambda own, n, wide: (n * own + SHRINK * wide) / (n + SHRINK)
    q = q.select("lang_", "source_", "measure", *[drawn(F.col(f"{s}0"), F.col("t0"), drawn(F.col(f"{s}1"), F.col("t1"), F.col(f"{s}2"))).alias(s) for s in SIDES])
    return q.groupBy("lang_", "source_").agg(*[F.max(F.when(F.col("measure") == k, F.col(s))).alias(f"{k}_{s}") for k in MEASURES for s in SIDES])


def judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """rows of `measured` with kept; limits: staged fences. A group without fences has no row that passes the base rules."""
    small = limits.count() <= BROADCAST_GROUPS
    beyond = lambda k, lo, hi: (F.col(k) < F.col(f"{k}_{lo}")) | (F.col(k) > F.col(f"{k}_{hi}"))
    strikes, far = F.lit(0), F.lit(False)
    for k in MEASURES:
        strikes, far = strikes + beyond(k, "il", "ih").cast("int"), far | beyond(k, "ol", "oh")
    marked = rows.select("*", *groups_of()).join(F.broadcast(limits) if small else limits, ["lang_", "source_"], "left")
    return marked.withColumn("kept", ~F.col("base_failed") & F.coalesce((strikes <= STRIKES) & ~far, F.lit(False)))


RESULT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def verdicts(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed and kept."""
    rows = stage(measured(docs.select("doc_id", "text", "lang", "source")).drop("text"), "rules-measures")
    return judged(rows, stage(fences(sketches(rows)), "rules-fences")).select(*RESULT)


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns of docs."""
    own = {"doc_id", "text", "lang", "source"}  # further columns may be named like ours
    packed = docs.select(F.struct("*").alias("__row"), *[F.col(c) for c in docs.columns if c in own])
    rows = stage(measured(packed).drop("text"), "rules-measures")  # measured once, for the sketches and for the verdicts
    kept = judged(rows, stage(fences(sketches(rows)), "rules-fences")).where("kept")
    return kept.select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns])
