"""Fill-in-middle transformation with SQL functions on whole texts.

A delimiter is escaped in the text, a regular expression appends it after every unit, its count is the number of units,
and parts are the text between delimiters of given ranks. Parts are unescaped and put together in one of two orders.
Cuts and orders come from a digest of the doc_id, so they don't depend on partitions or on other rows.

Defined cases: null text is empty; an empty text and one that contains a marker stay plain; a null doc_id counts as an empty
string in the digest; texts may be of any length; repeated rows are formed each; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: The delimiter and the escape character: each is written as the latter and a digit.
MARK, ESCAPE = "\x1f", "\x1e"
#: One character of the escaped text (an escaped one is two), and units made of these.
_ONE = rf"(?:{ESCAPE}.|[^{ESCAPE}])"
UNITS = {
    "char": rf"(?s)({_ONE})",
    "word": r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+)",
    "line": r"([^\n]*\n|[^\n]+)",
}
#: Texts of a hundred that are transformed, and those of them with the suffix first.
RATE, SUFFIX_FIRST = 90, 20


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0")), F.lit(MARK), F.lit(ESCAPE + "1"))


def unescaped(part: Column) -> Column:
    whole = F.translate(part, MARK, "")
    return F.replace(F.replace(whole, F.lit(ESCAPE + "1"), F.lit(MARK)), F.lit(ESCAPE + "0"), F.lit(ESCAPE))


def marked(text: Column, unit: str = "char") -> Column:
    """The escaped text with the delimiter after each unit."""
    return F.regexp_replace(escaped(text), UNITS[unit], "$1" + MARK)


def ranked(marks: Column, low: Column, high: Column) -> Column:
    """The units low + 1 to high of a marked text, still escaped."""
    upto = F.call_function("substring_index", marks, F.lit(MARK), high)
    return F.call_function("substring_index", upto, F.lit(MARK), low - high)


def numbers(doc_id: Column) -> list[Column]:
    """Four 32-bit numbers from the digest of the doc_id."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transformed(docs: DataFrame, unit: str = "char") -> DataFrame:
    """Rows (doc_id, n, form, prefix_chars, middle_chars, output): n counts units, the lengths count code points."""
    text = F.coalesce(F.col("text"), F.lit(""))
    h = numbers(F.col("doc_id"))
    rows = docs.select("doc_id", text.alias("text"), *[x.alias(f"h{k}") for k, x in enumerate(h)])
    rows = rows.withColumn("marks", marked(F.col("text"), unit))
    # the delimiter is one byte
    rows = rows.withColumn("n", (F.octet_length("marks") - F.octet_length(F.translate("marks", MARK, ""))).cast("long"))
    x, y = (F.pmod(F.col(c), F.col("n") + 1) for c in ("h0", "h1"))
    held = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        held = held | F.contains("text", F.lit(m))
    form = F.when((F.col("text") == "") | held | (F.col("h2") % 100 >= RATE), "plain").when(F.col("h3") % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", "marks", "n", form.alias("form"), F.least(x, y).cast("int").alias("low"), F.greatest(x, y).cast("int").alias("high"))
    n = F.col("n").cast("int")
    part = lambda a, b: unescaped(ranked(F.col("marks"), a, b))
    rest = unescaped(F.call_function("substring_index", F.col("marks"), F.lit(MARK), F.col("high") - n - 1))  # the last delimiter ends the last unit
    plain = F.col("form") == "plain"
    cut = rows.select(
        "doc_id", "text", "n", "form",
        F.when(~plain, part(F.lit(0), F.col("low"))).alias("prefix"), F.when(~plain, part(F.col("low"), F.col("high"))).alias("middle"), F.when(~plain, rest).alias("suffix"),
    )
    p, s, m = F.concat(F.lit(PREFIX), "prefix"), F.concat(F.lit(SUFFIX), "suffix"), F.concat(F.lit(MIDDLE), "middle")
    output = F.when(plain, F.col("text")).when(F.col("form") == "spm", F.concat(s, p, m)).otherwise(F.concat(p, s, m))
    return cut.select("doc_id", "n", "form", F.char_length("prefix").cast("long").alias("prefix_chars"), F.char_length("middle").cast("long").alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text again. Parts hold no markers, so the first of each is the one that was put there."""
    before = lambda s, m: F.substring_index(s, m, 1)
    after = lambda s, m: F.substring_index(s, m, -1)
    middle = after(output, MIDDLE)
    psm = F.concat(after(before(output, SUFFIX), PREFIX), middle, after(before(output, MIDDLE), SUFFIX))
    spm = F.concat(after(before(output, MIDDLE), PREFIX), middle, after(before(output, PREFIX), SUFFIX))
    return F.when(form == "plain", output).when(form == "spm", spm).otherwise(psm)


def digests(docs: DataFrame) -> DataFrame:
    """The transformation by characters, with digests of the output and of the text restored from it."""
    out = transformed(docs)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
