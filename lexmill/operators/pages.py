"""Raw page records to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalar import page_key
from ..schemas import RAW_PAGE

KEPT = "kept"
REASONS = ("ns", "redirect", "disamb", "no_html", KEPT)


def records(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON lines as page records. The schema is given: payloads are too large to infer it."""
    return lines.select(F.from_json(column, RAW_PAGE).alias("r")).select("r.*")


def is_redirect(wikitext: Column, html: Column) -> Column:
    mark = "mw:PageProp/redirect"
    by_html = html.contains(f'rel="{mark}"') | html.contains(f"rel='{mark}'")
    return F.coalesce(wikitext.rlike(r"(?Ui)^\s*#redirect\b"), F.lit(False)) | F.coalesce(by_html, F.lit(False))


def is_disambiguation(html: Column, listed: Column) -> Column:
    return F.coalesce(listed, F.lit(False)) | F.coalesce(html.contains("mw:PageProp/disambiguation"), F.lit(False))


def judged(pages: DataFrame, disambiguation_ids: DataFrame | None = None) -> DataFrame:
    """Page records with drop_reason, the first that holds of REASONS. JSON nulls count as missing.

    disambiguation_ids (item) is a lookup; the join is left to Catalyst, which broadcasts it while it is small.
    """
    if disambiguation_ids is not None:
        ids = disambiguation_ids.select(F.col("item").alias("__item"), F.lit(True).alias("__listed")).distinct()
        pages = pages.join(ids, pages["main_entity.identifier"] == ids["__item"], "left").drop("__item")
    else:
        pages = pages.withColumn("__listed", F.lit(False))
    html, wikitext = F.coalesce("article_body.html", F.lit("")), F.coalesce("article_body.wikitext", F.lit(""))
    reason = (
        F.when(~F.col("namespace.identifier").eqNullSafe(0), "ns")
        .when(is_redirect(wikitext, html), "redirect")
        .when(is_disambiguation(html, F.col("__listed")), "disamb")
        .when(html == "", "no_html")
        .otherwise(KEPT)
    )
    return pages.withColumn("drop_reason", reason).drop("__listed")


def documents(judged_pages: DataFrame) -> DataFrame:
    """Kept records as documents: id, text (html), metadata."""
    html = F.coalesce("article_body.html", F.lit(""))
    metadata = F.struct(
        F.col("is_part_of.identifier").alias("wikiname"),
        F.col("identifier").alias("page_id"),
        F.col("name").alias("title"),
        "url",
        "date_modified",
        F.col("in_language.identifier").alias("in_language"),
        F.col("main_entity.identifier").alias("wikidata_id"),
        F.octet_length(html).cast("bigint").alias("bytes_html"),
        F.coalesce("article_body.wikitext", F.lit("")).alias("wikitext"),
        F.col("version.identifier").alias("version"),
    )
    return judged_pages.where(F.col("drop_reason") == KEPT).select(
        page_key(F.col("is_part_of.identifier"), F.col("identifier")).alias("id"), html.alias("text"), metadata.alias("metadata")
    )


def counters(rows: DataFrame, reason: str = "drop_reason", names: tuple[str, ...] = REASONS) -> DataFrame:
    """One row of counts: total and one per reason. Partial sums per task, one final row."""
    return rows.agg(F.count(F.lit(1)).alias("total"), *[F.coalesce(F.sum((F.col(reason) == n).cast("bigint")), F.lit(0)).alias(n) for n in names])


def selected_files(files: DataFrame, ids: list[int] | None) -> DataFrame:
    """Files (path) with their place in name order as task_id; only those asked for. An id out of range fails."""
    by_name = Window.orderBy("path")  # paths of a listing only, one row per archive
    numbered = files.select((F.row_number().over(by_name) - 1).alias("task_id"), "path")
    if ids is None:
        return numbered
    n = files.count()
    if bad := [i for i in ids if not 0 <= i < n]:
        raise ValueError(f"task ids out of range: {bad}")
    return numbered.where(F.col("task_id").isin(ids))
