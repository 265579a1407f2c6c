"""Command lines: extract, filter, profile, publish, sample, estimate, histogram, cost."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from .functions.scalar import wiki_language
from .operators import filter_docs, pages, parse
from .plans import languages, lengths
from .session import session
from .sources import archives, files


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexmill")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *paths: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        for x in paths:
            c.add_argument(x)
        return c

    c = command("extract", "archives", "out")
    c.add_argument("--task-ids", help="places of archives in name order, with commas")
    c.add_argument("--disambiguation-ids")
    c.add_argument("--reference-words")
    c.add_argument("--seconds", type=float, default=parse.SECONDS)
    c.add_argument("--whole-files", action="store_true", help="let Spark open the archives, each whole in memory")
    c = command("filter", "documents", "script_map", "out")
    c.add_argument("--profiles", help="stored language profiles (see `profile`) to predict by, instead of stop words")
    command("profile", "published", "out")
    c = command("publish", "documents", "out")
    c.add_argument("--max-docs", type=int, default=0)
    c.add_argument("--max-files", type=int, default=0)
    c.add_argument("--by-language", action="store_true")
    c.add_argument("--rows-per-file", type=int)
    c.add_argument("--mb-per-file", type=int, default=500)
    for c in (command("stats", "published"), command("histogram", "published", "out")):
        c.add_argument("--max-items", type=int, default=0, help="read so many articles at most; 0: all")
    c = command("sample", "published", "out")
    c.add_argument("--per-bucket", type=int, default=lengths.PER_BUCKET)
    command("estimate", "results", "out")
    command("cost", "histogram", "estimates")
    return p


def task_ids(text: str | None) -> list[int] | None:
    return [int(x) for x in text.split(",") if x.strip()] if text else None


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    spark = session()
    if a.command == "extract":
        chosen = pages.selected_files(archives.files(spark, a.archives, "*.tar.gz"), task_ids(a.task_ids)) if a.task_ids else None
        lines = archives.read_tar_jsonl(spark, a.archives, chosen=chosen, streamed=not a.whole_files)
        ids = files.read_disambiguation_ids(spark, a.disambiguation_ids) if a.disambiguation_ids else None
        words: dict[str, list[str]] = {}
        if a.reference_words:
            for r in files.read_reference_words(spark, a.reference_words).collect():  # a lookup of some hundred headings
                words.setdefault(f"{r['wiki']}wiki", []).append(r["heading"])
        docs = pages.documents(pages.judged(pages.records(lines), ids))
        done = parse.forwarded(parse.parsed(docs, words, a.seconds))
        meta = F.col("metadata").withField("infoboxes", F.col("infoboxes")).withField("has_math", F.col("has_math"))
        files.write_documents(done.select("text", "id", meta.alias("metadata")), a.out)
    elif a.command == "filter":
        docs = files.read_documents(spark, a.documents)
        wiki = wiki_language(F.concat("metadata.wikiname", F.lit("_namespace_0")))
        rows = docs.select("*", wiki.alias("wiki"), F.coalesce(F.size("metadata.infoboxes"), F.lit(0)).alias("n_infoboxes"))
        predictor = languages.Profiles(spark.read.parquet(a.profiles)).predict if a.profiles else filter_docs.predict
        judged = filter_docs.verdict(filter_docs.with_predictions(rows, predictor), filter_docs.script_map(files.read_script_map(spark, a.script_map)))
        files.write_documents(judged.where("reason = 'kept'"), a.out)
    elif a.command == "profile":
        languages.gram_counts(files.read_published(spark, a.published).select(F.col("language_code").alias("lang"), "text")).write.parquet(a.out)
    elif a.command == "publish":
        docs = filter_docs.published(files.read_documents(spark, a.documents, a.max_files))
        docs = docs.orderBy("id").limit(a.max_docs) if a.max_docs else docs
        files.write_published(docs, a.out, a.by_language, a.rows_per_file, bytes_per_file=a.mb_per_file * 10**6)
    elif a.command == "stats":
        lengths.length_stats(files.capped(files.read_published(spark, a.published), a.max_items)).show(vertical=True)
    elif a.command == "histogram":
        files.to_json_object(lengths.bucket_histogram(files.capped(files.read_published(spark, a.published), a.max_items)), "bucket").write.text(a.out)
    elif a.command == "sample":
        lengths.sample_first(files.read_published(spark, a.published), a.per_bucket, key="id").orderBy("bucket", "rn").write.json(a.out)
    elif a.command == "estimate":
        averages = lengths.token_averages(lengths.flat_results(files.read_sample_results(spark, a.results).where("corrupt is null")))
        files.to_json_object(averages, "bucket").write.text(a.out)
    elif a.command == "cost":
        histogram = files.from_json_object(spark, a.histogram, "bigint")
        estimates = files.from_json_object(spark, a.estimates, "struct<avg_prompt_tokens: double, avg_completion_tokens: double, article_count: bigint>")
        lengths.cost(histogram, estimates, lengths.prices(spark)).show(truncate=False)


if __name__ == "__main__":
    main()
