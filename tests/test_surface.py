"""SQL table functions, sketches, sampling that stops early, bounded calls."""

import glob
import json
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill import cli, sql_surface
from lexmill.operators import parse
from lexmill.plans import calls, graphs, lengths, sketches
from lexmill.streaming import sampling
from tests.conftest import DATA


# SQL ----------------------------------------------------------------------------------------------------------------


def test_table_functions_equal_the_operators(spark):
    sql_surface.register(spark)
    pages = spark.read.parquet(f"{DATA}/sf0.001/pages.parquet")
    pages.createOrReplaceTempView("some_pages")
    lateral = spark.sql("SELECT p.page_id, b.* FROM some_pages p, LATERAL page_blocks(p.html) b").collect()
    whole = spark.sql("SELECT * FROM page_blocks(TABLE(SELECT page_id, html FROM some_pages) PARTITION BY page_id)").collect()
    want = parse.html_blocks(pages).collect()
    assert sorted(map(repr, map(tuple, lateral))) == sorted(map(repr, map(tuple, want))) == sorted(map(repr, map(tuple, whole)))
    lists = spark.sql("SELECT * FROM page_lists(TABLE(some_pages) PARTITION BY page_id)").collect()
    assert sorted(map(repr, map(tuple, lists))) == sorted(map(repr, map(tuple, parse.html_lists(pages).collect())))


def test_table_functions_are_checked_before_they_run(spark):
    sql_surface.register(spark)
    with pytest.raises(Exception, match="no column html"):
        spark.sql("SELECT * FROM page_blocks(TABLE(SELECT 1 AS page_id, 'x' AS body))")
    with pytest.raises(Exception, match="not string"):
        spark.sql("SELECT * FROM page_tables(3)")
    assert spark.sql("SELECT * FROM page_lists(NULL)").collect() == []
    got = spark.sql("SELECT * FROM page_lists(TABLE(SELECT '<ul><li>a</ul>' AS html, 7 AS page_id))").collect()
    assert [tuple(r) for r in got] == [(0, "- a\n", None)]


# Sketches -----------------------------------------------------------------------------------------------------------


def test_sketches_merge_within_their_bound(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet").select("doc_id", "text")
    source, path = str(tmp_path / "in"), str(tmp_path / "sketches")
    docs.where("doc_id % 4 > 0").repartition(5).write.parquet(source)
    assert sketches.refresh(spark, source, path) == 5
    docs.where("doc_id % 4 = 0").repartition(3).write.mode("append").parquet(source)
    assert sketches.refresh(spark, source, path) == 3 and sketches.refresh(spark, source, path) == 0
    table = spark.read.schema(sketches.SCHEMA).parquet(path)
    exact = np.sort(np.array([r[0] for r in lengths.lengths(docs).collect()]))
    for rows in (table, table.orderBy(F.desc("file")), table.repartition(7)):
        s = sketches.stats(rows).first()
        assert (s.n, s.min, s.max, s.total) == (len(exact), exact[0], exact[-1], exact.sum())
        assert abs(s.mean - exact.mean()) < 1e-6 and abs(s["std"] - exact.std()) < 1e-6
        for p in sketches.PROBABILITIES:
            v = s[f"p{p * 100:.0f}"]
            low, high = np.searchsorted(exact, v, "left") / len(exact), np.searchsorted(exact, v, "right") / len(exact)
            assert low - 0.01 <= p <= high + 0.01
    few = table.orderBy("file").limit(3)
    assert sketches.stats(few).first().n == few.agg(F.sum("n")).first()[0]
    assert sketches.stats(table.limit(0)).first().n is None


# Sampling -----------------------------------------------------------------------------------------------------------


def _files(spark, folder, lens, per_file=40):
    for k in range(0, len(lens), per_file):
        rows = [(k + j, "x" * n) for j, n in enumerate(lens[k : k + per_file])]
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)  # files are taken by age


def test_sampling_equals_the_window_and_stops_when_full(spark, tmp_path):
    grid = [500, 1000, 1500]
    r = np.random.default_rng(1)
    lens = [int(grid[r.integers(3)] + r.integers(-120, 121)) for _ in range(400)]
    source = str(tmp_path / "in")
    _files(spark, source, lens)
    docs = spark.read.schema("doc_id long, text string").parquet(source)
    want = {tuple(x) for x in lengths.sample_first(docs, 4).collect()}
    n = sampling.sample_until_full(spark, source, str(tmp_path / "out"), str(tmp_path / "checkpoint"), 4, grid)
    got = spark.read.schema(sampling.ROW).parquet(str(tmp_path / "out")).select("bucket", "rn", "doc_id", "len")
    assert {tuple(x) for x in got.collect()} == want and len(want) == 12
    assert n < 10


def test_sampling_goes_on_after_a_restart(spark, tmp_path):
    source, out, check = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    _files(spark, source, [500, 700, 1000])
    sampling.sample_until_full(spark, source, out, check, 2, [500, 1000, 1500])
    _files(spark, source, [501, 502, 1001, 1499])
    sampling.sample_until_full(spark, source, out, check, 2, [500, 1000, 1500])
    got = {(x.bucket, x.rn, x.len) for x in spark.read.schema(sampling.ROW).parquet(out).collect()}
    assert got == {(500, 1, 500), (500, 2, 501), (1000, 1, 1000), (1000, 2, 1001), (1500, 1, 1499)}


# Calls --------------------------------------------------------------------------------------------------------------


def _service(folder, fail=()):
    """A call that notes in the folder when it starts and ends, and how many are under way."""

    def call(text):
        name = os.path.join(folder, f"on-{text}-{os.getpid()}-{time.time_ns()}")
        open(name, "w").close()
        now = len(glob.glob(os.path.join(folder, "on-*")))
        time.sleep(0.03)
        os.remove(name)
        with open(os.path.join(folder, f"log-{os.getpid()}"), "a") as f:
            f.write(json.dumps([text, now]) + "\n")
        if text in fail and not os.path.exists(os.path.join(folder, f"failed-{text}")):
            open(os.path.join(folder, f"failed-{text}"), "w").close()
            if text == "t13":
                os._exit(1)  # the worker is lost
            raise OSError("busy")
        if text == "never":
            raise ValueError("no")
        return {"said": text.upper()}

    return call


def _log(folder):
    return [json.loads(line) for p in glob.glob(os.path.join(folder, "log-*")) for line in open(p)]


def test_calls_are_bounded_and_tried_again(spark, tmp_path):
    rows = spark.createDataFrame([(k, f"t{k}") for k in range(120)] + [(500, "never"), (501, None)], "doc_id long, text string").repartition(9)
    got = {r.doc_id: r for r in calls.called(rows, _service(str(tmp_path), {"t5", "t7"}), str(tmp_path / "journal"), at_once=6, threads=2, tries=3, pause=0.01).collect()}
    assert len(got) == 122 and json.loads(got[9].answer) == {"said": "T9"} and json.loads(got[501].answer) == {"said": ""}
    assert (got[5].tries, got[7].tries, got[9].tries) == (2, 2, 1) and got[500].error == "ValueError: no" and got[500].tries == 3
    assert 1 < max(n for _, n in _log(str(tmp_path))) <= 6


def test_finished_calls_are_not_made_again(spark, tmp_path):
    rows = spark.createDataFrame([(k, f"t{k}") for k in range(60)], "doc_id long, text string")
    run = lambda: calls.called(rows, _service(str(tmp_path), {"t13"}), str(tmp_path / "journal"), at_once=4, threads=1, pause=0.01).collect()
    try:
        run()  # locally a lost worker fails the job, on a cluster its task is run again
    except Exception:  # noqa: BLE001
        pass
    time.sleep(4)  # workers of cancelled tasks are ended after a while
    before = [t for t, _ in _log(str(tmp_path))]
    assert 0 < len(before) < 61
    got = run()
    assert sorted(json.loads(r.answer)["said"] for r in got) == sorted(f"T{k}" for k in range(60))
    times = {}
    for t, _ in _log(str(tmp_path)):
        times[t] = times.get(t, 0) + 1
    assert sum(n > 1 for n in times.values()) <= 4  # at most one per lane was under way
    total = len(_log(str(tmp_path)))
    run()
    assert len(_log(str(tmp_path))) == total


def test_extraction_by_calls(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, ""), (3, "bad")], "doc_id long, text string")

    def extractor(text):
        if text == "bad":
            raise ValueError("no")
        return [(w, "is", "x") for w in text.split()]

    got = graphs.extracted_once(docs, extractor, str(tmp_path / "journal"), at_once=2, threads=1)
    want = {(1, "a", "is", "x", None), (1, "b", "is", "x", None), (3, None, None, None, "ValueError: no")}
    assert {tuple(r) for r in got.collect()} == want
    assert {(*tuple(r)[:4], r.error and f"ValueError: {r.error}") for r in graphs.extracted(docs, extractor).collect()} == want


def test_filter_by_profiles(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select(F.col("lang").alias("language_code"), "text")
    docs.write.parquet(str(tmp_path / "published"))
    cli.main(["profile", str(tmp_path / "published"), str(tmp_path / "profiles")])
    meta = "named_struct('wikiname', 'enwiki')"
    rows = docs.where("language_code = 'en'").select("text", F.lit("enwiki/1").alias("id"), F.expr(meta).alias("metadata"))
    rows.write.json(str(tmp_path / "docs"))
    (tmp_path / "scripts.csv").write_text("subset,scripts\nen,Latn\n")
    cli.main(["filter", str(tmp_path / "docs"), str(tmp_path / "scripts.csv"), str(tmp_path / "kept"), "--profiles", str(tmp_path / "profiles")])
    kept = spark.read.schema("text string").json(str(tmp_path / "kept")).count()
    assert kept == rows.where("char_length(text) >= 20 and char_length(text) - char_length(replace(text, '\n', '')) >= 2").count() > 0
