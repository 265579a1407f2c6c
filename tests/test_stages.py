"""Sources, stages, analytics and graphs."""

import io
import json
import random
import tarfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from lexmill import cli
from lexmill import queries as own
from lexmill.functions.scalar import GRID, GRID43, any_date, closest_bucket, rounded_bucket
from lexmill.operators import catalog, filter_docs, pages, parse
from lexmill.plans import graphs, lengths
from lexmill.sources import archives, catalog_api, files
from lexmill.streaming import incremental
from tests.conftest import DATA, oracle, same


@pytest.mark.parametrize("name", sorted(own.SQL))
def test_query_equals_sql(spark, name):
    same(own.QUERIES[name](spark, f"{DATA}/sf0.001").toPandas(), oracle(own.SQL[name]))


@pytest.mark.parametrize("name", sorted(set(own.QUERIES) - set(own.SQL)))
def test_query_runs(spark, name):
    assert own.QUERIES[name](spark, f"{DATA}/sf0.001").count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == len(lengths.PRICES)


def test_buckets(spark):
    """Both functions against their plain definitions, on all lengths."""
    df = spark.range(0, 120_001, 1).select(F.col("id").alias("n"), closest_bucket(F.col("id")).alias("c"), rounded_bucket(F.col("id")).alias("r"))
    rows = df.where("n % 50 < 3 or n % 250 = 0").collect()
    for n, c, r in rows:
        at = min(max(n, 500), 100_000)
        assert c == min(GRID, key=lambda b: (abs(b - at), b))
        assert r == max(500, round(n / 500) * 500 if n <= 15_000 else round(n / 5_000) * 5_000 if n <= 100_000 else 100_000)
    assert len(GRID) == 47 and len(GRID43) == 43


def test_dates(spark):
    rows = [("2025-11-21T10:00:00.123456789Z", None), (None, "20251105"), ("x", "abc"), ("2024-02-30", "20240101")]
    got = [str(r[0]) for r in spark.createDataFrame(rows, "a string, b string").select(F.to_date(any_date(F.col("a"), F.col("b")))).collect()]
    assert got == ["2025-11-21", "2025-11-05", "None", "2024-01-01"]


def _record(i, ns=0, html="<p>text</p>", **more):
    return {"identifier": i, "name": f"N{i}", "url": f"https://en.x.org/{i}", "namespace": {"identifier": ns}, "version": {"identifier": 7},
            "main_entity": {"identifier": f"Q{i}"}, "is_part_of": {"identifier": "enwiki"}, "in_language": {"identifier": "en"}, "article_body": {"html": html, "wikitext": ""}} | more


@pytest.fixture
def archive(tmp_path):
    info = '<table class="infobox"><tr><th>Born</th><td>1900</td></tr></table>'
    text = "<p>the of and in a long enough line</p><p>the second</p><p>third é</p>"
    records = [
        _record(1, html=f"<html><head><title>One</title></head>{info}{text}</html>"), _record(2, ns=1), _record(3, namespace=None),
        _record(4, article_body={"html": "x", "wikitext": " #REDIRECT [[y]]"}), _record(5, html="<link rel='mw:PageProp/redirect'>"), _record(6), _record(7, html="mw:PageProp/disambiguation"),
        _record(8, html=""), _record(9, main_entity=None, article_body=None), _record(10, html="<div class=mw-redirect></div><p>short</p>", is_part_of=None),
    ]
    path = tmp_path / "in" / "a.json.tar.gz"
    path.parent.mkdir()
    with tarfile.open(path, "w:gz") as tar:
        for k, part in enumerate((records[:5], records[5:])):
            data = "\n".join(json.dumps(r) for r in part).encode() + b"\n\n"
            member = tarfile.TarInfo(f"part{k}.json")
            member.size = len(data)
            tar.addfile(member, io.BytesIO(data))
        folder = tarfile.TarInfo("folder")
        folder.type = tarfile.DIRTYPE
        tar.addfile(folder)
    return path.parent


def test_extract_filter_publish(spark, archive, tmp_path):
    lines = archives.read_tar_jsonl(spark, str(archive), spread=2)
    assert lines.count() == 10
    spark.dataSource.register(archives.TarJsonLines)
    assert spark.read.format("tarjsonl").load(str(archive)).count() == 10
    ids = spark.createDataFrame([("Q6",)], "item string")
    judged = pages.judged(pages.records(lines), ids)
    assert {r["identifier"]: r["drop_reason"] for r in judged.collect()} == {1: "kept", 2: "ns", 3: "ns", 4: "redirect", 5: "redirect", 6: "disamb", 7: "disamb", 8: "no_html", 9: "no_html", 10: "kept"}
    assert pages.counters(judged).first().asDict() == {"total": 10, "ns": 2, "redirect": 2, "disamb": 2, "no_html": 2, "kept": 2}
    docs = pages.documents(judged)
    assert {r["id"] for r in docs.collect()} == {"enwiki/1", "None/10"}
    read = {r["id"]: r for r in parse.parsed(docs).collect()}
    assert read["enwiki/1"]["text"].startswith("# One\n") and read["enwiki/1"]["infoboxes"][0]["data"][0]["values"] == ["1900"]
    assert {r["outcome"] for r in parse.parsed(docs, seconds=-1e9).collect()} <= {"timeout", "extracted"}

    words = tmp_path / "words.json"
    words.write_text('{"en": ["Notes"]}')
    idfile = tmp_path / "ids.json"
    idfile.write_text('[{"item": "http://x/entity/Q6"}]')
    cli.main(["extract", str(archive), str(tmp_path / "docs"), "--disambiguation-ids", str(idfile), "--reference-words", str(words), "--task-ids", "0"])
    back = files.read_documents(spark, str(tmp_path / "docs"))
    assert back.count() == 2 and back.where("id = 'enwiki/1'").first()["metadata"]["infoboxes"][0]["data"][0]["key"] == "Born"
    scripts = tmp_path / "scripts.csv"
    scripts.write_text("subset,scripts\nen,Latn\ncr,\n")
    cli.main(["filter", str(tmp_path / "docs"), str(scripts), str(tmp_path / "kept")])
    assert [r["id"] for r in files.read_documents(spark, str(tmp_path / "kept")).collect()] == ["enwiki/1"]
    cli.main(["publish", str(tmp_path / "kept"), str(tmp_path / "pub"), "--by-language", "--rows-per-file", "10", "--max-docs", "5"])
    pub = files.read_published(spark, str(tmp_path / "pub"))
    assert pub.columns and pub.count() == 1 and json.loads(pub.first()["infoboxes"])[0]["title"] == "Born"
    cli.main(["stats", str(tmp_path / "pub")])
    cli.main(["histogram", str(tmp_path / "pub"), str(tmp_path / "hist")])
    assert files.from_json_object(spark, str(tmp_path / "hist"), "bigint").where("n > 0").collect() == [(500, 1)]
    cli.main(["sample", str(tmp_path / "pub"), str(tmp_path / "sample")])


def test_task_ids(spark):
    f = spark.createDataFrame([("b",), ("a",), ("c",)], "path string")
    assert [r["path"] for r in pages.selected_files(f, [0, 2]).orderBy("task_id").collect()] == ["a", "c"]
    assert pages.selected_files(f, None).count() == 3
    with pytest.raises(ValueError, match="out of range"):
        pages.selected_files(f, [3])
    assert cli.task_ids("21,27") == [21, 27] and cli.task_ids(None) is None


def test_lookups(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text("subset,scripts\nzh,Hans/Hant\nsr,Cyrl/Latn\ncr,\n")
    assert {r["subset"]: r["scripts"] for r in filter_docs.script_map(files.read_script_map(spark, str(p))).collect()} == {"zh": ["Hani", "Hani"], "sr": ["Cyrl", "Latn"]}
    assert filter_docs.predict("Это русский текст")[1] == "Cyrl" and filter_docs.predict("the cat of the house")[0] == "eng" and filter_docs.predict(None) == ("und", "Zyyy", 0.0)


def test_predictions_read_the_whole_text():
    head = "der die das und " * 2500  # 10 000 words, 40 000 characters
    assert filter_docs.predict(head + "the cat of the house and it is here " * 9000)[:2] == ("eng", "Latn")
    assert filter_docs.predict("x " * 5000 + "Это русский текст " * 3000)[1] == "Cyrl"
    lang, script, score = filter_docs.predict("the " * 2000 + "der " * 6000)
    assert (lang, script, score) == ("deu", "Latn", 0.75)


def test_predictions_agree_with_languages(spark):
    d = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").where("n_chars > 400")
    names = {"en": "eng", "fr": "fra", "de": "deu", "es": "spa"}
    rows = filter_docs.with_predictions(d.select("doc_id", "text", F.col("lang").alias("true"))).collect()
    assert sum(names[r["true"]] == r["lang"] for r in rows) > 0.9 * len(rows)


def test_catalog(spark, tmp_path):
    calls = []

    def post(url, body, headers):
        calls.append((url, body, headers))
        return {"access_token": "t"} if url == "login" else [{"identifier": "en_0", "version": {"a": 1}, "chunks": ["c_0", "c_1"], "date_modified": "2025-11-21T00:00:00Z", "other": 1}]

    store = str(tmp_path / "token.json")
    with pytest.raises(catalog_api.LoginError) as e:
        catalog_api.token(store, "login", None, None, post)
    assert e.value.code == 1
    assert catalog_api.token(store, "login", None, None, post, may_login=False) is None
    assert catalog_api.token(store, "login", "u", "p", post) == catalog_api.token(store, "login", None, None, post) == "t"
    with pytest.raises(catalog_api.LoginError) as e:
        catalog_api.token(str(tmp_path / "no.json"), "login", "u", "p", lambda *a: {})
    assert e.value.code == 2
    snaps = catalog_api.snapshots(spark, "list", "t", {"namespace.identifier": 0}, post=post)
    assert calls[-1][1]["filters"] == [{"field": "namespace.identifier", "value": 0}]
    catalog_api.write_snapshots(snaps, str(tmp_path / "s.json"))
    assert json.loads((tmp_path / "s.json").read_text())[0]["identifier"] == "en_0"
    paths = catalog.chunk_paths(catalog.latest_snapshots(snaps))
    assert sorted(r["path"] for r in paths.collect()) == ["en_0/en_0_c_0.json.tar.gz", "en_0/en_0_c_1.json.tar.gz"]
    got = catalog_api.download(paths, "http://x", str(tmp_path / "dl"), "t", opener=lambda r: io.BytesIO(b"data")).collect()
    assert all(r["bytes"] == 4 and r["error"] is None for r in got)
    there = spark.createDataFrame([("en_0/en_0_c_0.json.tar.gz",)], "path string")
    assert catalog.pending(paths, there).count() == 1
    undated = snaps.withColumn("date_modified", F.lit("never")).withColumn("version", F.lit("hash"))
    assert catalog.latest_snapshots(undated.union(undated)).count() == 2
    assert archives.folders(spark, str(tmp_path)) == ["dl"]


def test_results_and_costs(spark, tmp_path):
    d = tmp_path / "results"
    d.mkdir()

    def result(n, length, bucket, p, c):
        r = {"article_id": n, "article_length": length, "extraction": {"tokens": {"prompt_tokens": p, "completion_tokens": c, "total_tokens": p + c}}}
        (d / f"{n}.json").write_text(json.dumps(r | ({"bucket": bucket} if bucket is not None else {}), indent=1))

    result("a", 750, None, 10, 20)
    result("b", 1000, 1000, 11, 21)
    result("c", 0, 500, 1, 1)
    result("d", 800, 0, 0, 0)
    result("e", 17_500, 0, 5, 0)
    (d / "bad.json").write_text('{"article_id": "x", ')
    raw = files.read_sample_results(spark, str(d))
    assert len([r for r in raw.collect() if r["corrupt"]]) == 1
    got = {r["bucket"]: tuple(r)[1:] for r in lengths.token_averages(lengths.flat_results(raw.where("corrupt is null"))).collect()}
    assert got == {1000: (10.5, 20.5, 2), 20_000: (5.0, 0.0, 1)}
    cli.main(["estimate", str(d), str(tmp_path / "est")])
    histogram = spark.createDataFrame([(1000, 10), (20_000, 3), (500, 99)], "bucket int, n bigint")
    files.to_json_object(histogram, "bucket").write.text(str(tmp_path / "hist"))
    assert (tmp_path / "hist").exists()
    est = files.from_json_object(spark, str(tmp_path / "est"), "struct<avg_prompt_tokens: double, avg_completion_tokens: double, article_count: bigint>")
    row = lengths.cost(histogram, est, lengths.prices(spark)).where("model = 'gpt-5-nano-medium'").first()
    assert (row["articles"], row["input_tokens"], row["output_tokens"]) == (13, 120.0, 205.0)
    cli.main(["cost", str(tmp_path / "hist"), str(tmp_path / "est")])
    by_model = est.drop("article_count").withColumn("model", F.lit("gpt-5"))
    assert lengths.cost(histogram, by_model, lengths.prices(spark)).count() == 1
    assert lengths.priced_models(lengths.prices(spark), by_model).count() == 1


def test_append_missing(spark, tmp_path):
    path, schema = str(tmp_path / "out"), "id string, n int"
    rows = spark.createDataFrame([("a",), ("b",)], "id string")
    compute = lambda todo: todo.withColumn("n", F.lit(1))
    assert files.append_missing(rows, path, "id", compute, schema) == 2
    (tmp_path / "out" / "bad.json").write_text("{")
    assert files.append_missing(rows.union(spark.createDataFrame([("c",)], "id string")), path, "id", compute, schema) == 1
    assert files.cached(spark, str(tmp_path / "c"), lambda: rows).count() == files.cached(spark, str(tmp_path / "c"), lambda: 1 / 0).count() == 2
    assert files.drop_cached(spark, str(tmp_path / "c"))


def test_failing_records_are_rows(spark, monkeypatch):
    from lexmill.operators import parse

    deep = "<ul><li>" * 3000 + "x"
    rows = spark.createDataFrame([(1, "<ul><li>a</ul>"), (2, deep), (3, None)], "page_id long, html string")
    got = {r["page_id"]: r for r in parse.html_lists(rows).collect()}
    assert (got[1]["text"], got[1]["error"]) == ("- a\n", None) and got[2]["error"].startswith("RecursionError") and 3 not in got
    late = parse._each(rows.limit(1), "page_id", "html", lambda h, page: [("x",)] if not page.deadline else (_ for _ in ()).throw(parse.OutOfTime), "text string", 1.0)
    assert [tuple(r) for r in late.collect()] == [(1, None, "timeout")]


def test_long_chains_of_names(spark):
    links = spark.createDataFrame([(1, f"n{k:03}", f"n{k + 1:03}") for k in range(70)] + [(2, "b", "a"), (2, "c", "b")], "graph_id long, a string, b string")
    got = {(r["graph_id"], r["name"]): r["label"] for r in graphs.smallest_of_components(links).collect()}
    assert got == {(1, f"n{k:03}"): "n000" for k in range(71)} | {(2, x): "a" for x in "abc"}


def test_first_files_and_caps(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"f{k}.json").write_text(f'{{"id": "{k}", "text": "t{k}"}}\n')
    assert {r["id"] for r in files.read_documents(spark, str(tmp_path), 2).collect()} == {"0", "1"}
    assert files.read_documents(spark, str(tmp_path)).count() == 3 and files.capped(spark.range(9), 4).count() == 4 and files.capped(spark.range(9)).count() == 9


def test_archives_as_streams(spark, archive):
    one, two = archives.read_tar_jsonl(spark, str(archive)), archives.read_tar_jsonl(spark, str(archive), streamed=False)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) != []


def test_nearest_by_shuffle(spark, monkeypatch):
    v = spark.createDataFrame([(k, [float((k * 7919) % 13 - 6), float((k * 104729) % 17 - 8), 1.0]) for k in range(1200)], "vec_id long, embedding array<float>")
    want = sorted(map(tuple, graphs.nearest(v, 3, 100, 64).collect()))
    monkeypatch.setattr(graphs, "BROADCAST_QUERIES", 0)
    assert sorted(map(tuple, graphs.nearest(v, 3, 100, 64).collect())) == want and len(want) == 36


def test_streams(spark, tmp_path):
    source, sink, check = str(tmp_path / "s"), str(tmp_path / "k"), str(tmp_path / "c")
    put = lambda *rows: spark.createDataFrame([(r,) for r in rows], "text string").coalesce(1).write.mode("append").parquet(source)
    step = lambda df: df.where(F.char_length("text") > 1)
    put("a", "bb")
    incremental.stage(spark, source, "text string", step, sink, check).awaitTermination()
    put("cc", "dd")
    incremental.stage(spark, source, "text string", step, sink, check).awaitTermination()
    assert sorted(r["text"] for r in spark.read.parquet(sink).collect()) == ["bb", "cc", "dd"]
    incremental.bucket_counts(spark, source, str(tmp_path / "c2"), "counts").awaitTermination()
    assert spark.table("counts").collect() == [(500, 4)]


def test_graphs(spark, tmp_path):
    rel = spark.createDataFrame([(1, "Paris", "in", "France"), (1, "paris", "in", "France."), (1, "Parisian region", "in", "France"), (1, "Parisian regions", "of", "x"), (2, "a", "b", "a")], "graph_id long, subject string, predicate string, object string")
    exact = graphs.exact_clusters(graphs.entities(rel))
    assert {r["member"]: r["representative"] for r in exact.where("graph_id = 1").collect()} == {"Paris": "Paris", "paris": "Paris", "France": "France", "France.": "France", "Parisian region": "Parisian region", "Parisian regions": "Parisian regions", "x": "x"}
    near = {r["member"]: r["representative"] for r in graphs.near_clusters(graphs.entities(rel)).where("graph_id = 1").collect()}
    assert near["Parisian regions"] == near["Parisian region"] == "Parisian region" and near["paris"] == "Paris" and len(near) == 7
    assert graphs.relabelled(rel, exact).where("graph_id = 1").count() == 3
    row = graphs.cleanup(rel, exact).where("graph_id = 1").first()
    assert (row["entities_before"], row["entities_after"], row["relations_before"], row["relations_after"], row["clusters"]) == (7, 5, 4, 3, 2)
    assert graphs.as_lists(rel).where("graph_id = 2").first()["entities"] == ["a"]
    assert graphs.aggregated(rel, F.lit(0)).count() == 5

    path = str(tmp_path / "groups")
    want = graphs.merged(rel, 2).collect()
    assert graphs.merged(rel, 2, path).collect() and sorted(graphs.merged(rel, 2, path).collect()) == sorted(want)

    def extractor(text):
        if text == "bad":
            raise RuntimeError("no")
        return [("s", "p", text)]

    docs = spark.createDataFrame([(1, "x"), (2, "bad")], "doc_id long, text string")
    got = {(r["graph_id"], r["object"], r["error"]) for r in graphs.extracted(docs, extractor).collect()}
    assert got == {(1, "x", None), (2, None, "no")}


def test_near_clusters_against_brute_force(spark):
    r = random.Random(4)
    rows = set()
    for g in range(3):
        for _ in range(60):
            name = "".join(r.choices("abcd", k=r.randint(1, 40)))
            at = [r.randrange(len(name) + 1) for _ in range(3)]
            rows |= {(g, x) for x in (name, "common prefix " + name, *[name[:k] + r.choice("abcd") + name[k:] for k in at])}
    names = spark.createDataFrame(sorted(rows), "graph_id long, entity string")
    got = {(x["graph_id"], x["member"]): x["representative"] for x in graphs.near_clusters(names).collect()}
    keys = {(g, m): m.replace(" ", "") for g, m in rows}
    grams = {k: {k[i : i + 3] for i in range(max(1, len(k) - 2))} for k in keys.values()}
    for g in range(3):
        names_of: dict[str, list[str]] = {}
        for (at, m), k in keys.items():
            if at == g:
                names_of.setdefault(k, []).append(m)
        todo = set(names_of)
        while todo:  # a component at a time
            found = [todo.pop()]
            for k in found:
                near = {x for x in todo if 5 * len(grams[k] & grams[x]) >= 4 * len(grams[k] | grams[x])}
                found += near
                todo -= near
            members = [m for k in found for m in names_of[k]]
            assert {got[g, m] for m in members} == {min(members)}
    assert sum(m != rep for (_, m), rep in got.items()) > 100
