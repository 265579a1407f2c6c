"""Sources and sinks of our own: pushed filters, growing folders, shards with a commit."""

import io
import json
import os
import tarfile
import zlib

import pytest
from pyspark.sql import functions as F

from lexmill.sources import archives, catalog_api, growing, shards


def _archive(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with tarfile.open(path, "w:gz") as tar:
        for name, lines in members.items():
            data = "\n".join(lines).encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))


def test_pushed_filters_open_no_other_archive(spark, tmp_path, monkeypatch):
    for k in range(4):
        _archive(tmp_path / f"wiki{k}" / f"c{k}.tar.gz", {"a.ndjson": [f"{k}-a1", f"{k}-a2"], "b.ndjson": [f"{k}-b1"]})
    (tmp_path / "wiki3" / "c3.tar.gz").write_bytes(b"not an archive")  # would fail if it were opened
    path, member = F.col("path"), F.col("member")
    try:
        some = archives.read_matching(spark, str(tmp_path), path.contains("/wiki1/") & (member == "a.ndjson"))
        assert sorted(r.value for r in some.collect()) == ["1-a1", "1-a2"]
        assert "Filter" not in some._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0]
        few = archives.read_matching(spark, str(tmp_path), ~path.endswith("c3.tar.gz") & member.isin("b.ndjson", "x") & (F.col("line_no") == 1))
        assert sorted(r.value for r in few.collect()) == ["0-b1", "1-b1", "2-b1"]
        with pytest.raises(Exception, match="(?i)gzip|read"):
            archives.read_matching(spark, str(tmp_path), member == "a.ndjson").count()
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_reader_takes_only_what_it_can_test(tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan, IsNotNull, Not, StringStartsWith

    for name in ("a", "b", "c"):
        _archive(tmp_path / f"{name}.tar.gz", {"m": ["x"]})
    r = archives._PushedReader(str(tmp_path))
    left = [*r.pushFilters([EqualTo(("line_no",), 3), IsNotNull(("path",)), Not(StringStartsWith(("path",), f"{tmp_path}/a")), GreaterThan(("path",), f"{tmp_path}/b.z")])]
    assert left == [EqualTo(("line_no",), 3)]
    assert [os.path.basename(p.path) for p in r.partitions()] == ["c.tar.gz"]


def test_snapshot_filters_are_sent(spark, tmp_path):
    asked = tmp_path / "asked.json"
    rows = [{"identifier": f"wiki{k}", "version": "v", "date_modified": "2025-11-21T00:00:00Z", "in_language": {"identifier": lang}, "chunks": ["c0"]} for k, lang in enumerate(("en", "fr", "en"))]

    class Here(catalog_api.Snapshots):
        @staticmethod
        def post(url, body, headers):
            asked.write_text(json.dumps([url, body, headers]))
            want = {f["field"]: f["value"] for f in body["filters"]}
            return [r for r in rows if all((r["in_language"]["identifier"] if f == "in_language.identifier" else r[f]) == v for f, v in want.items())]

    spark.dataSource.register(Here)
    assert spark.read.format("snapshots").option("url", "http://there").load().where("identifier = 'wiki1'").count() == 1
    assert json.loads(asked.read_text())[1]["filters"] == []
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        t = spark.read.format("snapshots").option("url", "http://there").option("token", "t").option("push", "true").load()
        assert t.count() == 3
        assert [r.identifier for r in t.where("version = 'v' and identifier = 'wiki2'").collect()] == ["wiki2"]
        url, body, headers = json.loads(asked.read_text())
        assert url == "http://there" and headers == {"Authorization": "Bearer t"}
        assert sorted((f["field"], f["value"]) for f in body["filters"]) == [("identifier", "wiki2"), ("version", "v")]
        assert t.where("in_language.identifier = 'en'").count() == 2
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_growing_archives_are_read_once_across_a_failure(spark, tmp_path):
    spark.dataSource.register(growing.GrowingArchives)
    source, sink, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")

    def run(fail=False):
        lines = spark.readStream.format("growing-tarjsonl").option("log", log).option("maxFiles", 1).load(str(source))
        if fail:
            lines = lines.withColumn("value", F.when(F.col("value") == "l4-1", F.raise_error(F.lit("stop"))).otherwise(F.col("value")))
        q = lines.writeStream.format("parquet").option("path", sink).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        q.awaitTermination()

    for k in (2, 1):
        _archive(source / f"a{k}.tar.gz", {"m": [f"l{k}-{j}" for j in range(3)]})
    run()
    for k in (0, 4, 3):  # also one that sorts before those that were read
        _archive(source / f"a{k}.tar.gz", {"m": [f"l{k}-{j}" for j in range(3)]})
    with pytest.raises(Exception, match="stop"):
        run(fail=True)
    _archive(source / "a5.tar.gz", {"m": ["l5-0"]})  # comes between the failure and the restart
    run()
    run()
    got = sorted(r.value for r in spark.read.parquet(sink).collect())
    assert got == sorted([f"l{k}-{j}" for k in range(5) for j in range(3)] + ["l5-0"])


def test_growing_offsets_keep_their_files(tmp_path):
    _archive(tmp_path / "in" / "b.tar.gz", {"m": ["x"]})
    r = growing._Growing(str(tmp_path / "in"), str(tmp_path / "log"), 2)
    one = r.latestOffset()
    for k in range(3):
        _archive(tmp_path / "in" / f"a{k}.tar.gz", {"m": ["x"]})
    again = growing._Growing(str(tmp_path / "in"), str(tmp_path / "log"), 2)
    names = lambda a, b: [os.path.basename(p.path) for p in again.partitions(a, b)]
    assert names(r.initialOffset(), one) == ["b.tar.gz"]
    two = again.latestOffset()
    assert two == {"log": 3} == again.latestOffset() and names(one, two) == ["a0.tar.gz", "a1.tar.gz", "a2.tar.gz"] and names(r.initialOffset(), one) == ["b.tar.gz"]


def _texts(spark, n=4000):
    return spark.range(0, n, 1, 3).select("id", F.concat_ws(" ", *[F.sha2(F.concat(F.lit(k), F.col("id")), 256) for k in range(8)]).alias("text"))


def test_shards_are_near_their_cap_and_listed(spark, tmp_path):
    cap = 200_000
    found = shards.write_shards(_texts(spark), str(tmp_path / "t"), cap)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(back.collect()) == sorted(_texts(spark).collect())
    assert sum(s["rows"] for s in found) == 4000 and len(found) > 5
    full = [s["bytes"] for s in found if s["bytes"] >= 0.9 * cap]
    assert all(s["bytes"] <= 1.1 * cap for s in found) and len(full) >= len(found) - 3  # the last one of each task is smaller
    for s in found:
        data = (tmp_path / "t" / s["name"]).read_bytes()
        assert len(data) == s["bytes"] and zlib.crc32(data) == s["crc32"]
    more = shards.write_shards(_texts(spark, 10), str(tmp_path / "t"), cap)
    assert more[: len(found)] == found and spark.read.parquet(str(tmp_path / "t")).count() == 4010
    shards.write_shards(_texts(spark, 7), str(tmp_path / "t"), cap, "overwrite")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 7 == sum(s["rows"] for s in shards.manifest(str(tmp_path / "t")))


def test_a_failing_task_leaves_no_visible_file(spark, tmp_path):
    found = shards.write_shards(_texts(spark, 50), str(tmp_path / "t"), 10_000)
    before = sorted(os.listdir(tmp_path / "t"))
    bad = _texts(spark).withColumn("text", F.when(F.col("id") == 3999, F.raise_error(F.lit("stop"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="stop"):
        shards.write_shards(bad, str(tmp_path / "t"), 10_000)
    assert sorted(os.listdir(tmp_path / "t")) == before and shards.manifest(str(tmp_path / "t")) == found
    assert shards.write_shards(_texts(spark, 0), str(tmp_path / "none"), 10_000) == []
