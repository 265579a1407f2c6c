"""A graph that grows by steps, and plans that read the documents once."""

import random

import pytest
from pyspark.sql import functions as F

from lexmill import queries as own
from lexmill.plans import graphs, standing
from lexmill.staging import stage
from tests.conftest import DATA


def _made(seed=4, n=300):
    r = random.Random(seed)
    name = lambda: "".join(r.choice([c, c.upper(), c + "-"]) for c in f"n{r.randint(0, 40)}")
    rows = [(k // 10, name(), r.choice(["to", "of"]), name()) for k in range(n)]
    links = [(k % 30, f"n{r.randint(0, 40)}", f"N{r.randint(0, 40)}") for k in range(25)]
    return rows, links


def _whole(rows, links):
    key = lambda x: "".join(c for c in x if c.isalnum()).lower()
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for _, a, b in links:
        a, b = find(key(a)), find(key(b))
        up[max(a, b)] = min(a, b)
    low = {}
    for _, s, _, o in rows:
        for x in (s, o):
            k = find(key(x))
            low[k] = min(low.get(k, x), x)
    return {(0, low[find(key(s))], p, low[find(key(o))]) for _, s, p, o in rows}


def _frames(spark, rows, links):
    return spark.createDataFrame(rows, "graph_id long, subject string, predicate string, object string"), spark.createDataFrame(links, "at long, a string, b string")


def test_increments_equal_one_run(spark, tmp_path):
    rows, links = _made()
    r, k = _frames(spark, rows, links)
    graph = standing.Standing(spark, f"file://{tmp_path}/g")
    for a in range(0, 30, 5):
        assert graph.add(r.where(F.col("graph_id").between(a, a + 4)), a, a + 5, k.where(F.col("at").between(a, a + 4)))
    assert not graph.add(r, 0, 5)
    want = _whole(rows, links)
    assert {tuple(x) for x in graph.relations().collect()} == want
    once = standing.Standing(spark, f"file://{tmp_path}/once")
    once.add(r, 0, 30, k)
    assert {tuple(x) for x in once.relations().collect()} == want


def test_a_failed_step_is_written_anew(spark, tmp_path, monkeypatch):
    rows, links = _made(9, 60)
    r, _ = _frames(spark, rows, links)
    graph = standing.Standing(spark, f"file://{tmp_path}/g")
    graph.add(r.where("graph_id < 3"), 0, 3)
    with monkeypatch.context() as m:
        m.setattr(standing.Standing, "_moved", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            graph.add(r, 3, 6)
    assert graph.steps() == ["0_3"]
    graph.add(r.where("graph_id >= 3"), 3, 6)
    assert {tuple(x) for x in graph.relations().collect()} == _whole(rows, [])


def test_old_graphs_are_not_written_again(spark, tmp_path):
    rows, _ = _made(2, 100)
    r, _ = _frames(spark, rows, [])
    graph = standing.Standing(spark, f"file://{tmp_path}/g")
    graph.add(r, 0, 10)
    graph.add(r, 10, 20)  # nothing new
    read = lambda t: spark.read.parquet(f"file://{tmp_path}/g/{t}/10_20").count()
    assert read("relations") == read("names") == read("forest") == 0
    assert standing.Standing(spark, f"file://{tmp_path}/none").relations().collect() == []


def test_relations_scan_the_documents_once(spark, monkeypatch):
    staged = []

    def noting(df, label):
        staged.append(df._jdf.queryExecution().executedPlan().toString().count("documents.parquet"))
        return stage(df, label)

    for module in (own, graphs, standing):
        monkeypatch.setattr(module, "stage", noting)
    for name in ("kg_merged", "kg_cleanup_pct", "kg_relabelled"):
        staged.clear()
        last = own.QUERIES[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert sum(staged) + last.count("documents.parquet") == 1, name
