"""Languages, scripts, title vectors, the index and topics."""

import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill import model_queries  # noqa: F401
from lexmill import queries as own
from lexmill.plans import graphs, languages, topics
from lexmill.staging import clear, home
from tests.conftest import DATA


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    found = own.QUERIES["language_identified"](spark, f"{DATA}/sf0.01").withColumnRenamed("lang", "found").join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where("doc_id % 10 = 0")
    right, n = held.agg(F.avg((F.col("found") == F.col("lang")).cast("int")), F.count(F.lit(1))).first()
    assert n == 100 and right >= 0.97


def test_profiles_merge_in_any_order(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    whole = languages.gram_counts(docs)
    parts = [languages.gram_counts(docs.where(F.col("doc_id") % 3 == k)) for k in (2, 0, 1)]
    assert sorted(whole.collect()) == sorted(languages.merged(*parts).collect())


def test_texts_without_trigrams(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "ab"), (4, "abc"), (5, "12 3")], "doc_id long, text string")
    p = languages.Profiles(spark.createDataFrame([("en", 7, 3), ("de", 9, 1)], "lang string, bucket int, n long"))
    got = {r.doc_id: r for r in languages.identified(rows, p).collect()}
    assert [got[k].lang for k in (1, 2, 3)] == ["und"] * 3 and got[3].script == "Latn" and got[3].n_letters == 2
    assert got[4].n_grams == 1 and got[4].lang == "de" and got[5].script == "Zyyy"
    assert languages.Profiles(spark.createDataFrame([], "lang string, bucket int, n long")).of("some text")[0] == "und"


@pytest.mark.parametrize(
    "text,script",
    [("Пример text", "Cyrl"), ("日本語のテキスト", "Jpan"), ("中文文本", "Hani"), ("한국어", "Hang"), ("ελληνικά", "Grek"), ("עברית", "Hebr"), ("العربية", "Arab"), ("हिन्दी", "Deva"), ("ไทย", "Thai"),
     ("မြန်မာ", "Mymr"), ("ქართული", "Geor"), ("አማርኛ", "Ethi"), ("𐌲𐌿𐍄", "Goth"), ("ⵜⵉⴼⵉⵏⴰⵖ", "Tfng"), ("ᏣᎳᎩ", "Cher"), ("naïve Ünïcode", "Latn"), ("12 %", "Zyyy"), ("", "Zyyy"), (None, "Zyyy")],
)
def test_scripts(text, script):
    assert languages.script_of(languages.letters(text)) == script


def test_blocks_of_scripts_are_apart():
    ranges = sorted(r for s in languages.SCRIPT_BLOCKS.values() for r in s)
    assert all(a <= b for a, b in ranges) and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:], strict=False))


def test_index_has_every_row_and_finds_neighbours(spark):
    v = spark.read.parquet(f"{DATA}/sf0.1/embeddings.parquet")
    index = topics.Index(v)
    assert index.lists.count() == v.count() == index.lists.select("id").distinct().count()
    exact = {(r.query, r.neighbour) for r in graphs.nearest(v).collect()}
    asked = v.where("vec_id % 100 = 0")
    found = {(r.query, r.neighbour) for r in index.nearest(asked, 5).collect()}
    assert len(exact & found) >= 0.9 * len(exact)
    assert "CartesianProduct" not in (plan := index.nearest(asked, 5, 3)._jdf.queryExecution().executedPlan().toString()) and "NestedLoop" not in plan
    every = {(r.query, r.neighbour) for r in index.nearest(asked, 5, len(index.centroids)).collect()}
    assert every == exact


def test_clustered_vectors_need_few_probes_and_hot_lists_are_cut(spark, monkeypatch):
    monkeypatch.setattr(topics, "BLOCK", 16)
    r = np.random.default_rng(0)
    centres = r.normal(size=(20, 16))
    rows = [(i, (centres[0 if i % 3 == 0 else i % 20] + 0.05 * r.normal(size=16)).tolist()) for i in range(600)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = topics.Index(v)
    assert index.probes() <= len(index.centroids) // 4
    got = {(x.query, x.neighbour) for x in index.nearest(v.where("vec_id < 50")).collect()}
    m = np.array([x for _, x in rows])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    s = m @ m.T
    np.fill_diagonal(s, -2)
    want = {(i, int(j)) for i in range(50) for j in np.argsort(-s[i], kind="stable")[:5]}
    assert len(got & want) >= 0.9 * len(want)


def test_topics_against_brute_force(spark):
    r = np.random.default_rng(3)
    rows = [(i, x.tolist()) for i, x in enumerate(r.normal(size=(60, 4)))] + [(100 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(7)] + [(200, None), (201, [0.0] * 4)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {x.vec_id: x.topic for x in topics.topics(v, k=3, similarity=0.6, probes=100).collect()}
    one = dict(rows[:60]) | {100: [1.0, 0.0, 0.0, 0.0]}
    ids = sorted(one)
    m = np.array([one[i] for i in ids], np.float32)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    s = m @ m.T
    np.fill_diagonal(s, -2)
    near = [{j for j in np.argsort(-s[i], kind="stable")[:3] if s[i, j] >= 0.6} for i in range(len(ids))]
    up = list(range(len(ids)))
    for _ in ids:
        up = [min([up[i], *(up[j] for j in near[i] if i in near[j])]) for i in range(len(ids))]
    want = {i: ids[up[k]] for k, i in enumerate(ids)} | {200: 200, 201: 201}
    want |= {100 + i: want[100] for i in range(7)}
    assert got == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topics.topics(none).collect() == [] and topics.Index(none).nearest().collect() == []
    titles = spark.createDataFrame([], "doc_id long, title string")
    assert topics.title_vectors(titles, "doc_id", "title").collect() == []


def test_titles_are_not_taken_apart_into_rows(spark):
    titles = spark.createDataFrame([(1, " aaaa "), (2, ""), (3, None), (4, " \U0001f600\u00e9z "), (5, "ab")], "doc_id long, title string")
    found = topics.title_vectors(titles, "doc_id", "title")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan  # a gram of a long title cost a walk from the title's start, and a row
    want = {}
    for k, t in ((1, " aaaa "), (4, " \U0001f600\u00e9z ")):
        n = np.zeros(topics.DIMS)
        for i in range(len(t) - 2):
            n[int(hashlib.md5(t[i : i + 3].encode()).hexdigest()[:8], 16) % topics.DIMS] += 1
        want[k] = (n / np.sqrt((n * n).sum())).astype(np.float32).tolist()
    assert {r.doc_id: r.embedding for r in found.collect()} == want | {2: None, 3: None, 5: None}


def test_best_of_a_block_against_brute_force():
    r = np.random.default_rng(5)
    for n, k in ((1, 5), (7, 5), (999, 5), (1000, 1)):
        ids, queries = r.permutation(2 * n)[:n], np.arange(0, 2 * n, 2)
        s = r.integers(0, 50, (len(queries), n)) / 50  # many ties
        want = {(i, int(j)) for i, q in enumerate(queries) for j in sorted((j for j in range(n) if ids[j] != q), key=lambda j: (-s[i, j], ids[j]))[:k]}
        i, j, _ = topics._best(s.copy(), queries, ids, k)
        assert len(i) == len(want) and set(zip(i.tolist(), j.tolist(), strict=True)) == want


def test_a_list_is_sent_once_to_a_group_of_queries(spark):
    v = spark.createDataFrame([(i, [float(i % 7), 1.0, float(i % 11)]) for i in range(3000)], "vec_id long, embedding array<float>")
    index = topics.Index(v, lists=2)
    plan = index.nearest(v, 3, 2)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan  # blocks of 512 rows were joined each with each


def _counts(n: int, dims: int = 64):
    m = np.random.default_rng(7).poisson(0.7, (n, dims)).astype(np.float32)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def test_a_query_is_sent_once_to_a_part_as_a_short_code(spark):
    m = _counts(2000, 256)
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "vec_id long, embedding array<float>")
    index = topics.Index(v, lists=64)
    sent = index._sent(topics.coded(v, "vec_id"), 32).collect()  # a copy of its floats went to each of the 32 lists
    assert len(sent) == len({(r.part, r.id) for r in sent}) <= 2000 * index.n_parts and index.n_parts <= topics.PARTS
    assert all(len(set(x)) == len(x) for x in (r.lists for r in sent)) and sum(len(r.lists) for r in sent) == 2000 * 32
    assert np.mean([len(r.code) for r in sent]) < 256 * 4 / 4


def test_codes_keep_each_bit():
    r = np.random.default_rng(1)
    for v in (r.normal(size=300), r.integers(0, 4, 300) / 3, np.zeros(5), np.ones(1), np.arange(256) / 7, np.arange(1000) / 7, np.full(3, 1e-30)):
        v = v.astype(np.float32)
        got, same = topics._vectors(topics.pa.array([topics._code(v), topics._code(v.copy())]))
        assert (got == v / np.maximum(np.linalg.norm(v[None], axis=1), 1e-30)).all() and (got == same).all()


def test_cut_lists_parts_and_blocks_against_brute_force(spark, monkeypatch):
    for name, x in (("BLOCK", 16), ("MOST", 64), ("ASKED", 90), ("ROWS", 7), ("COLUMNS", 11), ("DECODED", 13)):
        monkeypatch.setattr(topics, name, x)
    m = _counts(700)
    v = spark.createDataFrame([(3 * i, x.tolist()) for i, x in enumerate(m)] + [(9001, None), (9002, [0.0] * 64), (9003, [1.0] * 63 + [None])], "vec_id long, embedding array<float>")
    s = (m @ m.T).astype(float)
    np.fill_diagonal(s, -2)
    for lists, least in ((3, -2), (30, 0.6)):
        index = topics.Index(v, lists=lists)
        assert index.lists.count() == 700 and (lists > 3 or index.pieces.max() > 1)
        got = {}
        for r in index.nearest(k=4, probes=lists, least=least).collect():
            got.setdefault(r.query // 3, []).append((r.rn, r.neighbour // 3, r.similarity))
        for i in range(700):
            want = [x for x in np.sort(s[i])[::-1][:4] if round(x, 6) >= least]
            found = sorted(got.get(i, []))
            assert [x for x, _, _ in found] == list(range(1, len(want) + 1))
            assert np.allclose([x for _, _, x in found], want, atol=2e-6) and np.allclose([s[i, j] for _, j, _ in found], want, atol=2e-6)


def test_topic_graphs_keeps_no_neighbours_on_disk(spark):
    clear(spark)
    got = own.QUERIES["topic_graphs"](spark, f"{DATA}/sf0.001")
    left = {x.rsplit("-", 1)[0] for x in os.listdir(home(spark).removeprefix("file://"))}
    assert left and not left & {"index", "index-parts", "topic-neighbours", "topic-links", "kg-links"}
    assert got.count() > 0
