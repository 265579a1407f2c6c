"""The pipeline's stages on the smallest tables."""

import corpus_pipeline
from lexmill.llm import ngram_join
from tests.conftest import DATA


def test_stages(spark):
    sf = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    clean = set(labels[(labels.quality == 1) & (labels.toxic == 0)].doc_id)
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"] for r in docs.select("doc_id").collect()} & clean
        docs = f(spark, docs, sf)
        docs = ngram_join.stage(docs, f"test-{name}")
        if k < 4:
            assert docs.columns == columns
            counts.append(docs.count())
            if k < 2:
                assert len({r["doc_id"] for r in docs.select("doc_id").collect()} & before) >= 0.9 * len(before), name
    assert counts[0] > counts[1] >= counts[2] > counts[3] == counts[4]
    packed = docs.toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 2048
    assert set(packed.doc_id) <= set(range(counts[0]))


def test_odd_documents(spark, tmp_path):
    """Null, empty and long texts, repeated rows, an empty table, and further columns with names of the operators' own."""
    r = __import__("random").Random(2)
    say = lambda n: " ".join("".join(r.choice("abdeghilmnorstu") for _ in range(r.randint(2, 8))) for _ in range(n))
    same, passage = say(90), say(60)
    texts = [None, "", " ", "short", same, same, same + " end", say(30) + " " + passage, passage + " " + say(30), say(9000), say(50), "* " * 40]
    rows = [(k, t, "en", None if k % 3 else "s", len(t or ""), 1, "x", 2, 3) for k, t in enumerate(texts)] + [(10, texts[10], "en", None, 9, 1, "x", 2, 3), (None, say(60), None, None, 9, 1, "x", 2, 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n long, key string, hash long, kept int"
    labels = [(k, 0 if k in (3, 11) else 1, 0) for k in range(len(texts))]
    for name, some in (("all", rows), ("none", [])):
        spark.createDataFrame(some, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/all/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        docs = ngram_join.stage(f(spark, docs, f"{tmp_path}/all"), f"odd-{name}")
        assert k == 4 or docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] == sizes[4]
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


def test_near_copies_and_repeats_in_turn(spark):
    """The two stages on copies, against brute force: one of each group stays, and what still repeats goes."""
    from tests.llm.test_operators import _components, _repeats, _rows

    rows = [r[:5] for r in _rows() if r[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    one = stages["ngram_jaccard_join"](spark, docs, "")
    kept = sorted((r["doc_id"], r["text"]) for r in one.collect() if r["text"])
    found = _components(rows)
    groups = {root for _, n, _, root in found if n}
    assert one.count() == sum(not n for _, n, *_ in found) + len(groups)
    cut = stages["suffix_array_dedup"](spark, spark.createDataFrame(kept, "doc_id long, text string"), "")
    want = sorted((k, w[4].decode("utf-8", "ignore")) for (k, _), w in zip(kept, _repeats([t for _, t in kept], 200), strict=True))
    assert sorted((r["doc_id"], r["text"]) for r in cut.collect()) == want
