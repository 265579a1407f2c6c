"""Operators 11 to 13 against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexmill.llm import fill_middle, language_model, phrases, tally
from lexmill.llm.queries import QUERIES
from lexmill.llm.sql import SQL
from tests.conftest import DATA, oracle, same

SCHEMA = "doc_id long, text string, lang string, source string, n long, score double, block long, turn int, tokens long"


def _rows():
    r = random.Random(11)
    words = ["the", "of", "été", "straße", "İx"] + ["".join(r.choice("abdeghiln") for _ in range(r.randint(2, 5))) for _ in range(60)]
    say = lambda n: " ".join(r.choice(words) + r.choice(["", "", "", ",", ". New York"]) for _ in range(n))
    texts = [None, "", " \n\t ", "one", "The THE the.", "\x1e\x1f0\x1e1 a\x1f", "x <P> y", "<S", "S>a<", "😀 é\r\n" * 9, "one two " * 400, say(4000)]
    texts += [say(r.randint(1, 120)) for _ in range(60)] + ["United States of America, in New York\nNew York"] * 5
    rows = [(k, t, ("en", "fr", None, "und")[k % 4], "a", 1, 0.5, 2, 3, 4) for k, t in enumerate(texts)]
    return [*rows, rows[15], (rows[16][0], "another text under the same id", "en", "a", 1, 0.5, 2, 3, 4), (None, "a text without an id", None, None, 1, 0.5, 2, 3, 4)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(_rows(), SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _key(rows):
    return sorted(rows, key=repr)


# Counting -----------------------------------------------------------------------------------------------------------


def test_packed_integers_come_back():
    import numpy as np

    for a in (np.array([], np.uint64), np.array([0, 1 << 63, 7], np.uint64), np.arange(1000, dtype=np.int32) - 500):
        assert (tally.unpacked(tally.packed(a), a.dtype.type) == a).all()
    a = np.array([5, 9, 1 << 63], np.uint64)
    assert (np.cumsum(tally.steps(a), dtype=np.uint64) == a).all()


@pytest.mark.parametrize("fragments", [1, 3, 50])
def test_totals_equal_sums_and_each_key_has_one_owner(spark, fragments):
    import numpy as np

    r = np.random.default_rng(2)
    sent = {}
    for block in range(5):
        keys = np.unique(r.integers(0, 1 << 63, 40, dtype=np.uint64) % np.uint64(97) * np.uint64(190172619316593315))
        sent[block] = keys, r.integers(0, 3, len(keys)), (keys % np.uint64(4)).astype(np.uint8)
    asks = [row for b, (k, n, t) in sent.items() for row in tally.asked(b, 2, k, n, t, fragments)]
    answers = tally.totals(spark.createDataFrame(asks, tally.ASKS), fragments, "test")
    want, tags = Counter(), {}
    for k, n, t in sent.values():
        for x, y, z in zip(k.tolist(), n.tolist(), t.tolist(), strict=True):
            want[x] += y
            tags[x] = z
    owners = Counter()
    for b, (k, n, _) in sent.items():
        got = tally.answered(answers.where(F.col("block") == b).toArrow())[2]
        assert [int(x) >> 1 for x in got] == [want[x] for x in k.tolist()]
        for x, y, g in zip(k.tolist(), n.tolist(), got.tolist(), strict=True):
            if g & 1:
                owners[x] += 1
                assert y > 0
    assert owners == {x: 1 for x, n in want.items() if n}
    sums = tally.sums_of(answers)
    for t in range(4):
        mine = [n for x, n in want.items() if n and tags[x] == t]
        assert sums[:, t].tolist() == [len(mine), sum(mine), sum(n == 1 for n in mine)]


# 11 -----------------------------------------------------------------------------------------------------------------


def _tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w] + ["</s>"]


def _held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


class _Brute:
    """The model by dictionaries, one token after the other."""

    def __init__(self, rows):
        self.c = [Counter() for _ in range(4)]
        for i, t, *_ in rows:
            if not _held(i):
                s = ["<s>", *_tokens(t)]
                for n in (1, 2, 3):
                    for k in range(len(s) - n + 1):
                        self.c[n][tuple(s[k : k + n])] += 1
        self.words = {g: n for g, n in self.c[1].items() if g != ("<s>",)}
        self.n = sum(self.words.values())
        self.known = (self.n - sum(n == 1 for n in self.words.values())) / (self.n + 1)
        self.weight = {}
        for n in (2, 3):
            all_, again = Counter(), Counter()
            for g, k in self.c[n].items():
                b = self.c[n - 1][g[:-1]].bit_length()
                all_[b] += k
                again[b] += k if k > 1 else 0
            self.weight[n] = {b: again[b] / (all_[b] + 1) for b in all_}

    def p(self, h, w):
        if not h:
            k = self.words.get((w,), 0)
            return self.known * k / self.n if k else 1 - self.known
        low, c = self.p(h[1:], w), self.c[len(h)][h]
        if c < 2:
            return low
        x = self.weight[len(h) + 1].get(c.bit_length(), 0)
        return x * self.c[len(h) + 1][(*h, w)] / c + (1 - x) * low

    def row(self, i, text):
        t = _tokens(text)
        s = ["<s>", *t]
        score = sum(math.log10(self.p(tuple(s[max(0, k - 2) : k]), s[k])) for k in range(1, len(s)))
        base = sum(math.log10((self.words.get((w,), 0) + 0.1) / (self.n + 0.1 * (len(self.words) + 1))) for w in t)
        return i, _held(i), len(t), sum((w,) in self.words for w in t), self.n, round(base, 6), round(score, 6)


def test_lm_scores_equal_brute_force(docs, none, monkeypatch):
    brute = _Brute(_rows())
    want = [brute.row(i, t) for i, t, *_ in _rows()]
    short = lambda df: [(*r[:5], round(r[5], 6), round(r[6], 6)) for r in df.collect()]
    assert _key(short(language_model.scored(docs))) == _key(want)
    monkeypatch.setattr(tally, "KEYS", 300)  # several fragments
    monkeypatch.setattr(language_model, "BLOCK", 3000)
    assert _key(short(language_model.scored(docs.repartition(7)))) == _key(want)
    assert language_model.scored(none).collect() == []


def test_lm_probabilities_sum_to_one():
    brute = _Brute(_rows())
    words = [g[0] for g in brute.words]
    for h in [(), ("<s>",), ("the",), ("new", "york"), ("never", "met"), ("of", "the"), ("one", "two")]:
        assert abs(sum(brute.p(h, w) for w in words) + brute.p(h, "never-seen-before") - 1) < 1e-9


def test_lm_without_training_rows(spark):
    held = [i for i in range(100) if _held(i)][:3]
    got = language_model.scored(spark.createDataFrame([(i, "some words") for i in held], "doc_id long, text string")).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(3, 0, 0, 0.0, 0.0)] * 3


def test_lm_beats_the_base_on_held_out_documents(spark):
    got = QUERIES["op11_lm_scoring"](spark, f"{DATA}/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert got[0] / got[2] > got[1] / got[2] + 1  # log10 per token


# 12 -----------------------------------------------------------------------------------------------------------------


def _middle(i, text):
    text, h = text or "", hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    form = "plain" if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 20 else "psm"
    p, m, s = text[:a], text[a:b], text[b:]
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    plain = form == "plain"
    return i, n, form, None if plain else a, None if plain else b - a, out


def test_fill_in_middle_equals_brute_force(docs, none):
    want = [_middle(i, t) for i, t, *_ in _rows()]
    assert {"plain", "psm", "spm"} == {r[2] for r in want}
    assert _key(tuple(r) for r in fill_middle.transformed(docs).collect()) == _key(want)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    texts = {(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in _rows()}
    got = fill_middle.digests(docs).collect()
    assert _key((r.doc_id, r.output_sha256) for r in got) == _key((r[0], sha(r[5])) for r in want)
    assert {(r.doc_id, r.restored_sha256) for r in got} == texts
    assert fill_middle.digests(none).collect() == []


@pytest.mark.parametrize("unit", ["word", "line"])
def test_fill_in_middle_by_larger_units(docs, unit):
    got = fill_middle.transformed(docs, unit).withColumn("text", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert _key((r.doc_id, r.text) for r in got) == _key((i, t or "") for i, t, *_ in _rows())
    by = {(r.doc_id, r.text): r.n for r in got}
    assert by[11, _rows()[11][1]] == (len(_rows()[11][1].split()) if unit == "word" else 1)


def test_fill_in_middle_runs_in_the_jvm(docs):
    plan = fill_middle.digests(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_fill_in_middle_equals_sql(spark):
    plain = lambda rows: _key(tuple(None if pd.isna(x) else x for x in r) for r in rows)
    got = QUERIES["op12_fill_in_middle"](spark, f"{DATA}/sf0.001")
    want = oracle(SQL["op12_fill_in_middle"])
    assert plain(map(tuple, got.collect())) == plain(want[got.columns].astype(object).itertuples(index=False))


# 13 -----------------------------------------------------------------------------------------------------------------


def _collocations(rows, least, top):
    import re

    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        often = {g: k for g, k in c.items() if k >= least and len(g) > 1}
        rows = []
        for g, a in often.items():
            if any(len(q) > len(g) and b >= a and any(q[i : i + len(g)] == g for i in range(len(q))) for q, b in often.items()):
                continue
            score, _, l, r = min((1000 * a * n[lang] // (c[g[:k]] * c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), l, r))
        out += [(lang, k + 1, p.decode(), -a, l, r, n[lang], -s) for k, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return out


@pytest.mark.parametrize("least,top", [(4, 2000), (10, 7)])
def test_phrases_equal_brute_force(docs, none, monkeypatch, least, top):
    monkeypatch.setattr(phrases, "LEAST", least)
    monkeypatch.setattr(phrases, "TOP", top)
    monkeypatch.setattr(phrases, "BLOCK", 4000)
    monkeypatch.setattr(tally, "KEYS", 200)
    want = _collocations(_rows(), least, top)
    assert len({r[0] for r in want}) == 3 and max(len(r[2].split()) for r in want) == 5
    assert _key(tuple(r) for r in phrases.collocations(docs).collect()) == _key(want)
    assert phrases.collocations(none).collect() == []


def test_phrase_scores_are_exact_beyond_64_bits(spark):
    a, n, l, r = 10**12, 9 * 10**14, 3 * 10**12 + 1, 7 * 10**13 + 3
    found = spark.createDataFrame([("en", "x y", 2, a, n, [l], [r])], "lang string, phrase string, size int, a long, n long, ls array<long>, rs array<long>")
    assert phrases.scored(found).first().score == 1000 * a * n // (l * r)


def test_phrases_equal_sql(spark):
    same(QUERIES["op13_phrase_collocations"](spark, f"{DATA}/sf0.001").toPandas(), oracle(SQL["op13_phrase_collocations"]))
