"""Languages and scripts of whole texts.

Languages: multinomial naive Bayes over hashed character trigrams. Counts per (language, bucket) are sums, so counts of
parts, days or corpora are merged by adding them; a model is these counts, at most LANGUAGES x BUCKETS numbers, and scoring
is one sparse product per text. Scripts: most characters in the blocks of a script.

A text of fewer than three characters has no trigrams: its language is `und`, its score 0. Null text is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS, LANGUAGES = 4096, 1000

# First and last code points of the blocks (for Latin, of the letters) of each script.
SCRIPT_BLOCKS = {
    "Latn": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x2B8), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA722, 0xA787), (0xFB00, 0xFB06), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)],
    "Grek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrl": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armn": [(0x530, 0x58F), (0xFB13, 0xFB17)],
    "Hebr": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "Arab": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFC)],
    "Syrc": [(0x700, 0x74F)], "Thaa": [(0x780, 0x7BF)], "Nkoo": [(0x7C0, 0x7FF)], "Deva": [(0x900, 0x97F), (0xA8E0, 0xA8FF)], "Beng": [(0x980, 0x9FF)], "Guru": [(0xA00, 0xA7F)],
    "Gujr": [(0xA80, 0xAFF)], "Orya": [(0xB00, 0xB7F)], "Taml": [(0xB80, 0xBFF)], "Telu": [(0xC00, 0xC7F)], "Knda": [(0xC80, 0xCFF)], "Mlym": [(0xD00, 0xD7F)], "Sinh": [(0xD80, 0xDFF)],
    "Thai": [(0xE00, 0xE7F)], "Laoo": [(0xE80, 0xEFF)], "Tibt": [(0xF00, 0xFFF)], "Mymr": [(0x1000, 0x109F), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F)],
    "Geor": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)], "Hang": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)], "Ethi": [(0x1200, 0x139F), (0x2D80, 0x2DDF)],
    "Cher": [(0x13A0, 0x13FF), (0xAB70, 0xABBF)], "Cans": [(0x1400, 0x167F), (0x18B0, 0x18FF)], "Khmr": [(0x1780, 0x17FF), (0x19E0, 0x19FF)], "Bugi": [(0x1A00, 0x1A1F)], "Olck": [(0x1C50, 0x1C7F)],
    "Tfng": [(0x2D30, 0x2D7F)], "Hani": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F)], "Hira": [(0x3041, 0x309F)],
    "Kana": [(0x30A1, 0x30FA), (0x30FC, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)], "Mtei": [(0xAAE0, 0xAAFF), (0xABC0, 0xABFF)], "Goth": [(0x10330, 0x1034F)],
}
_NAMES = [*SCRIPT_BLOCKS]
_RANGES = sorted((a, b, k) for k, s in enumerate(SCRIPT_BLOCKS) for a, b in SCRIPT_BLOCKS[s])
_FIRST, _LAST, _OF = (np.array(c) for c in zip(*_RANGES, strict=True))


def points(text: str | None) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def trigrams(text: str | None) -> np.ndarray:
    """The bucket of every three characters."""
    c = points(text)
    return (c[:-2] * 961 + c[1:-1] * 31 + c[2:]) % BUCKETS


def letters(text: str | None) -> dict[str, int]:
    """Characters per script."""
    c, n = np.unique(points(text), return_counts=True)
    at = np.searchsorted(_FIRST, c, "right") - 1
    inside = (at >= 0) & (c <= _LAST[at])
    counts = np.bincount(_OF[at[inside]], n[inside], len(_NAMES)).astype(int)
    return {_NAMES[k]: int(counts[k]) for k in np.flatnonzero(counts)}


def script_of(counts: dict[str, int]) -> str:
    """The script with the most characters, of equal ones the last name; kana make Japanese of Han and of themselves."""
    if not counts:
        return "Zyyy"
    best = max(counts, key=lambda s: (counts[s], s))
    kana = counts.get("Hira", 0) + counts.get("Kana", 0)
    japanese = kana + counts.get("Hani", 0)
    return "Jpan" if kana and japanese >= counts[best] else best


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) of documents (lang, text): a mergeable profile; rows without a language are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if lang is not None:
                    at = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    at += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "bucket", "n"])

    return merged(docs.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long"))


def merged(*counts: DataFrame) -> DataFrame:
    """Profiles put together."""
    every = counts[0]
    for c in counts[1:]:
        every = every.union(c)
    return every.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Profiles:
    """log P(bucket | language) of all languages, with one added to every count."""

    def __init__(self, counts: DataFrame):
        rows = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("n")).orderBy("lang").limit(LANGUAGES + 1).collect()  # at most BUCKETS numbers each
        if len(rows) > LANGUAGES:
            raise ValueError(f"more than {LANGUAGES} languages")
        self.langs = [r["lang"] for r in rows]
        n = np.ones((len(rows), BUCKETS))
        for k, r in enumerate(rows):
            n[k, [x["bucket"] for x in r["n"]]] += [x["n"] for x in r["n"]]
        self.log = np.log(n) - np.log(n.sum(1, keepdims=True))

    def of(self, text: str | None) -> tuple[str, float, float, int]:
        """(language, posterior with equal priors, mean log likelihood, trigrams)."""
        at, c = np.unique(trigrams(text), return_counts=True)
        if not len(at) or not self.langs:
            return "und", 0.0, 0.0, 0
        s = self.log[:, at] @ c
        best = int(s.argmax())  # of equal ones the first name
        return self.langs[best], float(1 / np.exp(s - s[best]).sum()), float(s[best] / c.sum()), int(c.sum())

    def predict(self, text: str | None) -> tuple[str, str, float]:
        """(language, script, score), as the document filter's predictor."""
        lang, score, _, _ = self.of(text)
        return lang, script_of(letters(text)), score


RESULT = "lang string, score double, mean_log double, n_grams long, script string, n_letters long"


def identified(docs: DataFrame, profiles: Profiles, key: str = "doc_id") -> DataFrame:
    """(key, lang, score, mean_log, n_grams, script, n_letters): n_letters counts the characters of the script."""
    there = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = there.value
        for b in batches:
            rows = []
            for t in b.column(1):
                text = t.as_py()
                counts = letters(text)
                script = script_of(counts)
                n = sum(counts.get(s, 0) for s in ("Hani", "Hira", "Kana")) if script == "Jpan" else counts.get(script, 0)
                rows.append((*p.of(text), script, n))
            types = (pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.string(), pa.int64())
            columns = zip(*rows, strict=True) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names=[key, *(x.split()[0] for x in RESULT.split(", "))])

    return docs.select(key, "text").mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, {RESULT}")
