"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL-proximal.

Features are hashed n-grams of words (1 and 2) and of word shapes (1 to 3; runs of letters become a or A, digits 0), and
the share of five-word windows met before in the text, as a token. A document's counts become square roots of
frequencies, so its vector has length 1 per family and a score is one sparse dot product. Training reads at most
SAMPLE labelled documents, those with the lowest hashes of their ids; scoring reads every text whole.

Defined cases: null text is empty and scores the bias; labels that are null or have no document are skipped; repeated
rows are learned from once and scored each; without any labels all scores are 0.5; an empty table gives no rows; further columns are ignored
by `scores` and kept by `keep_good`.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import blocks, joined, release, spelled, trimmed

#: Labelled documents that training reads at most.
SAMPLE = 8000
BITS = 18
EPOCHS = 4
#: FTRL-proximal: learning rate, its offset, and the L1 and L2 penalties.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.05
THRESHOLD = 0.7
_MASK = np.uint64((1 << BITS) - 1)
_LETTERS = re.compile(r"[^\W\d_]+")


def shape(word: str) -> str:
    """The word with runs of letters as A (no lower case), Aa or a, runs of digits as 0, and other characters kept."""
    w = _LETTERS.sub(lambda m: "a" if m[0].islower() else ("A" if m[0].isupper() and len(m[0]) > 1 else "B"), word)
    return re.sub(r"\d+", "0", w)


def vectors(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices, values) of the sparse vector of each text."""
    for a, b in blocks(texts):
        offsets, index, words = spelled(texts.slice(a, b - a))
        words = words.to_pylist()
        raw = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))[index]
        form = np.fromiter((xxhash.xxh3_64_intdigest(shape(w), 1) for w in words), np.uint64, len(words))[index]
        for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            yield vector(raw[x:y], form[x:y])


def vector(raw: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """raw, form: hashes of the words of a text and of their shapes."""
    n = len(raw)
    bias = (np.zeros(1, np.int64), np.ones(1))
    if not n:
        return bias
    ix, val = [bias[0]], [bias[1]]

    def family(parts: list[np.ndarray]) -> None:
        h = np.concatenate(parts)
        i, c = np.unique(((h ^ (h >> np.uint64(32))) & _MASK).astype(np.int64), return_counts=True)
        ix.append(i)
        val.append(np.sqrt(c / len(h)))

    with np.errstate(over="ignore"):
        two = raw[:-1] * np.uint64(0x9E3779B97F4A7C15) + raw[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        f2 = form[:-1] * np.uint64(0x9E3779B97F4A7C15) + form[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        f3 = f2[:-1] * np.uint64(0x165667B19E3779F9) + form[2:]
        five = raw[: n - 4].copy() if n > 4 else raw[:0].copy()
        for k in range(1, 5):
            five = five * np.uint64(0x9E3779B97F4A7C15) + raw[k : n - 4 + k][: len(five)]
    family([raw, two])
    family([form, f2, f3])
    again = 1 - len(np.unique(five)) / len(five) if len(five) else 0.0
    tokens = [f"again {math.ceil(again * 10)}", f"size {min(12, n.bit_length())}"]
    ix.append(np.array([xxhash.xxh3_64_intdigest(t, 2) & int(_MASK) for t in tokens]))
    val.append(np.full(len(tokens), 0.5))
    return np.concatenate(ix), np.concatenate(val)


class Ftrl:
    """FTRL-proximal for logistic loss (McMahan et al. 2013)."""

    def __init__(self):
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(self, i=slice(None)) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, i: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(i)
        g = (sigmoid(float(w @ x)) - y) * x
        root = np.sqrt(self.n[i] + g * g)
        np.add.at(self.z, i, g - (root - np.sqrt(self.n[i])) / ALPHA * w)
        np.add.at(self.n, i, g * g)


def sigmoid(v: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, v))))


def fitted(rows: list[tuple[str | None, int]]) -> np.ndarray:
    """Weights from (text, label) rows, in their order, over EPOCHS passes (each in another fixed order)."""
    model = Ftrl()
    found = [(*v, y) for v, (_, y) in zip(vectors(pa.array([t for t, _ in rows], pa.string())), rows, strict=True)]
    for k in range(EPOCHS):
        for j in np.random.default_rng(k).permutation(len(found)):
            model.learn(*found[j])
    return model.weights().astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights from the labelled documents whose crc32(doc_id as text) mod 4 is not 2; labels: doc_id, quality."""
    free = labels.where(F.col("quality").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    free = free.select("doc_id", F.col("quality").cast("int").alias("y"), F.xxhash64("doc_id").alias("turn")).orderBy("turn", "doc_id", "y").limit(sample)
    # equal rows count once, so that no repeated id or text fills the sample's one task
    rows = docs.select("doc_id", F.xxhash64("text").alias("hash")).join(F.broadcast(free), "doc_id").distinct().orderBy("turn", "doc_id", "hash", "y").limit(sample)
    once = docs.select("doc_id", F.xxhash64("text").alias("hash"), "text").join(F.broadcast(rows), ["doc_id", "hash"]).dropDuplicates(["doc_id", "hash", "y"])
    rows = once.select("turn", "doc_id", "text", "y").repartition(1)  # at most `sample` documents

    def run(batches):
        got = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        got.sort(key=lambda r: (r[0], r[1], r[2] or ""))
        yield pa.RecordBatch.from_arrays([pa.array([fitted([(t, y) for _, _, t, y in got]).tobytes()], pa.binary())], names=["w"])

    row = rows.mapInArrow(trimmed(run), "w binary").first()
    return np.frombuffer(row["w"], np.float32) if row else np.zeros(1 << BITS, np.float32)


def scorer(spark, weights: np.ndarray):
    """A function of texts to scores, for use on executors; the weights (1 MB) are broadcast."""
    there = spark.sparkContext.broadcast(weights)

    def score(texts: pa.Array) -> list[float]:
        w = there.value
        return [sigmoid(float(w[i].astype(np.float64) @ x)) for i, x in vectors(texts)]

    return score


def scores(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    score = scorer(docs.sparkSession, weights)

    def run(batches):
        for b in joined(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score(b.column(1)), pa.float64())], names=["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(trimmed(run), "doc_id long, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score THRESHOLD or more, with the columns of docs."""
    score = scorer(docs.sparkSession, train(docs, labels))

    @F.arrow_udf("double")
    def of(text: pa.Array) -> pa.Array:
        found = pa.array(score(text), pa.float64())
        release()
        return found

    return docs.where(of("text") >= THRESHOLD)
