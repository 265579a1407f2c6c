"""Document fingerprints: the k smallest shingle hashes.

Fingerprints of parts merge into that of the whole (the k smallest of both) and estimate resemblance, containment and
the number of distinct shingles. They are strings of k 48-bit hashes in base64, smallest first; a set of fewer than k
shingles is held whole, so its estimates are exact.

Defined cases: null text is empty and has the empty fingerprint; two empty fingerprints are alike (1), an empty and
another are not (0); equal texts have equal fingerprints; repeated doc_ids are ordered by a digest, null doc_ids come last;
a single row is its own next document; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import width
from .shingles import shingled
from .words import blocks, joined, trimmed

K = 128
#: Documents in a stretch of consecutive ids, about; a stretch is streamed, never held.
STRETCH = 200
#: Stretches of ids at most (and of nulls, and of repeated ids), so that the table of their edges is bounded.
STRETCHES = 20_000
_SCALE = float(1 << 48)


def sketch(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest of sorted 64-bit hashes, as 48-bit numbers."""
    return np.unique((hashes[: 2 * k] >> np.uint64(16)))[:k]


def write(s: np.ndarray) -> str:
    return base64.b64encode(s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def read(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, 2:] = raw
    return out.reshape(-1).view(">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def distinct(s: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(s)) if len(s) < k else (k - 1) / (float(s[k - 1]) / _SCALE)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity: the share of both in the k smallest of the union."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    low = merge(a, b, k)
    return float(np.isin(low, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum()) / len(low)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    j, union = resemblance(a, b, k), distinct(merge(a, b, k), k)
    return min(1.0, j * union / distinct(a, k))


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Rows (doc_id, n_chars, fingerprint, n_distinct)."""

    def run(batches):
        for batch in joined(batches):
            found = [sketch(h, k) for h in shingled(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.fill_null(pc.utf8_length(batch.column(1)), 0).cast(pa.int64()), pa.array([write(s) for s in found], pa.string()), pa.array([distinct(s, k) for s in found], pa.float64())],
                names=["doc_id", "n_chars", "fingerprint", "n_distinct"],
            )

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), "doc_id long, n_chars long, fingerprint string, n_distinct double")


class Stretches:
    """Consecutive stretches of rows in the order (doc_id descending, nulls last; digest), of about equal numbers.

    Cuts are approximate quantiles of the ids. An id that fills several stretches, and the rows without an id, are cut by
    their digests.
    """

    def __init__(self, docs: DataFrame):
        n, known = docs.agg(F.count(F.lit(1)), F.count("doc_id")).first()
        want = max(1, min(STRETCHES, known // STRETCH))
        at = [k / want for k in range(1, want)]
        found = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, at)), max(10_000, 4 * want))).first()[0] if at and known else []
        self.cuts, times = np.unique(np.array(found or [], np.int64), return_counts=True)
        size = np.ones(2 * len(self.cuts) + 1, np.int64)  # ascending: below a cut or equal, the cut alone if repeated
        size[1::2] = np.where(times > 1, times, 0)
        size = np.r_[max(1, min(STRETCHES, (n - known) // STRETCH)), size]  # nulls come before the smallest
        self.first = np.r_[np.cumsum(size[::-1])[::-1][1:], 0]  # descending
        self.size, self.count = size, int(size.sum())

    def of(self, ids: pa.Array, digests: list[str]) -> np.ndarray:
        x = ids.fill_null(0).to_numpy()
        k = np.searchsorted(self.cuts, x)
        region = 1 + 2 * k
        alone = (k < len(self.cuts)) & (self.cuts[np.minimum(k, len(self.cuts) - 1)] == x) & (self.size[np.minimum(region + 1, len(self.size) - 1)] > 1) if len(self.cuts) else np.zeros(len(x), bool)
        region = np.where(ids.is_valid().to_numpy(zero_copy_only=False), region + alone, 0)
        turn = np.array([int(d[:8], 16) for d in digests], np.int64)
        return self.first[region] + (turn * self.size[region] >> 32)


def _order(ids: list[int | None], digests: list[str]) -> list[tuple]:
    return [(i is None, 0 if i is None else -i, d) for i, d in zip(ids, digests, strict=True)]


def _edges(docs: DataFrame, stretches: Stretches) -> dict[tuple, int]:
    """The first row (doc_id, digest) of each stretch -> the stretch before it (the last, for the first one)."""

    def run(batches):
        low: dict[int, tuple] = {}
        for batch in batches:
            ids, digests = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for p, o, i in zip(stretches.of(batch.column(0), digests).tolist(), _order(ids, digests), ids, strict=True):
                if p not in low or o < low[p][0]:
                    low[p] = (o, i)
        rows = [(p, i, o[2]) for p, (o, i) in low.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["part", "doc_id", "digest"])

    firsts = docs.select("doc_id", _digest()).mapInArrow(trimmed(run), "part long, doc_id long, digest string")
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not("doc_id").alias("down"), "digest", "doc_id")
    found = firsts.groupBy("part").agg(F.min(row).alias("r")).select("part", "r.doc_id", "r.digest").collect()  # at most three times STRETCHES rows
    found.sort(key=lambda r: r["part"])
    return {(r["doc_id"], r["digest"]): found[k - 1]["part"] for k, r in enumerate(found)}


def _digest():
    return F.md5(F.coalesce("text", F.lit(""))).alias("digest")


def edited(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of each document, of its edited text and of the next document, in descending doc_id.

    The edited text has its last third (floor of a third of the code points) replaced by the first as many of the next
    document. Rows are dealt into stretches of consecutive ids; each stretch is streamed in order, and its last row
    finds the next document as a second copy of the next stretch's first row. Texts are shuffled once, compressed.
    """
    stretches = Stretches(docs)
    edges = docs.sparkSession.sparkContext.broadcast(_edges(docs, stretches))

    def deal(batches):
        z, sent = zstandard.ZstdCompressor(level=3), set()
        for batch in batches:
            ids, digests = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in blocks(batch.column(2)):
                rows = []
                parts = stretches.of(batch.column(0).slice(a, b - a), digests[a:b]).tolist()
                for p, i, d, t in zip(parts, ids[a:b], digests[a:b], batch.column(2).slice(a, b - a).to_pylist(), strict=True):
                    raw = z.compress((t or "").encode())
                    rows.append((p, 0, i, d, raw))
                    before = edges.value.get((i, d))
                    if before is not None and (i, d) not in sent:
                        sent.add((i, d))
                        rows.append((before, 1, i, d, raw))
                types = (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["part", "second", "doc_id", "digest", "text"])

    rows = docs.select("doc_id", _digest(), "text").mapInArrow(trimmed(deal), "part long, second int, doc_id long, digest string, text binary")
    order = ["part", "second", F.desc_nulls_last("doc_id"), "digest"]
    dealt = rows.repartition(min(stretches.count, max(4 * width(docs.sparkSession), stretches.count // 100)), "part").sortWithinPartitions(*order)

    def paired(held):
        """The results of rows (part, second, key, text), each with the one after it in its part."""
        sketches = [sketch(h, k) for h in shingled(pa.array([r[3] for r in held], pa.string()))]
        found = []
        for j in range(len(held) - 1):
            (part, second, key, text), (part2, _, _, after) = held[j], held[j + 1]
            if part == part2 and not second:
                cut = len(text) // 3
                found.append((key, text, text[: len(text) - cut] + after[:cut], sketches[j], sketches[j + 1]))
        edits = [sketch(h, k) for h in shingled(pa.array([r[2] for r in found], pa.string()))]
        out = [(key, len(text), hashlib.sha256(new.encode()).hexdigest(), write(s), write(e), resemblance(s, e, k), resemblance(s, nxt, k)) for (key, text, new, s, nxt), e in zip(found, edits, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True) if out else [[]] * len(fields), fields, strict=True)], schema=pa.schema(fields))

    def run(batches):
        unzip = zstandard.ZstdDecompressor()
        held, size = [], 0
        for batch in batches:
            for part, second, key, _, z in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if second and held and held[-1][:2] == (part, 1):
                    continue  # sent by several tasks
                held.append((part, second, key, unzip.decompress(z).decode()))
                size += len(held[-1][3])
                if len(held) > 500 or size > 4_000_000:
                    yield paired(held)
                    held = held[-1:]
                    size = len(held[0][3])
        if held:
            yield paired(held)

    fields = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    return dealt.mapInArrow(trimmed(run), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
