"""Counting over blocks: tables of blocks ask for the totals of their keys, fragments of the key space answer.

A block is one row that holds some megabytes of tokenized text. A block sends each of its distinct keys (64-bit hashes)
once, with its own count, to the fragment that the key lies in; the fragment adds up and answers for just these keys, in
their order, so that no key travels back. A frequent key is one entry per block, so no key is hot. Blocks lie in a
bucketed table: in every further round only answers are shuffled, to the buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import home, stage
from .common import width
from .words import trimmed

#: Keys per fragment, about; the most fragments, and the most partitions of a shuffle by fragment.
KEYS, FRAGMENTS, PARTITIONS = 1_500_000, 1 << 17, 20_000
#: Bytes of a row group of a table of blocks.
ROW_GROUP = 16 << 20

ASKS = "block long, turn int, frag int, keys binary, counts binary, tags binary"
ANSWERS = "block long, turn int, frag int, totals binary, sums binary"


def packed(a: np.ndarray) -> bytes:
    """Integers by planes of equal bytes, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def steps(a: np.ndarray) -> np.ndarray:
    """First value and differences (modulo 2**64), small where a ascends."""
    return np.diff(a, prepend=a.dtype.type(0))


def rows(found: list[tuple], ddl: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    names, types = zip(*(x.split() for x in ddl.split(", ")), strict=True)
    columns = zip(*found, strict=True) if found else [[]] * len(names)
    return pa.table([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], names=names)


def blocked(df: DataFrame, label: str) -> DataFrame:
    """df (block, …), written to the shared folder in buckets by block, as many as the session's shuffles have partitions."""
    spark = df.sparkSession
    name = f"lexmill_{label}_{uuid.uuid4().hex}"
    path = f"{home(spark)}/{name}"
    df.write.option("parquet.block.size", ROW_GROUP).option("path", path).bucketBy(min(width(spark), 100_000), "block").saveAsTable(name)
    return spark.table(name)


def asked(block: int, turn: int, keys: np.ndarray, counts: np.ndarray, tags: np.ndarray, fragments: int) -> list[tuple]:
    """Rows of ASKS for ascending keys."""
    bounds = np.array([(i << 64) // fragments for i in range(1, fragments)], np.uint64)
    cuts = np.r_[0, np.searchsorted(keys, bounds), len(keys)]
    return [(block, turn, f, packed(steps(keys[a:b])), packed(counts[a:b].astype(np.uint32)), packed(tags[a:b].astype(np.uint8))) for f, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]


def answered(there: pa.Table) -> dict[int, np.ndarray]:
    """turn -> totals of the keys that the block asked for, ascending: twice the total, and 1 where the key is the block's own."""
    out: dict[int, list] = {}
    for turn, _, totals in sorted(zip(*(there.column(c).to_pylist() for c in ("turn", "frag", "totals")), strict=True), key=lambda r: r[:2]):
        out.setdefault(turn, []).append(unpacked(totals, np.uint64))
    return {t: np.concatenate(parts) for t, parts in out.items()}


def fragments_for(keys: int) -> int:
    return max(1, min(FRAGMENTS, keys // KEYS))


def _answers(least: int) -> Callable:
    """Adds up the asks of a fragment. The key belongs to the first block that counted it at least once."""

    def answer(turn: int, frag: int, asks: list[tuple]) -> pa.RecordBatch:
        asks.sort()  # by block
        sizes, parts = [], []
        for _, keys, _, _ in asks:
            parts.append(np.cumsum(unpacked(keys, np.uint64), dtype=np.uint64))
            sizes.append(len(parts[-1]))
        keys, of = np.unique(np.concatenate(parts), return_inverse=True)
        counts = np.concatenate([unpacked(a[2], np.uint32) for a in asks]).astype(np.int64)
        tags = np.concatenate([unpacked(a[3], np.uint8) for a in asks])
        total = np.bincount(of, counts, len(keys)).astype(np.int64)
        own = np.full(len(keys), len(of), np.int64)
        some = np.flatnonzero(counts)[::-1]
        own[of[some]] = some  # the first one is written last
        tag = np.zeros(len(keys), np.uint8)
        tag[of] = tags
        sums = np.zeros((3, 256), np.int64)  # per tag: distinct keys, their total, and those of the total that come once
        there = total > 0
        sums[0] = np.bincount(tag[there], minlength=256)
        sums[1] = np.bincount(tag, total, 256)
        sums[2] = np.bincount(tag[total == 1], minlength=256)
        reply = np.where(total >= least, total, 0)[of].astype(np.uint64) << np.uint64(1)
        mine = own[of] == np.arange(len(of))
        reply[mine & (reply > 0)] += np.uint64(1)
        out, a = [], 0
        for (block, *_), n in zip(asks, sizes, strict=True):
            out.append((block, turn, frag, packed(reply[a : a + n]), packed(sums.ravel()) if a == 0 else None))
            a += n
        return rows(out, ANSWERS).to_batches()[0]

    def run(batches):
        held, asks = None, []
        for batch in batches:
            for block, turn, frag, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (turn, frag) != held:
                    if asks:
                        yield answer(*held, asks)
                    held, asks = (turn, frag), []
                asks.append((block, *rest))
        if asks:
            yield answer(*held, asks)

    return trimmed(run)


def totals(asks: DataFrame, fragments: int, label: str, least: int = 1) -> DataFrame:
    """The staged answers; totals below `least` are answered by 0."""
    dealt = asks.repartition(min(fragments, PARTITIONS), "frag").sortWithinPartitions("frag", "turn")
    return stage(dealt.mapInArrow(_answers(least), ANSWERS), label)


def sums_of(answers: DataFrame) -> np.ndarray:
    """Per tag: distinct keys, their total, and the total of keys that come once, over all fragments (256 rows at most)."""

    def run(batches):
        got = np.zeros(768, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                got += unpacked(raw, np.int64)
        at = np.flatnonzero(got)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(got[at], pa.int64())], names=["at", "n"])

    found = answers.where(F.col("sums").isNotNull()).select("sums").mapInArrow(trimmed(run), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(768, np.int64)
    for r in found:
        out[r["at"]] = r["n"]
    return out.reshape(3, 256)


def each_block(table: DataFrame, answers: list[DataFrame], run: Callable[[pa.Table, dict[int, np.ndarray]], pa.Table], ddl: str) -> DataFrame:
    """run(block, its totals by turn) for every block of the bucketed table; only the answers are shuffled."""
    there = table.sparkSession.createDataFrame([], ANSWERS) if not answers else answers[0]
    for a in answers[1:]:
        there = there.union(a)

    def one(block: pa.Table, answer: pa.Table) -> pa.Table:
        return run(block, answered(answer))

    return table.groupBy("block").cogroup(there.select("block", "turn", "frag", "totals").groupBy("block")).applyInArrow(one, ddl)
