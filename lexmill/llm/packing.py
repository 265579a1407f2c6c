"""Best-fit packing by bin completion.

Documents become token pieces of at most one sequence. A packing needs only how many pieces there are of each length,
which is a bounded table, so the search runs on counts: branch and bound in which each node takes the largest piece
left, enumerates undominated fillings of the room beside it, of any number of pieces, and applies a filling as often as
the counts allow, or half as often, and so on down to once. The search ends at the bound, when it is complete, or at a limit.
Fillings whose waste, with that so far, can't beat the incumbent are pruned; best-fit decreasing completes each node to
a new incumbent. The bound is the ceiling of all tokens over the capacity. The plan (patterns times multiplicity) is
then laid over the pieces by their rank among those of equal length.

Defined cases: null text is empty and gives one piece with just the closing id; ties and repeated rows are packed as
rows of their own; a text of any length is cut into whole sequences and a rest; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import text_encoder
from .common import local_rows, ranked, stage
from .words import blocks, joined, trimmed

CAPACITY = 2048
#: Nodes that the search may visit, and steps that its fillings may take, before it returns its incumbent.
NODES, STEPS = 400, 3_000_000
RANK_ROWS = 4000

Pattern = tuple[int, ...]  # lengths in a sequence, largest first


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on counts: (pattern, how often). Bins with equal room and contents are kept together."""
    rooms: list[int] = []  # sorted
    open_: dict[int, list[tuple[Pattern, int]]] = {}

    def put(pattern: Pattern, room: int, n: int) -> None:
        if n:
            if room not in open_:
                bisect.insort(rooms, room)
                open_[room] = []
            open_[room].append((pattern, n))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                pattern, n = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                pattern, room, n = (), capacity, left
            fit = room // size  # the tightest bin stays the tightest until it is full for this size
            whole = min(n, left // fit)
            put(pattern + (size,) * fit, room - size * fit, whole)
            left -= whole * fit
            if whole < n:
                rest = left if left < fit else 0
                if rest:
                    put(pattern + (size,) * rest, room - size * rest, 1)
                    left -= rest
                if pattern:
                    put(pattern, room, n - whole - (1 if rest else 0))
    return [x for same in open_.values() for x in same]


def fillings(counts: dict[int, int], room: int, most_waste: int, tick: Callable[[], bool] = lambda: True) -> Iterator[tuple[int, Pattern]]:
    """The fillings of the room of any number of pieces, by increasing waste up to most_waste: (waste, lengths).

    Left out are those to which a piece left over could be added, or in which one could take a smaller one's place: any
    packing with such a filling can be changed to one without it. tick counts the steps; the search ends when it is false.
    """
    sizes = sorted((x for x, n in counts.items() if n and x <= room), reverse=True)
    mask = (1 << (room + 1)) - 1
    reach = [1] * (len(sizes) + 1)  # bit k of reach[i]: pieces of sizes[i:] can add up to k
    for i in range(len(sizes) - 1, -1, -1):
        bits, left, part = reach[i + 1], min(counts[sizes[i]], room // sizes[i]), 1
        while left:
            part = min(part, left)
            bits |= bits << part * sizes[i] & mask
            left, part = left - part, 2 * part
        reach[i] = bits

    def chosen(i: int, todo: int, waste: int, above: int | None) -> Iterator[Pattern]:
        """Pieces of sizes[i:] that add up to todo; above is the smallest larger size of which some are left over."""
        for j in range(i, len(sizes)):
            if not reach[j] >> todo & 1 or not tick():
                return
            x, n = sizes[j], counts[sizes[j]]
            if x <= waste and n * x > todo:
                return  # a piece left over would fit
            if x <= todo and (above is None or above > x + waste):
                for k in range(min(n, todo // x), 0, -1):
                    if reach[j + 1] >> (todo - k * x) & 1 and (k == n or x > waste):
                        for more in chosen(j + 1, todo - k * x, waste, above if k == n else x):
                            yield (x,) * k + more
            if x <= waste:
                return
            above = x
        if not todo:
            yield ()

    for waste in range(min(room, most_waste) + 1):
        if reach[0] >> (room - waste) & 1:
            for filling in chosen(0, room - waste, waste, None):
                yield waste, filling


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES, steps: int = STEPS) -> list[tuple[Pattern, int]]:
    """A packing of pieces, given how many there are of each length, into few sequences: (pattern, how often)."""
    counts = {k: v for k, v in counts.items() if v}
    if not counts:
        return []
    total = sum(k * v for k, v in counts.items())
    bound = -(-total // capacity)
    best = best_fit(counts, capacity)
    best_size = sum(n for _, n in best)
    seen = taken = 0

    def tick() -> bool:
        nonlocal taken
        taken += 1
        return taken <= steps

    def spare(waste: int) -> int:  # waste that a better packing may still have
        return capacity * (best_size - 1) - total - waste

    def nexts(left: dict[int, int], waste: int) -> Iterator[tuple[int, Pattern, int]]:
        top = max(left)
        for w, filling in fillings({**left, top: left[top] - 1}, capacity - top, spare(waste), tick):
            pattern = (top, *filling)
            times = min(left[k] // c for k, c in Counter(pattern).items())
            while times:
                yield w, pattern, times
                times //= 2

    stack = [(counts, [], 0, nexts(counts, 0))] if best_size > bound else []
    while stack and best_size > bound and seen < nodes and taken <= steps:
        left, plan, waste, todo = stack[-1]
        found = next(todo, None)
        if found is None or found[0] > spare(waste):  # the others waste no less
            stack.pop()
            continue
        w, pattern, times = found
        waste += w * times
        if spare(waste) < 0:
            continue
        seen += 1
        need = Counter(pattern)
        after = {k: v for k, v in ((k, v - need[k] * times) for k, v in left.items()) if v}
        plan = [*plan, (pattern, times)]
        # no piece left fits into the sequences of the plan
        done = [*plan, *best_fit(after, capacity)]
        if (s := sum(n for _, n in done)) < best_size:
            best, best_size = done, s
        if after:
            stack.append((after, plan, waste, nexts(after, waste)))
    return best


def laid_out(plan: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, lo, hi, copies, first sequence, offset): the piece of rank r in [lo, hi) among those of its length
    goes to sequence first + (r - lo) // copies, at offset + (r - lo) % copies * length."""
    used: Counter = Counter()
    out, first = [], 0
    for pattern, times in plan:
        at = 0
        for length, copies in sorted(Counter(pattern).items(), reverse=True):
            out.append((length, used[length], used[length] + copies * times, copies, first, at))
            used[length] += copies * times
            at += copies * length
        first += times
    return out


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32) and, if keep_ids, ids binary (little-endian unsigned 32-bit)."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + ([("ids", pa.binary())] if keep_ids else [])

    def run(batches):
        enc, out_schema = text_encoder(path, library=True), pa.schema(fields)
        for batch in joined(batches):
            for a, b in blocks(batch.column(1)):
                offsets, ids = enc.block(batch.column(1).slice(a, b - a))
                ids = np.insert(ids, offsets[1:], 0).astype("<u4")  # id 0 closes a document
                n = np.diff(offsets) + 1
                count = -(-n // capacity)
                of = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(capacity, n[of] - start)
                raw, at = memoryview(ids.tobytes()), 4 * np.r_[0, np.cumsum(length)]
                parts = [raw[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                cols = [batch.column(0).slice(a, b - a).take(pa.array(of)), piece, start, length, [*map(zlib.crc32, parts)]] + ([[*map(bytes, parts)]] if keep_ids else [])
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(cols, fields, strict=True)], schema=out_schema)

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), schema)


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """cut (staged rows of `pieces`) with sequence_id and offset."""
    # at most `capacity` rows, whatever the corpus holds
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = laid_out(pack_counts(counts, capacity))
    # best fit splits at most two classes a length, so the plan is bounded by the lengths, not by the corpus
    plan = local_rows(cut.sparkSession, rows, "length long, lo long, hi long, copies long, first long, at long")
    n = sum(counts.values())
    order = [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    buckets = max(1, n // RANK_ROWS // max(1, len(counts)) + 1, max(counts.values(), default=0) // RANK_ROWS + 1)
    r = ranked(cut, ["length"], order, F.xxhash64("doc_id", "piece"), "r", buckets)
    k = F.col("r") - F.col("lo")
    there = r.join(F.broadcast(plan), "length").where((F.col("r") >= F.col("lo")) & (F.col("r") < F.col("hi")))
    return there.withColumn("sequence_id", F.col("first") + F.floor(k / F.col("copies")).cast("long")).withColumn(
        "offset", F.col("at") + k % F.col("copies") * F.col("length")
    ).select(*cut.columns, "sequence_id", "offset")


def best_fit_pack(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if keep_ids)."""
    return packed(stage(pieces(docs, path, capacity, keep_ids), "pack-pieces"), capacity)
