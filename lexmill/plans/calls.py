"""Calls of an outside service for each row, never more than so many at once over the whole cluster.

Rows are dealt to a fixed number of lanes, one task each, and a lane has a fixed number of threads: lanes x threads is the most
that can be under way (speculative execution would run a lane twice, so it is refused). A call that fails is tried again after
growing pauses. Finished calls are written to the lane's journal, in a folder that all workers share, before the next ones start: an
attempt that follows a lost task, or a later run, reads the journals and makes only the calls that are missing. Spark lets the worker
of a cancelled task go on for some seconds (spark.python.task.killTimeout); a run that is started within these may exceed the
bound and repeat calls.

A lane that would read more than LANE_BYTES of text is gone through in rounds, each a job of its own whose answers are staged: a
round begins when the one before has ended, so the bound holds over all. Keys have a fixed part of their lane (PARTS), rounds are
ranges of parts, and journals are kept by part: a task reads only those of its parts, and they are found again however many
rounds a later run has.
"""

from __future__ import annotations

import json
import os
import random
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import exists, home, stage

#: Text that a task reads, about, and the parts of a lane: so many rounds at most.
LANE_BYTES, PARTS = 128 << 20, 64
#: Seconds before the second try; each further pause is twice as long, and a random part of it is left out.
PAUSE = 0.5


def _tried(call: Callable[[str], object], text: str | None, tries: int, pause: float) -> tuple[str | None, str | None, int]:
    """(answer as JSON, error, tries)."""
    for n in range(1, tries + 1):
        try:
            return json.dumps(call(text or ""), ensure_ascii=False), None, n
        except Exception as e:  # noqa: BLE001  whatever the service raises
            error = f"{type(e).__name__}: {e}"
            if n < tries:
                time.sleep(pause * 2 ** (n - 1) * random.uniform(0.5, 1))
    return None, error, tries


def _journal(folder: str, part: int) -> dict[str, tuple]:
    """Finished calls of a lane's part: those of all attempts that have an answer. Files without a part are of the whole lane."""
    out = {}
    for name in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
        if "-" in name and not name.startswith(f"{part:02d}-"):
            continue
        with open(os.path.join(folder, name), encoding="utf-8") as f:
            for line in f:
                if line.endswith("\n"):  # else its writer was lost
                    key, answer, error, tries = json.loads(line)
                    if error is None:
                        out[key] = (answer, error, tries)
    return out


def called(rows: DataFrame, call: Callable[[str], object], journal: str, key: str = "doc_id", text: str = "text", at_once: int = 100, threads: int = 10, tries: int = 4, pause: float = PAUSE) -> DataFrame:
    """(key, answer, error, tries): answer is the call's result as JSON. At most `at_once` calls are under way at any time.

    Keys must be unique and not null; `journal` is a mounted folder, one for each table and kind of call.
    """
    if rows.sparkSession.conf.get("spark.speculation", "false") == "true":
        raise ValueError("speculative execution would exceed the bound")
    threads = min(threads, at_once)
    lanes = max(1, at_once // threads)
    kind = rows.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        with ThreadPoolExecutor(threads) as pool:
            done: dict[str, tuple] = {}
            last = None
            try:
                for batch in _by_part(batches):
                    at, keys, texts = (batch.column(k).to_pylist() for k in (0, 2, 3))
                    part_no = batch.column(1)[0].as_py()
                    if part_no != last:
                        if out is not None:
                            out.close()
                        last, folder = part_no, os.path.join(journal, f"lane-{at[0]:05d}")
                        done = _journal(folder, part_no)
                        os.makedirs(folder, exist_ok=True)
                        out = open(os.path.join(folder, f"{part_no:02d}-{uuid.uuid4().hex}.jsonl"), "a", encoding="utf-8")  # noqa: SIM115
                    names = [str(k) for k in keys]
                    todo = [i for i, k in enumerate(names) if k not in done]
                    for a in range(0, len(todo), threads):
                        part = todo[a : a + threads]
                        for i, found in zip(part, pool.map(lambda i: _tried(call, texts[i], tries, pause), part), strict=True):
                            done[names[i]] = found
                            out.write(json.dumps([names[i], *found], ensure_ascii=False) + "\n")
                        out.flush()
                        os.fsync(out.fileno())
                    found = [done.pop(k) for k in names]
                    columns = zip(*found, strict=True) if found else [[], [], []]
                    yield pa.RecordBatch.from_arrays([batch.column(2), *[pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32()), strict=True)]], names=[key, "answer", "error", "tries"])
            finally:
                if out is not None:
                    out.close()

    lane = F.pmod(F.xxhash64(F.col(key)), F.lit(lanes)).cast("int")
    part = F.pmod(F.xxhash64(F.lit("part"), F.col(key)), F.lit(PARTS)).cast("int")
    dealt = rows.select(lane.alias("lane"), part.alias("part"), F.col(key), F.col(text))
    once = lambda of: (
        of.repartitionById(lanes, F.col("lane")).sortWithinPartitions("lane", "part", key).mapInArrow(run, f"{key} {kind.simpleString()}, answer string, error string, tries int")
    )
    rounds = min(PARTS, -(-(rows.agg(F.sum(F.octet_length(text))).first()[0] or 0) // (lanes * LANE_BYTES)))
    if rounds <= 1:
        return once(dealt)
    path = f"{home(rows.sparkSession)}/calls-{uuid.uuid4().hex}"
    dealt.withColumn("round", F.floor(F.col("part") * rounds / PARTS).cast("int")).write.partitionBy("round").parquet(path)  # each round reads its own
    found = [stage(once(rows.sparkSession.read.schema(dealt.schema).parquet(p)), "calls-round") for p in (f"{path}/round={n}" for n in range(rounds)) if exists(rows.sparkSession, p)]
    return reduce(DataFrame.union, found)


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut where the part changes."""
    for b in batches:
        at = 0
        while at < b.num_rows:
            part = b.column(1)
            end = at + 1 if part[at] != part[b.num_rows - 1] else b.num_rows
            while end < b.num_rows and part[end] == part[at]:
                end += 1
            yield b.slice(at, end - at)
            at = end
