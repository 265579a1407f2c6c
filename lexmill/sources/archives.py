"""Archives of JSON lines: gzip tar files as a table of lines, and as a Python data source."""

from __future__ import annotations

import glob
import io
import os
import re
import tarfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith,
)

LINES = "path string, member string, line_no bigint, value string"


def lines_of(data: io.BufferedIOBase, wanted: Callable[[str], bool] = lambda member: True) -> Iterator[tuple[str, int, str]]:
    """(member, line number from 1, line) of the wanted files in a gzip tar; blank lines are skipped."""
    with tarfile.open(fileobj=data, mode="r|gz") as tar:
        for member in tar:
            if not wanted(member.name):
                continue
            f = tar.extractfile(member)
            if f is None:
                continue
            for n, raw in enumerate(f, 1):
                line = raw.decode("utf-8").rstrip("\r\n")
                if line.strip():
                    yield member.name, n, line


def opened(path: str):
    """A file as a stream: a local or mounted one, or one in a store that Arrow knows by its address."""
    scheme = path.split("://", 1)[0] if "://" in path else path.split(":/", 1)[0] if ":/" in path else ""
    if scheme in ("", "file"):
        return open(re.sub("^file:/+", "/", path), "rb")
    store, inside = pafs.FileSystem.from_uri(path)
    return store.open_input_stream(inside, buffer_size=1 << 20)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["path", "member", "line_no", "value"])


def _batches(name: str, data, size: int, wanted: Callable[[str], bool] = lambda member: True) -> Iterator[pa.RecordBatch]:
    rows = []
    for member, n, line in lines_of(data, wanted):
        rows.append((name, member, n, line))
        if len(rows) >= size:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


def read_tar_jsonl(spark: SparkSession, path: str, batch: int = 100, spread: int | None = None, chosen: DataFrame | None = None, streamed: bool = True) -> DataFrame:
    """Lines of *.tar.gz files under a path; `chosen` (path) are those to read, if not all.

    A file is one task, since gzip can't be split, and is read as a stream: memory is bounded by `batch` lines. `spread`
    deals the lines out again for costly parsing. Not streamed, Spark's own reader opens the files, whole, from any of
    its file systems.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar.gz").option("recursiveFileLookup", "true").load(path)
    if chosen is not None:
        listed = listed.join(F.broadcast(chosen.select("path")), "path", "left_semi")  # a listing: one row per archive
    if streamed:
        paths = listed.select("path")
        paths = paths.repartition(max(1, paths.count()))  # round robin: one file each
        out = paths.mapInArrow(lambda it: (x for b in it for name in b.column(0).to_pylist() for x in _streamed(name, batch)), LINES)
    else:
        whole = listed.select("path", "content")
        out = whole.mapInArrow(lambda it: (x for b in it for k in range(b.num_rows) for x in _batches(b.column(0)[k].as_py(), io.BytesIO(b.column(1)[k].as_py()), batch)), LINES)
    return out.repartition(spread) if spread else out


def _streamed(name: str, size: int, wanted: Callable[[str], bool] = lambda member: True) -> Iterator[pa.RecordBatch]:
    with opened(name) as data:
        yield from _batches(name, data, size, wanted)


def archives_in(path: str) -> list[str]:
    """The *.tar.gz files below a folder (or matching a local pattern), sorted."""
    if "://" in path and not path.startswith("file:"):
        store, inside = pafs.FileSystem.from_uri(path)
        scheme = path.split("://", 1)[0]
        return sorted(f"{scheme}://{f.path}" for f in store.get_file_info(pafs.FileSelector(inside, recursive=True)) if f.path.endswith(".tar.gz"))
    local = re.sub("^file:/+", "/", path)
    return sorted(glob.glob(os.path.join(local, "**", "*.tar.gz"), recursive=True) if os.path.isdir(local) else glob.glob(local))


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class TarJsonLines(DataSource):
    """spark.read.format("tarjsonl").load(path): one input partition per file, read as a stream.

    With option("push", "true"), which needs spark.sql.python.filterPushdown.enabled, conditions on path and member are pushed
    down: archives whose path fails them are never opened, members that fail them are passed over without being decoded. Spark keeps what was pushed
    with the loaded table, so load it anew for each query, as `read_matching` does.
    """

    @classmethod
    def name(cls) -> str:
        return "tarjsonl"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> DataSourceReader:
        return (_PushedReader if self.options.get("push") == "true" else _Reader)(self.options.get("path", ""))


#: How a pushed condition reads a name.
_TESTS: dict[type, Callable[[str, object], bool]] = {
    EqualTo: lambda name, v: name == v,
    In: lambda name, v: name in v,
    StringStartsWith: lambda name, v: name.startswith(v),
    StringEndsWith: lambda name, v: name.endswith(v),
    StringContains: lambda name, v: v in name,
    GreaterThan: lambda name, v: name > v,
    GreaterThanOrEqual: lambda name, v: name >= v,
    LessThan: lambda name, v: name < v,
    LessThanOrEqual: lambda name, v: name <= v,
}


def _holds(condition: Filter, name: str) -> bool:
    return not _holds(condition.child, name) if isinstance(condition, Not) else _TESTS[type(condition)](name, condition.value)


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path
        self.pushed: dict[str, list[Filter]] = {"path": [], "member": []}

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in archives_in(self.path) if all(_holds(f, p) for f in self.pushed["path"])]

    def read(self, partition: _File):
        yield from _streamed(partition.path, 100, lambda member: all(_holds(f, member) for f in self.pushed["member"]))


class _PushedReader(_Reader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes the conditions that it can test on path and member; the others are Spark's."""
        for f in filters:
            inner = f.child if isinstance(f, Not) else f
            column = getattr(inner, "attribute", ("",))
            if isinstance(inner, IsNotNull) and inner is f and column in (("path",), ("member",)):
                continue  # neither is ever null
            if type(inner) in _TESTS and column in (("path",), ("member",)) and isinstance(inner.value, (str, tuple, list)):
                self.pushed[column[0]].append(f)
            else:
                yield f


def read_matching(spark: SparkSession, path: str, condition: Column) -> DataFrame:
    """Lines of the archives under a path that meet the condition, which is pushed down as far as it can be."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TarJsonLines)
    return spark.read.format("tarjsonl").option("push", "true").load(path).where(condition)


#: Bytes of lines in an archive, about.
ARCHIVE_BYTES = 64 << 20


def dealt_by_size(lines: DataFrame, size: int | None = None) -> DataFrame:
    """Lines (value) in partitions of about `size` bytes each. An archive is written and read by one task, so their number must grow with
    the lines."""
    n = lines.agg(F.sum(F.octet_length("value"))).first()[0] or 0
    return lines.repartition(max(1, -(-n // (size or ARCHIVE_BYTES))))


def write_tar_jsonl(lines: DataFrame, path: str, per_member: int = 1000) -> list[str]:
    """Write lines (value) as archives, one for each partition that has any, with so many lines in a member; their names.

    An archive gets its name when it is whole, so a lost task leaves none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)
        task = TaskContext.get()
        name, part = f"{folder}/part-{task.partitionId():05d}.tar.gz", f"{folder}/.{uuid.uuid4().hex}"
        tar = out = None
        members = 0
        for batch in batches:
            values = batch.column(0).to_pylist()
            for a in range(0, len(values), per_member):
                if tar is None:
                    store.create_dir(folder, recursive=True)
                    out = store.open_output_stream(part)
                    tar = tarfile.open(fileobj=out, mode="w|gz")  # noqa: SIM115
                data = "".join(f"{v}\n" for v in values[a : a + per_member]).encode()
                info = tarfile.TarInfo(f"lines-{members:05d}.ndjson")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
                members += 1
        if tar is not None:
            tar.close()
            out.close()
            store.move(part, name)
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["path"])

    return sorted(r["path"] for r in lines.select("value").mapInArrow(run, "path string").collect())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a path, by Hadoop's file systems."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    listed = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    return sorted(s.getPath().getName() for s in listed if s.isDirectory())


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length) of the files below a path; contents are not read."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return rows.select("path", F.col("length").alias("length"))
