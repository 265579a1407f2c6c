"""A sink of Parquet shards of a given size, with a commit.

Tasks write shards under a hidden folder; a shard is closed when its compressed bytes come near the cap, so all but the last
one of a task lie within a tenth of it. When all tasks are done, the driver moves the shards to their places and writes the
manifest (name, rows, bytes, crc32 of each); when one fails for good, the hidden folder is deleted. Readers that go by the
manifest, or pass over hidden folders as Spark does, never see half a result. A repeated attempt of a task writes other files;
only those whose names were reported are moved.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

MANIFEST = "_manifest.json"
#: Parts of a shard that are written at once, about; they bound what a task holds and how far a shard misses its cap.
PARTS = 25


def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    """A local or mounted folder, or one in a store that Arrow knows by its address."""
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


@dataclass
class _Written(WriterCommitMessage):
    shards: list


class Shards(DataSource):
    """df.write.format("shards").option("bytes", cap).mode("append" or "overwrite").save(path)."""

    @classmethod
    def name(cls) -> str:
        return "shards"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"].rstrip("/"), int(self.options.get("bytes", str(256 << 20))), schema, overwrite)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, cap: int, schema, overwrite: bool):
        self.path, self.cap, self.schema, self.overwrite = path, cap, schema, overwrite
        self.hidden = f"{path}/_shards-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        store, hidden = store_of(self.hidden)
        store.create_dir(hidden, recursive=True)
        schema, task, done = to_arrow_schema(self.schema), TaskContext.get(), []
        short = [f.name for f in schema if pa.types.is_primitive(f.type)]  # statistics of texts would fill the footers
        ratio = 2.0  # bytes in memory for each one written
        out = writer = name = None
        rows = 0

        def close() -> None:
            nonlocal out, writer
            writer.close()
            size = out.tell()
            out.close()
            with store.open_input_stream(f"{hidden}/{name}") as f:
                crc = 0
                while block := f.read(1 << 20):
                    crc = zlib.crc32(block, crc)
            done.append((task.partitionId(), len(done), name, rows, size, crc))
            out = writer = None

        for batch in iterator:
            at = 0
            batch = pa.Table.from_batches([batch]).cast(schema).combine_chunks()
            while at < batch.num_rows:
                if writer is None:
                    name, rows = f"{task.partitionId():05d}-{task.attemptNumber()}-{len(done):05d}-{uuid.uuid4().hex[:8]}.parquet", 0
                    out = store.open_output_stream(f"{hidden}/{name}")
                    writer = pq.ParquetWriter(out, schema, compression="zstd", write_statistics=short)
                step = max(1, int(batch.num_rows * min(1.0, self.cap / PARTS * ratio / max(batch.nbytes, 1))))
                part = batch.slice(at, step)
                before = out.tell()
                writer.write_table(part, row_group_size=max(1, part.num_rows))
                took = max(1, out.tell() - before)
                ratio = 0.5 * ratio + 0.5 * max(0.1, batch.nbytes * part.num_rows / batch.num_rows / took)
                at, rows = at + part.num_rows, rows + part.num_rows
                if out.tell() + took > self.cap:
                    close()
        if writer is not None:
            close()
        return _Written(done)

    def commit(self, messages: list) -> None:
        store, path = store_of(self.path)
        _, hidden = store_of(self.hidden)
        store.create_dir(path, recursive=True)
        there = [] if self.overwrite else manifest(self.path)
        old = {s["name"] for s in manifest(self.path)} if self.overwrite else set()
        found = [s for m in messages if m is not None for s in m.shards]
        run = uuid.uuid4().hex[:8]
        for k, (_, _, name, rows, size, crc) in enumerate(sorted(found), len(there)):
            to = f"shard-{k:06d}-{run}.parquet"
            store.move(f"{hidden}/{name}", f"{path}/{to}")
            there.append({"name": to, "rows": rows, "bytes": size, "crc32": crc})
        with store.open_output_stream(f"{path}/{MANIFEST}.new") as f:
            f.write(json.dumps(there, indent=1).encode())
        store.move(f"{path}/{MANIFEST}.new", f"{path}/{MANIFEST}")
        for name in old:
            store.delete_file(f"{path}/{name}")
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        store, hidden = store_of(self.hidden)
        if store.get_file_info(hidden).type == pafs.FileType.Directory:
            store.delete_dir(hidden)


def manifest(path: str) -> list[dict]:
    """The shards of a folder as its manifest has them."""
    store, at = store_of(path)
    at = f"{at.rstrip('/')}/{MANIFEST}"
    if store.get_file_info(at).type != pafs.FileType.File:
        return []
    with store.open_input_stream(at) as f:
        return json.loads(f.read())


def write_shards(df: DataFrame, path: str, cap: int, mode: str = "append") -> list[dict]:
    """Write df as shards of about `cap` bytes; the manifest."""
    df.sparkSession.dataSource.register(Shards)
    df.write.format("shards").option("bytes", cap).mode(mode).save(path)
    return manifest(path)
