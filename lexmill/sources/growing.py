"""A folder of archives that grows, as a stream: each archive is read once, also over restarts.

The order in which archives were found is kept in a log next to the stream's checkpoint: a numbered file per listing that
found something new. An offset is the number of a log file, so a batch that is planned again after a failure has the same
archives, whatever has been added meanwhile. Log files are written under another name and renamed, and never changed.
"""

from __future__ import annotations

import json
import os
import re
import uuid

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .archives import LINES, _File, _streamed, archives_in


class GrowingArchives(DataSource):
    """spark.readStream.format("growing-tarjsonl").option("log", folder).option("maxFiles", 100).load(path).

    log: a folder that outlives the driver (mounted or local), one for each checkpoint. maxFiles: archives in one log file.
    """

    @classmethod
    def name(cls) -> str:
        return "growing-tarjsonl"

    def schema(self) -> str:
        return LINES

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Growing(self.options.get("path", ""), re.sub("^file:/+", "/", self.options["log"]), int(self.options.get("maxFiles", "100")))


class _Growing(DataSourceStreamReader):
    def __init__(self, path: str, log: str, most: int):
        self.path, self.log, self.most = path, log, most

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in os.listdir(self.log) if re.fullmatch(r"\d+\.json", n)) if os.path.isdir(self.log) else []

    def _files(self, number: int) -> list[str]:
        with open(os.path.join(self.log, f"{number}.json"), encoding="utf-8") as f:
            return json.load(f)

    def initialOffset(self) -> dict:
        return {"log": 0}

    def latestOffset(self) -> dict:
        os.makedirs(self.log, exist_ok=True)
        last = max(self._numbers(), default=0)
        seen = {f for n in range(1, last + 1) for f in self._files(n)}
        new = [f for f in archives_in(self.path) if f not in seen]
        for at in range(0, len(new), self.most):
            last += 1
            part = os.path.join(self.log, f".{uuid.uuid4().hex}")
            with open(part, "w", encoding="utf-8") as f:
                json.dump(new[at : at + self.most], f)
                f.flush()
                os.fsync(f.fileno())
            os.rename(part, os.path.join(self.log, f"{last}.json"))
        return {"log": last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_File(f) for n in range(start["log"] + 1, end["log"] + 1) for f in self._files(n)]

    def read(self, partition: _File):
        yield from _streamed(partition.path, 100)
