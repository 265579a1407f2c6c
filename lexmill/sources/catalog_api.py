"""The snapshot service: login, listing with the projection and filters sent along, and chunk downloads."""

from __future__ import annotations

import json
import os
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, IsNotNull

from ..schemas import SNAPSHOT

FIELDS = ["identifier", "version", "date_modified", "in_language.identifier", "is_part_of.identifier", "namespace.identifier", "size", "chunks"]
BLOCK = 20 * 1024 * 1024
#: post(url, body, headers) -> decoded JSON
Post = Callable[[str, dict, dict], object]


def post_json(url: str, body: dict, headers: dict) -> object:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"} | headers)
    with urllib.request.urlopen(request, timeout=60) as answer:  # noqa: S310
        return json.load(answer)


class LoginError(RuntimeError):
    """No user or password (code 1), or the service refused them (code 2)."""

    def __init__(self, what: str, code: int):
        super().__init__(what)
        self.code = code


def token(path: str, login_url: str, user: str | None, password: str | None, post: Post = post_json, may_login: bool = True) -> str | None:
    """The stored access token; else, if allowed, a new one, which is stored."""
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            if found := json.load(f).get("access_token"):
                return found
    if not may_login:
        return None
    if not user or not password:
        raise LoginError("no user or password", 1)
    try:
        answer = post(login_url, {"username": user, "password": password}, {})
        found = answer["access_token"]
    except (OSError, KeyError, TypeError) as e:
        raise LoginError(f"login failed: {e}", 2) from e
    with open(path, "w", encoding="utf-8") as f:
        json.dump(answer, f)
    return found


def snapshots(spark: SparkSession, url: str, access: str, filters: dict[str, object], fields: list[str] = FIELDS, post: Post = post_json) -> DataFrame:
    """The snapshots that match all filters, with the fields asked for."""
    body = {"fields": fields, "filters": [{"field": k, "value": v} for k, v in filters.items()]}
    rows = post(url, body, {"Authorization": f"Bearer {access}"})
    lines = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    return lines.select(F.from_json("value", SNAPSHOT).alias("s")).select("s.*")


class Snapshots(DataSource):
    """spark.read.format("snapshots").option("url", …).option("token", …).load(): the snapshot service as a table.

    With option("push", "true"), which needs spark.sql.python.filterPushdown.enabled, equalities on its fields are sent to the
    service as filters, so that it lists only what is asked for. `post` may be replaced in a subclass.
    """

    post = staticmethod(post_json)

    @classmethod
    def name(cls) -> str:
        return "snapshots"

    def schema(self) -> str:
        return SNAPSHOT if isinstance(SNAPSHOT, str) else SNAPSHOT.simpleString()

    def reader(self, schema) -> DataSourceReader:
        return (_FilteredService if self.options.get("push") == "true" else _Service)(self.options.get("url", ""), self.options.get("token", ""), type(self).post, schema)


class _Service(DataSourceReader):
    def __init__(self, url: str, access: str, post: Post, schema):
        self.url, self.access, self.post, self.schema = url, access, post, schema
        self.filters: list[dict] = []

    def read(self, partition):
        answer = self.post(self.url, {"fields": FIELDS, "filters": self.filters}, {"Authorization": f"Bearer {self.access}"})
        for r in answer:
            yield _typed(r, self.schema)


class _FilteredService(_Service):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and ".".join(f.attribute) in FIELDS and not isinstance(f.value, (list, dict)):
                self.filters.append({"field": ".".join(f.attribute), "value": f.value})
            elif not isinstance(f, IsNotNull) or not any(x["field"] == ".".join(f.attribute) for x in self.filters):
                yield f


def _typed(value, kind):
    """A decoded JSON value in the shape of a Spark type; what doesn't fit is null."""
    if isinstance(kind, T.StructType):
        return tuple(_typed(value.get(f.name), f.dataType) for f in kind) if isinstance(value, dict) else None
    if isinstance(kind, T.ArrayType):
        return [_typed(v, kind.elementType) for v in value] if isinstance(value, list) else None
    if value is None or isinstance(kind, T.StringType):
        return value if value is None or isinstance(value, str) else json.dumps(value)
    try:
        return float(value) if isinstance(kind, (T.DoubleType, T.FloatType)) else int(value)
    except (TypeError, ValueError):
        return None


def write_snapshots(rows: DataFrame, path: str) -> None:
    """One JSON array: a catalogue of a few hundred rows."""
    with open(path, "w", encoding="utf-8") as f:
        json.dump([json.loads(r["j"]) for r in rows.select(F.to_json(F.struct("*")).alias("j")).collect()], f, indent=2, ensure_ascii=False)


def download(pending: DataFrame, base_url: str, root: str, access: str | None, opener: Callable = urllib.request.urlopen) -> DataFrame:
    """Copy pending chunks (identifier, chunk, path) below a folder that all workers share: rows (path, bytes, error).

    A chunk is written under another name and renamed when it is whole, so a lost task leaves no half files.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for identifier, chunk, path in zip(pdf["identifier"], pdf["chunk"], pdf["path"], strict=True):
                to = os.path.join(root, path)
                try:
                    os.makedirs(os.path.dirname(to), exist_ok=True)
                    request = urllib.request.Request(f"{base_url}/{identifier}/chunks/{chunk}/download", headers={"Authorization": f"Bearer {access}"} if access else {})
                    size, part = 0, f"{to}.{os.getpid()}.part"
                    with opener(request) as source, open(part, "wb") as f:
                        while block := source.read(BLOCK):
                            size += f.write(block)
                    os.replace(part, to)
                    rows.append((path, size, None))
                except OSError as e:
                    rows.append((path, None, str(e)))
            yield pd.DataFrame(rows, columns=["path", "bytes", "error"])

    return pending.select("identifier", "chunk", "path").mapInPandas(run, "path string, bytes bigint, error string")
