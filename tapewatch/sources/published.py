"""Micro-batch output that readers see whole or not at all.

Each attempt of a batch writes a folder of its own; the batch is published by the rename of one small
file, its commit, into ``_commits``. The last commit of a batch counts. Folders are never rewritten, so who
reads an older one goes on reading it, and what no commit names is not there for readers.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS, COMPACTED = "_commits", "_compacted"


class _Store:
    """The few operations on shared storage that the commits need."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.spark = spark._jvm, spark
        self.fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        where = self._path(path)
        if not self.fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(where) if not s.getPath().getName().startswith("."))

    def create(self, path: str, text: str) -> bool:
        """Publish ``text`` under a name that must be new; False when somebody was first."""
        folder = path.rsplit("/", 1)[0]
        hidden = self._path(f"{folder}/.{uuid.uuid4().hex}")
        out = self.fs.create(hidden, False)
        out.write(bytearray(text.encode()))
        out.close()
        if not self.fs.exists(self._path(path)) and self.fs.rename(hidden, self._path(path)):
            return True
        self.fs.delete(hidden, False)
        return False

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def age(self, path: str) -> float:
        return time.time() - self.fs.getFileStatus(self._path(path)).getModificationTime() / 1000


@dataclass(frozen=True)
class Commit:
    """Batches ``first`` to ``last`` are the rows of ``folder``, a path below the table."""

    first: int
    last: int
    attempt: int
    folder: str
    schema: str

    @property
    def name(self) -> str:
        return f"{self.first:012d}-{self.last:012d}-{self.attempt:06d}.json"


def _commit(store: _Store, path: str, first: int, last: int, folder: str, schema: str) -> Commit:
    prefix = f"{first:012d}-{last:012d}-"
    while True:
        earlier = [n for n in store.names(f"{path}/{COMMITS}") if n.startswith(prefix)]
        commit = Commit(first, last, len(earlier), folder, schema)
        if store.create(f"{path}/{COMMITS}/{commit.name}", json.dumps(commit.__dict__)):
            return commit


def publish_batch(df: DataFrame, path: str, batch_id: int) -> Commit:
    """Add one micro-batch; a retried batch takes the place of its earlier attempt in one step, without reading anything
    back. Plain readers of ``path`` see ``batch_id`` as a partition column, but also attempts that never were published."""
    folder = f"batch_id={batch_id}/{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    return _commit(_Store(df.sparkSession, path), path, batch_id, batch_id, folder, df.schema.json())


def commits(spark: SparkSession, path: str) -> list[Commit]:
    """What readers are to read: the last attempt of each batch, and compacted folders in place of the batches in them.

    One small row per commit comes to the driver, as file names do; ``compact_published`` keeps them few.
    """
    names = _Store(spark, path).names(f"{path}/{COMMITS}")
    newest: dict[str, str] = {}
    for name in names:  # sorted, so the last attempt wins
        newest[name[:25]] = name
    covered, live = -1, []
    spans = sorted((int(k[:12]), -int(k[13:25]), name) for k, name in newest.items())
    for first, last, name in spans:  # a compacted span starts where it does and reaches furthest
        if -last > covered:
            live.append(name)
            covered = -last
    if not live:
        return []
    texts = spark.read.text([f"{path}/{COMMITS}/{name}" for name in live], wholetext=True).collect()
    return sorted((Commit(**json.loads(r["value"])) for r in texts), key=lambda c: c.first)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all published batches, each with its ``batch_id``; an error when nothing was published yet."""
    live = commits(spark, path)
    if not live:
        raise ValueError(f"no batch was published in {path}")
    schema = T.StructType.fromJson(json.loads(live[-1].schema)).add("batch_id", "long")
    single = [c.folder for c in live if not c.folder.startswith(COMPACTED)]
    merged = [c.folder for c in live if c.folder.startswith(COMPACTED)]
    tables = []
    if single:
        tables.append(spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in single]))
    if merged:
        tables.append(spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in merged]))
    return tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])


def compact_published(spark: SparkSession, path: str, leave: int = 1) -> Commit | None:
    """Merge all published batches but the last ``leave`` into few files, in one commit. The last batch may still be
    retried, so leave it."""
    live = commits(spark, path)
    old = live[:len(live) - leave]
    if len(old) < 2:
        return None
    rows = read_published(spark, path).filter(F.col("batch_id") <= old[-1].last)
    folder = f"{COMPACTED}/{uuid.uuid4().hex}"
    rows.hint("rebalance").write.parquet(f"{path}/{folder}")
    return _commit(_Store(spark, path), path, old[0].first, old[-1].last, folder, old[-1].schema)


def vacuum(spark: SparkSession, path: str, older_than: float = 86_400) -> list[str]:
    """Delete folders that no live commit names and that are older than any reader or writer; returns them."""
    store, live = _Store(spark, path), {c.folder for c in commits(spark, path)}
    found = [f"{b}/{a}" for b in [*[n for n in store.names(path) if n.startswith("batch_id=")], COMPACTED]
             for a in store.names(f"{path}/{b}")]
    gone = [f for f in found if f not in live and store.age(f"{path}/{f}") >= older_than]
    for folder in gone:
        store.delete(f"{path}/{folder}")
    return gone
