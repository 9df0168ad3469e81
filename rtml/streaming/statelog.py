"""Versioned state of micro-batch operators as a log of runs with an atomic manifest.

Every batch writes one run, a Parquet folder. A manifest names the runs that count; it is written
aside and renamed, so a reader sees the old log or the new one. Runs older than the last ``keep``
batches are merged ``fanout`` at a time, level by level, so a log of n batches has about
fanout * log(n) folders and a row is rewritten log(n) times. Folders leave the disk one manifest
after they left the log.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass
class Manifest:
    seq: int = 0
    runs: list[list] = field(default_factory=list)  # first batch, last batch, level, folder
    leaving: list[str] = field(default_factory=list)


class Files:
    """The few file operations of a log, on any file system that Spark can write to."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.root = path.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        where = self._path(folder)
        if not self.fs.exists(where):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(where)]

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """The file appears whole under its name, or not at all; it must not exist yet."""
        aside = f"{name}.{uuid.uuid4().hex}"
        out = self.fs.create(self._path(aside), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self.fs.exists(self._path(name)) or not self.fs.rename(self._path(aside), self._path(name)):
            self.drop(aside)
            raise RuntimeError(f"{self.root}/{name} was written by another query")

    def drop(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


class StateLog:
    """State written once per batch.

    ``whole=False``: a version adds rows to all earlier ones (dictionaries, metrics, history);
    old runs are merged. ``whole=True``: a version replaces the one before (moments, cells); old
    runs are dropped. A batch that is run again replaces its own run. One query writes at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, whole: bool = False,
                 keep: int = 4, fanout: int = 8):
        if keep < 2 or fanout < 2:
            raise ValueError("keep and fanout must be at least 2")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.whole, self.keep, self.fanout = whole, keep, fanout
        self.files = Files(spark, self.path)
        self._clean()

    def manifest(self) -> Manifest:
        found = [int(n[:-5]) for n in self.files.names("_manifest") if re.fullmatch(r"\d+\.json", n)]
        return Manifest(**json.loads(self.files.read(f"_manifest/{max(found)}.json"))) if found \
            else Manifest()

    def _commit(self, now: Manifest, runs: list[list]) -> Manifest:
        kept = {r[3] for r in runs}
        out = Manifest(now.seq + 1, sorted(runs), [r[3] for r in now.runs if r[3] not in kept])
        self.files.publish(f"_manifest/{out.seq}.json", json.dumps(asdict(out)))
        for folder in now.leaving:
            self.files.drop(folder)
        self.files.drop(f"_manifest/{out.seq - 3}.json")
        return out

    def _clean(self) -> None:
        """Remove what a killed writer left behind: folders that no manifest names."""
        now = self.manifest()
        named = {r[3] for r in now.runs} | set(now.leaving) | {"_manifest"}
        for name in self.files.names():
            if name not in named:
                self.files.drop(name)

    def _folder(self, first: int, last: int) -> str:
        return f"run-{first}-{last}-{uuid.uuid4().hex[:12]}"

    def write(self, df: DataFrame, batch_id: int) -> None:
        folder = self._folder(batch_id, batch_id)
        df.withColumn("batch_id", F.lit(batch_id)).write.parquet(f"{self.path}/{folder}")
        now = self.manifest()
        if any(r[0] <= batch_id <= r[1] and r[2] for r in now.runs):
            raise ValueError(f"batch {batch_id} is merged already; keep more than {self.keep}")
        runs = [r for r in now.runs if not (r[0] == r[1] == batch_id)]
        self.compact(self._commit(now, [*runs, [batch_id, batch_id, 0, folder]]))

    def compact(self, now: Manifest | None = None) -> None:
        """Drop or merge runs that no batch will be run again for."""
        now = now or self.manifest()
        newest = max((r[1] for r in now.runs), default=-1)
        while True:
            old = [r for r in now.runs if r[1] <= newest - self.keep]
            if self.whole:
                if len(old) >= self.fanout:
                    self._commit(now, [r for r in now.runs if r not in old])
                return
            levels = sorted({r[2] for r in old})
            group = next((g for g in ([r for r in old if r[2] == v] for v in levels)
                          if len(g) >= self.fanout), None)
            if group is None:
                return
            group = group[:self.fanout]
            first, last = group[0][0], group[-1][1]
            folder = self._folder(first, last)
            self._read([r[3] for r in group]).coalesce(8).write.parquet(f"{self.path}/{folder}")
            now = self._commit(now, [*[r for r in now.runs if r not in group],
                                     [first, last, group[0][2] + 1, folder]])

    def _read(self, folders: list[str]) -> DataFrame:
        schema = f"{self.schema}, batch_id int"
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def version(self, batch_id: int) -> DataFrame:
        """What one batch wrote; no rows if it wrote nothing."""
        hit = [r[3] for r in self.manifest().runs if r[0] <= batch_id <= r[1]]
        return self._read(hit).where(F.col("batch_id") == batch_id).drop("batch_id")

    def before(self, batch_id: int) -> DataFrame:
        """Rows of all batches before one."""
        hit = [r[3] for r in self.manifest().runs if r[0] < batch_id]
        return self._read(hit).where(F.col("batch_id") < batch_id).drop("batch_id")

    def all(self) -> DataFrame:
        """Rows of all batches that are kept, with ``batch_id``."""
        return self._read([r[3] for r in self.manifest().runs])

    def latest(self) -> int:
        """The last batch that was written, -1 if none was."""
        return max((r[1] for r in self.manifest().runs), default=-1)
