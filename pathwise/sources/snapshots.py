"""Atomic publishing: a table as numbered snapshots (SNK1, SNK3).

    <table>/data/<write>/...            one folder per write, never changed
    <table>/snapshots/<number>.json     which folders make up the table then

A write puts its rows into a folder of its own, then commits a snapshot file
under the next number by a rename that fails if the number is taken.  Until
that rename nothing of the write is visible, so a run killed at any step
leaves the table as it was; a second writer that started from the same
snapshot finds its number taken and gets ``Conflict``, and nothing of the
first is lost.  Readers read the folders of one snapshot: what is committed
later does not change what a plan already built reads.

A month's rows are one folder; publishing a month replaces its folder in the
next snapshot, or removes it if the run has no rows for it.  All file access
is by Hadoop's file system classes, so the table may lie in any store that
Spark reads.  ``vacuum`` removes folders that no kept snapshot names.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Conflict(RuntimeError):
    """Another writer committed the number this one was to commit."""


@dataclass(frozen=True)
class Snapshot:
    number: int
    schema: T.StructType | None = None
    #: folder below ``data`` -> month it holds, or None for a whole table
    folders: dict[str, str | None] = field(default_factory=dict)


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm.org.apache.hadoop.fs
        self._path = jvm.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = jvm.Path(self.path).getFileSystem(self._conf)
        self._context = jvm.FileContext.getFileContext(jvm.Path(self.path).toUri(), self._conf)

    # ---- snapshots ----------------------------------------------------------
    def _names(self, folder: str) -> list[str]:
        p = self._path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("snapshots") if n.endswith(".json") and not n.startswith("."))

    def current(self) -> Snapshot:
        """The newest committed snapshot; number 0 before the first."""
        numbers = self.numbers()
        return self.at(numbers[-1]) if numbers else Snapshot(0)

    def at(self, number: int) -> Snapshot:
        stream = self._fs.open(self._path(f"{self.path}/snapshots/{number:012d}.json"))
        try:
            reader = self.spark._jvm.java.io.BufferedReader(
                self.spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            text = reader.readLine()
        finally:
            stream.close()
        content = json.loads(text)
        return Snapshot(number, T.StructType.fromJson(content["schema"]), content["folders"])

    def _commit(self, snapshot: Snapshot) -> Snapshot:
        """Whole file under a temporary name, then a rename that never overwrites."""
        text = json.dumps({"schema": snapshot.schema.jsonValue(), "folders": snapshot.folders}) + "\n"
        temporary = self._path(f"{self.path}/snapshots/.{uuid.uuid4().hex}")
        self._fs.mkdirs(temporary.getParent())
        out = self._fs.create(temporary, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        final = self._path(f"{self.path}/snapshots/{snapshot.number:012d}.json")
        gateway = self.spark.sparkContext._gateway
        rename = getattr(self.spark._jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            self._context.rename(temporary, final, gateway.new_array(rename, 0))
        except Exception as e:
            self._fs.delete(temporary, False)
            if self._fs.exists(final):
                raise Conflict(f"{self.path}: snapshot {snapshot.number} was committed by another writer") from e
            raise
        return snapshot

    # ---- writing --------------------------------------------------------------
    def _write(self, df: DataFrame) -> str:
        name = uuid.uuid4().hex
        df.write.parquet(f"{self.path}/data/{name}")
        return name

    def publish_full(self, df: DataFrame, base: Snapshot | None = None) -> Snapshot:
        """SNK1: the next snapshot holds ``df`` and nothing else."""
        base = base or self.current()
        return self._commit(Snapshot(base.number + 1, df.schema, {self._write(df): None}))

    def publish_months(self, df: DataFrame, months: Iterable[dt.date], month_col: str = "month",
                       base: Snapshot | None = None, append: bool = False) -> Snapshot:
        """SNK3: the next snapshot has ``df`` for the run's ``months`` and keeps
        the others.  ``append`` keeps these months' rows too, as the
        reference's plain insert does.  Rows outside ``months`` are an error.
        """
        base = base or self.current()
        months = sorted(set(months))
        name = uuid.uuid4().hex
        df.write.partitionBy(month_col).parquet(f"{self.path}/data/{name}")
        written = {n.split("=", 1)[1] for n in self._names(f"data/{name}") if n.startswith(f"{month_col}=")}
        if extra := written - {m.isoformat() for m in months}:
            raise ValueError(f"rows of months that the run does not cover: {sorted(extra)}")
        replaced = set() if append else {m.isoformat() for m in months}
        kept = {f: m for f, m in base.folders.items() if m not in replaced}
        new = {f"{name}/{month_col}={m}": m for m in sorted(written)}
        return self._commit(Snapshot(base.number + 1, df.schema, {**kept, **new}))

    # ---- reading ----------------------------------------------------------------
    def read(self, snapshot: Snapshot | None = None, month_col: str = "month") -> DataFrame:
        """The rows of one snapshot (the current one).  A filter on the month
        leaves out the other months' folders."""
        snapshot = snapshot or self.current()
        if snapshot.schema is None:
            raise ValueError(f"{self.path}: nothing is published yet")
        columns = snapshot.schema.fieldNames()
        whole = [f for f, m in snapshot.folders.items() if m is None]
        stored = T.StructType([f for f in snapshot.schema if whole or f.name != month_col])
        if whole:
            return self.spark.read.schema(stored).parquet(*[f"{self.path}/data/{f}" for f in whole]).select(*columns)
        writes: dict[str, list[str]] = {}
        for f in snapshot.folders:
            writes.setdefault(f.split("/")[0], []).append(f"{self.path}/data/{f}")
        out = None
        for write, folders in writes.items():  # one scan per write, its months as partitions
            part = (self.spark.read.schema(snapshot.schema).option("basePath", f"{self.path}/data/{write}")
                    .parquet(*folders).select(*columns))
            out = part if out is None else out.unionByName(part)
        return self.spark.createDataFrame([], snapshot.schema) if out is None else out

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all snapshots but the ``keep`` newest, and the folders that
        none of these names.  Not while a write is under way: its folder is not
        named yet."""
        numbers = self.numbers()
        kept = numbers[-keep:]
        named = {f for n in kept for f in self.at(n).folders}
        gone = []
        for n in numbers[:-keep] if keep else numbers:
            self._fs.delete(self._path(f"{self.path}/snapshots/{n:012d}.json"), False)
        for write in self._names("data"):
            if write in named:
                continue
            months = [f"{write}/{m}" for m in self._names(f"data/{write}") if "=" in m]
            held = [m for m in months if m in named]
            for f in ([m for m in months if m not in named] if held else [write]):
                self._fs.delete(self._path(f"{self.path}/data/{f}"), True)
                gone.append(f)
        return gone
