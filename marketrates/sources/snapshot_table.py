"""A table of snapshots whose changes are commits: readers see the whole of one commit or of another, never what lies between.

root/data/version=<v>/ holds Parquet files in order of their snapshots; a version is what one change wrote. There are as many files as the rows need, not one for each snapshot, of which there
may be hundreds of thousands; the files' statistics tell which hold a snapshot. root/commits/<number>.json names, for each snapshot that is there, its version and rows, and for each version the
snapshots that have gone from it. A change writes a version aside, counts what was written, and then renames one small file to the next number, which fails if another writer took that number: the change is then made
again on top of that one's commit. Nothing is moved or deleted before, so a crash at any step leaves the table as it was, with files that no commit names; `vacuum` removes them and those
that only old commits name. A frame that was read keeps its commit's files until then.

A commit has an entry per published file, so it is small; the driver reads no more of the data than that.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Entries = dict[str, dict]
#: Snapshots that a filter names; more are joined.
NAMED = 1000


class Conflict(Exception):
    """Another writer took the commit's number."""


def named(ids) -> list[str]:
    ids = [str(x) for x in ids]
    if not ids or any(x in ("", "None") for x in ids):
        raise ValueError("name at least one snapshot, and none that is empty")
    return ids


class SnapshotTable:
    """schema: the columns without the snapshot's, as DDL."""

    def __init__(self, spark: SparkSession, root: str, schema: str, column: str = "snapshot_id", records_per_file: int = 500_000):
        self.spark, self.root, self.schema, self.column, self.records_per_file = spark, root.rstrip("/"), schema, column, records_per_file
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.system = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.hadoop.Path("/".join([self.root, *parts]))

    # --- commits ----------------------------------------------------------------------------------------------------------------------------------------

    def commits(self) -> list[int]:
        folder = self._path("commits")
        if not self.system.exists(folder):
            return []
        return sorted(int(x.getPath().getName().removesuffix(".json")) for x in self.system.listStatus(folder) if x.getPath().getName().endswith(".json"))

    def _record(self, at: int) -> dict:
        if at == 0:
            return {"snapshots": {}, "gone": {}}
        stream = self.system.open(self._path("commits", f"{at:010}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _last(self) -> int:
        return (self.commits() or [0])[-1]

    def entries(self, at: int | None = None) -> Entries:
        """Snapshot -> version and rows, of the commit `at` or the last one; nothing before the first."""
        return self._record(self._last() if at is None else at)["snapshots"]

    def _write_aside(self, text: str):
        path = self._path("commits", f".{uuid.uuid4().hex}.tmp")
        stream = self.system.create(path, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return path

    def _take_number(self, aside, number: int) -> None:
        """Rename the record to its number; refused where the number is taken."""
        context = self.hadoop.FileContext.getFileContext(self._path().toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(self.hadoop, "Options$Rename"), 0)
        try:
            context.rename(self.system.makeQualified(aside), self.system.makeQualified(self._path("commits", f"{number:010}.json")), options)
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                raise Conflict(number) from error
            raise

    def _commit(self, change: Callable[[Entries], Entries], tries: int = 20) -> int:
        for _ in range(tries):
            number = self._last()
            before, gone = self.entries(number), self._record(number)["gone"]
            after = change(dict(before))
            for k, v in before.items():
                if after.get(k, {}).get("version") != v["version"]:
                    gone.setdefault(v["version"], []).append(k)
            used = {v["version"] for v in after.values()}
            aside = self._write_aside(json.dumps({"commit": number + 1, "snapshots": after, "gone": {v: x for v, x in gone.items() if v in used}}))
            try:
                self._take_number(aside, number + 1)
                return number + 1
            except Conflict:
                continue
            finally:
                self.system.delete(aside, False)
        raise Conflict("too many other writers")

    # --- data -------------------------------------------------------------------------------------------------------------------------------------------

    def _stage(self, frame: DataFrame) -> str:
        """Write the frame as a version, rows brought together by snapshot and in their order; a large snapshot is split over tasks."""
        version, own = uuid.uuid4().hex, frame.withColumn(self.column, F.col(self.column).cast("string"))
        own = own.hint("rebalance", self.column).sortWithinPartitions(self.column)
        own.write.option("maxRecordsPerFile", self.records_per_file).parquet(f"{self.root}/data/version={version}")
        return version

    def _counted(self, version: str) -> dict[str | None, int]:
        """Rows of each snapshot as they were written."""
        written = self.spark.read.schema(f"{self.schema}, {self.column} string").parquet(f"{self.root}/data/version={version}")
        return dict(written.groupBy(self.column).agg(F.count("*")).collect())  # a row per published file

    def replace(self, frame: DataFrame, ids) -> dict[str, int]:
        """The named snapshots' rows become frame's, also none; rows outside the scope, or without a snapshot, are an error, and nothing is changed. Returns the rows of each."""
        ids = dict.fromkeys(named(ids))
        version = self._stage(frame)
        rows = self._counted(version)
        if outside := rows.keys() - ids.keys():
            raise ValueError(f"rows outside the snapshots that are to be replaced: {sorted(map(str, outside))[:3]}")
        new = {x: {"version": version, "rows": n} for x, n in rows.items() if n}
        self._commit(lambda old: {k: v for k, v in old.items() if k not in ids} | new)
        return {x: rows.get(x, 0) for x in ids}

    def load(self, frame: DataFrame) -> dict[str, int]:
        """The first commit: every snapshot that the frame holds, told from what was written, so that the frame is computed once. Returns the rows of each."""
        version = self._stage(frame)
        rows = self._counted(version)
        if rows:
            named(rows)

        def first(old: Entries) -> Entries:
            if old:
                raise ValueError("the table has rows: name the snapshots that are to be replaced")
            return {x: {"version": version, "rows": n} for x, n in rows.items()}

        self._commit(first)
        return rows

    def clear(self, ids) -> None:
        ids = set(named(ids))
        self._commit(lambda old: {k: v for k, v in old.items() if k not in ids})

    def keep_current(self, snapshots: DataFrame) -> list[str]:
        """Take out the snapshots that are not current; returns them."""
        stale = [str(r[0]) for r in snapshots.filter("not is_current").select(self.column).collect()]  # a row per published file
        there = sorted(set(stale) & self.entries().keys())
        if there:
            self.clear(there)
        return there

    def read(self, at: int | None = None, ids=None) -> DataFrame:
        """The rows of a commit, of the named snapshots or all: versions that are there in whole, and of others the snapshots that are left."""
        at = self._last() if at is None else at
        entries, gone = self.entries(at), self._record(at)["gone"]
        chosen = entries if ids is None else {k: entries[k] for k in map(str, ids) if k in entries}
        left: dict[str, list[str]] = {}
        for k, v in chosen.items():
            left.setdefault(v["version"], []).append(k)
        if not left:
            return self.spark.createDataFrame([], f"{self.schema}, {self.column} string")
        reader = self.spark.read.schema(f"{self.schema}, {self.column} string, version string").option("basePath", f"{self.root}/data")
        own, version, snapshot = reader.parquet(*[f"{self.root}/data/version={v}" for v in left]), F.col("version"), F.col(self.column)
        whole = [v for v in left if ids is None and not gone.get(v)]
        tests, joined = [version.isin(whole)], []
        for v in left.keys() - set(whole):
            if ids is None and len(gone[v]) <= NAMED:
                tests.append((version == v) & ~snapshot.isin(gone[v]))
            elif len(left[v]) <= NAMED:
                tests.append((version == v) & snapshot.isin(left[v]))
            else:
                joined += [(v, k) for k in left[v]]
        out = own.filter(reduce(lambda a, b: a | b, tests))
        if joined:
            pairs = self.spark.createDataFrame(joined, f"version string, {self.column} string")
            out = out.unionByName(own.join(pairs, ["version", self.column], "left_semi"))
        return out.select(*[c for c in own.columns if c != "version"])

    def vacuum(self, keep: int = 1) -> int:
        """Delete versions that none of the last `keep` commits names, and the records of older commits; returns how many versions went. Not while a change is being written."""
        known = self.commits()
        used = {e["version"] for n in known[-keep:] for e in self.entries(n).values()}
        gone = 0
        if self.system.exists(self._path("data")):
            for part in self.system.listStatus(self._path("data")):
                if part.getPath().getName().removeprefix("version=") not in used:
                    self.system.delete(part.getPath(), True)
                    gone += 1
        for n in known[:-keep]:
            self.system.delete(self._path("commits", f"{n:010}.json"), False)
        return gone
