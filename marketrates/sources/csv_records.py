"""CSV files of any size to numbered records: files are read in splits, and a record may run over line ends and over splits.

Spark reads a file's lines split by split, in no common order, and a line end inside quotes is no record's end. So a split is read twice. First each gives a row: its lines, and for either state in
which it may begin, outside quotes or inside, the state in which it ends and how many records begin in it. A file's splits are folded in order, which says how each of them really begins and what
stands before it: a row per split, whatever the files hold. Then each line of the second reading knows its number, its record's number, and whether it is a record by itself; only lines of records
that run over several are brought together. A record whose quotes are not closed by the file's end is set aside by its first line, so a stray quote makes no record of the rest of a file.
"""

from __future__ import annotations

import csv

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files

_LINES = "file string, block long, index long, value string, inside_out boolean, inside_in boolean, begun_out long, begun_in long, after_out boolean, after_in boolean"
_RECORDS = "file string, record_ordinal long, line_ordinal long, record string, closed boolean"
_SPLITS = "file string, block long, lines long, begun_out long, begun_in long, after_out boolean, after_in boolean"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside quotes, begun outside or inside; quotes open a cell only at its beginning, two of them are one of its text."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] == '"':
                at += 2
                continue
            inside = False
        elif line[at : at + 1] == '"':
            inside, at = True, at + 1
            continue
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1


class _Run:
    """A split as far as it was read: for either state in which it begins, the state now and the records begun."""

    def __init__(self):
        self.lines, self.state, self.begun = 0, [False, True], [0, 0]

    def take(self, values: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """(inside before, records begun so far, inside after) each line, for both beginnings."""
        n = len(values)
        quoted = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
        texts = values.take(pa.array(quoted)).to_pylist()
        before, begun, after = [], [], []
        for k in (0, 1):
            states = [self.state[k]]
            for x in texts:
                states.append(ends_inside(x, states[-1]))
            states = np.array(states)
            before.append(states[np.searchsorted(quoted, np.arange(n))])
            after.append(states[np.searchsorted(quoted, np.arange(n), "right")])
            begun.append(self.begun[k] + np.cumsum(~before[k]))
            self.state[k], self.begun[k] = bool(states[-1]), int(begun[k][-1]) if n else self.begun[k]
        self.lines += n
        return before, begun, after


def _runs(batch: pa.RecordBatch):
    """(file, block, lines) of each stretch of one split."""
    files, blocks = batch.column("file").dictionary_encode(), np.asarray(batch.column("block"))
    codes = np.asarray(files.indices)
    cuts = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
        if b > a:
            yield (files.dictionary[int(codes[a])].as_py(), int(blocks[a])), batch.column("value").slice(a, b - a)


def _split_rows(batches):
    key, run = None, None
    row = lambda: pa.RecordBatch.from_pylist([dict(zip(_names(_SPLITS), [*key, run.lines, *run.begun, *run.state]))], pa.schema(_types(_SPLITS)))
    for batch in batches:
        for own, values in _runs(batch):
            if own != key:
                if run:
                    yield row()
                key, run = own, _Run()
            run.take(values)
    if run:
        yield row()


def _line_rows(batches):
    key, run = None, None
    for batch in batches:
        for own, values in _runs(batch):
            if own != key:
                key, run = own, _Run()
            first, n = run.lines, len(values)
            before, begun, after = run.take(values)
            columns = [pa.array([own[0]] * n), pa.array([own[1]] * n), pa.array(np.arange(first, first + n)), values, *map(pa.array, [*before, *begun, *after])]
            yield pa.RecordBatch.from_arrays(columns, _names(_LINES))


def _names(ddl: str) -> list[str]:
    return [x.split()[0] for x in ddl.split(", ")]


def _types(ddl: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    return [(x.split()[0], kinds[x.split()[1]]) for x in ddl.split(", ")]


def _entries(splits: DataFrame) -> DataFrame:
    """How each split begins: inside quotes or not, lines and records before it; and the number of the record that its file leaves open, if any. A row per split."""
    ordered = splits.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("block", "lines", "begun_out", "begun_in", "after_out", "after_in"))).alias("s"))
    seen = "array<struct<block:bigint,inside:boolean,lines:bigint,records:bigint>>"
    start = F.struct(F.lit(False).alias("inside"), F.lit(0).cast("long").alias("lines"), F.lit(0).cast("long").alias("records"), F.array().cast(seen).alias("seen"))

    def step(a: Column, x: Column) -> Column:
        pick = lambda name: F.when(a["inside"], x[f"{name}_in"]).otherwise(x[f"{name}_out"])
        own = F.struct(x["block"].alias("block"), a["inside"].alias("inside"), a["lines"].alias("lines"), a["records"].alias("records"))
        return F.struct(pick("after").alias("inside"), (a["lines"] + x["lines"]).alias("lines"), (a["records"] + pick("begun")).alias("records"), F.concat(a["seen"], F.array(own)).alias("seen"))

    folded = ordered.select("file", F.aggregate("s", start, step).alias("f"))
    return folded.select("file", F.when(F.col("f.inside"), F.col("f.records") - 1).alias("open"), F.inline("f.seen"))


def read_records(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(file, record_ordinal from 0, line_ordinal from 0 of its first line, record: the records of all files; the same of records that are never closed, by their first line)."""
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    entries = _entries(text.mapInArrow(_split_rows, _SPLITS))
    own = text.mapInArrow(_line_rows, _LINES).join(entries.withColumnRenamed("lines", "before"), ["file", "block"])
    pick = lambda name: F.when(F.col("inside"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out"))
    own = own.select(
        "file", (F.col("before") + F.col("index")).alias("line_ordinal"), (F.col("records") + pick("begun") - 1).alias("record_ordinal"), pick("inside").alias("continues"), pick("after").alias("goes_on"), "open", "value"
    )
    is_open = F.coalesce(F.col("record_ordinal") == F.col("open"), F.lit(False))
    alone = own.filter(~F.col("continues") & ~F.col("goes_on") & ~is_open)
    single = alone.select("file", "record_ordinal", "line_ordinal", F.col("value").alias("record"))
    parts = own.filter((F.col("continues") | F.col("goes_on")) & ~is_open).groupBy("file", "record_ordinal").agg(F.sort_array(F.collect_list(F.struct("line_ordinal", "value"))).alias("x"))
    several = parts.select("file", "record_ordinal", F.get("x", F.lit(0))["line_ordinal"].alias("line_ordinal"), F.array_join("x.value", "\n").alias("record"))
    left = own.filter(is_open & ~F.col("continues")).select("file", "record_ordinal", "line_ordinal", F.col("value").alias("record"))
    return single.unionByName(several), left


#: Files up to this many bytes are read whole by a task; a longer one is read in splits.
WHOLE = 32 << 20


def _whole_rows(batches):
    """file, record_ordinal, line_ordinal, record, closed: the records of whole files, one after another; of a record that is never closed its first line."""
    held = []

    def told():
        rows = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()))], _names(_RECORDS))
        held.clear()
        return rows

    for batch in batches:
        for path in batch.column("path").to_pylist():
            data = files.content(path).removeprefix(b"\xef\xbb\xbf")
            lines, open_, number = [x.decode(errors="replace") for x in data.splitlines()], [], 0
            for n, line in enumerate(lines):
                inside = ends_inside(line, bool(open_)) if open_ or '"' in line else False
                if inside or open_:
                    open_.append(line)
                if not inside:
                    held.append((path, number, n - max(len(open_) - 1, 0), "\n".join(open_) if open_ else line, True))
                    open_, number = [], number + 1
            if open_:
                held.append((path, number, len(lines) - len(open_), open_[0], False))
            if len(held) >= files.BATCH:
                yield told()
    if held:
        yield told()


def records_of(spark: SparkSession, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """read_records of listed files (path, length): a task reads its files whole, one after another, so a small one costs its opening and nothing is dealt; long ones are read in splits."""
    some = lambda frame, closed: frame.filter("closed" if closed else "not closed").drop("closed")
    rows = files.dealt(listed.filter(F.col("length") <= WHOLE).select("path")).mapInArrow(_whole_rows, _RECORDS)
    long = [r[0] for r in listed.filter(F.col("length") > WHOLE).select("path").collect()]  # a row per 32 MB of input at most
    closed, left = some(rows, True), some(rows, False)
    if long:
        more, more_left = read_records(spark, long)
        closed, left = closed.unionByName(more), left.unionByName(more_left)
    return closed, left


def with_cells(frame: DataFrame, record: str = "record", out: str = "cells") -> DataFrame:
    """The record's cells in its place, as an array of any length of trimmed texts; records without quotes are split by Arrow."""

    def run(batches):
        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            at = batch.schema.names.index(record)
            values = pc.fill_null(batch.column(at), "")
            quoted = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
            plain = np.setdiff1d(np.arange(len(values)), quoted)
            rows = pa.array([next(csv.reader([x]), []) for x in values.take(pa.array(quoted)).to_pylist()], pa.list_(pa.string()))
            split = pc.split_pattern(values.take(pa.array(plain)), ",").cast(pa.list_(pa.string()))
            cells = pa.concat_arrays([split, rows]).take(pa.array(np.argsort(np.concatenate([plain, quoted]), kind="stable")))
            trimmed = pa.ListArray.from_arrays(cells.offsets, pc.utf8_trim_whitespace(cells.values))
            rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n not in (record, out)]
            yield pa.RecordBatch.from_arrays([*[c for _, c in rest], trimmed], [*[n for n, _ in rest], out])

    kept = [f for f in frame.schema.fields if f.name not in (record, out)]
    return frame.mapInArrow(run, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], f"{out} array<string>"]))
