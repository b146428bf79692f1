"""Changes of a snapshot table are seen whole or not at all: empty frames, crashes at each step, readers and writers at once."""

import pytest

from marketrates.sources.snapshot_table import Conflict, SnapshotTable
from marketrates.streaming.arrivals import stream_commits

SCHEMA = "x int"


@pytest.fixture
def table(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    t.replace(rows(spark, [(1, "a"), (2, "b"), (3, "b")]), ["a", "b"])
    return t


def rows(spark, values):
    return spark.createDataFrame(values, "x int, snapshot_id string")


def seen(frame):
    return sorted(map(tuple, frame.collect()))


def test_replace_clear_and_history(spark, table):
    assert table.replace(rows(spark, [(9, "b"), (8, "c/ä=1")]), ["b", "c/ä=1"]) == {"b": 1, "c/ä=1": 1}
    assert seen(table.read()) == [(1, "a"), (8, "c/ä=1"), (9, "b")] and seen(table.read(ids=["c/ä=1", "none"])) == [(8, "c/ä=1")]
    assert table.replace(rows(spark, []), ["a"]) == {"a": 0}
    assert table.replace(table.read().filter("x = 100"), ["b"]) == {"b": 0}
    assert seen(table.read()) == [(8, "c/ä=1")] and seen(table.read(at=1)) == [(1, "a"), (2, "b"), (3, "b")] and table.commits() == [1, 2, 3, 4]
    table.clear(["c/ä=1"])
    assert seen(table.read()) == [] and table.read().columns == ["x", "snapshot_id"]
    assert table.vacuum(keep=1) == 4 and table.commits() == [5] and seen(table.read()) == []


def test_scope_is_held(spark, table):
    for bad in ([(1, "z")], [(1, None)], [(1, "a"), (2, "b")]):
        with pytest.raises(ValueError):
            table.replace(rows(spark, bad), ["a"])
    for ids in ([], [""], [None]):
        with pytest.raises(ValueError):
            table.replace(rows(spark, []), ids)
    assert seen(table.read()) == [(1, "a"), (2, "b"), (3, "b")] and table.commits() == [1]


@pytest.mark.parametrize("step", ["_stage", "_counted", "entries", "_write_aside", "_take_number"])
@pytest.mark.parametrize("after", [False, True])
def test_crash_at_each_step(spark, table, step, after, monkeypatch):
    """A crash before or after a step: the table is the old one, or the new one if the last step was done; running again gives the new one."""
    own = getattr(table, step)

    def crash(*args):
        if after:
            own(*args)
        raise RuntimeError("lost")

    reader = table.read()
    with monkeypatch.context() as m:
        m.setattr(table, step, crash)
        with pytest.raises(RuntimeError):
            table.replace(rows(spark, [(7, "b")]), ["b"])
    done = step == "_take_number" and after
    assert seen(table.read()) == ([(1, "a"), (7, "b")] if done else [(1, "a"), (2, "b"), (3, "b")])
    table.replace(rows(spark, [(7, "b")]), ["b"])
    assert seen(table.read()) == [(1, "a"), (7, "b")]
    assert seen(reader) == [(1, "a"), (2, "b"), (3, "b")]  # a reader that began before sees what it began with
    table.vacuum()
    assert seen(table.read()) == [(1, "a"), (7, "b")]


def test_two_writers(spark, table, monkeypatch):
    other = SnapshotTable(spark, table.root, SCHEMA)
    own, first = table._write_aside, []

    def slow(text):
        if not first:
            first.append(other.replace(rows(spark, [(5, "c")]), ["c"]))
        return own(text)

    monkeypatch.setattr(table, "_write_aside", slow)
    table.replace(rows(spark, [(6, "a")]), ["a"])
    assert seen(table.read()) == [(2, "b"), (3, "b"), (5, "c"), (6, "a")] and table.commits() == [1, 2, 3]


def test_taken_numbers_are_refused(table):
    with pytest.raises(Conflict):
        table._take_number(table._write_aside("{}"), 1)
    assert len(table.entries()) == 2


def test_keep_current(spark, table):
    flags = spark.createDataFrame([("a", True), ("b", False), ("z", False)], "snapshot_id string, is_current boolean")
    assert table.keep_current(flags) == ["b"] and table.keep_current(flags) == [] and seen(table.read()) == [(1, "a")]


def test_stream_of_commits(spark, table, tmp_path):
    source = str(tmp_path / "in")
    for values in ([(7, "b"), (4, "c")], [(5, "c")]):
        rows(spark, values).write.mode("append").parquet(source)
        stream_commits(source, table, str(tmp_path / "check")).awaitTermination(60)
    assert seen(table.read()) == [(1, "a"), (5, "c"), (7, "b")] and table.commits() == [1, 2, 3]


def test_files_do_not_grow_with_snapshots(spark, tmp_path):
    """Hundreds of snapshots in few files; of many named, left or gone, each read holds what it should."""
    from marketrates.sources import snapshot_table

    t, ids = SnapshotTable(spark, str(tmp_path / "many"), SCHEMA), [f"s{i}" for i in range(300)]
    t.replace(rows(spark, [(i, f"s{i}") for i in range(300)]), ids)
    assert len(list((tmp_path / "many" / "data").rglob("*.parquet"))) <= 8
    t.clear(ids[:150])
    for named in (1000, 10):
        snapshot_table.NAMED, before = named, snapshot_table.NAMED
        try:
            assert seen(t.read()) == [(i, f"s{i}") for i in sorted(range(150, 300))] and t.read(ids=ids[:200]).count() == 50 and t.read(at=1).count() == 300
        finally:
            snapshot_table.NAMED = before
