"""CSV files read in splits of any size against Python's reader: quoted line ends over seams, stray quotes, headers of their own, hundreds of columns."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from marketrates.sources import csv_records, ingest


def test_states_agree_with_the_reader():
    r = random.Random(1)
    for _ in range(3000):
        line = "".join(r.choice('ab,"" ') for _ in range(r.randrange(12)))
        assert csv_records.ends_inside(line, False) == (len(list(csv.reader(io.StringIO(line + '\n","end"\n')))) == 1 or _open(line)), line


def _open(line):
    """Whether the reader goes on with the next line."""
    rows = list(csv.reader(io.StringIO(line + "\nX\n")))
    return not (rows and rows[-1] == ["X"])


@pytest.fixture
def splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda n: spark.conf.set(key, str(n))
    spark.conf.set(key, before)


def write(path, rows, tail=""):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    path.write_text(out.getvalue() + tail)


@pytest.mark.parametrize("size", [40, 300, 1 << 20])
def test_records_over_seams(spark, splits, tmp_path, size):
    r = random.Random(2)
    cell = lambda: "".join(r.choice(["a", "bc", ",", '"', "\n", "\n\n", " x"]) for _ in range(r.randrange(9)))
    want = {}
    for name in ("a", "b", "c"):
        rows = [[cell(), "mid", cell()] for _ in range(80)]
        write(tmp_path / f"{name}.csv", rows)
        want[name] = [[x.strip() for x in row] for row in rows]
    splits(size)
    records, left = csv_records.read_records(spark, str(tmp_path))
    got = {}
    for x in csv_records.with_cells(records).collect():
        got.setdefault(x["file"][-5], {})[x["record_ordinal"]] = list(x["cells"])
    assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == want
    assert left.count() == 0


def test_records_that_never_close(spark, splits, tmp_path):
    write(tmp_path / "a.csv", [["x", "y"]] * 30, tail='1,"open\n' + "z,z\n" * 50)
    write(tmp_path / "b.csv", [["x", 'say "y"']] * 3, tail='5" pipe,1\n2,3\n')
    splits(60)
    records, left = csv_records.read_records(spark, str(tmp_path))
    assert [(x["file"][-5], x["record_ordinal"], x["line_ordinal"], x["record"]) for x in left.collect()] == [("a", 30, 30, '1,"open')]
    assert records.filter("file like '%a.csv'").count() == 30
    assert [x["record"] for x in records.filter("file like '%b.csv'").orderBy("record_ordinal").collect()] == ['x,"say ""y"""'] * 3 + ['5" pipe,1', "2,3"]


def lines_of(records):
    return records.selectExpr("regexp_extract(file, '([^/]*)[.]csv', 1) AS snapshot_id", "record_ordinal AS line_ordinal", "record AS line")


def test_wide_files_of_different_headers(spark, splits, tmp_path):
    payers = {"p": ["Aetna", "Blue"], "q": [f"Payer {i}" for i in range(150)]}
    want = []
    for name, own in payers.items():
        names = ["description", "code|1", "code|1|type", "standard_charge|gross"]
        for p in own:
            names += [f"standard_charge|{p}|PPO|negotiated_dollar", f"methodology|{p}|PPO"]
        rows = []
        for k in range(5):
            row = [f"line\n{k}", str(k), "CPT", "9"]
            for i, p in enumerate(own):
                full = k < 4 and (i + k) % 3 == 0
                row += [str(i), "case rate"] if full else [" ", ""]
                if full:
                    want.append((name, k, p, "PPO", f"line\n{k}", str(k), {"standard_charge_negotiated_dollar": str(i), "methodology": "case rate"}))
            rows.append(row)
            if not any((i + k) % 3 == 0 for i in range(len(own))) and k < 4:
                want.append((name, k, None, None, f"line\n{k}", str(k), {}))
        want.append((name, 4, None, None, "line\n4", "4", {}))
        write(tmp_path / f"{name}.csv", [["version"], ["2.2.0"], names, *rows])
    splits(500)
    lines = lines_of(csv_records.read_records(spark, str(tmp_path))[0])
    got = [(x["snapshot_id"], x["row_ordinal"], x["payer_name"], x["plan_name"], x["cells"]["description"], x["cells"]["code_1"], x["values"]) for x in ingest.csv_wide_rows(lines).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    headers, rows = ingest.csv_files(lines)
    assert sorted((x["snapshot_id"], x["layout"], x["version"]) for x in headers.collect()) == [("p", "csv_wide", "2.2.0"), ("q", "csv_wide", "2.2.0")]
    assert max(len(x["cells"]) for x in rows.collect()) == 304


def test_no_file_is_no_record(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    records, left = csv_records.read_records(spark, str(tmp_path))
    assert records.count() == left.count() == 0


def test_small_files_are_read_whole_as_in_splits(spark, tmp_path, monkeypatch):
    """Quotes over lines, line ends of any kind, a mark, no last line end, an open quote: the records that splits give, with their numbers, also where a file is too long to be read whole."""
    from marketrates.sources import files

    texts = ['a,b\n"x\ny",2\r\n\nlast', '﻿q,"1 ""z""\n\n",3\n', "one\rtwo\n", 'ok\n"open\nrest,x\nmore\n', "\n", 'a"b,c"\n"",""\n', "é,ü\n" * 50]
    for i, x in enumerate(texts):
        (tmp_path / f"f{i}.csv").write_bytes(x.encode())
    listed = files.listed(spark, str(tmp_path), "*.csv")
    rows = lambda frames: [sorted(tuple(r) for r in x.select(F.regexp_extract("file", "[^/]+$", 0), "record_ordinal", "line_ordinal", "record").collect()) for x in frames]
    want = rows(csv_records.read_records(spark, str(tmp_path)))
    assert rows(csv_records.records_of(spark, listed)) == want and want[1]
    monkeypatch.setattr(csv_records, "WHOLE", 20)
    assert rows(csv_records.records_of(spark, listed)) == want
    assert listed.filter("length > 20").count() in range(1, len(texts))


def test_written_files_need_no_listing(spark, tmp_path, monkeypatch):
    """What was written is told with its length, and read by more than one task however few bytes the paths have."""
    from marketrates.sources import files, shared

    monkeypatch.setattr(shared, "folder", lambda _: str(tmp_path / "shared"))
    lines = spark.createDataFrame([(f"s{i}", n, f"{i},é{n}") for i in range(40) for n in range(3)], "k string, n int, line string")
    told = files.write_files(lines, str(tmp_path / "out"), "k", ["n"], "line", ".csv")
    assert sorted((r["path"], r["length"]) for r in told.collect()) == sorted((str(p), p.stat().st_size) for p in (tmp_path / "out").iterdir())
    records, left = csv_records.records_of(spark, told)
    assert records.count() == 120 and left.count() == 0
    assert records.select(F.spark_partition_id().alias("p")).distinct().count() > 1
