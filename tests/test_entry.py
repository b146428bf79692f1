"""The entry file: every query plans, results agree with SQL on the small tables, and it imports without the training subpackage."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from marketrates.plans import queries as market

TOP = Path(__file__).resolve().parents[1]


def test_flagship(spark):
    assert entry.entry(spark).columns[:2] == ["hospital_id", "service_context_key"]


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(market.queries()) == set(market.oracle_sql())


@pytest.mark.parametrize("name", ["clean_text", "match_code" if "match_code" in market.queries() else "code_status", "rule_summary", "pattern_rule_match", "peer_benchmarks", "comparability_funnel"])
def test_agrees_with_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.sql(market.oracle_sql()[name])
    got = market.queries()[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    norm = lambda v: round(v, 4) if isinstance(v, float) else v
    rows = lambda r: sorted((tuple(norm(x) for x in row) for row in r), key=str)
    assert rows(got.select(*order).collect()) == rows(want.select(*[f'"{c}"' for c in order]).fetchall())


def test_imports_without_training_subpackage():
    code = f"import sys; sys.path.insert(0, {str(TOP)!r}); sys.modules['marketrates.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert not any(k.startswith('op') for k in e.queries()) and e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True)


def test_rest_works_without_both_folders(tmp_path):
    """A copy without the training subpackage, its tests and the pipeline: all other tests are collected, and a query runs."""
    import shutil

    gone = {str(TOP / "marketrates" / "llm"), str(TOP / "tests" / "llm"), str(TOP / "corpus_pipeline.py"), str(TOP / ".git")}
    ignore = lambda folder, names: [n for n in names if f"{folder}/{n}" in gone or n == "__pycache__"]
    copy = shutil.copytree(TOP, tmp_path / "copy", ignore=ignore)
    collected = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=copy, capture_output=True, text=True)
    assert collected.returncode == 0 and "tests/test_operators.py" in collected.stdout and "tests/llm" not in collected.stdout
    code = (
        "import sys; sys.path.insert(0, '.'); import __spark_entry__ as e; from pyspark.sql import SparkSession; assert set(e.queries()) == set(e.oracle_sql());"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').config('spark.checkpoint.dir', sys.argv[1]).getOrCreate();"
        "assert e.queries()['rule_violations'](s, '/root/testdata/sf0.001').count() > 0"
    )
    subprocess.run([sys.executable, "-c", code, str(tmp_path / "tables")], cwd=copy, check=True, capture_output=True)
