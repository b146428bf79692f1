"""Steps whose cost must not grow faster than their input: files and folders made, texts parsed, tables computed again."""

import pytest
from pyspark.sql import functions as F

from marketrates.plans import published, queries, star
from marketrates.plans.registry import Model
from marketrates.sources import files, shared
from marketrates.sources.snapshot_table import SnapshotTable


@pytest.fixture
def own_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "folder", lambda _: str(tmp_path / "shared"))
    return tmp_path / "shared"


@pytest.mark.parametrize("name", ["snapshot_scope", "snapshot_replace_and_clear", "prune_and_sync"])
def test_snapshots_make_no_folder_each(spark, sf_dir, own_folder, name):
    assert queries.queries()[name](spark, sf_dir).count() > 0
    made = [p for p in own_folder.rglob("*") if p.suffix == ".parquet" or p.is_dir()]
    assert 0 < len(made) < 60  # there are seven snapshots a publisher


def test_a_table_is_loaded_once(spark, tmp_path):
    rows = lambda values: spark.createDataFrame(values, "x int, snapshot_id string")
    t = SnapshotTable(spark, str(tmp_path / "t"), "x int")
    assert t.load(rows([(1, "a"), (2, "b"), (3, "b")])) == {"a": 1, "b": 2} and t.commits() == [1]
    for bad, table in ((rows([(4, "c")]), t), (rows([(1, None)]), SnapshotTable(spark, str(tmp_path / "u"), "x int"))):
        with pytest.raises(ValueError):
            table.load(bad)
    assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (2, "b"), (3, "b")]
    empty = SnapshotTable(spark, str(tmp_path / "e"), "x int")
    assert empty.load(rows([])) == {} and empty.read().count() == 0


def test_a_file_for_each_name(spark, tmp_path):
    """Names of any kind, lines in order whatever their partitions, nothing else in the folder."""
    names = ["a", "b c", "d/é=%+1", "_e.~x", *[f"s{i}" for i in range(200)]]
    rows = [(n, i, None if i == 3 else f"{n},{i}\nx") for n in names for i in range(5)]
    root = str(tmp_path / "out")
    lines = spark.createDataFrame(rows, "k string, i int, line string").repartition(7)
    assert files.write_lines(lines, root, "k", ["i"], "line", ".csv") == len(names)
    found = spark.read.text(root, wholetext=True).select(files.name_of(F.col("_metadata.file_path"), ".csv"), "value")
    want = {n: "".join("\n" if i == 3 else f"{n},{i}\nx\n" for i in range(5)) for n in names}
    assert dict(map(tuple, found.collect())) == want and len(list((tmp_path / "out").iterdir())) == len(names)
    assert files.write_lines(lines.limit(0), root + "-none", "k", ["i"], "line") == 0
    with pytest.raises(Exception, match="without a file's name"):
        files.write_lines(spark.createDataFrame([(None, 1, "x")], "k string, i int, line string"), root, "k", ["i"], "line")


@pytest.mark.parametrize("name", ["file_layouts", "csv_tall_files", "csv_wide_files"])
def test_published_files_make_no_folder_each(spark, sf_dir, own_folder, name):
    assert queries.queries()[name](spark, sf_dir).count() > 0
    assert len([p for p in own_folder.rglob("*") if p.is_dir()]) < 10


def test_records_are_parsed_once_for_all_grains(spark, sf_dir, own_folder):
    """What base entities are made of reads parsed records, and only the grains that they need are held to the rules."""
    f = published.Files(Model(spark, sf_dir))
    plans = [own._jdf.queryExecution().optimizedPlan().toString() for own in f.stored.values()]
    assert all("from_json(" not in p for p in plans)
    assert f.items.count() > 0 and sorted(f.rejected) == ["codes", "drugs", "items"]


@pytest.mark.parametrize("name", ["json_item_tables", "current_rule_summary"])
def test_a_query_of_many_grains_parses_once(spark, sf_dir, own_folder, name):
    own = queries.queries()[name](spark, sf_dir)
    assert "from_json(" not in own._jdf.queryExecution().optimizedPlan().toString()


def optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def scans(plan):
    return sum("Relation [" in line and "l_orderkey#" in line for line in plan.splitlines())


@pytest.mark.parametrize("name, lines", [("blocker_reasons", 2), ("comparison_spine", 2), ("profile_code_expansion", 1), ("profile_blocker_distribution", 2)])
def test_rows_fan_out_after_all_joins(spark, sf_dir, name, lines):
    """Amounts and codes are dealt to no join, and the lines are read once for the rates and once for the snapshots."""
    plan = optimized(queries.queries()[name](spark, sf_dir))
    assert "Join" not in plan[: plan.index("Generate")] and scans(plan) == lines


@pytest.mark.parametrize("name", ["market_explorer", "profile_legible_examples"])
def test_contexts_are_named_from_the_ranked_rows(spark, sf_dir, own_folder, name):
    assert scans(optimized(queries.queries()[name](spark, sf_dir))) == 0


def test_codes_of_parts_that_share_a_key(spark):
    """Each rate of a key has all its parts' codes once; a part without a brand has a code without a text."""
    rows = [(1, "a", "B 1", "T", 3), (1, "a", "B 2", "T", 4), (2, "b", None, "T", None)]
    part = spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    got = star.with_codes(part).selectExpr("p_partkey", "transform(codes, c -> concat(c.code_system, ':', coalesce(c.match_code, '-'))) AS c").collect()
    assert sorted(map(tuple, got)) == [(1, ["brand:B1", "brand:B2", "type:T"]), (1, ["brand:B1", "brand:B2", "type:T"]), (2, ["brand:-", "type:T"])]
    held = star.bridge(part.withColumnRenamed("p_partkey", "item_id")).filter("code_comparable").distinct().groupBy("item_id").count()
    assert sorted(map(tuple, held.collect())) == [(1, 3), (2, 2)]


def test_history_is_dealt_once_by_identity(spark, sf_dir, own_folder):
    """Distinct counts of snapshots and items deal no expanded rows; signatures are made of parts, not of rates."""
    own = queries.queries()["service_item_history"](spark, sf_dir)
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and sum("Exchange hashpartitioning(service_item_id" in line for line in plan.splitlines()) == 1 and scans(optimized(own)) == 2


@pytest.mark.parametrize("name", ["coverage_scorecard", "transparency_scorecard"])
def test_coverage_is_one_pass(spark, sf_dir, own_folder, name):
    """The lines are read once for all counts, dealt once by snapshot, and no row of an amount is dealt."""
    own = queries.queries()[name](spark, sf_dir)
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert scans(optimized(own)) == 1 and "Exchange hashpartitioning(snapshot_id" in plan
    dealt = [line for line in plan.splitlines() if "Exchange " in line]
    assert not any("rate_id" in line or "item_id" in line for line in dealt)


def test_checks_hold_written_tables(spark, sf_dir, own_folder):
    """What is held twice, as it is and with a fault, is computed once; the fact is read once for both of its checks."""
    for name, most in (("summary_reconciliation", 0), ("bi_guards", 0), ("semantic_guards", 2)):
        assert scans(optimized(queries.queries()[name](spark, sf_dir))) <= most, name


def test_price_comparison_joins_observations_once(spark, sf_dir, own_folder):
    plan = optimized(queries.queries()["price_comparison"](spark, sf_dir))
    assert plan[: plan.index("Generate")].count("Join") == 1


def test_code_findings_clean_a_text_once(spark, sf_dir, own_folder):
    """Cleaned texts are not written out again wherever they are named: the code of their step would be too long to compile."""
    assert optimized(queries.queries()["code_findings"](spark, sf_dir)).count("(?i)") < 20


@pytest.mark.parametrize("name, written", [("base_payer_rates", ["lines"]), ("base_standard_charges", ["lines"]), ("base_charge_items", ["lines"]), ("csv_item_identity", [])])
def test_entities_need_no_keys(spark, sf_dir, own_folder, name, written):
    """Nothing but the lines is written, and what a rule excludes above an entity is told in its own row: no table of rejected keys, no join with it."""
    own = queries.queries()[name](spark, sf_dir)
    assert own.count() > 0 and sorted(p.name.split("-")[0] for p in own_folder.glob("*")) == written
    assert optimized(own).count("Join ") == (0 if written else 3)  # lines with orders, customers and parts


def methods(frame):
    """Bytes of the longest method of each compiled step."""
    steps = frame._jdf.queryExecution().debug().codegenToSeq()
    return [steps.apply(i)._3().maxMethodCodeSize() for i in range(steps.size())]


def test_steps_are_short_enough_to_compile(spark, sf_dir, own_folder):
    """A method of over 8000 bytes is interpreted."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert max(methods(queries.queries()["base_payer_rates"](spark, sf_dir))) <= 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("name", ["published_rule_summary", "current_rule_summary"])
def test_summaries_take_current_lines_only(spark, sf_dir, own_folder, name):
    """Lines of other snapshots than a publisher's last leave before the joins: none of them is written."""
    assert queries.queries()[name](spark, sf_dir).count() > 0
    (lines,) = own_folder.glob("lines-*")
    held = spark.read.parquet(str(lines)).groupBy("l_suppkey").agg(F.count_distinct(F.year("l_shipdate")).alias("n"), F.max(F.year("l_shipdate")).alias("y"))
    last = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_suppkey").agg(F.lit(1).cast("long").alias("n"), F.max(F.year("l_shipdate")).alias("y"))
    assert held.count() > 0 and held.exceptAll(last).count() == 0


def test_reconciliation_is_one_join_of_what_is_kept(spark, sf_dir, own_folder):
    own = queries.queries()["base_reconciliation"](spark, sf_dir)
    assert own.count() == 1 and sorted(p.name.split("-")[0] for p in own_folder.glob("*")) == ["lines", "parsed", "rows"]
    assert optimized(own).count("Join ") == 1


def test_code_findings_write_lines_only(spark, sf_dir, own_folder):
    """No records as texts, no rows: a record is made, parsed and flattened in one step."""
    assert queries.queries()["code_findings"](spark, sf_dir).count() > 0
    assert [p.name.split("-")[0] for p in own_folder.glob("*")] == ["lines"]
