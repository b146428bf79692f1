import datetime

import pytest
from pyspark.sql import functions as F

from marketrates.operators import compare, match, quality, reshape, rules, scope
from marketrates.sources import ingest, sinks
from marketrates.streaming.arrivals import stream_snapshots


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


SPINE = "hospital_id string, snapshot_id string, service_context_key string, contract_key string, item_id string, payer_id string, market_segment string, service_code_key string, comparison_methodology string, amount_kind string, amount_value decimal(18,4), comparison_tier string, is_price_rankable boolean, is_current boolean, code_is_specific boolean, match_code string, setting string, billing_class string"


def spine(spark, rows):
    from decimal import Decimal

    full = [(h, f"{h}-1", "ctx", c, i, "p", "seg", "code", "case rate", kind, Decimal(v), tier, rank, current, True, "m", "s", "b") for h, c, i, kind, v, tier, rank, current in rows]
    return spark.createDataFrame(full, SPINE)


def test_one_vote_per_contract_and_hospital(spark):
    t2, t1 = "tier_2_context_aligned", "tier_1_code_backed"
    rows = [("a", "c1", str(i), "negotiated_dollar", "100", t2, True, True) for i in range(56)]
    rows += [("b", "c1", "1", "negotiated_dollar", "10", t2, True, True), ("b", "c1", "2", "negotiated_dollar", "20", t2, True, True), ("b", "c2", "2", "negotiated_dollar", "40", t2, True, True)]
    rows += [("c", "c1", "1", "negotiated_dollar", "1", t1, True, True), ("c", "c1", "1", "gross_charge", "7", t2, True, True), ("d", "c9", "1", "negotiated_dollar", "1", t2, True, True), ("d", "c9", "1", "negotiated_dollar", "2", t2, True, True)]
    rows += [("e", "c1", "1", "negotiated_dollar", "5", t2, False, True), ("f", "c1", "1", "negotiated_dollar", "5", t2, True, False)]
    s = spine(spark, rows)
    reps = compare.contract_representatives(s)
    got = {(r["hospital_id"], r["contract_key"]): r for r in reps.collect()}
    assert set(got) == {("a", "c1"), ("b", "c1"), ("b", "c2"), ("d", "c9")}
    assert got["a", "c1"]["raw_observation_count"] == 56 and got["a", "c1"]["contract_amount"] == 100 and not got["a", "c1"]["has_multiple_amounts"]
    assert got["b", "c1"]["contract_amount"] is None and got["b", "c1"]["has_multiple_amounts"]
    amounts = {(r["hospital_id"], r["amount_kind"]): r for r in compare.hospital_amounts(s, reps).collect()}
    assert amounts["b", "negotiated_dollar"]["hospital_amount"] == 40 and amounts["b", "negotiated_dollar"]["ambiguous_contract_count"] == 1
    assert amounts["d", "negotiated_dollar"]["hospital_amount"] is None
    assert amounts["c", "gross_charge"]["hospital_amount"] == 7


def test_floor_and_peers(spark):
    frame = spark.createDataFrame([(str(i), "x", float(i), 1, 1, 0) for i in range(5)] + [("0", "y", 1.0, 1, 1, 0), ("1", "y", 2.0, 1, 1, 0), ("2", "y", None, 1, 1, 1)], "hospital_id string, service_context_key string, hospital_amount double, raw_observation_count long, contract_count long, ambiguous_contract_count long")
    got = {r["service_context_key"]: r for r in compare.distribution(frame).collect()}
    assert got["x"]["median_amount"] == 2 and got["x"]["meets_threshold"]
    assert got["y"]["median_amount"] is None and got["y"]["reporting_hospital_count"] == 3 and got["y"]["hospital_count"] == 2
    peers = compare.peer_statistics(frame, {"all": ["service_context_key"]})
    assert rows_of(peers.filter("service_context_key = 'x'"), "pct_rank_all") == [(0.0,), (0.25,), (0.5,), (0.75,), (1.0,)]
    assert {r["pct_rank_all"] for r in peers.filter("service_context_key = 'y'").collect()} == {None}


def test_blockers_and_tiers(spark):
    schema = "is_current boolean, code_comparable boolean, code_is_specific boolean, match_code string, amount_unit string, amount_role string, amount_tier string, has_split_modifier boolean, is_drug boolean, drug_unit_status string, scope string, payer_id string, market_segment string, setting string, billing_class string, service_code_key string, modifier_signature string, amount_kind string, methodology string, drug_unit string"
    rows = [(True, True, True, "1", "usd", "published", "comparable_dollar", False, False, None, "payer_rate", "p", "m", "s", "b", "k", "m", "negotiated_dollar", "case rate", None), (None, None, None, None, "percent", None, "derived_dollar", True, True, "missing_unit", "payer_rate", None, "unknown", None, None, None, "m", "gross_charge", "x", "ml")]
    good, bad = compare.with_comparison(spark.createDataFrame(rows, schema)).collect()
    assert good["blocker_reasons"] == [] and good["comparison_tier"] == "tier_2_context_aligned" and good["comparison_methodology"] == "case rate"
    assert bad["comparison_tier"] == "tier_0_trace_only" and bad["comparison_methodology"] == "not applicable"
    assert bad["blocker_reasons"] == ["not_current_snapshot", "code_not_cross_hospital_comparable", "missing_match_code", "non_rankable_amount", "derived_dollar", "modifier_context_required", "drug_unit_context_missing", "payer_unmatched", "market_segment_unknown"]


def test_currentness(spark):
    d = datetime.date
    frame = spark.createDataFrame([("a", "1", d(2020, 1, 1)), ("a", "2", d(2021, 1, 1)), ("a", "0", None), ("b", "9", None)], "h string, s string, valid_from date")
    got = {r["s"]: r for r in scope.with_currentness(frame, "h", ["valid_from", "s"]).collect()}
    assert [got[k]["is_current"] for k in "0129"] == [False, False, True, True]
    assert got["1"]["valid_to"] == d(2021, 1, 1) and got["2"]["valid_to"] is None
    assert rows_of(scope.changed_arrivals(spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("b", 1, None)], "h string, t int, d string"), "h", ["t"], "d"), "h", "t") == [("a", 1), ("a", 3)]


def test_snapshot_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda rows: spark.createDataFrame(rows, "x int, snapshot_id string")
    assert sinks.write_partitioned(frame([(1, "a"), (2, "b"), (3, "b")]), path) == 3
    scope.replace_snapshots(frame([(9, "b")]), path, ["b"])
    read = lambda: rows_of(spark.read.schema("x int, snapshot_id string").parquet(path), "x", "snapshot_id")
    assert read() == [(1, "a"), (9, "b")]
    scope.replace_snapshots(frame([]), path, ["a"])
    assert read() == [(9, "b")]
    scope.replace_snapshots(frame([(4, "c"), (5, "d")]), path, ["c", "d"])
    for rows, ids in (([(1, "z")], ["c"]), ([(1, None)], ["c"]), ([], []), ([], [None])):
        with pytest.raises(ValueError):
            scope.replace_snapshots(frame(rows), path, ids)
    snapshots = spark.createDataFrame([("b", True), ("c", False), ("d", True)], "snapshot_id string, is_current boolean")
    assert scope.prune_stale(spark, [path], snapshots) == ["c"] and read() == [(5, "d"), (9, "b")]
    with pytest.raises(ValueError):
        scope.clear_snapshots(spark, [path], [])
    scope.clear_snapshots(spark, [path], ["d"])
    assert read() == [(9, "b")]
    plan = scope.in_scope(spark.read.parquet(path), ["b"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [(snapshot_id" in plan or "PartitionFilters" in plan


def test_stream_equals_batch(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    frame = lambda rows: spark.createDataFrame(rows, "x int, snapshot_id string")
    frame([(1, "a"), (2, "b")]).write.parquet(source)
    for rows in (None, [(7, "b")]):
        if rows:
            frame(rows).write.mode("append").parquet(source)
        stream_snapshots(spark, source, "x int, snapshot_id string", target, str(tmp_path / "check")).awaitTermination(60)
    assert rows_of(spark.read.schema("x int, snapshot_id string").parquet(target), "x", "snapshot_id") == [(1, "a"), (7, "b")]


def test_rules(spark):
    frame = spark.createDataFrame([(1, "5"), (2, "x"), (3, None), (None, "x")], "k int, v string")
    own = [rules.Rule("number", "row", "v", F.col("v").try_cast("double").isNull() & F.col("v").isNotNull(), F.col("v")), rules.Rule("missing", "row", "v", F.col("v").isNull(), F.col("v"), "warn", "report_only"), rules.Rule("never", "row", "v", F.lit(None).cast("boolean"), F.col("v"))]
    broken = rules.evaluate(frame, own, ["k"])
    assert rows_of(broken, "k", "rule_id", "excludes") == [(2, "number", True), (3, "missing", False), (None, "number", True)]
    left = scope.accepted(frame, rules.rejected_keys(broken, ["k"]), ["k"])
    assert rows_of(left, "k") == [(1,), (3,), (None,)]
    assert rows_of(rules.rule_summary(broken, own), "rule_id", "violation_count") == [("missing", 1), ("never", 0), ("number", 2)]


def test_matching(spark):
    names = spark.createDataFrame([("blue", "tn"), ("blue", "ga"), ("red", None)], "name string, state string")
    aliases = spark.createDataFrame([(1, "blue", "g", "global", None, True), (2, "blue", "t", "state", "tn", False), (3, "red", "r", "global", None, False), (4, "red", "q", "global", None, True)], "alias_id int, alias string, canonical_id string, scope string, scope_region string, verified boolean")
    found = match.best_alias(names, aliases, "name", "state")
    assert rows_of(match.attach(names, found, ["name", "state"]), "name", "state", "canonical_id") == [("blue", "ga", "g"), ("blue", "tn", "t"), ("red", None, "q")]


def test_reshape(spark):
    frame = spark.createDataFrame([(1, "A", "x", None, "y"), (1, "A", "x", None, "y"), (2, None, "x", "B", None)], "id int, c1 string, t1 string, c2 string, t2 string")
    assert rows_of(reshape.unpivot_slots(frame, [("c1", "t1"), ("c2", "t2")], ["id"]), "id", "code_ordinal", "code", "code_type") == [(1, 1, "A", "x"), (2, 2, "B", None)]
    assert rows_of(reshape.split_ordinal(spark.createDataFrame([("26|TC|",), (None,)], "m string"), "m"), "value", "ordinal") == [("26", 0), ("TC", 1)]


def test_quality(spark):
    a = spark.createDataFrame([(1, 5), (2, None), (3, 1)], "k int, v int")
    b = spark.createDataFrame([(1, 5), (2, None), (4, 1)], "k int, v int")
    assert rows_of(quality.differing(a, b, ["k"], ["v"]), "k") == [(3,), (4,)]
    assert rows_of(quality.missing_rows(a, b, spark.createDataFrame([(3,)], "k int"), ["k"]), "k") == []
    assert quality.related(a, "k", b, "k").count() == 1


WIDE = ["description", "code|1", "code|1|type", "standard_charge|gross", "standard_charge|Aetna|PPO|negotiated_dollar", "methodology|Aetna|PPO", "standard_charge|Cigna|HMO|negotiated_dollar", "methodology|Cigna|HMO"]


def test_wide_csv(spark):
    frame = spark.createDataFrame([("a", "1", "CPT", "9", "5", "case rate", " ", None), ("b", "2", "CPT", "9", "", "", None, None)], ", ".join(f"`{c}` string" for c in WIDE))
    assert ingest.layout(WIDE) == "csv_wide" and ingest.code_slots(WIDE) == [("code|1", "code|1|type")]
    got = rows_of(ingest.unpivot_wide(frame, ["description"]), "description", "payer_name", "plan_name", "standard_charge_negotiated_dollar", "methodology")
    assert got == [("a", "Aetna", "PPO", "5", "case rate"), ("b", None, None, None, None)]


def test_json_items(spark):
    item = '{"description":"d","code_information":[{"code":1,"type":"CPT"}],"drug_information":{"unit":"2","type":"ML"},"standard_charges":[{"gross_charge":10.5,"setting":"both","modifier_code":["26"],"payers_information":[{"payer_name":"p","standard_charge_percentage":50,"estimated_amount":3}]}]}'
    frame = spark.createDataFrame([("s", 0, item), ("s", 1, '{"description": '), ("s", 2, '{"description":"e"}')], "snapshot_id string, item_ordinal int, raw string")
    good, bad = ingest.split_json(frame, "raw", ingest.ITEM)
    assert bad.count() == 1 and ingest.diagnostics(bad, ["snapshot_id", "item_ordinal"], "raw", "items").collect()[0]["item_ordinal"] == 1
    tables = ingest.flatten_items(good)
    assert {k: v.count() for k, v in tables.items()} == {"standard_charge_info": 2, "code_information": 1, "drug_information": 1, "standard_charges": 1, "standard_charge_modifiers": 1, "payers_information": 1}
    assert rows_of(tables["standard_charges"], "standard_charge_id", "gross_charge") == [("s_0_0", "10.5")]
    assert sorted(str(r[0]) for r in good.select(ingest.schema_family()).collect()) == ["2.2", "None"]


def test_reference_and_encoding(spark):
    lines = spark.createDataFrame([("Title",), ("7\tX\tYes",), ("x\ty\tNo",)], "value string")
    assert rows_of(ingest.reference_table(lines, ["code", "description", "post_acute_drg"], "code", 3, "v1"), "code", "description", "post_acute_drg") == [("007", "X", True)]
    frame = spark.createDataFrame([(bytearray("﻿é".encode()),), (bytearray("é".encode("cp1252")),)], "b binary")
    assert [r[0] for r in frame.select(ingest.decoded(F.col("b"))).collect()] == ["é", "é"]


def test_publish(spark, tmp_path):
    target = str(tmp_path / "pub")
    tables = {"a": spark.range(3), "b": spark.range(1), "secret": spark.range(9)}
    for _ in range(2):
        sinks.publish(tables, ["a", "b"], target)
    assert spark.read.parquet(f"{target}/a").count() == 3 and not (tmp_path / "pub" / "secret").exists()
    with pytest.raises(ValueError):
        sinks.publish(tables, ["a", "zz"], target)
    counts = sinks.metadata(tables, "x", "1")
    assert rows_of(sinks.readiness(counts, {"a": 5, "b": 1, "zz": 1}), "table_name", "issue") == [("a", "too few rows"), ("zz", "missing")]
    sinks.write_csv(tables["a"], str(tmp_path / "csv"), 3)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3
    assert ingest.snapshots_of(spark, str(tmp_path / "none"), "x int").columns == ["x", "snapshot_id"]
