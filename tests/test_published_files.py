"""Published files: records that are set aside, families, CSV files from their lines, base entities, replacing snapshots."""

import json

import pytest
from pyspark.sql import functions as F

from marketrates.functions import codes
from marketrates.operators import base, scope
from marketrates.sources import ingest, shared


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def test_containers_under_scalars_are_set_aside(spark):
    charge = {"setting": "both", "modifier_code": ["26", "T]C"], "payers_information": [{"payer_name": 'p "count": {', "count": 5}]}
    good = [{"description": 'd "code": [1', "code_information": [{"code": 1, "type": "CPT"}], "standard_charges": [charge]}, {"description": None}, {}]
    bad = [{"description": {"a": 1}}, {"code_information": [{"code": [1]}]}, {"drug_information": {"unit": {}}}, {"standard_charges": [{"modifier_code": ["26", {"x": 1}]}]}, {"standard_charges": [{"payers_information": [{"payer_name": []}]}]}]
    frame = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(good + bad)], "i int, raw string")
    left, aside = ingest.split_json(frame, "raw", ingest.ITEM)
    assert rows_of(left, "i") == [(i,) for i in range(len(good))] and rows_of(aside, "i") == [(i,) for i in range(len(good), len(good + bad))]


def test_families(spark):
    rate = lambda **x: {"standard_charges": [{"payers_information": [x]}]}
    records = [rate(standard_charge_percentage=50, count="0"), rate(standard_charge_algorithm="a", **{"90th_percentile": 5}), rate(standard_charge_percentage=50, estimated_amount=3), rate(count="0"), rate(standard_charge_percentage=50, count="0", estimated_amount=3), {}]
    frame = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(records)], "i int, raw string")
    good, _ = ingest.split_json(frame, "raw", ingest.ITEM)
    assert rows_of(good, "i", ingest.schema_family(default=F.lit("2.1")), ingest.schema_conflict()) == [(0, "3.0", False), (1, "3.0", False), (2, "2.2", False), (3, "2.1", False), (4, "3.0", True), (5, "2.1", False)]


def test_csv_files_from_lines(spark):
    tall = ["hospital_name,last_updated_on,version,location_name,license_number|GA", '"H ""x""",1/2/2024, 2.2.0 ,A|B,9', "Description,code|1,code|1|type,payer_name,standard_charge|negotiated_dollar,10th_percentile", 'a,1,CPT,"p, q",5,', "b,,,,,7,"]
    wide = ["version", "", "description,standard_charge|gross,standard_charge|P|Q|negotiated_dollar", "c,1,2"]
    lines = [("t", i, x) for i, x in enumerate(tall)] + [("w", i, x) for i, x in enumerate(wide)] + [("u", 0, "x"), ("u", 1, "y"), ("u", 2, "z")]
    headers, rows = ingest.csv_files(spark.createDataFrame(lines, "snapshot_id string, line_ordinal long, line string").repartition(3))
    assert rows_of(headers, "snapshot_id", "layout", "version") == [("t", "csv_tall", "2.2.0"), ("u", "unknown", None), ("w", "csv_wide", None)]
    names = ["description", "code_1", "code_1_type", "payer_name", "standard_charge_dollar", "tenth_percentile"]
    own = ingest.tall_rows(rows.filter("snapshot_id = 't'"), names)
    assert rows_of(own, "row_ordinal", *names) == [(0, "a", "1", "CPT", "p, q", "5", None), (1, "b", None, None, None, None, "7")]
    tables = ingest.csv_header_tables(headers.filter("snapshot_id = 't'"))
    assert rows_of(tables["hospital_mrf_snapshots"], "reported_hospital_name", "license_number", "reported_state") == [('H "x"', "9", "GA")]
    assert rows_of(tables["hospital_locations"], "location_ordinal", "location_name") == [(0, "A"), (1, "B")] and tables["type2_npi"].count() == 0


def csv_row(ordinal, **texts):
    names = ["description", "code_1", "code_1_type", "drug_unit_of_measurement", "drug_type_of_measurement", *base.CHARGE, *base.RATE]
    return ("s", "h", "3.0", ordinal, *[texts.get(n) for n in names])


def test_csv_rows_of_one_item(spark):
    """Rows of equal description, codes and unit are one item; equal charge texts one charge; rows that name no payer and state no rate are no rate."""
    item = {"description": " CT  head", "code_1": "70450", "code_1_type": "CPT", "setting": "both", "gross_charge": "10", "minimum": "1", "maximum": "9"}
    rate = {"payer_name": "A", "plan_name": "PPO", "methodology": "case rate", "standard_charge_dollar": "5"}
    rows = [csv_row(0, **item, **rate), csv_row(1, **item, **rate | {"payer_name": "B"}), csv_row(2, **item), csv_row(3, **item | {"gross_charge": "11"}, **rate), csv_row(4, **item | {"code_1": "70451"}, **rate), csv_row(5, **item, **rate | {"standard_charge_dollar": "x"}), csv_row(6, **item | {"setting": "ward"}, **rate), csv_row(7, **item | {"description": "n/a"}, **rate)]
    names = ["description", "code_1", "code_1_type", "drug_unit_of_measurement", "drug_type_of_measurement", *base.CHARGE, *base.RATE]
    frame = spark.createDataFrame(rows, "snapshot_id string, hospital_id string, schema_family string, row_ordinal long, " + ", ".join(f"`{n}` string" for n in names))
    staged = base.union(base.stage_csv(frame, [("code_1", "code_1_type")]))
    rejected = base.rejections(staged)
    items = base.charge_items(staged, rejected)
    charges = base.standard_charges(staged, rejected, items)
    rates = base.payer_rates(staged, rejected, charges)
    assert items.select("charge_item_id").distinct().count() == 2 and items.count() == 7
    assert charges.select("standard_charge_id").distinct().count() == 3
    assert rows_of(rates, F.col("source_id").cast("int"), "clean_payer_name", F.col("negotiated_dollar").cast("int")) == [(0, "a", 5), (1, "b", 5), (3, "a", 5), (4, "a", 5)]
    assert ("rates", "payer_numeric_parseable") in {("rates", r["rule_id"]) for r in base.violations(staged, "rates").collect()}


def test_modifiers_and_statuses(spark):
    rates = spark.createDataFrame([("r1", "c1"), ("r2", "c1"), ("r3", "c2")], "payer_rate_id string, standard_charge_id string")
    modifiers = spark.createDataFrame([("c1", "TC"), ("c1", "26"), ("c1", "26")], "standard_charge_id string, match_modifier_code string")
    got = {r["payer_rate_id"]: r for r in base.rate_modifiers(rates, modifiers).collect()}
    assert got["r1"]["modifier_signature"] == got["r2"]["modifier_signature"] != got["r3"]["modifier_signature"] and [got[k]["modifier_count"] for k in ("r1", "r2", "r3")] == [2, 2, 0]
    frame = spark.createDataFrame([(1, "missing_unit"), (1, "canonical"), (2, "unknown_unit"), (2, "missing_unit"), (3, None)], "k int, s string")
    assert rows_of(frame.groupBy("k").agg(codes.collapse_status(F.col("s")).alias("s")), "k", "s") == [(1, "canonical"), (2, "unknown_unit"), (3, "missing_unit")]


def test_replace_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "snapshot_id string, k int").write.partitionBy("snapshot_id").parquet(path)
    own = spark.read.parquet(path)
    scope.replace_snapshots(own.filter("snapshot_id = 'a'").withColumn("k", F.col("k") + 10), path, ["a"])
    assert rows_of(spark.read.parquet(path), "snapshot_id", "k") == [("a", 11), ("a", 12), ("b", 3)]
    with pytest.raises(ValueError):
        scope.replace_snapshots(spark.createDataFrame([(None, 1)], "snapshot_id string, k int"), path, ["a"])
    assert rows_of(spark.read.parquet(path), "snapshot_id", "k") == [("a", 11), ("a", 12), ("b", 3)] and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_written_tables_can_be_cleared(spark):
    own = shared.written(spark.range(3), "numbers")
    assert own.count() == 3 and shared.clear(spark)


def test_a_quick_sign_precedes_every_container_found(spark):
    """Records that the full pattern sets aside all show the quick sign; plain records do not, so the slow pattern is not run on them."""
    from marketrates.sources.ingest import ITEM, _container_pattern, _odd_bracket

    plain = ['{"description":"a","code_information":[{"code":"1","type":"CPT"},{"code":"2"}],"drug_information":{"unit":"1"},"standard_charges":[{"payers_information":[{"count":"1"}]}]}', "{}"]
    wrong = ['{"description":{"x":1}}', '{"description" : [1]}', '{"standard_charges":[{"modifier_code":["a",{"b":1}]}]}', '{"standard_charges":[{"modifier_code": [["b"]]}]}', '{"code_information":[{"code":[{"x":1}]}]}', '{"drug_information":{"unit":\n{"x":1}}}']
    own = spark.createDataFrame([(x,) for x in plain + wrong], "raw string").select("raw", F.col("raw").rlike(_container_pattern(ITEM)).alias("full"), F.col("raw").rlike(_odd_bracket(ITEM)).alias("quick"))
    got = {r["raw"]: (r["full"], r["quick"]) for r in own.collect()}
    assert all(got[x] == (False, False) for x in plain) and all(got[x] == (True, True) for x in wrong)


def test_a_record_is_parsed_once_and_texts_cleaned_once(spark):
    from marketrates.operators import base
    from marketrates.sources.ingest import ITEM, split_json

    items = spark.createDataFrame([("s", "h", "3.0", 1, "{}")], "snapshot_id string, hospital_id string, schema_family string, item_ordinal int, raw string")
    broken = base.violations(base.stage_json(split_json(items, "raw", ITEM)[0]), "rates")
    plan = broken._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("regexp_replace(") <= 1


def test_records_give_the_entities_that_keys_give(spark):
    """Going down the records tells the same items, charges and rates as staged grains with rejected keys, whatever is missing or broken above them."""
    rate = {"payer_name": "A  b", "plan_name": "PPO", "methodology": "Case\tRate", "standard_charge_dollar": "5"}
    charge = {"setting": " Both ", "gross_charge": "10", "minimum": "1", "maximum": "9"}
    rates = [rate, rate | {"methodology": "barter"}, rate | {"standard_charge_dollar": "x"}, rate | {"standard_charge_dollar": None, "standard_charge_percentage": "40"}, rate | {"standard_charge_dollar": None, "standard_charge_percentage": "40", "count": "0"}, {}, None]
    charges = [charge | {"payers_information": rates}, charge, charge | {"setting": "ward", "payers_information": [rate]}, charge | {"minimum": "n/a", "payers_information": [rate]}, {"payers_information": [rate]}, None]
    codes = [{"code": " 70450", "type": "CPT"}, {"code": "1", "type": "XYZ"}, {"code": None, "type": "RC"}, {"code": "12345-678-90", "type": "Ndc"}, {}]
    drugs = [None, {"unit": "5", "type": "ML"}, {"unit": "x", "type": "ML"}, {"unit": "N/A", "type": None}]
    items = [{"description": d, "code_information": c, "drug_information": g, "standard_charges": s} for d in ("CT  head", "none", None) for c in (codes, codes[1:3], codes[:1], [], None) for g in drugs for s in (charges, [], None)]
    frame = spark.createDataFrame([("s", "h", f, i, json.dumps(x)) for f in ("3.0", "2.2") for i, x in enumerate(items)], "snapshot_id string, hospital_id string, schema_family string, item_ordinal int, raw string")
    good = ingest.split_json(frame.withColumn("snapshot_id", F.concat("snapshot_id", "schema_family")), "raw", ingest.ITEM)[0]
    names = ["description", "code_1", "code_1_type", "code_2", "code_2_type", "drug_unit_of_measurement", "drug_type_of_measurement", *base.CHARGE, *base.RATE]
    cells = [{"description": d, "code_1": a, "code_1_type": b, "code_2": "7", "code_2_type": c, "drug_unit_of_measurement": u, **x, **y} for d in ("CT  head", "n/a") for a, b in (("70450", "CPT"), ("12345-678-90", "ndc"), ("-", None)) for c in ("RC", "XYZ", None) for u in ("x", None, "5") for x in (charge, charges[3], {"setting": "ward"}) for y in [r or {} for r in rates]]
    cells = [{k: v for k, v in c.items() if k in names} for c in cells]
    rows = spark.createDataFrame([("c", "h", "3.0", i, *[c.get(n) for n in names]) for i, c in enumerate(cells)], "snapshot_id string, hospital_id string, schema_family string, row_ordinal long, " + ", ".join(f"`{n}` string" for n in names))
    slots = [("code_1", "code_1_type"), ("code_2", "code_2_type")]
    for staged, records in ((base.stage_json(good), base.json_records(good)), (base.stage_csv(rows, slots), base.csv_records(rows, slots))):
        rejected = base.rejections(staged)
        by_key = [base.charge_items(staged, rejected)]
        by_key += [base.standard_charges(staged, rejected, by_key[0])]
        by_key += [base.payer_rates(staged, rejected, by_key[1])]
        items_, rows_ = base.item_of(records), len(cells)
        charges_ = base.charge_of(items_)
        down = [items_.filter("item_there"), charges_.filter("charge_there"), base.rate_of(charges_).filter("charge_there and not rejected")]
        for want, got in zip(by_key, down):
            columns = sorted(set(want.columns) & set(got.columns))
            assert len(columns) >= 8 and len(rows_of(got, *columns)) > 0 and rows_of(got, *columns) == rows_of(want, *columns)
        assert base.rate_of(charges_).count() == staged["rates"].count() and rows_ > 0


def test_quick_texts_are_clean_texts(spark):
    from marketrates.functions import text

    odd = ["", " ", "a", " a ", "a  b", "a\tb", "\n", "a\x0bb", "a\fb", "a\rb", "N/A", " n/a ", "not  applicable", "not\tavailable", "UnKnown", "un known", "-", "--", " ", "İ", "nulls", None]
    frame = spark.createDataFrame([(x,) for x in odd], "x string")
    assert frame.select("x").filter(~text.quick_display_text(F.col("x")).eqNullSafe(text.clean_display_text(F.col("x")))).count() == 0


def test_brackets_beyond_a_records_containers(spark):
    """Texts with brackets in them are no containers; containers under scalars are set aside, also where nulls, repeated keys or unknown keys change the count."""
    good = ['{"description":"a [{ b","code_information":[null,{"code":"1"}],"standard_charges":null}', '{"other":{"x":[1]},"description":"a"}', '{"standard_charges":[{"modifier_code":["a",null],"payers_information":[]},null]}']
    bad = ['{"description":{"a":1},"code_information":[null]}', '{"code_information":[{"code":[1]}],"standard_charges":[null]}', '{"drug_information":null,"description":["x"]}']
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(good + bad)], "i int, raw string")
    left, aside = ingest.split_json(frame, "raw", ingest.ITEM)
    assert rows_of(left, "i") == [(0,), (1,), (2,)] and rows_of(aside, "i") == [(3,), (4,), (5,)]
