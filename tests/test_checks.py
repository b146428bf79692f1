"""Run states in any order and as a stream, counts from maps, reconciliation, guards and gates."""

import random

from pyspark.sql import functions as F

from marketrates.operators import quality, rules, runs

EVENTS = "run_id int, event_id long, state string, terminal_status string, started_at timestamp, ended_at timestamp, command string"


def events(spark):
    import datetime

    r = random.Random(4)
    at = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=n)
    rows = []
    for k in range(300):
        done = r.random() < 0.2
        rows.append((r.randrange(40), k, "completed" if done else "started", r.choice(["ok", "failed"]), at(r.randrange(50)), at(r.randrange(90)) if done else None, f"c{k % 3}"))
    return rows + rows[:30]


def plain(rows):
    best = {}
    for x in rows:
        order = (x[2] == "completed", x[5] or x[4], x[1])
        if x[0] not in best or order > best[x[0]][0]:
            best[x[0]] = (order, x)
    return sorted((k, x[1], x[3] if x[2] == "completed" else runs.OPEN) for k, (_, x) in best.items())


def seen(frame):
    return sorted(map(tuple, frame.select("run_id", "event_id", "terminal_status").collect()))


def test_runs_do_not_depend_on_order(spark):
    rows = events(spark)
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        assert seen(runs.latest_runs(spark.createDataFrame(rows, EVENTS).repartition(5))) == plain(rows)
    assert runs.latest_runs(spark.createDataFrame([], EVENTS)).count() == 0


def test_stream_equals_batch(spark, tmp_path):
    rows = events(spark)
    random.Random(9).shuffle(rows)
    source, log, check = (str(tmp_path / x) for x in ("in", "log", "check"))
    for a in range(0, len(rows), 70):
        spark.createDataFrame(rows[a : a + 70], EVENTS).coalesce(1).write.mode("append").parquet(source)
        runs.stream_runs(spark, source, EVENTS, log, check, files_per_batch=1).awaitTermination(60)
        assert seen(runs.read_runs(spark, log)) == plain(rows[: a + 70])


def test_map_counts(spark):
    frame = spark.createDataFrame([(1, {"a": 2, "b": 0}, None), (2, {}, {"a": 1}), (3, None, None)], "k int, x map<string,bigint>, y map<string,bigint>")
    assert sorted(map(tuple, runs.map_counts(frame, ["k"], {"bronze": "x", "quarantine": "y"}).collect())) == [(1, "bronze", "a", 2), (1, "bronze", "b", 0), (2, "quarantine", "a", 1)]


def test_reconcile(spark):
    schema = "k string, v double, n int"
    left = spark.createDataFrame([("a", 1.0, 1), (None, None, 2), ("b", 2.0, 3), ("c", 5.0, None), ("d", None, 1)], schema)
    right = spark.createDataFrame([("a", 1.0004, 1), (None, None, 2), ("b", 2.1, 4), ("e", 5.0, None), ("d", 0.0, 1)], schema)
    got = sorted((x["k"], x["side"], x["differing"] if x["side"] == "both" else []) for x in quality.reconcile(left, right, ["k"], {"v": 0.001, "n": 0}).collect())
    assert got == [("b", "both", ["v", "n"]), ("c", "summary", []), ("d", "both", ["v"]), ("e", "again", [])]


def test_guards_and_gates(spark):
    funnel = spark.createDataFrame([("h", 1, 9), ("h", 2, 9), ("h", 3, 10), ("i", 1, 1)], "h string, stage int, n int")
    assert [tuple(x)[:2] for x in quality.not_monotone(funnel, ["h"], "stage", "n").collect()] == [("h", 3)]
    assert quality.outside(spark.createDataFrame([(0.0, 1.0), (1.1, 0.5), (None, 0.1)], "a double, b double"), ["a", "b"], 0, 1).count() == 1
    specs = [quality.Gate("share", "good", "all", 97), quality.Gate("info", "good", "all", None), quality.Gate("block", "good", "all", 0, share=False)]
    one = lambda good, all_: {x["gate"]: (x["metric_value"], x["status"], x["blocker_count"]) for x in quality.gate_rows(spark.createDataFrame([(good, all_)], "good long, all long"), specs).collect()}
    assert one(97, 100) == {"share": (97.0, "pass", 3), "info": (97.0, "info", 3), "block": (3.0, "fail", 3)}
    assert one(0, 0) == one(None, None) == {"share": (None, "fail", 0), "info": (None, "info", 0), "block": (0.0, "pass", 0)}


def test_rules_without_a_break_stay(spark):
    own = [rules.Rule("r1", "g", "v", F.col("v").isNull(), F.col("v")), rules.Rule("r2", "g", "v", F.col("v") == "x", F.col("v"), "warn", "report_only"), rules.Rule("r3", "g", "v", F.lit(False), F.col("v"))]
    frame = spark.createDataFrame([("s1", "h1", None), ("s1", "h1", None), ("s2", "h1", None), ("s2", "h1", "x"), ("old", "h2", "x")], "snapshot_id string, hospital_id string, v string")
    current = spark.createDataFrame([("s1",), ("s2",)], "snapshot_id string")
    got = sorted(tuple(x) for x in rules.current_summary(rules.evaluate(frame, own, ["snapshot_id", "hospital_id"]), own, current).drop("severity", "disposition").collect())
    assert got == [("r1", "g", 3, 2, 1, 3), ("r2", "g", 1, 1, 1, 0), ("r3", "g", 0, 0, 0, 0)]


def test_metadata_children(spark):
    from marketrates.operators import base

    modifiers = spark.createDataFrame([("m1", None), ("m2", "26"), ("m3", "TC")], "modifier_code_id string, code string")
    payers = spark.createDataFrame([("m1", 0, "x"), ("m2", 0, None), ("m2", 1, "y"), ("m3", 0, "z")], "modifier_code_id string, ordinal int, name string")
    places = spark.createDataFrame([("s",)], "snapshot_id string")
    keys = {"modifiers": ["modifier_code_id"], "payers": ["modifier_code_id", "ordinal"]}
    missing = lambda c: [rules.Rule("missing", "g", c, F.col(c).isNull(), F.col(c))]
    broken = {"modifiers": rules.evaluate(modifiers, missing("code"), keys["modifiers"]), "payers": rules.evaluate(payers, missing("name"), keys["payers"])}
    kept = base.metadata_children({"modifiers": modifiers, "payers": payers, "places": places}, broken, keys, {"payers": "modifiers"})
    assert sorted(x[0] for x in kept["modifiers"].collect()) == ["m2", "m3"] and kept["places"].count() == 1
    assert sorted(x["name"] for x in kept["payers"].collect()) == ["y", "z"]


def test_sparsity(spark):
    frame = spark.createDataFrame([("g", 1, None), ("g", None, None), ("h", 2, "x")], "g string, a int, b string")
    got = sorted(map(tuple, quality.sparsity(frame, ["g"], ["a", "b"]).collect()))
    assert got == [("g", "a", 2, 1, 0.5), ("g", "b", 2, 0, 0.0), ("h", "a", 1, 1, 1.0), ("h", "b", 1, 1, 1.0)]
    assert quality.sparsity(frame.filter("false"), ["g"], ["a"]).count() == 0
