"""Exact quantiles, ordinals and rule matching against plain versions."""

import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from marketrates.operators import match, quantiles, rules
from marketrates.operators.ordinal import with_ordinals


def test_quantiles(spark):
    r = random.Random(3)
    rows = [("a", float(r.randrange(20))) for _ in range(500)] + [("b", r.random()) for _ in range(101)] + [("c", 7.0), ("d", None), (None, 1.0), (None, 2.0), ("e", 5.0)] + [("e", 5.0)] * 300 + [("e", 9.0)]
    frame = spark.createDataFrame(rows, "k string, v double").repartition(7)
    qs = {"low": 0.0, "tenth": 0.1, "middle": 0.5, "high": 0.9, "top": 1.0}
    got = {x["k"]: [x[n] for n in qs] for x in quantiles.exact_quantiles(frame, ["k"], "v", qs).collect()}
    groups = {k: [v for g, v in rows if g == k and v is not None] for k in {g for g, _ in rows}}
    want = {k: np.quantile(v, list(qs.values())).tolist() for k, v in groups.items() if v}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)
    assert quantiles.exact_quantiles(frame.filter("false"), ["k"], "v", qs).count() == 0


def test_profile_without_numbers(spark):
    frame = spark.createDataFrame([("g", "c", "x"), ("g", "c", None), ("g", "d", "1")], "grain string, column_name string, raw_value string")
    got = {x["column_name"]: x.asDict() for x in rules.numeric_profile(frame).collect()}
    assert got["c"]["median_value"] is None and got["c"]["row_count"] == 2 and got["c"]["non_numeric_count"] == 1 and got["d"]["median_value"] == 1


def test_ordinals_of_ties_and_hot_groups(spark):
    rows = [("hot", k % 3) for k in range(400)] + [(None, 1), (None, None), ("z", 5)]
    frame = spark.createDataFrame(rows, "g string, v int").repartition(5)
    got = {}
    for x in with_ordinals(frame, ["g"], [F.col("v").desc_nulls_last()], "n", 0).collect():
        got.setdefault(x["g"], []).append((x["n"], x["v"]))
    for g, own in got.items():
        assert [n for n, _ in sorted(own)] == list(range(len(own)))
        assert [v for _, v in sorted(own)] == sorted((v for k, v in rows if k == g), key=lambda v: (v is None, -(v or 0)))


def plain_best(p, q, region, table):
    spaced = None if p is None else " " + re.sub("[^a-z0-9]+", " ", p) + " "
    joined = " ".join(x for x in (p, q) if x is not None)
    out = []
    for rule_id, kind, text, priority, scope, where in table:
        met = {
            "exact_clean": joined == text, "payer_name": p == text, "token_contains": spaced is not None and f" {text} " in spaced, "plan_contains": q is not None and text in q, "regex": re.search(text, joined) is not None,
        }[kind]
        if met and (scope == "global" or (region is not None and where == region)):
            out.append((priority, scope != "state", match.MATCH_TYPES.index(kind), -len(text), rule_id))
    return min(out)[-1] if out else None


def test_rules_through_indexes(spark):
    r = random.Random(9)
    words = ["blue", "cross", "of", "tn", "a", "ppo", "hmo", "gold-plus", "é", "x1"]
    some = lambda n: " ".join(r.choice(words) for _ in range(r.randrange(1, n)))
    inputs = [(r.choice([None, some(4), some(4).replace(" ", r.choice([" ", "-", " / "]))]), r.choice([None, "", some(3)]), r.choice([None, "tn", "ga"])) for _ in range(300)]
    table = []
    for k in range(80):
        kind = r.choice(match.MATCH_TYPES)
        text = r.choice(["", " ", "bl", "pp", some(3), some(2)[1:], some(2)]) if kind != "regex" else r.choice(["^blue", "hmo$", "cross.*tn", "x[0-9]"])
        table.append((k, kind, text, r.randrange(4), r.choice(["global", "state"]), r.choice(["tn", "ga"])))
    frame = spark.createDataFrame(inputs, "p string, q string, s string")
    ruled = spark.createDataFrame(table, "rule_id int, match_type string, pattern string, priority int, scope string, scope_region string")
    got = {(x["p"], x["q"], x["s"]): x["rule_id"] for x in match.attach(frame, match.best_rule(frame, ruled, "p", "q", "s", []), ["p", "q", "s"]).collect()}
    assert got == {x: plain_best(*x, table) for x in set(inputs)}


def test_only_patterns_are_a_nested_loop(spark):
    frame = spark.createDataFrame([("a b", "c", "tn")], "p string, q string, s string")
    ruled = spark.createDataFrame([(1, "token_contains", "a", 1, "global", "")], "rule_id int, match_type string, pattern string, priority int, scope string, scope_region string")
    plan = match.rule_hits(frame, ruled, "p", "q", "s")._jdf.queryExecution().optimizedPlan().toString()
    loops = [x for x in itertools.chain(plan.split("\n")) if "Join Inner" in x and "_key" not in x]
    assert len(loops) == 1 and "regex" in loops[0]
