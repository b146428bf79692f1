"""Queries that check: summaries recomputed by a second route, guards, gates with their counts, rules without a break; and the operational marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import semantics
from ..operators import base, compare, quality, rules, runs
from ..operators.quantiles import exact_quantiles
from ..sources import shared
from . import audit, market, published
from .registry import MARKET, query


@query(
    "summary_reconciliation",
    """, n AS (SELECT service_context_key, count(hospital_amount) AS n FROM amounts GROUP BY ALL), c AS (SELECT snapshot_id, count(gross) AS n FROM rates GROUP BY ALL)
       SELECT 'votes_from_contracts' AS "check", 0 AS failing, (SELECT count(*) FROM amounts WHERE amount_kind = 'negotiated_dollar' AND contract_count % 2 = 1 AND hospital_amount IS NOT NULL) AS planted
       UNION ALL SELECT 'summary_from_votes', 0, (SELECT count(*) FROM n WHERE n >= 3 AND n % 2 = 0) UNION ALL SELECT 'coverage_from_fact', 0, (SELECT count(*) FROM c WHERE n % 2 = 0)""",
    model=True,
    keep=MARKET,
)
def _(m):
    """Three summaries recomputed by another route: publishers' votes from their contracts, contexts' medians from votes, both by rank selection, and what rates state from the fact's rows.

    failing: keys that differ; planted: the same after a fault was put into the summary.
    """
    votes = m.amounts.filter("amount_kind = 'negotiated_dollar'").select("hospital_id", "service_context_key", "contract_count", F.col("hospital_amount").alias("median"))
    stated = m.reps.select("hospital_id", "service_context_key", F.col("contract_amount").cast("double").alias("x"))
    counted = stated.groupBy("hospital_id", "service_context_key").agg(F.count("*").alias("contract_count"))
    again = counted.join(exact_quantiles(stated, ["hospital_id", "service_context_key"], "x", {"median": 0.5}), ["hospital_id", "service_context_key"], "left")
    summary = compare.distribution(m.amounts).filter("meets_threshold").select("service_context_key", "hospital_count", "median_amount", "p90_amount")
    held = m.amounts.select("service_context_key", F.col("hospital_amount").alias("x"))
    ranks = exact_quantiles(held, ["service_context_key"], "x", {"median_amount": 0.5, "p90_amount": 0.9})
    medians = held.groupBy("service_context_key").agg(F.count("x").alias("hospital_count")).filter(F.col("hospital_count") >= compare.FLOOR).join(ranks, "service_context_key")
    coverage = m.rates.groupBy("snapshot_id").agg(F.count("gross").alias("n"))
    facts = m.fact.filter("amount_kind = 'gross_charge'").groupBy("snapshot_id").agg(F.count("*").alias("n"))
    checks = {
        "votes_from_contracts": (votes, again, ["hospital_id", "service_context_key"], {"contract_count": 0, "median": 1e-6}, "median", F.col("contract_count") % 2 == 1),
        "summary_from_votes": (summary, medians, ["service_context_key"], {"hospital_count": 0, "median_amount": 1e-6, "p90_amount": 1e-6}, "median_amount", F.col("hospital_count") % 2 == 0),
        "coverage_from_fact": (coverage, facts, ["snapshot_id"], {"n": 0}, "n", F.col("n") % 2 == 0),
    }
    out = []
    for name, (own, other, keys, tolerances, column, fault) in checks.items():
        own, other = shared.written(own, f"{name}-summary"), shared.written(other, f"{name}-again")  # each is held twice, a row a key
        wrong = own.withColumn(column, F.when(fault, F.col(column) + 1).otherwise(F.col(column)))
        counts = [quality.reconcile(x, other, keys, tolerances).agg(F.count("*").alias(c)) for x, c in ((own, "failing"), (wrong, "planted"))]
        out.append(counts[0].crossJoin(counts[1]).select(F.lit(name).alias("check"), "failing", "planted"))  # one row each
    return reduce(lambda a, b: a.unionByName(b), out)


@query(
    "bi_guards",
    market._more(
        market._COVERAGE + ", " + market._SCORED,
        """SELECT 'funnel_monotone' AS "check", 0 AS failing, (SELECT count(DISTINCT hospital_id) + 1 FROM spine WHERE is_current) AS planted
           UNION ALL SELECT 'scores_in_range', 0, (SELECT count(*) FROM sc WHERE payer_score > 0)""",
    ),
    model=True,
    keep=("snapshots",),
)
def _(m):
    """Funnel stages only lose rows, scores lie in [0, 1]: rows that break it, and the same after a fault was put in."""
    counts = [F.count_if(F.expr(c)).alias(n) for n, (c, _) in market._STAGES.items()]
    own = m.current_spine.rollup("hospital_id").agg(*counts).withColumn("hospital_id", F.coalesce("hospital_id", F.lit("<corpus>")))
    own = shared.written(own, "funnel")  # a row per publisher, held twice
    funnel = market.reshape.columns_to_rows(own, {n: (n,) for n in market._STAGES}, ["stage"], "rows", ["hospital_id"])
    swollen = funnel.withColumn("rows", F.when(F.col("stage") == "3_full_context", F.col("rows") + 1_000_000_000).otherwise(F.col("rows")))
    scores = shared.written(market._transparency(m), "scores")
    columns = ["freshness_score", "code_score", "amount_score", "payer_score", "readiness_score", "overall_score"]
    checks = {
        "funnel_monotone": [quality.not_monotone(f, ["hospital_id"], "stage", "rows") for f in (funnel, swollen)],
        "scores_in_range": [quality.outside(s, columns, 0, 1) for s in (scores, scores.withColumn("payer_score", F.col("payer_score") + F.signum("payer_score")))],
    }
    pairs = [a.agg(F.count("*").alias("failing")).crossJoin(b.agg(F.count("*").alias("planted"))).withColumn("check", F.lit(name)) for name, (a, b) in checks.items()]
    return reduce(lambda a, b: a.unionByName(b), pairs)


GATES = [
    quality.Gate("payer_identity_coverage", "matched", "rates", 97),
    quality.Gate("market_segment_coverage", "known", "rates", 85),
    quality.Gate("plan_type_coverage", "typed", "rates", None),
    quality.Gate("amount_semantics_contract", "priced", "rates", 0, share=False),
    quality.Gate("code_normalization_contract", "told", "codes", 0, share=False),
]


def _measures(rates, bridge):
    """One row of counts: rates and those that a gate looks for, codes and those whose status and comparability are all told."""
    typed = F.coalesce(semantics.plan_type(F.col("plan_name")) == "hmo", F.lit(False))
    own = rates.agg(
        F.count("*").alias("rates"), F.count_if(F.col("payer_id") != compare.UNMATCHED).alias("matched"), F.count_if(F.col("market_segment") != "unknown").alias("known"), F.count_if(typed).alias("typed"),
        F.count_if(F.col("methodology").isNotNull() & F.col("negotiated").isNotNull()).alias("priced"),
    )
    status = audit.codes.code_status(F.col("match_code"), F.col("code_system"), F.col("code_system"), F.col("match_code"))
    told = status.isNotNull() & F.col("code_comparable").isNotNull() & F.col("code_is_specific").isNotNull()
    return own.crossJoin(bridge.agg(F.count("*").alias("codes"), F.count_if(told).alias("told")))  # one row each


@query(
    "gate_counts",
    f""", {audit._CURRENT}, x AS (SELECT count(*) AS n, count(*) FILTER (WHERE payer_id <> '<unmatched>') AS matched, count(*) FILTER (WHERE market_segment <> 'unknown') AS known, count(*) FILTER (WHERE plan_name LIKE '%hmo%') AS typed,
         count(*) FILTER (WHERE methodology IS NOT NULL AND negotiated IS NOT NULL) AS priced FROM cur), b AS (SELECT count(*) AS codes FROM bridge),
       g AS (SELECT 'payer_identity_coverage' AS gate, matched AS a, n AS d, 97.0 AS threshold, true AS share FROM x UNION ALL SELECT 'market_segment_coverage', known, n, 85, true FROM x UNION ALL SELECT 'plan_type_coverage', typed, n, NULL, true FROM x
         UNION ALL SELECT 'amount_semantics_contract', priced, n, 0, false FROM x UNION ALL SELECT 'code_normalization_contract', codes, codes, 0, false FROM b),
       e AS (SELECT 'current' AS scope, * FROM g UNION ALL SELECT 'none', gate, 0, 0, threshold, share FROM g),
       v AS (SELECT *, CASE WHEN share THEN 100.0 * a / nullif(d, 0) ELSE d - a END AS v FROM e)
       SELECT scope, gate, round(v, 2) AS metric_value, cast(threshold AS DOUBLE) AS threshold, CASE WHEN threshold IS NULL THEN 'info' WHEN (share AND v >= threshold) OR (NOT share AND v <= threshold) THEN 'pass' ELSE 'fail' END AS status,
         a AS numerator_count, d AS denominator_count, d - a AS blocker_count FROM v""",
    model=True,
    keep=("snapshots", "bridge"),
)
def _(m):
    """Gates with what they count, over the current snapshots and over none: shares of no rows fail, nothing is divided by zero."""
    own = audit._current(m)
    scopes = {"current": _measures(own, m.bridge), "none": _measures(own.filter("false"), m.bridge.filter("false"))}
    return reduce(lambda a, b: a.unionByName(b), [quality.gate_rows(x, GATES).withColumn("scope", F.lit(name)) for name, x in scopes.items()])


def _rules():
    return [r for grain in base.KEYS for r in base.rules_of(grain)]


#: The rules by grain, and those that only report.
_BY_GRAIN = {
    "charge_item": "charge_item_description_non_empty charge_item_required_arrays_non_empty csv_code_pair_required ndc_requires_drug_information schema_version_header_record_mismatch",
    "code": "code_information_required_shape code_text_non_empty code_type_allowed_values code_type_family_specific_enum",
    "drug": "drug_information_required_shape_when_present drug_type_allowed_values drug_unit_numeric_parseable drug_unit_positive",
    "payer_rate": "count_zero_requires_explanation csv_payer_identity_required_with_rate csv_payer_rate_required_with_identity methodology_allowed_values methodology_other_requires_notes payer_numeric_parseable payer_numeric_positive payer_required_identity_and_methodology payer_requires_negotiated_charge v2_2_percentage_or_algorithm_requires_estimated_amount v3_algorithm_with_dollar_missing_count v3_count_allowed_format v3_count_nonzero_requires_allowed_amounts v3_percentage_or_algorithm_requires_count",
    "standard_charge": "billing_class_allowed_values charge_requires_any_standard_charge_value payer_dollar_requires_minimum_and_maximum setting_allowed_values standard_charge_numeric_parseable standard_charge_numeric_positive standard_charge_required_setting_shape",
}
_REPORTED = ["billing_class_allowed_values", "schema_version_header_record_mismatch", "v3_algorithm_with_dollar_missing_count"]
_REGISTRY = ", ".join(
    f"('{rule}', '{grain}', '{'warn' if rule in _REPORTED else 'error'}', '{'report_only' if rule in _REPORTED else 'exclude_entity'}')" for grain, names in _BY_GRAIN.items() for rule in names.split()
)


@query(
    "current_rule_summary",
    f"""WITH {published._BROKEN}, current AS (SELECT l_suppkey || '-' || max(year(l_shipdate)) AS snapshot_id FROM lineitem GROUP BY l_suppkey), known(rule_id, grain, severity, disposition) AS (VALUES {_REGISTRY}),
       every AS (SELECT 'charge_item' AS grain, snapshot_id, rule_id FROM item_broken UNION ALL SELECT 'code', snapshot_id, rule_id FROM code_broken UNION ALL SELECT 'drug', snapshot_id, rule_id FROM drug_broken
         UNION ALL SELECT 'standard_charge', snapshot_id, rule_id FROM charge_broken UNION ALL SELECT 'payer_rate', snapshot_id, rule_id FROM rate_broken),
       hit AS (SELECT grain, rule_id, count(*) AS n, count(DISTINCT snapshot_id) AS s, count(DISTINCT split_part(snapshot_id, '-', 1)) AS h FROM every JOIN current USING (snapshot_id) GROUP BY ALL)
       SELECT rule_id, grain, severity, disposition, coalesce(n, 0) AS violation_count, coalesce(s, 0) AS affected_snapshot_count, coalesce(h, 0) AS affected_hospital_count, CASE WHEN disposition = 'exclude_entity' THEN coalesce(n, 0) ELSE 0 END AS rejected_violation_count
       FROM known LEFT JOIN hit USING (grain, rule_id)""",
)
def _(m):
    """Every rule with its breaks in current snapshots, also those without any."""
    f = published.Files(m, current=True)
    every = reduce(lambda a, b: a.unionByName(b), [base.violations(f.stored, g).select("grain", "snapshot_id", "rule_id", "excludes") for g in base.KEYS])
    return rules.current_summary(every.withColumn("hospital_id", F.split_part("snapshot_id", F.lit("-"), F.lit(1))), _rules(), published.current_ids(m))


# --- operational marts --------------------------------------------------------------------------------------------------------------------------------------

_RUNS = """ev AS (SELECT event_id, event_id % 400 AS run_id, CASE WHEN event_type IN ('purchase', 'error') THEN 'completed' ELSE 'started' END AS state, event_type AS terminal_status, ts AS started_at,
    CASE WHEN event_type IN ('purchase', 'error') THEN ts + INTERVAL 1 HOUR END AS ended_at, 'load-' || user_id % 3 AS command FROM events),
  rn AS (SELECT run_id, event_id, command, started_at, ended_at, CASE WHEN state = 'completed' THEN terminal_status ELSE 'running_or_interrupted' END AS terminal_status
    FROM ev QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY (state = 'completed') DESC, coalesce(ended_at, started_at) DESC, event_id DESC) = 1)"""


def _run_events(m):
    done = F.col("event_type").isin("purchase", "error")
    return m.table("events").select(
        "event_id", (F.col("event_id") % 400).alias("run_id"), F.when(done, "completed").otherwise("started").alias("state"), F.col("event_type").alias("terminal_status"), F.col("ts").alias("started_at"),
        F.when(done, F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ended_at"), F.concat(F.lit("load-"), (F.col("user_id") % 3).cast("string")).alias("command"),
    )


@query("run_states", f"WITH {_RUNS} SELECT run_id, event_id, command, terminal_status, date_diff('second', TIMESTAMP '2024-01-01', started_at) AS second FROM rn")
def _(m):
    """What is known of each run from its events, in whatever order they came."""
    second = F.unix_timestamp("started_at") - F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return runs.latest_runs(_run_events(m)).select("run_id", "event_id", "command", "terminal_status", second.cast("long").alias("second"))


@query(
    "attempt_row_counts",
    """SELECT l_orderkey AS attempt_id, 'bronze' AS count_type, l_returnflag AS table_name, count(*) AS row_count FROM lineitem GROUP BY ALL
       UNION ALL SELECT l_orderkey, 'quarantine', l_linestatus, count(*) FROM lineitem WHERE l_quantity > 40 GROUP BY ALL""",
)
def _(m):
    """A row per table and kind of count from the maps that attempts carry."""
    own = m.table("lineitem").select("l_orderkey", F.col("l_returnflag").alias("a"), F.when(F.col("l_quantity") > 40, F.col("l_linestatus")).alias("b"))
    counted = own.select("l_orderkey", F.explode(F.array(F.struct(F.lit("bronze").alias("kind"), F.col("a").alias("name")), F.struct(F.lit("quarantine").alias("kind"), F.col("b").alias("name")))).alias("x"))
    counted = counted.filter("x.name is not null").groupBy("l_orderkey", "x.kind", "x.name").agg(F.count("*").alias("n"))
    of = lambda kind: F.map_from_entries(F.collect_list(F.when(F.col("kind") == kind, F.struct("name", "n"))))
    attempts = counted.groupBy(F.col("l_orderkey").alias("attempt_id")).agg(of("bronze").alias("bronze_row_counts"), of("quarantine").alias("quarantine_counts"))
    return runs.map_counts(attempts, ["attempt_id"], {"bronze": "bronze_row_counts", "quarantine": "quarantine_counts"})


@query(
    "node_results",
    f"""WITH {_RUNS}, nodes AS (SELECT l_orderkey % 500 AS run_id, l_orderkey AS attempt_id, l_partkey || '.' || l_linenumber AS node_name, CASE WHEN l_returnflag = 'R' THEN 'test' WHEN l_linenumber = 7 THEN 'seed' ELSE 'model' END AS resource_type,
         ['view', 'incremental', 'table', 'other'][l_partkey % 4 + 1] AS materialization, l_suppkey FROM lineitem),
       att AS (SELECT o_orderkey AS attempt_id, o_custkey AS attempt_ordinal, o_orderstatus AS status FROM orders WHERE o_orderkey % 5 <> 0)
       SELECT n.run_id, n.attempt_id, node_name, l_suppkey, attempt_ordinal, status AS attempt_status, command AS run_command, terminal_status AS run_terminal_status,
         CASE WHEN resource_type = 'test' THEN 'use_test_failures' WHEN materialization = 'view' THEN 'not_applicable' WHEN materialization = 'incremental' THEN 'rows_written_this_run' WHEN materialization = 'table' THEN 'rebuilt_table_rows'
           WHEN resource_type = 'seed' THEN 'rows_seeded' ELSE 'unknown' END AS row_count_semantics
       FROM nodes n JOIN rn ON n.run_id = rn.run_id LEFT JOIN att ON n.attempt_id = att.attempt_id""",
)
def _(m):
    """Nodes of known runs with their attempt and run, and what their counts mean."""
    kind = F.when(F.col("l_returnflag") == "R", "test").when(F.col("l_linenumber") == 7, "seed").otherwise("model")
    how = F.element_at(F.array(*[F.lit(x) for x in ("view", "incremental", "table", "other")]), (F.col("l_partkey") % 4 + 1).cast("int"))
    nodes = m.table("lineitem").select(
        (F.col("l_orderkey") % 500).alias("run_id"), F.col("l_orderkey").alias("attempt_id"), F.concat_ws(".", F.col("l_partkey").cast("string"), F.col("l_linenumber").cast("string")).alias("node_name"), kind.alias("resource_type"), how.alias("materialization"), "l_suppkey"
    )
    attempts = m.table("orders").filter("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("attempt_id"), F.col("o_custkey").alias("attempt_ordinal"), F.col("o_orderstatus").alias("status"))
    return runs.node_results(nodes, attempts, runs.latest_runs(_run_events(m))).drop("resource_type", "materialization")
