"""Queries over gates, review queues, findings, payer enrichment, profiles and pages, and over CSV files as published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import codes, semantics
from ..functions.keys import signature_text
from ..operators import base, compare, match, reshape
from ..sources import csv_records, files, ingest, shared
from . import market, published
from .registry import MARKET, query, r4
from .sql import BLOCKERS

# --- payers -----------------------------------------------------------------------------------------------------------------------------------------------

_RULES = [(1, "payer_name", "building", 5, "global", None, "medicare", "medicare advantage", None), (2, "plan_contains", "urgent", 3, "global", None, "commercial", None, "ppo"), (3, "token_contains", "machinery", 5, "global", None, None, None, "hmo")]
_DEFAULTS = [("auto_mutual", "commercial", None), ("builders_health", "medicaid", "dental")]


@query(
    "payer_enrichment",
    f"""SELECT rate_id, payer_id, coalesce(s.market_segment, d.default_segment, 'unknown') AS segment, coalesce(s.benefit_line, d.default_line, 'unknown') AS benefit_line, coalesce(s.plan_type, derived) AS plan_type,
         CASE WHEN s.plan_type IS NOT NULL THEN 'payer_context_rule' WHEN derived IS NOT NULL THEN 'derived_plan_type' ELSE 'none' END AS plan_type_basis,
         CASE WHEN payer_id <> '<unmatched>' THEN 'payer_alias' ELSE 'unmatched' END AS payer_basis, CASE WHEN s.rule_id IS NOT NULL THEN 'payer_context_rule' ELSE 'no_context_rule' END AS context_basis
       FROM (SELECT *, CASE WHEN p_size % 4 = 0 THEN plan_name || ' epo' ELSE plan_name END AS plan, CASE WHEN p_size % 4 = 0 THEN 'epo' END AS derived FROM rates) r
       LEFT JOIN LATERAL (SELECT * FROM {market._values(_RULES, ["rule_id", "match_type", "pattern", "priority", "scope", "scope_region", "market_segment", "benefit_line", "plan_type"])} u
         WHERE CASE match_type WHEN 'payer_name' THEN payer_name = pattern WHEN 'token_contains' THEN contains(' ' || payer_name || ' ', ' ' || pattern || ' ') ELSE contains(r.plan, pattern) END ORDER BY priority, match_type <> 'payer_name', rule_id LIMIT 1) s ON true
       LEFT JOIN {market._values(_DEFAULTS, ["canonical", "default_segment", "default_line"])} d ON payer_id = d.canonical""",
    model=True,
)
def _(m):
    """Rates with their payer's identity and context: a rule's value, else the payer's default, else unknown, and where each came from."""
    plan = F.when(F.col("p_size") % 4 == 0, F.concat("plan_name", F.lit(" epo"))).otherwise(F.col("plan_name"))
    own = m.rates.select("rate_id", "payer_id", "payer_name", plan.alias("plan"), F.lit("tn").alias("region"))
    rules = m.spark.createDataFrame(_RULES, "rule_id int, match_type string, pattern string, priority int, scope string, scope_region string, market_segment string, benefit_line string, plan_type string")
    defaults = m.spark.createDataFrame(_DEFAULTS, "payer_id string, default_segment string, default_line string")
    found = match.best_rule(own, rules, "payer_name", "plan", "region", ["market_segment", "benefit_line", "plan_type"])
    own = match.attach(own, found, ["payer_name", "plan", "region"]).join(defaults, "payer_id", "left")
    derived = semantics.plan_type(F.col("plan"))
    matched = F.when(F.col("payer_id") != compare.UNMATCHED, F.col("payer_id"))
    return own.select(
        "rate_id", "payer_id", F.coalesce("market_segment", "default_segment", F.lit("unknown")).alias("segment"), F.coalesce("benefit_line", "default_line", F.lit("unknown")).alias("benefit_line"),
        F.coalesce("plan_type", derived).alias("plan_type"), semantics.chosen_source(payer_context_rule=F.col("plan_type"), derived_plan_type=derived).alias("plan_type_basis"),
        F.when(matched.isNotNull(), "payer_alias").otherwise("unmatched").alias("payer_basis"), F.when(F.col("rule_id").isNotNull(), "payer_context_rule").otherwise("no_context_rule").alias("context_basis"),
    )


@query(
    "rate_modifier_signatures",
    "SELECT rate_id, modifier_signature, CASE WHEN modifier_text IS NULL THEN 0 WHEN modifier_text LIKE '%|%' THEN 2 ELSE 1 END AS modifier_count FROM rates",
    model=True,
    keep=("rates",),
)
def _(m):
    """Charges' modifiers as rows, brought back to every rate below the charge."""
    charges = m.rates.select("rate_id", F.explode("modifiers").alias("match_modifier_code"))
    return base.rate_modifiers(m.rates.select(F.col("rate_id").alias("payer_rate_id"), "rate_id").distinct(), charges, "rate_id").select(F.col("payer_rate_id").alias("rate_id"), "modifier_signature", F.col("modifier_count").cast("int").alias("modifier_count"))


@query(
    "drug_status_by_item",
    """SELECT item_id, CASE WHEN bool_or(status = 'canonical') THEN 'canonical' WHEN bool_or(status = 'unknown_unit') THEN 'unknown_unit' ELSE 'missing_unit' END AS drug_unit_status, bool_or(lacking) AS lacks_unit
       FROM (SELECT item_id, CASE WHEN unit IS NULL THEN 'missing_unit' WHEN unit = 'ml' THEN 'canonical' ELSE 'unknown_unit' END AS status, is_drug AND unit IS NULL AS lacking
         FROM (SELECT *, CASE WHEN setting = 'inpatient' THEN drug_unit WHEN methodology = 'other' THEN 'cup' END AS unit FROM rates)) GROUP BY item_id""",
    model=True,
)
def _(m):
    """The most informative status of an item's units, and whether a drug code lacks one."""
    unit = F.when(F.col("setting") == "inpatient", F.col("drug_unit")).when(F.col("methodology") == "other", "cup")
    own = m.rates.select("item_id", "is_drug", unit.alias("unit"))
    status = codes.drug_unit_status(F.col("unit"), F.when(F.col("unit") == "ml", "ml"))
    return own.withColumn("status", status).groupBy("item_id").agg(codes.collapse_status(F.col("status")).alias("drug_unit_status"), F.bool_or(codes.ndc_lacks_unit(F.col("is_drug"), F.col("unit"), F.col("unit"))).alias("lacks_unit"))


# --- gates, queues, findings --------------------------------------------------------------------------------------------------------------------------------

_CURRENT = "cur AS (SELECT r.* FROM rates r JOIN snapshots s ON r.snapshot_id = s.snapshot_id WHERE s.is_current)"


def _current(m):
    return m.rates.join(m.snapshots.filter("is_current").select("snapshot_id"), "snapshot_id", "left_semi")


@query(
    "gold_gates",
    f""", {_CURRENT}, {market._IDENTITY},
       x AS (SELECT count(*) AS n, count(*) FILTER (WHERE payer_id <> '<unmatched>') AS matched, count(*) FILTER (WHERE market_segment <> 'unknown') AS known, count(*) FILTER (WHERE plan_name LIKE '%hmo%') AS typed,
         count(*) FILTER (WHERE methodology IS NULL OR negotiated IS NULL) AS missing FROM cur),
       u AS (SELECT coalesce(max(n), 0) AS most FROM (SELECT count(*) AS n FROM cur WHERE payer_id = '<unmatched>' GROUP BY payer_name)), c AS (SELECT count(*) AS n, count(*) FILTER (WHERE match_code IS NULL) AS missing FROM bridge),
       i AS (SELECT count(*) AS n, count(*) FILTER (WHERE service_item_id IS NULL) AS missing FROM ident), h AS (SELECT count(*) AS n FROM (SELECT service_item_id FROM ident GROUP BY 1 HAVING count(DISTINCT hospital_id) > 1))
       SELECT 'payer_identity_coverage' AS gate, round(100.0 * matched / n, 2) AS metric_value, 97.0 AS threshold, CASE WHEN 100.0 * matched / n >= 97 THEN 'pass' ELSE 'fail' END AS status FROM x
       UNION ALL SELECT 'unmatched_payer_backlog', most, 100000, CASE WHEN most <= 100000 THEN 'pass' ELSE 'fail' END FROM u UNION ALL SELECT 'market_segment_coverage', round(100.0 * known / n, 2), 85, CASE WHEN 100.0 * known / n >= 85 THEN 'pass' ELSE 'fail' END FROM x
       UNION ALL SELECT 'plan_type_coverage', round(100.0 * typed / n, 2), NULL, 'info' FROM x UNION ALL SELECT 'amount_semantics_contract', missing, 0, CASE WHEN missing = 0 THEN 'pass' ELSE 'fail' END FROM x
       UNION ALL SELECT 'code_normalization_contract', missing, 0, CASE WHEN missing = 0 THEN 'pass' ELSE 'fail' END FROM c UNION ALL SELECT 'service_item_identity', i.missing + h.n, 0, CASE WHEN i.missing + h.n = 0 THEN 'pass' ELSE 'fail' END FROM i, h""",
    model=True,
    keep=("rates", "snapshots", "bridge"),
)
def _(m):
    """Whether the current snapshots are good enough to build on: seven measures with their thresholds."""
    share = lambda c: F.round(F.try_divide(100.0 * F.count_if(c), F.count("*")), 2)
    own = _current(m)
    typed = F.coalesce(semantics.plan_type(F.col("plan_name")) == "hmo", F.lit(False))
    rates = own.agg(share(F.col("payer_id") != compare.UNMATCHED).alias("payer"), share(F.col("market_segment") != "unknown").alias("segment"), share(typed).alias("typed"), F.count_if(F.col("methodology").isNull() | F.col("negotiated").isNull()).alias("amounts"))
    backlog = own.filter(F.col("payer_id") == compare.UNMATCHED).groupBy("payer_name").agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)).alias("backlog"))
    coded = m.bridge.agg(F.count_if(F.col("match_code").isNull()).alias("codes"))
    identities = market._identified(m).groupBy("service_item_id").agg(F.min("hospital_id").alias("a"), F.max("hospital_id").alias("b"))
    items = identities.agg(F.count_if(F.col("service_item_id").isNull() | (F.col("a") != F.col("b"))).alias("items"))
    one = rates.crossJoin(backlog).crossJoin(coded).crossJoin(items)  # one row each
    gate = lambda name, value, bound, least: F.struct(
        F.lit(name).alias("gate"), F.col(value).cast("double").alias("metric_value"), F.lit(bound).cast("double").alias("threshold"),
        F.lit("info").alias("status") if bound is None else F.when((F.col(value) >= bound) if least else (F.col(value) <= bound), "pass").otherwise("fail").alias("status"),
    )
    gates = [gate("payer_identity_coverage", "payer", 97, True), gate("unmatched_payer_backlog", "backlog", 100_000, False), gate("market_segment_coverage", "segment", 85, True), gate("plan_type_coverage", "typed", None, True)]
    gates += [gate(n, v, 0, False) for n, v in (("amount_semantics_contract", "amounts"), ("code_normalization_contract", "codes"), ("service_item_identity", "items"))]
    return one.select(F.explode(F.array(*gates)).alias("g")).select("g.*")


def _queue(own, by: list[str], **more):
    """Counts, publishers and an example of each kind of row that waits for review, the most frequent first."""
    counts = {"rate_count": F.count("*"), "hospital_count": F.count_distinct("hospital_id"), "example": F.min("rate_id"), **more}
    return own.groupBy(*by).agg(*[c.alias(n) for n, c in counts.items()]).orderBy(F.col("rate_count").desc(), *by)


_COUNTS = "count(*) AS rate_count, count(DISTINCT hospital_id) AS hospital_count, min(rate_id) AS example"


@query("review_queue_payer_plans", f", {_CURRENT} SELECT payer_id, plan_name, market_segment, {_COUNTS} FROM cur WHERE payer_id <> '<unmatched>' AND plan_name NOT LIKE '1%' GROUP BY ALL", model=True)
def _(m):
    return _queue(_current(m).filter((F.col("payer_id") != compare.UNMATCHED) & ~F.col("plan_name").like("1%")), ["payer_id", "plan_name", "market_segment"])


@query("review_queue_code_systems", f", {_CURRENT} SELECT code_system, {_COUNTS}, count(DISTINCT match_code) AS code_count FROM cur JOIN bridge USING (item_id) WHERE NOT code_is_specific GROUP BY code_system", model=True)
def _(m):
    return _queue(_current(m).join(m.bridge.filter("not code_is_specific"), "item_id"), ["code_system"], code_count=F.count_distinct("match_code"))


@query("review_queue_modifiers", f", {_CURRENT}, x AS (SELECT *, unnest(string_split(modifier_text, '|')) AS modifier FROM cur WHERE modifier_text IS NOT NULL) SELECT modifier, {_COUNTS} FROM x WHERE modifier <> '26' GROUP BY modifier", model=True)
def _(m):
    own = _current(m).select("*", F.explode("modifiers").alias("modifier"))
    return _queue(own.filter(codes.modifier_status(F.when(F.col("modifier") == "26", "26")) == "unknown"), ["modifier"])


@query(
    "review_queue_plan_context",
    f", {_CURRENT} SELECT payer_name, plan_name, {_COUNTS}, count(*) FILTER (WHERE market_segment = 'unknown') AS no_segment, count(*) FILTER (WHERE payer_id = '<unmatched>') AS no_payer FROM cur WHERE market_segment = 'unknown' OR payer_id = '<unmatched>' GROUP BY ALL",
    model=True,
)
def _(m):
    weak = (F.col("market_segment") == "unknown") | (F.col("payer_id") == compare.UNMATCHED)
    return _queue(_current(m).filter(weak), ["payer_name", "plan_name"], no_segment=F.count_if(F.col("market_segment") == "unknown"), no_payer=F.count_if(F.col("payer_id") == compare.UNMATCHED))


@query(
    "code_findings",
    f"""WITH {published.LINES}, c AS (SELECT snapshot_id, source_id, k, code_1 AS code, code_1_type AS kind FROM records UNION ALL SELECT snapshot_id, source_id, k, code_2, code_2_type FROM records UNION ALL SELECT snapshot_id, source_id, k, code_3, code_3_type FROM records WHERE code_3 IS NOT NULL)
       SELECT snapshot_id, CASE WHEN kind IS NULL THEN 'missing_code_system' WHEN kind = 'XYZ' THEN 'unknown_code_system' ELSE 'invalid_format' END AS finding, count(*) AS n FROM c WHERE kind IS NULL OR kind = 'XYZ' OR (kind = 'RC' AND length(code) > 4) GROUP BY ALL""",
)
def _(m):
    """Published codes whose form or system is not as it should be, by snapshot."""
    own = published.Files(m).staged["codes"]
    code, kind = base.clean_display_text(F.col("code")), base.clean_text(F.col("type"))
    system = F.when(F.col("kind").isin(*codes.VALID_FORMS, *codes.SPECIFIC_SYSTEMS, *codes.LOCAL_SYSTEMS), F.col("kind"))
    # As elements of one-row arrays, texts are cleaned once for a code; as columns they are written out again wherever they are named, until the code is too long to compile.
    once = lambda frame, **columns: frame.select("snapshot_id", F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("x")).select("snapshot_id", "x.*")
    own = once(own, code=code, kind=kind)
    own = once(own, code=F.col("code"), kind=F.col("kind"), system=system, match=codes.match_code(system, F.col("code")))
    found = codes.code_status(F.col("code"), F.col("kind"), F.col("system"), F.col("match"))
    return own.select("snapshot_id", found.alias("finding")).filter(~F.col("finding").isin("valid", "not_validated")).groupBy("snapshot_id", "finding").agg(F.count("*").alias("n"))


# --- profiles, pages ----------------------------------------------------------------------------------------------------------------------------------------


@query("profile_amount_sparsity", "SELECT amount_kind, count(*) AS n, count(amount_value) AS valued, round(100.0 * count(*) / (SELECT count(*) FROM rates), 4) AS pct FROM fact GROUP BY amount_kind", model=True, keep=("rates",))
def _(m):
    total = m.rates.agg(F.count("*").alias("total"))
    own = m.fact.groupBy("amount_kind").agg(F.count("*").alias("n"), F.count("amount_value").alias("valued")).crossJoin(total)  # one row
    return own.select("amount_kind", "n", "valued", F.round(100.0 * F.col("n") / F.col("total"), 4).alias("pct"))


@query("profile_blocker_distribution", "SELECT len(blocker_reasons) AS blockers, comparison_tier, count(*) AS n FROM spine WHERE is_current GROUP BY ALL", model=True)
def _(m):
    return m.current_spine.groupBy(F.size("blocker_reasons").cast("long").alias("blockers"), "comparison_tier").agg(F.count("*").alias("n"))


@query("profile_corpus_overview", ", n AS (SELECT count(*) AS rates, count(DISTINCT hospital_id) AS hospitals, count(DISTINCT item_id) AS items, count(DISTINCT payer_name) AS payers, min(ship_date) AS first_day, max(ship_date) AS last_day FROM rates) SELECT n.*, (SELECT count(*) FROM snapshots) AS snapshots FROM n", model=True, keep=("rates",))
def _(m):
    by = m.rates.groupBy("hospital_id", "item_id", "payer_name").agg(F.count("*").alias("n"), F.min("ship_date").alias("a"), F.max("ship_date").alias("b"))  # so that distinct counts expand few rows
    own = by.agg(F.sum("n").alias("rates"), F.count_distinct("hospital_id").alias("hospitals"), F.count_distinct("item_id").alias("items"), F.count_distinct("payer_name").alias("payers"), F.min("a").alias("first_day"), F.max("b").alias("last_day"))
    return own.crossJoin(m.snapshots.agg(F.count("*").alias("snapshots")))  # one row each


@query("profile_code_systems", "SELECT code_system, count(*) AS rows, count(DISTINCT match_code) AS codes, count(DISTINCT item_id) AS items FROM bridge GROUP BY code_system", model=True)
def _(m):
    return m.bridge.groupBy("code_system").agg(F.count("*").alias("rows"), F.count_distinct("match_code").alias("codes"), F.count_distinct("item_id").alias("items"))


@query("profile_modifiers", "SELECT coalesce(modifier_text, '<none>') AS modifiers, setting, count(*) AS n FROM rates GROUP BY ALL", model=True)
def _(m):
    return m.rates.groupBy(F.coalesce(F.nullif(F.array_join("modifiers", "|"), F.lit("")), F.lit("<none>")).alias("modifiers"), "setting").agg(F.count("*").alias("n"))


@query("profile_payers", "SELECT payer_name, payer_id, string_agg(DISTINCT plan_name, '|' ORDER BY plan_name) AS plans, count(*) AS n FROM rates GROUP BY payer_name, payer_id", model=True)
def _(m):
    return m.rates.groupBy("payer_name", "payer_id").agg(signature_text(F.col("plan_name")).alias("plans"), F.count("*").alias("n"))


@query(
    "profile_code_descriptions",
    ", d AS (SELECT DISTINCT code_system, match_code FROM bridge), p AS (SELECT DISTINCT upper(replace(p_brand, ' ', '')) AS match_code FROM part) SELECT code_system, count(*) AS codes, count(p.match_code) AS described FROM d LEFT JOIN p ON d.match_code = p.match_code AND code_system = 'brand' GROUP BY code_system",
    model=True,
)
def _(m):
    known = m.table("part").select(F.lit("brand").alias("code_system"), F.upper(F.regexp_replace("p_brand", " ", "")).alias("match_code"), F.lit(1).alias("known")).distinct()
    return m.bridge.select("code_system", "match_code").distinct().join(known, ["code_system", "match_code"], "left").groupBy("code_system").agg(F.count("*").alias("codes"), F.count("known").alias("described"))


@query(
    "profile_legible_examples",
    market._more(market._SUMMARY + ", " + market._NAMES, "SELECT service_context_key, match_code, setting, hospital_count, round(p50, 4) AS median_amount FROM g JOIN nm USING (service_context_key) WHERE hospital_count >= 3 AND amount_kind = 'negotiated_dollar' ORDER BY hospital_count DESC, service_context_key LIMIT 20"),
    model=True,
    keep=MARKET,
)
def _(m):
    """The twenty contexts that most publishers share."""
    own = compare.distribution(m.amounts).filter("meets_threshold").join(market._names(m).filter("amount_kind = 'negotiated_dollar'"), "service_context_key")
    return own.orderBy(F.col("hospital_count").desc(), "service_context_key").limit(20).select("service_context_key", "match_code", "setting", "hospital_count", r4("median_amount").alias("median_amount"))


@query("page_top_below_market", market._more(market._PEERS_ALL, "SELECT hospital_id, service_context_key, delta_all FROM pa WHERE delta_all < 0 ORDER BY delta_all, hospital_id, service_context_key LIMIT 100"), model=True, keep=MARKET)
def _(m):
    own = market._positions(m).filter("delta_all < 0").select("hospital_id", "service_context_key", "delta_all")
    return own.orderBy("delta_all", "hospital_id", "service_context_key").limit(100)


@query(
    "page_blocker_detail",
    ", c AS (SELECT hospital_id, comparison_tier, unnest(blocker_reasons) AS blocker FROM spine WHERE is_current) SELECT hospital_id, comparison_tier, blocker, count(*) AS n FROM c GROUP BY ALL",
    model=True,
)
def _(m):
    own = m.current_spine.select("hospital_id", "comparison_tier", *BLOCKERS)
    counts = own.groupBy("hospital_id", "comparison_tier").agg(*[F.count_if(b).alias(b) for b in BLOCKERS])  # before they become rows
    return reshape.columns_to_rows(counts, {b: (b,) for b in BLOCKERS}, ["blocker"], "n", ["hospital_id", "comparison_tier"]).filter("n > 0")


# --- CSV files as published ---------------------------------------------------------------------------------------------------------------------------------


def _csv_lines(m, edited=lambda line: line):
    """Each odd supplier's year as the lines of a file: header keys, header values, column names, rows, whose lines may be edited by what the rows hold."""
    rows = published.Files(m, family="csv").rows
    named = {"description": "description", "code_1": "code|1", "code_1_type": "code|1|type", "setting": "setting", "gross_charge": "standard_charge|gross", "payer_name": "payer_name", "standard_charge_dollar": "standard_charge|negotiated_dollar", "count": "count"}
    line = F.to_csv(F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in named]), {"emptyValue": ""})
    value = F.concat(F.lit('"Hospital ""'), "hospital_id", F.lit('""",2024-01-02,v'), "hospital_id", F.lit(",North|South,1 First St|2 Second St,77,1234567890"))
    heads = [F.lit("hospital_name, last_updated_on,Version,location_name,hospital_address,license_number|TN,type_2_npi"), value, F.lit(",".join(named.values()))]
    return _headed(rows.select("snapshot_id", "hospital_id", "row_ordinal", "description", line.alias("line")).withColumn("line", edited(F.col("line"))), heads)


def _headed(rows, heads: list):
    """snapshot_id, line_ordinal, line: rows (with row_ordinal and line) below their file's heads, which its first row brings."""
    line = lambda n, x: F.struct(n.cast("long").alias("line_ordinal"), x.alias("line"))
    own, first = line(F.col("row_ordinal") + 3, F.col("line")), [line(F.lit(n), x) for n, x in enumerate(heads)]
    return rows.select("snapshot_id", F.explode(F.when(F.col("row_ordinal") == 0, F.array(*first, own)).otherwise(F.array(own))).alias("x")).select("snapshot_id", "x.*")


@query("csv_tall_load", f"WITH {published.LINES} SELECT snapshot_id, row_ordinal, nullif(trim(description), '') AS description, code_1, setting, gross AS gross_charge, payer_name, dollar AS standard_charge_dollar, counted AS count FROM lines WHERE format_family = 'csv'")
def _(m):
    """Rows of tall files from their lines, columns named by the third."""
    lines = _csv_lines(m)
    return ingest.tall_rows(ingest.csv_files(lines)[1], ["description", "code_1", "setting", "gross_charge", "payer_name", "standard_charge_dollar", "count"])


def _as_files(m, lines):
    """The lines written as a file per snapshot that has its name; path and length of each."""
    return files.write_files(lines, f"{shared.folder(m.spark)}/csv-{shared.uuid.uuid4().hex}", "snapshot_id", ["line_ordinal"], "line", ".csv")


def _from_files(m, listed):
    records, _ = csv_records.records_of(m.spark, listed)
    own = records.select(files.name_of("file", ".csv").alias("snapshot_id"), F.col("record_ordinal").alias("line_ordinal"), F.col("record").alias("line"))
    return shared.written(own, "records").repartition("snapshot_id", "line_ordinal")  # heads and bodies: the files are read once; lines that pack well are few files, and what follows takes all tasks


@query(
    "csv_tall_files",
    rf"""WITH {published.LINES} SELECT snapshot_id, row_ordinal, CASE WHEN row_ordinal % 3 = 0 THEN trim(description) || chr(10) || 'a, "b"' ELSE description END AS description, code_1, setting, gross AS gross_charge, payer_name, dollar AS standard_charge_dollar, counted AS count
       FROM (SELECT * REPLACE (nullif(trim(description), '') AS description) FROM lines WHERE format_family = 'csv' AND (row_ordinal % 3 <> 0 OR trim(description) <> ''))""",
)
def _(m):
    """Rows of tall files from the files themselves: quoted cells with line ends, commas and quotes, in splits of any size."""
    own = F.trim(F.coalesce("description", F.lit("")))
    quoted = lambda line: F.concat(F.lit('"'), own, F.lit('\na, ""b""\n"'), F.regexp_extract(line, r"^[^,]*(,.*)$", 1))
    lines = _csv_lines(m, lambda line: F.when((F.col("row_ordinal") % 3 == 0) & (own != ""), quoted(line)).otherwise(line))
    rows = ingest.csv_files(_from_files(m, _as_files(m, lines)))[1]
    own = ingest.tall_rows(rows, ["description", "code_1", "setting", "gross_charge", "payer_name", "standard_charge_dollar", "count"])
    return own.filter("row_ordinal % 3 <> 0 or description is not null")


@query(
    "csv_wide_files",
    f"""WITH {published.LINES}, w AS (SELECT *, CASE WHEN dollar IS NOT NULL THEN 'Payer ' || hospital_id WHEN percentage IS NOT NULL THEN 'Cigna' END AS payer_name FROM (SELECT * EXCLUDE (payer_name) FROM pub WHERE format_family = 'csv'))
       SELECT snapshot_id, row_ordinal, nullif(trim(description), '') AS description, payer_name, CASE WHEN payer_name = 'Cigna' THEN 'HMO' WHEN payer_name IS NOT NULL THEN 'PPO' END AS plan_name, dollar, percentage FROM w""",
)
def _(m):
    """Wide files of different payers in one job, each by its own header: 40 more payers there without a value."""
    rows = published.wide_rows(m)
    more = [f"standard_charge|Other {i}|HMO|negotiated_dollar" for i in range(40)]
    names = F.concat(F.lit("description,standard_charge|Payer "), "hospital_id", F.lit("|PPO|negotiated_dollar," + ",".join(more) + ",standard_charge|Cigna|HMO|negotiated_percentage"))
    line = F.concat_ws(",", F.concat(F.lit('"'), F.coalesce("description", F.lit("")), F.lit('"')), F.coalesce("dollar", F.lit(" ")), *[F.lit("")] * len(more), F.coalesce("percentage", F.lit("")))
    lines = _headed(rows.withColumn("line", line), [F.lit("version"), F.lit("2.2.0"), names])
    own = ingest.csv_wide_rows(_from_files(m, _as_files(m, lines)))
    of = lambda c, n: F.nullif(F.try_element_at(c, F.lit(n)), F.lit(""))
    return own.select(
        "snapshot_id", "row_ordinal", of("cells", "description").alias("description"), "payer_name", "plan_name", of("values", "standard_charge_negotiated_dollar").alias("dollar"), of("values", "standard_charge_negotiated_percentage").alias("percentage")
    )


@query(
    "file_digests",
    """WITH f AS (SELECT conv_id % 20 AS k, string_agg(coalesce(text, '') || chr(10), '' ORDER BY conv_id, turn, role, text) AS content FROM conversations GROUP BY 1)
       SELECT k, strlen(content) AS byte_count, sha256(content) AS file_hash, 'utf-8' AS encoding, len(content) - len(replace(content, chr(10), '')) AS line_count, len(replace(content, chr(10), '')) AS char_count FROM f""",
)
def _(m):
    """Files written, listed and streamed: digest and encoding by one reading in pieces, lines by another."""
    own = m.table("conversations").select((F.col("conv_id") % 20).alias("k"), F.struct("conv_id", "turn", "role", "text").alias("place"), F.coalesce("text", F.lit("")).alias("value"))
    path = f"{shared.folder(m.spark)}/said-{shared.uuid.uuid4().hex}"
    own.repartition("k").sortWithinPartitions("k", "place").select("k", "value").write.partitionBy("k").text(path)
    k = F.regexp_extract("path", "k=([0-9]+)/", 1).cast("bigint").alias("k")
    listed = files.listed(m.spark, path, "part-*")
    counts = files.decoded_lines(listed).groupBy(k).agg(F.count("*").alias("line_count"), F.sum(F.length("line")).cast("long").alias("char_count"))
    return files.digests(listed).select(k, "byte_count", "file_hash", "encoding").join(counts, "k")


@query(
    "file_layouts",
    f"""WITH {published.LINES} SELECT DISTINCT snapshot_id, CASE WHEN format_family = 'json' THEN 'json' WHEN cast(hospital_id AS BIGINT) % 4 = 1 THEN 'csv_tall' ELSE 'csv_wide' END AS layout,
         CASE WHEN format_family = 'json' THEN '3.0' ELSE 'v' || hospital_id END AS version FROM pub""",
)
def _(m):
    """A folder of JSON, tall and wide files told apart by their first bytes."""
    own = published.Files(m).lines.select("snapshot_id", "hospital_id", "format_family", "k", "description")
    tall = F.col("hospital_id").cast("bigint") % 4 == 1
    head = F.when(F.col("format_family") == "json", F.lit('{"hospital_name": "x", "version": "3.0", "standard_charge_information": ['))
    head = head.otherwise(F.concat(F.lit('Version,name\nv'), "hospital_id", F.lit(',"a, b"\n'), F.when(tall, "description,payer_name").otherwise("description,standard_charge|P|Q|negotiated_dollar")))
    heads = own.groupBy("snapshot_id").agg(F.min(head).alias("line")).withColumn("place", F.lit(-1).cast("long"))
    lines = heads.unionByName(own.select("snapshot_id", F.col("k").alias("place"), F.to_json(F.struct("description")).alias("line")))
    path = f"{shared.folder(m.spark)}/mixed-{shared.uuid.uuid4().hex}"
    files.write_lines(lines, path, "snapshot_id", ["place"], "line")
    told = files.layouts(files.listed(m.spark, path, "*.txt"), 256)
    return told.select(files.name_of("path").alias("snapshot_id"), "layout", "version")


@query(
    "csv_headers",
    f"""WITH {published.LINES}, h AS (SELECT DISTINCT snapshot_id, hospital_id FROM pub WHERE format_family = 'csv')
       SELECT snapshot_id, 'csv_tall' AS layout, 'Hospital "' || hospital_id || '"' AS reported_hospital_name, '2024-01-02' AS published_last_updated_on, 'v' || hospital_id AS schema_version, '77' AS license_number, 'TN' AS reported_state, ['North', 'South'][i + 1] AS location_name,
         ['1 First St', '2 Second St'][i + 1] AS hospital_address, i AS location_ordinal FROM h, (SELECT unnest([0, 1]) AS i)""",
)
def _(m):
    """Headers of CSV files, a row for each location."""
    tables = ingest.csv_header_tables(ingest.csv_files(_csv_lines(m))[0])
    return tables["hospital_mrf_snapshots"].join(tables["hospital_locations"], "snapshot_id")


@query("reference_codes", "SELECT 'ms-drg' AS code_system, lpad(cast(p_partkey % 1000 AS VARCHAR), 3, '0') AS match_code, max(p_name) AS description, 'v1' AS code_edition FROM part GROUP BY 1, 2")
def _(m):
    """A reference table in the form that codes are matched in, one description for each code."""
    lines = m.table("part").select(F.concat_ws("\t", (F.col("p_partkey") % 1000).cast("string"), "p_name", F.lit("Yes")).alias("value"))
    table = ingest.reference_table(lines, ["code", "description", "post_acute_drg"], "code", 3, "v1")
    own = ingest.conformed(table, "ms-drg", "code", {"description": "description"})
    return own.groupBy("code_system", "match_code", "code_edition").agg(F.max("description").alias("description"))


@query("schema_families", "SELECT o_orderkey, ['3.0', '2.2', '3.0', '2.1'][o_orderkey % 4 + 1] AS family, o_orderkey % 4 = 0 AS conflict FROM orders WHERE o_orderkey % 5 <> 0")
def _(m):
    """The family that each record's payers show; records with an object where a text belongs are set aside."""
    k = F.col("o_orderkey")
    payer = F.struct(F.when(k % 4 < 3, "50").alias("standard_charge_percentage"), F.when(k % 4 < 2, "7").alias("estimated_amount"), F.when(k % 4 == 0, "9").alias("10th_percentile"), F.when(k % 4 == 2, "11").alias("count"))
    record = F.to_json(F.struct(F.lit('a "code": {x').alias("description"), F.array(F.struct(F.array(payer).alias("payers_information"))).alias("standard_charges")))
    wrong = F.regexp_replace(record, '"description":"[^}]*?x"', '"description":{"x":1}')
    good, _ = ingest.split_json(m.table("orders").select("o_orderkey", F.when(k % 5 == 0, wrong).otherwise(record).alias("raw")), "raw", ingest.ITEM)
    return good.select("o_orderkey", ingest.schema_family(default=F.lit("2.1")).alias("family"), ingest.schema_conflict().alias("conflict"))


@query("columns_like", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem")
def _(m):
    return ingest.columns_like(m.table("lineitem"), "l_.*(key|number)")

