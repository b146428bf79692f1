"""The domain model once more, in the SQL that the results are held against."""

from __future__ import annotations

_ALIAS = "CASE payer_name WHEN 'automobile' THEN 'auto_mutual' WHEN 'building' THEN 'builders_health' WHEN 'furniture' THEN 'home_benefit' WHEN 'household' THEN 'home_benefit' ELSE '<unmatched>' END"

HOSPITALS = """hospitals AS (
  SELECT cast(s_suppkey AS VARCHAR) AS hospital_id, s_name AS hospital_name, lower(n_name) AS state, lower(r_name) AS health_system,
    CASE WHEN s_acctbal < 0 THEN 'critical access' WHEN s_acctbal < 5000 THEN 'general' ELSE 'teaching' END AS hospital_type
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

RATES = f"""raw AS (
  SELECT *, cast(l_extendedprice AS DECIMAL(12,2)) AS price, cast(l_discount AS DECIMAL(5,2)) AS disc, cast(l_tax AS DECIMAL(5,2)) AS tax,
    lower(trim(c_mktsegment)) AS payer_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey),
rates AS (
  SELECT cast(l_suppkey AS VARCHAR) AS hospital_id, l_suppkey || '-' || year(l_shipdate) AS snapshot_id,
    md5(l_orderkey || '||' || l_linenumber || '||' || l_partkey || '||' || l_suppkey || '||' || cast(l_shipdate AS DATE) || '||' || price) AS rate_id,
    cast(l_shipdate AS DATE) AS ship_date, cast(l_partkey AS VARCHAR) AS item_id, p_name AS description, p_brand, p_type, p_size,
    CASE WHEN l_linestatus = 'O' THEN 'outpatient' ELSE 'inpatient' END AS setting,
    CASE lower(o_orderstatus) WHEN 'f' THEN 'facility' WHEN 'o' THEN 'professional' END AS billing_class,
    CASE WHEN l_linenumber = 7 THEN 'other' WHEN l_returnflag = 'A' THEN 'case rate' WHEN l_returnflag = 'N' THEN 'fee schedule' ELSE 'per diem' END AS methodology,
    payer_name, trim(lower(o_orderpriority)) AS plan_name, {_ALIAS} AS payer_id,
    CASE WHEN payer_name = 'machinery' THEN 'unknown' ELSE 'commercial' END AS market_segment,
    CASE WHEN tax >= 0.06 AND disc >= 0.08 THEN '26|TC' WHEN tax >= 0.06 THEN '26' WHEN disc >= 0.08 THEN 'TC' END AS modifier_text,
    md5(coalesce(CASE WHEN tax >= 0.06 AND disc >= 0.08 THEN '26|TC' WHEN tax >= 0.06 THEN '26' WHEN disc >= 0.08 THEN 'TC' END, '<no_modifiers>')) AS modifier_signature,
    (tax >= 0.06 OR disc >= 0.08) AS has_split_modifier, p_type = 'SMALL' AS is_drug, CASE WHEN p_type = 'SMALL' AND p_size <= 25 THEN 'ml' END AS drug_unit,
    CASE WHEN p_type = 'SMALL' AND p_size <= 25 THEN 'canonical' WHEN p_type = 'SMALL' THEN 'missing_unit' ELSE 'not_a_drug' END AS drug_unit_status,
    cast(price AS DECIMAL(18,4)) AS gross, cast(cast(price * (1 - disc) AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS cash,
    cast(cast(price * (1 - disc) * (1 + tax) AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS negotiated,
    CASE WHEN l_linenumber <= 2 THEN cast(cast(price * CASE WHEN l_linenumber = 2 THEN 1.75 ELSE 0.50 END AS DECIMAL(18,2)) AS DECIMAL(18,4)) END AS minimum, CASE WHEN l_linenumber <= 2 THEN cast(cast(price * 1.50 AS DECIMAL(18,2)) AS DECIMAL(18,4)) END AS maximum,
    CASE WHEN l_linenumber = 3 THEN cast(price AS DECIMAL(18,4)) END AS median_amount, CASE WHEN l_linenumber = 3 THEN cast(cast(price * 0.25 AS DECIMAL(18,2)) AS DECIMAL(18,4)) END AS p10_amount,
    CASE WHEN l_linenumber = 3 THEN cast(cast(price * 1.75 AS DECIMAL(18,2)) AS DECIMAL(18,4)) END AS p90_amount, CASE WHEN l_linenumber = 4 THEN cast(price AS DECIMAL(18,4)) END AS estimated_amount,
    CASE WHEN l_linenumber = 5 THEN cast((1 - disc) * 100 + 2 AS DECIMAL(18,4)) END AS percentage, CASE WHEN l_linenumber = 6 THEN 'lesser of ' || l_returnflag END AS algorithm
  FROM raw)"""

SNAPSHOTS = """first_days AS (SELECT hospital_id, snapshot_id, min(ship_date) AS valid_from FROM rates GROUP BY ALL),
snapshots AS (
  SELECT *, row_number() OVER (PARTITION BY hospital_id ORDER BY valid_from DESC, snapshot_id DESC) = 1 AS is_current,
    lead(valid_from) OVER (PARTITION BY hospital_id ORDER BY valid_from, snapshot_id) AS valid_to,
    cast(date_diff('day', valid_from, DATE '2002-01-01') AS BIGINT) AS age_days,
    CASE WHEN date_diff('day', valid_from, DATE '2002-01-01') <= 365 THEN '<=365d' WHEN date_diff('day', valid_from, DATE '2002-01-01') <= 730 THEN '<=730d'
      WHEN date_diff('day', valid_from, DATE '2002-01-01') <= 1460 THEN '<=1460d' ELSE '>1460d' END AS freshness
  FROM first_days)"""

_KINDS = [
    ("gross_charge", "standard_charge", "gross", "usd", "gross"), ("discounted_cash", "standard_charge", "cash", "usd", "cash"), ("min_negotiated", "standard_charge", "bound", "usd", "minimum"),
    ("max_negotiated", "standard_charge", "bound", "usd", "maximum"), ("negotiated_dollar", "payer_rate", "negotiated", "usd", "negotiated"), ("negotiated_percentage", "payer_rate", "negotiated", "percent", "percentage"),
    ("negotiated_algorithm", "payer_rate", "negotiated", "text", "algorithm"), ("estimated_amount", "payer_rate", "estimated", "usd", "estimated_amount"), ("median_amount", "payer_rate", "allowed_amount_stat", "usd", "median_amount"),
    ("p10_amount", "payer_rate", "allowed_amount_stat", "usd", "p10_amount"), ("p90_amount", "payer_rate", "allowed_amount_stat", "usd", "p90_amount"),
]

FACT = f"""fact AS (
  SELECT *, md5(rate_id || '||' || amount_kind) AS observation_id,
    CASE WHEN scope = 'standard_charge' THEN 'standard' WHEN methodology IN ('fee schedule', 'case rate', 'per diem') THEN 'comparable_dollar' ELSE 'derived_dollar' END AS amount_tier,
    amount_kind IN ('gross_charge', 'discounted_cash') OR (amount_kind = 'negotiated_dollar' AND methodology IN ('fee schedule', 'case rate', 'per diem')) AS is_price_rankable
  FROM ({" UNION ALL ".join(f"SELECT *, '{k}' AS amount_kind, '{s}' AS scope, '{r}' AS amount_role, '{u}' AS amount_unit, {'cast(NULL AS DECIMAL(18,4))' if u == 'text' else c} AS amount_value, {c if u == 'text' else 'cast(NULL AS VARCHAR)'} AS raw_algorithm_value FROM rates WHERE {c} IS NOT NULL" for k, s, r, u, c in _KINDS)}))"""

BRIDGE = r"""bridge AS (
  SELECT item_id, code_system, match_code, code_comparable, code_is_specific, md5(code_system || '||' || match_code) AS service_code_key
  FROM (
    SELECT DISTINCT item_id, 'brand' AS code_system, upper(regexp_replace(p_brand, '\s+', '', 'g')) AS match_code, true AS code_comparable, true AS code_is_specific FROM rates
    UNION ALL SELECT DISTINCT item_id, 'type', upper(regexp_replace(p_type, '\s+', '', 'g')), true, false FROM rates
    UNION ALL SELECT DISTINCT item_id, 'local', cast(p_size AS VARCHAR), false, false FROM rates))"""

BLOCKERS = {
    "not_current_snapshot": "NOT is_current",
    "code_not_cross_hospital_comparable": "NOT coalesce(code_comparable, false)",
    "code_not_specific": "coalesce(code_comparable, false) AND NOT coalesce(code_is_specific, false)",
    "missing_match_code": "match_code IS NULL",
    "non_rankable_amount": "amount_unit <> 'usd' OR amount_role IN ('allowed_amount_stat', 'estimated')",
    "derived_dollar": "amount_tier = 'derived_dollar'",
    "modifier_context_required": "has_split_modifier",
    "drug_unit_context_missing": "is_drug AND drug_unit_status = 'missing_unit'",
    "payer_unmatched": "scope = 'payer_rate' AND payer_id = '<unmatched>'",
    "market_segment_unknown": "market_segment = 'unknown'",
}

SPINE = f"""spine AS (
  SELECT *, {", ".join(f"({c}) AS {n}" for n, c in BLOCKERS.items())},
    CASE WHEN NOT coalesce(code_comparable, false) THEN 'tier_0_trace_only'
      WHEN coalesce(code_is_specific, false) AND match_code IS NOT NULL AND setting IS NOT NULL AND billing_class IS NOT NULL THEN 'tier_2_context_aligned'
      ELSE 'tier_1_code_backed' END AS comparison_tier,
    md5(coalesce(service_code_key, '<null>') || '||' || coalesce(setting, '<null>') || '||' || coalesce(billing_class, '<null>') || '||' || modifier_signature || '||' || amount_kind
      || '||' || coalesce(comparison_methodology, '<null>') || '||' || coalesce(drug_unit, '<none>')) AS service_context_key,
    list_filter([{", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in BLOCKERS.items())}], lambda x: x IS NOT NULL) AS blocker_reasons
  FROM (
    SELECT f.*, b.* EXCLUDE (item_id), s.is_current, CASE WHEN amount_kind = 'negotiated_dollar' THEN methodology ELSE 'not applicable' END AS comparison_methodology
    FROM fact f LEFT JOIN (SELECT * FROM bridge WHERE code_comparable) b ON f.item_id = b.item_id JOIN (SELECT snapshot_id, is_current FROM snapshots) s ON f.snapshot_id = s.snapshot_id))"""

_RANKED = "is_current AND comparison_tier = 'tier_2_context_aligned' AND is_price_rankable"

REPRESENTATIVES = f"""reps AS (
  SELECT hospital_id, snapshot_id, service_context_key, md5(payer_name || '||' || plan_name) AS contract_key, min(payer_id) AS payer_id, min(market_segment) AS market_segment,
    min(service_code_key) AS service_code_key, min(comparison_methodology) AS comparison_methodology, count(*) AS raw_observation_count,
    count(DISTINCT amount_value) AS distinct_amount_count, count(DISTINCT item_id) AS distinct_item_count, min(amount_value) AS contract_amount_min, max(amount_value) AS contract_amount_max,
    CASE WHEN count(DISTINCT amount_value) = 1 THEN min(amount_value) END AS contract_amount, count(DISTINCT amount_value) > 1 AS has_multiple_amounts
  FROM spine WHERE {_RANKED} AND amount_kind = 'negotiated_dollar' GROUP BY ALL)"""

AMOUNTS = f"""amounts AS (
  SELECT hospital_id, service_context_key, 'negotiated_dollar' AS amount_kind, cast(sum(raw_observation_count) AS BIGINT) AS raw_observation_count, count(*) AS contract_count,
    count(*) FILTER (WHERE NOT has_multiple_amounts) AS valid_contract_count, count(*) FILTER (WHERE has_multiple_amounts) AS ambiguous_contract_count,
    count(DISTINCT CASE WHEN payer_id <> '<unmatched>' THEN payer_id END) AS matched_payer_count, median(cast(contract_amount AS DOUBLE)) AS hospital_amount
  FROM reps GROUP BY hospital_id, service_context_key
  UNION ALL
  SELECT hospital_id, service_context_key, amount_kind, count(*), NULL, NULL, NULL, 0, median(cast(amount_value AS DOUBLE))
  FROM spine WHERE {_RANKED} AND amount_kind IN ('gross_charge', 'discounted_cash') GROUP BY hospital_id, service_context_key, amount_kind)"""

_PARTS = [("hospitals", HOSPITALS), ("rates", RATES), ("snapshots", SNAPSHOTS), ("fact", FACT), ("bridge", BRIDGE), ("spine", SPINE), ("reps", REPRESENTATIVES), ("amounts", AMOUNTS)]


def model(body: str) -> str:
    """The body with the model's tables before it; a body that begins with a comma adds tables of its own. Unused tables cost nothing."""
    return "WITH " + ",\n".join(p for _, p in _PARTS) + "\n" + body
