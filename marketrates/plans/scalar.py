"""Queries over cleaning, codes, reshaping, snapshots and windows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import casts, codes, keys, semantics, text
from ..operators import compare, reshape, scope
from ..operators.ordinal import with_ordinals
from .registry import query

# --- scalar functions -------------------------------------------------------------------------------------------------------------------------------------

_NULLS = ", ".join(f"'{t}'" for t in text.NULL_TOKENS)


def _clean(x: str, lower: bool = True) -> str:
    t = rf"trim(regexp_replace(cast({x} AS VARCHAR), '\s+', ' ', 'g'))"
    kept = f"CASE WHEN lower({t}) NOT IN ({_NULLS}) THEN {t} END"
    return f"lower({kept})" if lower else kept


@query(
    "clean_text",
    f"SELECT doc_id, md5({_clean('text')}) AS text_md5, length({_clean('text', False)}) AS display_length, {_clean('source')} AS source, {_clean(chr(39) + '  N/A ' + chr(39))} AS nothing FROM documents",
)
def _(m):
    t = F.col("text")
    return m.table("documents").select("doc_id", F.md5(text.clean_text(t)).alias("text_md5"), F.length(text.clean_display_text(t)).cast("long").alias("display_length"), text.clean_text(F.col("source")).alias("source"), text.clean_text(F.lit("  N/A ")).alias("nothing"))


@query(
    "title_case",
    """WITH p AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Not  Available' WHEN 1 THEN '  ' || upper(p_name) || '  x' ELSE p_name END AS name FROM part),
       w AS (SELECT p_partkey, generate_subscripts(regexp_split_to_array(trim(lower(name)), ' +'), 1) AS i, unnest(regexp_split_to_array(trim(lower(name)), ' +')) AS word FROM p WHERE name <> 'Not  Available')
       SELECT p_partkey, title FROM p LEFT JOIN (SELECT p_partkey, string_agg(upper(left(word, 1)) || substr(word, 2), ' ' ORDER BY i) AS title FROM w GROUP BY p_partkey) USING (p_partkey)""",
)
def _(m):
    k, name = F.col("p_partkey"), F.col("p_name")
    odd = F.when(k % 5 == 0, "Not  Available").when(k % 5 == 1, F.concat(F.lit("  "), F.upper(name), F.lit("  x"))).otherwise(name)
    return m.table("part").select("p_partkey", text.title_case(odd).alias("title"))


@query(
    "safe_casts",
    """SELECT o_orderkey, try_cast(lower(left(o_orderpriority, 1)) AS BIGINT) AS priority, try_cast(lower(o_orderpriority) AS DOUBLE) AS not_a_number,
       try_cast(cast(cast(o_orderdate AS DATE) AS VARCHAR) AS DATE) AS day, try_cast(cast(o_custkey AS VARCHAR) || '.125' AS DECIMAL(18,4)) AS amount,
       o_custkey / nullif(cast(o_custkey % 3 AS DOUBLE), 0) AS ratio FROM orders""",
)
def _(m):
    return m.table("orders").select(
        "o_orderkey",
        casts.safe_bigint(F.left("o_orderpriority", F.lit(1))).alias("priority"),
        casts.safe_double(F.col("o_orderpriority")).alias("not_a_number"),
        casts.safe_date(F.to_date("o_orderdate").cast("string")).alias("day"),
        casts.safe_decimal(F.concat(F.col("o_custkey").cast("string"), F.lit(".125"))).alias("amount"),
        casts.ratio(F.col("o_custkey"), F.col("o_custkey") % 3).alias("ratio"),
    )


@query("surrogate_key", "SELECT o_orderkey, md5(o_orderkey || '||' || o_orderpriority || '||' || coalesce(nullif(o_orderstatus, 'P'), '<null>')) AS key FROM orders")
def _(m):
    return m.table("orders").select("o_orderkey", keys.surrogate_key("o_orderkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("P"))).alias("key"))


@query(
    "description_tokens",
    r"""WITH spelt AS (SELECT doc_id, replace(regexp_replace(regexp_replace(lower(text), '\bw/o\b', ' without ', 'g'), '\bw/', ' with ', 'g'), '&', ' and ') AS t FROM documents),
       w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(t, '[a-z0-9]+')) AS word FROM spelt),
       j AS (SELECT doc_id, md5(string_agg(word, ' ' ORDER BY word)) AS tokens_md5 FROM w GROUP BY doc_id)
       SELECT doc_id, tokens_md5 FROM documents LEFT JOIN j USING (doc_id)""",
)
def _(m):
    return m.table("documents").select("doc_id", F.md5(text.description_tokens(F.col("text"))).alias("tokens_md5"))


@query("service_slug", "SELECT page_id, trim(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM pages")
def _(m):
    return m.table("pages").select("page_id", text.slug(F.col("url")).alias("slug"))


_SLUG = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '-')"


@query(
    "context_slugs",
    f"""SELECT rate_id, {_SLUG.format("description")} || '-negotiated-' || {_SLUG.format("methodology")} || '-' || left(rate_id, 10) AS slug,
       CASE methodology WHEN 'case rate' THEN 'Case rate (per episode)' WHEN 'fee schedule' THEN 'Fee schedule (per item/service)' WHEN 'per diem' THEN 'Per diem (per day)' ELSE methodology END AS label,
       {_SLUG.format("description")} || '-list-' || left(rate_id, 10) AS list_slug,
       CASE WHEN p_size > 25 THEN 'available' WHEN p_type = 'SMALL' THEN 'license_restricted' ELSE 'not_loaded' END AS availability FROM rates""",
    model=True,
)
def _(m):
    described = F.when(F.col("p_size") > 25, F.col("description"))
    return m.rates.select(
        "rate_id", text.context_slug(F.col("description"), F.lit("negotiated_dollar"), F.col("methodology"), F.col("rate_id")).alias("slug"),
        text.context_slug(F.col("description"), F.lit("gross_charge"), F.lit("not applicable"), F.col("rate_id")).alias("list_slug"), text.methodology_label(F.col("methodology")).alias("label"), text.description_availability(described, F.col("is_drug")).alias("availability"),
    )


@query(
    "plan_type_tokens",
    r"""WITH p AS (SELECT o_orderkey, lower(o_orderpriority) || ' ' || ['ppo', 'gold hmo', 'dhmo', 'ppo/hmo', 'hdhp-1', 'pos'][o_custkey % 6 + 1] AS plan FROM orders),
       t AS (SELECT *, list_filter(['ppo', 'hmo', 'pos', 'epo', 'pffs', 'hdhp'], lambda x: regexp_matches(plan, '(^|[^a-z0-9])' || x || '([^a-z0-9]|$)')) AS hits FROM p)
       SELECT o_orderkey, plan, CASE WHEN len(hits) = 1 THEN hits[1] END AS plan_type FROM t""",
)
def _(m):
    kinds = F.element_at(F.array(*[F.lit(x) for x in ("ppo", "gold hmo", "dhmo", "ppo/hmo", "hdhp-1", "pos")]), (F.col("o_custkey") % 6 + 1).cast("int"))
    own = m.table("orders").withColumn("plan", F.concat_ws(" ", F.lower("o_orderpriority"), kinds))
    return own.select("o_orderkey", "plan", semantics.plan_type(F.col("plan")).alias("plan_type"))


@query(
    "count_bounds",
    """WITH c AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 5 THEN '0' WHEN l_quantity < 15 THEN '1 through 10' WHEN l_quantity < 20 THEN 'about 12'
         WHEN l_quantity < 25 THEN '0' || cast(cast(l_quantity AS BIGINT) AS VARCHAR) WHEN l_quantity < 30 THEN ' ' || cast(cast(l_quantity AS BIGINT) AS VARCHAR) || '00000000000' ELSE cast(cast(l_quantity AS BIGINT) AS VARCHAR) END AS n FROM lineitem),
       t AS (SELECT *, trim(n) AS x, regexp_full_match(trim(n), '[1-9][0-9]+') AND try_cast(n AS BIGINT) > 10 AS whole FROM c)
       SELECT l_orderkey, l_linenumber, n, CASE WHEN x = '0' THEN 0 WHEN x = '1 through 10' THEN 1 WHEN whole THEN try_cast(x AS BIGINT) END AS low,
       CASE WHEN x = '0' THEN 0 WHEN x = '1 through 10' THEN 10 WHEN whole THEN try_cast(x AS BIGINT) END AS high FROM t""",
)
def _(m):
    q = F.col("l_quantity")
    whole = q.cast("long").cast("string")
    n = F.when(q < 5, "0").when(q < 15, "1 through 10").when(q < 20, "about 12").when(q < 25, F.concat(F.lit("0"), whole)).when(q < 30, F.concat(F.lit(" "), whole, F.lit("00000000000"))).otherwise(whole)
    own = m.table("lineitem").select("l_orderkey", "l_linenumber", n.alias("n"))
    return own.select("*", semantics.count_min(F.col("n")).alias("low"), semantics.count_max(F.col("n")).alias("high"))


@query(
    "amount_semantics",
    """SELECT rate_id, ['percentage', 'algorithm', 'dollar', 'none', 'estimated'][p_size % 5 + 1] AS kind,
       CASE p_size % 5 WHEN 0 THEN 'percentage' WHEN 1 THEN 'algorithm' WHEN 2 THEN CASE WHEN methodology = 'other' THEN 'derived_dollar' ELSE 'comparable_dollar' END ELSE 'none' END AS tier,
       CASE WHEN p_size % 3 > 0 THEN methodology END AS methodology, CASE WHEN drug_unit IS NOT NULL THEN 'unit' WHEN billing_class IS NOT NULL THEN 'class' ELSE 'none' END AS chosen FROM rates""",
    model=True,
)
def _(m):
    of = lambda k, v: F.when(F.col("p_size") % 5 == k, v)
    kind = semantics.amount_kind(of(2, F.col("negotiated")), of(0, F.lit(50.0)), of(1, F.lit("list")), of(4, F.lit(1.0)))
    stated = F.when(F.col("p_size") % 3 == 1, F.concat(F.lit(" "), F.upper("methodology"))).when(F.col("p_size") % 3 == 2, F.initcap("methodology")).otherwise(F.concat(F.lit("about "), F.col("methodology")))
    own = m.rates.withColumn("kind", kind)
    return own.select(
        "rate_id", "kind", semantics.amount_tier(F.col("kind"), F.col("methodology")).alias("tier"), semantics.canonical_methodology(stated).alias("methodology"),
        semantics.chosen_source(unit=F.col("drug_unit"), **{"class": F.col("billing_class")}).alias("chosen"),
    )


#: Codes as they might be published: (system, code); where the system is not known its type is kept, where there is no type both are null.
_CODES = [
    ("rc", "450"), ("rc", "0450"), ("rc", "45O"), ("drg", "7"), ("ms-drg", "5"), ("ms-drg", "1234"), ("tris-drg", "45"), ("ms-ltc-drg", "9"), ("apc", "604"), ("apc", "05302"), ("apc", "15302"), ("eapg", "12"), ("cmg", "a 1"),
    ("ndc", "1234-5678-90"), ("ndc", "12345-678-90"), ("ndc", "12345-6789-0"), ("ndc", "12345-6789-01"), ("ndc", "12345678901"), ("ndc", "1234567890"), ("ndc", "12345-67890"), ("ndc", "12345678"), ("cdm", "ABC 123"), ("local", "pharm 001"),
    ("hcpcs", "j1100"), ("hcpcs", "J1100TC26"), ("cpt", "99213"), ("cpt", "0001U"), ("cpt", "9921"), ("hipps", "x1"), ("cdt", "D0120"), ("icd", "A00"), ("rc", None), (None, "123"), ("mystery code", "456"),
]
_UNKNOWN = "mystery code"


def _code_rows() -> str:
    text = lambda x: "NULL" if x is None else f"'{x}'"
    return ", ".join(f"({i}, {text(k)}, {text(c)})" for i, (k, c) in enumerate(_CODES))


@query(
    "code_status",
    f"""WITH k AS (SELECT * FROM (VALUES {_code_rows()}) AS t(i, kind, code)), c AS (SELECT p_partkey, kind, nullif(kind, '{_UNKNOWN}') AS system, code FROM part JOIN k ON p_partkey % {len(_CODES)} = i),
       d AS (SELECT *, regexp_replace(code, '[^0-9]', '', 'g') AS digits FROM c),
       n AS (SELECT *, CASE WHEN system <> 'ndc' THEN NULL WHEN length(digits) = 11 THEN digits WHEN regexp_full_match(code, '\\d{{4}}-\\d{{4}}-\\d{{2}}') THEN concat('0', digits)
           WHEN regexp_full_match(code, '\\d{{5}}-\\d{{3}}-\\d{{2}}') THEN concat(left(digits, 5), '0', right(digits, 5)) WHEN regexp_full_match(code, '\\d{{5}}-\\d{{4}}-\\d') THEN concat(left(digits, 9), '0', right(digits, 1)) END AS ndc,
         CASE WHEN system <> 'ndc' OR system IS NULL OR code IS NULL THEN NULL WHEN regexp_full_match(code, '\\d{{11}}') THEN 'canonical_11_unhyphenated' WHEN length(digits) = 11 THEN 'canonical_11'
           WHEN regexp_full_match(code, '\\d{{4}}-\\d{{4}}-\\d{{2}}') THEN 'padded_from_10_4_4_2' WHEN regexp_full_match(code, '\\d{{5}}-\\d{{3}}-\\d{{2}}') THEN 'padded_from_10_5_3_2'
           WHEN regexp_full_match(code, '\\d{{5}}-\\d{{4}}-\\d') THEN 'padded_from_10_5_4_1' WHEN regexp_full_match(code, '\\d{{10}}') THEN 'ambiguous_10_unhyphenated' WHEN length(digits) = 10 THEN 'invalid_layout' ELSE 'invalid_length' END AS ndc_status FROM d),
       m AS (SELECT *, CASE WHEN system IN ('rc', 'apc') AND regexp_full_match(code, '\\d{{1,4}}') OR system LIKE '%drg' AND regexp_full_match(code, '\\d{{1,3}}') THEN lpad(code, CASE WHEN system LIKE '%drg' THEN 3 ELSE 4 END, '0')
           WHEN system = 'apc' AND regexp_full_match(code, '0\\d{{4}}') THEN right(code, 4) WHEN system = 'ndc' AND ndc IS NOT NULL THEN ndc ELSE upper(regexp_replace(code, '\\s', '', 'g')) END AS match_code FROM n)
       SELECT p_partkey, system, match_code, ndc_status,
         CASE WHEN code IS NULL THEN 'missing_code' WHEN kind IS NULL THEN 'missing_code_system' WHEN system IS NULL THEN 'unknown_code_system' WHEN system NOT IN ('rc', 'ms-drg', 'cpt', 'hcpcs', 'ndc') THEN 'not_validated'
           WHEN CASE system WHEN 'rc' THEN regexp_full_match(match_code, '\\d{{4}}') WHEN 'ms-drg' THEN regexp_full_match(match_code, '\\d{{3}}') WHEN 'ndc' THEN ndc IS NOT NULL
             WHEN 'cpt' THEN regexp_full_match(match_code, '\\d{{4}}[0-9A-Z]') ELSE regexp_full_match(match_code, '[A-Z]\\d{{4}}|\\d{{4}}[0-9A-Z]') END THEN 'valid' ELSE 'invalid_format' END AS status,
         system IS NOT NULL AND system NOT IN ('cdm', 'local') AS comparable, system IS NOT NULL AND system NOT IN ('rc', 'cdm', 'local', 'icd') AS specific FROM m""".replace("\\\\", "\\"),
)
def _(m):
    known = m.spark.createDataFrame([(i, k, c) for i, (k, c) in enumerate(_CODES)], "i int, kind string, code string")
    own = m.table("part").join(known, F.col("p_partkey") % len(_CODES) == F.col("i")).select("p_partkey", "kind", F.nullif("kind", F.lit(_UNKNOWN)).alias("system"), "code")
    s, c, k = F.col("system"), F.col("code"), F.col("kind")
    own = own.withColumn("match_code", codes.match_code(s, c))
    status = codes.code_status(c, k, s, F.col("match_code"))
    return own.select("p_partkey", "system", "match_code", F.when(s == "ndc", codes.ndc_status(c)).alias("ndc_status"), status.alias("status"), codes.comparable_across_publishers(s).alias("comparable"), codes.is_specific(s).alias("specific"))


@query(
    "drug_and_modifier_status",
    """SELECT drug_unit_status AS status, CASE WHEN modifier_text IS NULL THEN 'none' WHEN modifier_text LIKE '%|%' THEN 'known' ELSE 'known' END AS modifier, count(*) AS n
       FROM (SELECT CASE WHEN NOT is_drug THEN 'missing_unit' WHEN drug_unit IS NULL THEN 'missing_unit' ELSE 'canonical' END AS drug_unit_status, modifier_text FROM rates) GROUP BY ALL""",
    model=True,
)
def _(m):
    status = codes.drug_unit_status(F.col("drug_unit"), F.when(F.col("drug_unit") == "ml", "ml"))
    first = F.try_element_at("modifiers", F.lit(1))
    modifier = F.when(first.isNull(), "none").otherwise(codes.modifier_status(F.when(first.isin("26", "TC"), first)))
    return m.rates.groupBy(status.alias("status"), modifier.alias("modifier")).agg(F.count("*").alias("n"))


# --- reshape ----------------------------------------------------------------------------------------------------------------------------------------------


@query(
    "code_slot_unpivot",
    """WITH s AS (SELECT DISTINCT p_partkey, p_brand, p_type, nullif(cast(p_size AS VARCHAR), '1') AS size FROM part)
       SELECT p_partkey, 1 AS code_ordinal, trim(p_brand) AS code, 'brand' AS code_type FROM s UNION ALL SELECT p_partkey, 2, trim(p_type), 'type' FROM s
       UNION ALL SELECT p_partkey, 3, size, 'local' FROM s WHERE size IS NOT NULL""",
)
def _(m):
    own = m.table("part").select("p_partkey", F.col("p_brand").alias("code_1"), F.lit("Brand").alias("type_1"), F.col("p_type").alias("code_2"), F.lit("type").alias("type_2"), F.nullif(F.col("p_size").cast("string"), F.lit("1")).alias("code_3"), F.lit("local").alias("type_3"))
    return reshape.unpivot_slots(own, [(f"code_{i}", f"type_{i}") for i in (1, 2, 3)], ["p_partkey"])


@query(
    "delimited_split",
    """SELECT rate_id, cast(i - 1 AS BIGINT) AS ordinal, string_split(modifier_text, '|')[i] AS modifier FROM (SELECT *, unnest(range(1, len(string_split(modifier_text, '|')) + 1)) AS i FROM rates WHERE modifier_text IS NOT NULL)""",
    model=True,
)
def _(m):
    own = m.rates.select("rate_id", F.nullif(F.array_join("modifiers", "|"), F.lit("")).alias("joined")).filter("joined is not null")
    return reshape.split_ordinal(own, "joined", value="modifier").select("rate_id", F.col("ordinal").cast("long").alias("ordinal"), "modifier")


@query(
    "map_explode",
    """SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL
       UNION ALL SELECT event_id, 'kind', event_type FROM events""",
)
def _(m):
    own = m.table("events").select("event_id", F.map_concat(F.coalesce(F.from_json("props", "map<string,string>"), F.create_map().cast("map<string,string>")), F.create_map(F.lit("kind"), F.col("event_type"))).alias("map"))
    return reshape.explode_map(own, "map")


@query(
    "union_map_keys",
    """SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS before_value, CAST(NULL AS VARCHAR) AS after_value FROM events
       UNION ALL SELECT event_id, 'kind', NULL, event_type FROM events UNION ALL SELECT event_id, 'user', 'u', cast(user_id AS VARCHAR) FROM events""",
)
def _(m):
    before = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("user"), F.lit("u")))
    after = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))
    return reshape.union_keys(m.table("events").select("event_id", before.alias("before"), after.alias("after")), "before", "after")


@query(
    "pivot_back",
    """SELECT snapshot_id, max(gross) AS gross_charge, max(cash) AS discounted_cash, max(negotiated) AS negotiated_dollar FROM rates GROUP BY snapshot_id""",
    model=True,
)
def _(m):
    return reshape.pivot_back(m.fact, ["snapshot_id"], "amount_kind", "amount_value", {k: k for k in compare.RANKED_KINDS})


@query(
    "payer_cash_bands",
    """, b AS (SELECT payer_id, CASE WHEN negotiated < cash THEN 'below' WHEN negotiated = cash THEN 'equal' WHEN negotiated <= gross THEN 'above' ELSE 'above_gross' END AS band, count(*) AS n FROM rates GROUP BY ALL)
       SELECT p.payer_id, g.band, coalesce(n, 0) AS n FROM (SELECT DISTINCT payer_id FROM rates) p CROSS JOIN (SELECT unnest(['below', 'equal', 'above', 'above_gross']) AS band) g LEFT JOIN b ON b.payer_id = p.payer_id AND b.band = g.band""",
    model=True,
)
def _(m):
    band = F.when(F.col("negotiated") < F.col("cash"), "below").when(F.col("negotiated") == F.col("cash"), "equal").when(F.col("negotiated") <= F.col("gross"), "above").otherwise("above_gross")
    counts = m.rates.groupBy("payer_id", band.alias("band")).agg(F.count("*").alias("n"))
    grid = reshape.with_bands(m.rates.select("payer_id").distinct(), ["below", "equal", "above", "above_gross"])
    return grid.join(counts, ["payer_id", "band"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


# --- snapshots, windows -----------------------------------------------------------------------------------------------------------------------------------


@query("snapshot_currentness", "SELECT hospital_id, snapshot_id, valid_from, valid_to, is_current, age_days, freshness FROM snapshots", model=True)
def _(m):
    return m.snapshots.select("hospital_id", "snapshot_id", "valid_from", "valid_to", "is_current", "age_days", "freshness")


@query(
    "arrival_change_detection",
    """SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE event_type IS DISTINCT FROM p""",
)
def _(m):
    return scope.changed_arrivals(m.table("events"), "user_id", ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type")


@query(
    "latest_run_state",
    """SELECT user_id, event_id, event_type, n_events FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn, count(*) OVER (PARTITION BY user_id) AS n_events FROM events) WHERE rn = 1""",
)
def _(m):
    own = m.table("events").groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type")).alias("x"), F.count("*").alias("n_events"))
    return own.select("user_id", "x.event_id", "x.event_type", "n_events")


@query(
    "attempt_stages",
    """SELECT user_id, event_type AS stage, count(*) AS attempts, min(event_id) AS first_event, max(event_id) AS last_event, round(sum(value), 2) AS total FROM events GROUP BY ALL""",
)
def _(m):
    return m.table("events").groupBy("user_id", F.col("event_type").alias("stage")).agg(F.count("*").alias("attempts"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"), F.round(F.sum("value"), 2).alias("total"))


@query(
    "derived_ordinal",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) - 1 AS ordinal FROM lineitem""",
)
def _(m):
    own = m.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    placed = with_ordinals(own, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"], first=0)
    return placed.drop("l_shipdate", "l_extendedprice")


@query(
    "source_ordinal",
    """SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS ordinal FROM lineitem""",
)
def _(m):
    """Ordinals of a few groups that each hold much of the table."""
    own = m.table("lineitem").select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    placed = with_ordinals(own, ["l_returnflag", "l_linestatus"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"])
    return placed.drop("l_suppkey", "l_shipdate", "l_extendedprice")


@query("dedupe_first", "SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL")
def _(m):
    return m.table("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))


@query(
    "turn_ordinals",
    "SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS role_ordinal FROM conversations",
)
def _(m):
    return m.table("conversations").select("conv_id", "turn", "role", (F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn")) - 1).cast("long").alias("role_ordinal"))
