"""Marts with the names, labels and slugs that pages show; base tables of the metadata; staging projections and small scans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import semantics, text
from ..operators import base, compare, published_rules, quality, reshape, rules
from ..sources import ingest, shared, sinks
from . import market
from .registry import MARKET, query, r4

# --- marts --------------------------------------------------------------------------------------------------------------------------------------------------

_SLUG = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '-')"
_SERVICE = f"""dc AS (SELECT upper(replace(p_brand, ' ', '')) AS described_code, arg_max(p_name, (p_size, p_name)) AS code_description FROM part GROUP BY 1),
  md AS (SELECT modifier_signature, CASE min(modifier_text) WHEN '26' THEN 'Professional component' WHEN 'TC' THEN 'Technical component' WHEN '26|TC' THEN 'Professional component, Technical component' ELSE 'No modifier' END AS modifier_label
    FROM rates GROUP BY 1),
  nm AS (SELECT DISTINCT service_context_key, code_system, match_code, setting, billing_class, modifier_signature, amount_kind, comparison_methodology FROM spine WHERE is_current AND comparison_tier = 'tier_2_context_aligned'),
  lb AS (SELECT nm.*, modifier_label AS modifier_display_label, {_SLUG.format("code_system || ' ' || match_code")} AS service_url_slug, upper(code_system) || ' ' || match_code AS service_display_code,
    coalesce(code_description, 'Description not available') AS service_display_name, upper(code_system) || ' ' || match_code || coalesce(' - ' || code_description, '') AS service_display_label,
    CASE WHEN code_description IS NOT NULL THEN 'available' WHEN code_system = 'type' THEN 'license_restricted' ELSE 'not_loaded' END AS description_availability,
    CASE comparison_methodology WHEN 'case rate' THEN 'Case rate (per episode)' WHEN 'fee schedule' THEN 'Fee schedule (per item/service)' WHEN 'per diem' THEN 'Per diem (per day)' WHEN 'not applicable' THEN 'Not applicable' ELSE comparison_methodology END
      AS methodology_display_label,
    concat_ws('-', {_SLUG.format("code_system || ' ' || match_code")}, CASE amount_kind WHEN 'negotiated_dollar' THEN 'negotiated' WHEN 'discounted_cash' THEN 'cash' ELSE 'list' END,
      CASE WHEN comparison_methodology <> 'not applicable' THEN {_SLUG.format("comparison_methodology")} END, left(service_context_key, 10)) AS service_context_url_slug, code_description IS NOT NULL AS described
    FROM nm LEFT JOIN dc ON match_code = described_code LEFT JOIN md USING (modifier_signature))"""
_SHOWN = "service_context_key, service_url_slug, service_display_code, service_display_name, service_display_label, description_availability, setting, billing_class, modifier_display_label, amount_kind, methodology_display_label, service_context_url_slug"


def _labelled(m):
    """A row per context with what pages show of it; descriptions, modifiers and codes are a row each before they meet contexts."""
    described = m.table("part").groupBy(F.upper(F.regexp_replace("p_brand", " ", "")).alias("match_code")).agg(F.max_by("p_name", F.struct("p_size", "p_name")).alias("code_description"))
    names = F.transform("modifiers", lambda x: F.when(x == "26", "Professional component").when(x == "TC", "Technical component").otherwise(x))
    label = F.when(F.size("modifiers") > 0, F.array_join(names, ", ")).otherwise("No modifier")
    modifiers = m.rates.groupBy("modifier_signature").agg(F.min(label).alias("modifier_display_label"))
    codes = m.bridge.select("service_code_key", "code_system").distinct()
    own = m.ranked.select("service_context_key", "service_code_key", "match_code", "setting", "billing_class", "modifier_signature", "amount_kind", "comparison_methodology").distinct()
    own = own.join(codes, "service_code_key").join(described, "match_code", "left").join(modifiers, "modifier_signature", "left")
    service, code = F.concat_ws(" ", "code_system", "match_code"), F.concat_ws(" ", F.upper("code_system"), "match_code")
    return own.withColumns(
        {
            "service_url_slug": text.slug(service), "service_display_code": code, "service_display_name": F.coalesce("code_description", F.lit("Description not available")),
            "service_display_label": F.concat(code, F.coalesce(F.concat(F.lit(" - "), "code_description"), F.lit(""))),
            "description_availability": text.description_availability(F.col("code_description"), F.col("code_system") == "type"), "methodology_display_label": text.methodology_label(F.col("comparison_methodology")),
            "service_context_url_slug": text.context_slug(service, F.col("amount_kind"), F.col("comparison_methodology"), F.col("service_context_key")), "described": F.col("code_description").isNotNull(),
        }
    )


@query(
    "bi_service_market",
    market._more(
        market._SUMMARY + ", " + _SERVICE,
        f"""SELECT {_SHOWN}, observation_count, contract_count, reporting_hospital_count, hospital_count, excluded_hospital_count, ambiguous_contract_count, CASE WHEN hospital_count >= 3 THEN round(p50, 4) END AS median_amount,
       CASE WHEN hospital_count >= 3 THEN round(p90 - p10, 4) END AS spread_amount,
       CASE WHEN hospital_count < 3 THEN 'insufficient_denominator' WHEN described THEN 'described_comparable' ELSE 'code_only_comparable' END AS comparison_status,
       CASE WHEN hospital_count < 3 THEN 'low' WHEN hospital_count >= 10 AND described THEN 'high' WHEN hospital_count >= 5 THEN 'moderate' ELSE 'limited' END AS comparison_confidence_band,
       CASE WHEN hospital_count < 3 THEN 'not_ranked' WHEN p10 <> 0 AND round(p90 / p10, 6) >= 3 THEN 'very_high_variation' WHEN p10 <> 0 AND round(p90 / p10, 6) >= 2 THEN 'high_variation' ELSE 'moderate_variation' END AS variation_band
       FROM g JOIN lb USING (service_context_key)""",
    ),
    model=True,
    keep=MARKET,
)
def _(m):
    """The market of each context as its page shows it: names, slugs, counts, amounts, status and bands."""
    own = compare.distribution(m.amounts).join(_labelled(m), "service_context_key")
    enough = F.col("meets_threshold")
    status = F.when(~enough, "insufficient_denominator").when(F.col("described"), "described_comparable").otherwise("code_only_comparable")
    counts = ["observation_count", "contract_count", "reporting_hospital_count", "hospital_count", "excluded_hospital_count", "ambiguous_contract_count"]
    return own.select(
        *_SHOWN.split(", "), *counts, r4("median_amount").alias("median_amount"), r4(F.col("p90_amount") - F.col("p10_amount")).alias("spread_amount"), status.alias("comparison_status"),
        semantics.comparison_confidence(enough, F.col("hospital_count"), F.col("described")).alias("comparison_confidence_band"), semantics.variation(enough, r4("spread_p90_to_p10", 6)).alias("variation_band"),
    )


_PAYER_HEAD, _PAYER_TAIL = market._PAYER_SQL.rsplit("\n       SELECT payer_id", 1)


@query(
    "bi_payer_contracting",
    f"""{_PAYER_HEAD}, pb AS (SELECT payer_id{_PAYER_TAIL}), {_SERVICE}
       SELECT pb.*, hospital_name AS hospital_display_name, h.state, health_system, hospital_type, lb.* EXCLUDE (service_context_key, code_system, match_code, modifier_signature, comparison_methodology, described)
       FROM pb JOIN lb USING (service_context_key) LEFT JOIN hospitals h USING (hospital_id)""",
    model=True,
    keep=MARKET,
)
def _(m):
    """Each payer's price at each publisher in each context with the names, labels and slugs of all three."""
    own = market._payer_benchmarks(m).join(_labelled(m).select(*_SHOWN.split(", ")), "service_context_key")
    hospitals = m.hospitals.select("hospital_id", F.col("hospital_name").alias("hospital_display_name"), "state", "health_system", "hospital_type")
    return own.join(hospitals, "hospital_id", "left")


_SPARSE = ["gross", "cash", "minimum", "maximum", "negotiated", "percentage", "algorithm", "estimated_amount", "median_amount", "p10_amount", "p90_amount"]


@query(
    "profile_amount_sparsity",
    ", " + "x AS (" + " UNION ALL ".join(f"SELECT methodology, '{c}' AS column_name, count(*) AS row_count, count({c}) AS present_count FROM rates GROUP BY methodology" for c in _SPARSE) + ") SELECT *, round(present_count / row_count, 6) AS present_rate FROM x",
    model=True,
)
def _(m):
    """How often each stated amount is filled, by method of payment."""
    return quality.sparsity(m.rates, ["methodology"], _SPARSE)


# --- base tables of the metadata ------------------------------------------------------------------------------------------------------------------------------


@query(
    "base_metadata_children",
    """WITH c AS (SELECT c_custkey AS k FROM customer), m AS (SELECT k, 0 AS i FROM c WHERE k % 3 <> 0 UNION ALL SELECT k, 1 FROM c WHERE k % 4 <> 0 AND k % 6 <> 0)
       SELECT 'modifiers' AS table_name, k, count(*) AS n FROM m GROUP BY k UNION ALL SELECT 'modifier_payer_info', k, count(*) FROM m WHERE i = 0 OR k % 5 <> 0 GROUP BY k
       UNION ALL SELECT 'type2_npi', k, 1 FROM c WHERE k % 7 <> 0 UNION ALL SELECT 'provisions', k, 1 FROM c WHERE k % 2 <> 0 UNION ALL SELECT 'hospital_locations', k, 1 FROM c""",
)
def _(m):
    """Locations, identifiers, provisions, modifiers and their payers without what the rules reject; payers of rejected modifiers go with them."""
    k = F.col("c_custkey")
    payer = lambda d: F.struct(F.lit("p").alias("payer_name"), F.lit("q").alias("plan_name"), d.alias("description"))
    none = F.array().cast("array<struct<payer_name:string,plan_name:string,description:string>>")
    one = F.struct(F.when(k % 3 != 0, "26").alias("code"), F.lit("d").alias("description"), F.lit(None).cast("string").alias("setting"), F.array(payer(F.lit("x"))).alias("modifier_payer_information"))
    two = F.struct(F.lit("TC").alias("code"), F.lit("d").alias("description"), F.when(k % 4 == 0, "ward").otherwise("both").alias("setting"), F.when(k % 6 == 0, none).otherwise(F.array(payer(F.when(k % 5 != 0, "x")))).alias("modifier_payer_information"))
    header = F.struct(F.lit("h").alias("hospital_name"), F.array(F.lit("North")).alias("hospital_location"), F.array(F.lit("1 First St")).alias("hospital_address"), F.array(F.when(k % 7 == 0, "12").otherwise("1234567890")).alias("type_2_npi"))
    provision = F.array(F.struct(F.lit("p").alias("payer_name"), F.lit("q").alias("plan_name"), F.when(k % 2 != 0, "text").alias("provisions")))
    files = m.table("customer").select(k.alias("snapshot_id"), F.to_json(F.array(one, two)).alias("modifiers"), F.to_json(header).alias("header"), provision.alias("record"))
    heads, _ = ingest.split_json(files.select("snapshot_id", "header"), "header", ingest.HEADER)
    tables = ingest.flatten_headers(heads) | ingest.flatten_modifiers(files.select("snapshot_id", F.from_json("modifiers", f"array<{ingest.MODIFIER}>").alias("record")))
    tables = {n: tables[n] for n in ("hospital_locations", "type2_npi", "modifiers", "modifier_payer_info")} | {"provisions": ingest.flatten_provisions(files.select("snapshot_id", "record"))}
    counts = tables["modifier_payer_info"].groupBy("modifier_code_id").agg(F.count("*").alias("n"))
    told = {"format_family": F.lit("json"), "schema_family": F.lit("3.0"), "payer_count": F.coalesce("n", F.lit(0)), "has_amount_or_note": F.lit(False)}
    keys = {"type2_npi": ["snapshot_id", "npi_ordinal"], "modifiers": ["modifier_code_id"], "modifier_payer_info": ["modifier_code_id", "modifier_payer_ordinal"], "provisions": ["snapshot_id", "provision_ordinal"]}
    broken = {
        "type2_npi": rules.evaluate(tables["type2_npi"], published_rules.npi(), keys["type2_npi"]), "provisions": rules.evaluate(tables["provisions"], published_rules.provision(), keys["provisions"]),
        "modifiers": rules.evaluate(tables["modifiers"].join(counts, "modifier_code_id", "left").withColumns(told), published_rules.modifier(), keys["modifiers"]),
        "modifier_payer_info": rules.evaluate(tables["modifier_payer_info"], published_rules.modifier_payer(), keys["modifier_payer_info"]),
    }
    kept = base.metadata_children(tables, broken, keys, {"modifier_payer_info": "modifiers"})
    return reduce(lambda a, b: a.unionByName(b), [t.groupBy(F.col("snapshot_id").alias("k")).agg(F.count("*").alias("n")).withColumn("table_name", F.lit(n)) for n, t in kept.items()])


# --- small scans and families ---------------------------------------------------------------------------------------------------------------------------------


@query(
    "file_families",
    """SELECT s_suppkey, ['2.1', '2.2', '3.0', NULL, NULL][s_suppkey % 5 + 1] AS schema_family, ['json', 'csv', 'csv', 'other'][s_suppkey % 4 + 1] AS format_family FROM supplier""",
)
def _(m):
    """The families of schemas and formats that versions and formats belong to."""
    pick = lambda names, n: F.element_at(F.array(*[F.lit(x) for x in names]), (F.col("s_suppkey") % n + 1).cast("int"))
    return m.table("supplier").select("s_suppkey", text.schema_family(pick(["2.1.0", " 2.2.1", "3.0.0", "1.9", None], 5)).alias("schema_family"), text.format_family(pick(["json", "csv_tall", "csv_wide", "pdf"], 4)).alias("format_family"))


@query(
    "code_slots",
    """SELECT p_partkey, 1 AS code_ordinal, p_brand AS code, 'rc' AS code_type FROM part UNION ALL SELECT p_partkey, 2, cast(p_size AS VARCHAR), 'local' FROM part WHERE p_size % 2 = 0""",
)
def _(m):
    """Codes from the slots that a file's own header has, in the order of their numbers."""
    own = m.table("part").select(
        "p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).alias("code|10"), F.when(F.col("p_size") % 2 == 0, "LOCAL").alias("code|10|type"), F.col("p_brand").alias("Code|2"), F.lit("RC").alias("code|2|type"), F.lit("x").alias("description")
    )
    slots = ingest.code_slots(own.columns)
    return reshape.unpivot_slots(own.toDF(*[c.lower() for c in own.columns]), slots, ["p_partkey"]).select("p_partkey", "code_ordinal", "code", "code_type")


@query("missing_table", "SELECT n_regionkey, count(*) AS nations, 0 AS notes FROM nation GROUP BY n_regionkey")
def _(m):
    """A table of snapshots that was never loaded is empty and typed, so what joins it still runs."""
    path = f"{shared.folder(m.spark)}/optional-{shared.uuid.uuid4().hex}"
    sinks.write_partitioned(m.table("nation").select("n_nationkey", F.col("n_regionkey").alias("snapshot_id")), path)
    there = ingest.snapshots_of(m.spark, path, "n_nationkey long")
    missing = ingest.snapshots_of(m.spark, f"{path}-none", "n_nationkey long, note string")
    own = there.join(missing.select("n_nationkey", "note"), "n_nationkey", "left")
    return own.groupBy(F.col("snapshot_id").cast("long").alias("n_regionkey")).agg(F.count("*").alias("nations"), F.count("note").alias("notes"))


@query(
    "json_item_tables",
    """WITH l AS (SELECT l_orderkey AS k, l_quantity AS q, l_linenumber AS n FROM lineitem WHERE l_orderkey % 11 <> 0), o AS (SELECT k, count(*) AS n FROM l GROUP BY k)
       SELECT k, 'standard_charge_info' AS table_name, 1 AS n FROM o UNION ALL SELECT k, 'code_information', 1 + k % 2 FROM o UNION ALL SELECT k, 'drug_information', 1 FROM o WHERE k % 3 = 0 UNION ALL SELECT k, 'standard_charges', n FROM o
       UNION ALL SELECT k, 'standard_charge_modifiers', cast(sum(CASE WHEN q > 40 THEN 2 WHEN q > 25 THEN 1 END) AS BIGINT) FROM l WHERE q > 25 GROUP BY k UNION ALL SELECT k, 'payers_information', count(*) FROM l WHERE n <> 2 GROUP BY k""",
)
def _(m):
    """Item records with codes, drugs, charges, their modifiers and payers as JSON texts, flattened into six tables; records that do not parse are set aside."""
    k, q, n = F.col("l_orderkey"), F.col("l_quantity"), F.col("l_linenumber")
    modifiers = F.filter(F.array(F.when(q > 25, "26"), F.when(q > 40, "TC")), lambda x: x.isNotNull())
    payers = F.when(n != 2, F.array(F.struct(F.lit("p").alias("payer_name"), F.lit("q").alias("plan_name"), F.col("l_extendedprice").cast("string").alias("standard_charge_dollar"))))
    charge = F.struct(n.alias("place"), F.struct(F.col("l_extendedprice").cast("string").alias("gross_charge"), F.lit("both").alias("setting"), modifiers.alias("modifier_code"), payers.alias("payers_information")).alias("charge"))
    own = m.table("lineitem").select("l_orderkey", charge.alias("x")).groupBy("l_orderkey").agg(F.collect_list("x").alias("charges"))
    code = lambda kind: F.struct(F.lit("1").alias("code"), F.lit(kind).alias("type"))
    record = F.to_json(F.struct(
        F.lit("d").alias("description"), F.when(k % 2 == 0, F.array(code("CPT"))).otherwise(F.array(code("CPT"), code("RC"))).alias("code_information"),
        F.when(k % 3 == 0, F.struct(F.lit("1").alias("unit"), F.lit("ML").alias("type"))).alias("drug_information"), F.transform("charges", lambda x: x["charge"]).alias("standard_charges"),
    ))
    raw = own.select(k.alias("item_ordinal"), F.lit("s").alias("snapshot_id"), F.when(k % 11 == 0, F.left(record, F.length(record) - 3)).otherwise(record).alias("raw"))
    good = shared.written(ingest.split_json(raw, "raw", ingest.ITEM)[0].drop("raw"), "items")  # six tables of records that are parsed once
    place = F.split_part("key", F.lit("_"), F.lit(2)).cast("long").alias("k")
    tables = {n: t.withColumnRenamed("charge_item_id" if "charge_item_id" in t.columns else "standard_charge_id", "key").groupBy(place).agg(F.count("*").alias("n")) for n, t in ingest.flatten_items(good).items()}
    return reduce(lambda a, b: a.unionByName(b), [t.withColumn("table_name", F.lit(n)) for n, t in tables.items()])
