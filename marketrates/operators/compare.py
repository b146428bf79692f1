"""Comparison of published prices: tiers, blockers, context keys, one vote per publisher, peer statistics.

Rows that may not be compared stay, with flags that say why. Statistics are over publishers, one amount each, and are withheld below a floor. Medians are exact: a
group has one row per publisher, so it stays small. The statistics of a context are windows over one shuffle by context, not joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from .reshape import non_null_names

FLOOR = 3
UNMATCHED = "<unmatched>"
CONTEXT = ["service_code_key", "setting", "billing_class", "modifier_signature", "amount_kind", "comparison_methodology", "drug_unit"]
#: Fixed values, in the published order: reasons not to compare a row; the last two need its context's and its contract's other rows.
BLOCKERS = [
    "not_current_snapshot", "code_not_cross_hospital_comparable", "code_not_specific", "missing_match_code", "non_rankable_amount", "derived_dollar", "modifier_context_required", "drug_unit_context_missing",
    "payer_unmatched", "market_segment_unknown", "below_min_hospital_denominator", "multiple_amounts_per_contract_context",
]
RANKED_KINDS = ["negotiated_dollar", "gross_charge", "discounted_cash"]


def comparison_methodology(kind: Column, methodology: Column) -> Column:
    return F.when(kind == "negotiated_dollar", methodology).otherwise("not applicable")


def context_key() -> Column:
    return surrogate_key(*CONTEXT[:-1], F.coalesce(F.col("drug_unit"), F.lit("<none>")))


def comparison_tier() -> Column:
    aligned = F.coalesce(F.col("code_is_specific"), F.lit(False)) & F.col("match_code").isNotNull() & F.col("setting").isNotNull() & F.col("billing_class").isNotNull()
    return F.when(~F.coalesce(F.col("code_comparable"), F.lit(False)), "tier_0_trace_only").when(aligned, "tier_2_context_aligned").otherwise("tier_1_code_backed")


def blocker_flags() -> dict[str, Column]:
    """Each reason not to compare a row, as a flag that is never null."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    col = F.col
    return {
        "not_current_snapshot": ~yes(col("is_current")),
        "code_not_cross_hospital_comparable": ~yes(col("code_comparable")),
        "code_not_specific": yes(col("code_comparable")) & ~yes(col("code_is_specific")),
        "missing_match_code": col("match_code").isNull(),
        "non_rankable_amount": yes((col("amount_unit") != "usd") | col("amount_role").isin("allowed_amount_stat", "estimated")),
        "derived_dollar": yes(col("amount_tier") == "derived_dollar"),
        "modifier_context_required": yes(col("has_split_modifier")),
        "drug_unit_context_missing": yes(col("is_drug") & (col("drug_unit_status") == "missing_unit")),
        "payer_unmatched": yes(col("scope") == "payer_rate") & (col("payer_id").isNull() | (col("payer_id") == UNMATCHED)),
        "market_segment_unknown": yes(col("market_segment") == "unknown"),
    }


def with_comparison(rows: DataFrame) -> DataFrame:
    """Add comparison_methodology, service_context_key, comparison_tier, the blocker flags and blocker_reasons."""
    own = rows.withColumn("comparison_methodology", comparison_methodology(F.col("amount_kind"), F.col("methodology")))
    own = own.withColumns({"service_context_key": context_key(), "comparison_tier": comparison_tier(), **blocker_flags()})
    return own.withColumn("blocker_reasons", non_null_names({n: F.col(n) for n in blocker_flags()}))


def ranking_rows(spine: DataFrame, kinds: list[str]) -> DataFrame:
    """Rows whose price may be ranked: current, context-aligned, rankable. What the tier implies is said again, so that it reaches the scans and joins below."""
    implied = F.col("code_is_specific") & F.col("match_code").isNotNull() & F.col("setting").isNotNull() & F.col("billing_class").isNotNull()
    spine = spine.filter(implied)
    return spine.filter(F.col("is_current") & (F.col("comparison_tier") == "tier_2_context_aligned") & F.col("is_price_rankable") & F.col("amount_kind").isin(kinds))


def contract_representatives(spine: DataFrame) -> DataFrame:
    """One row per publisher, context and contract: its one distinct amount, or null where it states several."""
    keys = ["hospital_id", "snapshot_id", "service_context_key", "contract_key"]
    amounts = F.count_distinct("amount_value")
    return (
        ranking_rows(spine, ["negotiated_dollar"])
        .groupBy(*keys)
        .agg(
            F.min("payer_id").alias("payer_id"),
            F.min("market_segment").alias("market_segment"),
            F.min("service_code_key").alias("service_code_key"),
            F.min("comparison_methodology").alias("comparison_methodology"),
            F.count("*").alias("raw_observation_count"),
            amounts.alias("distinct_amount_count"),
            F.count_distinct("item_id").alias("distinct_item_count"),
            F.min("amount_value").alias("contract_amount_min"),
            F.max("amount_value").alias("contract_amount_max"),
            F.when(amounts == 1, F.min("amount_value")).alias("contract_amount"),
            (amounts > 1).alias("has_multiple_amounts"),
        )
    )


def hospital_amounts(spine: DataFrame, representatives: DataFrame) -> DataFrame:
    """One vote per publisher and context: the median of its contracts' amounts, or of its gross or cash prices. All-ambiguous publishers keep a null amount."""
    keys = ["hospital_id", "service_context_key"]
    matched = F.when(F.col("payer_id").isNotNull() & (F.col("payer_id") != UNMATCHED), F.col("payer_id"))
    negotiated = representatives.groupBy(*keys).agg(
        F.lit("negotiated_dollar").alias("amount_kind"),
        F.sum("raw_observation_count").alias("raw_observation_count"),
        F.count("*").alias("contract_count"),
        F.count_if(~F.col("has_multiple_amounts")).alias("valid_contract_count"),
        F.count_if("has_multiple_amounts").alias("ambiguous_contract_count"),
        F.count_distinct(matched).alias("matched_payer_count"),
        F.median(F.col("contract_amount").cast("double")).alias("hospital_amount"),
    )
    none = F.lit(None).cast("long")
    standard = (
        ranking_rows(spine, ["gross_charge", "discounted_cash"])
        .groupBy(*keys, "amount_kind")
        .agg(
            F.count("*").alias("raw_observation_count"),
            F.median(F.col("amount_value").cast("double")).alias("hospital_amount"),
        )
        .withColumns({"contract_count": none, "valid_contract_count": none, "ambiguous_contract_count": none, "matched_payer_count": F.lit(0).cast("long")})
    )
    return negotiated.unionByName(standard)


def distribution(amounts: DataFrame, floor: int = FLOOR) -> DataFrame:
    """Per context: counts of publishers, and the distribution of their amounts, withheld below the floor; outliers lie beyond 1.5 quartile ranges."""
    n, quantiles = F.count("hospital_amount"), [0.1, 0.25, 0.5, 0.75, 0.9]
    own = amounts.groupBy("service_context_key").agg(
        F.sum("raw_observation_count").alias("observation_count"),
        F.sum("contract_count").alias("contract_count"),
        F.count("*").alias("reporting_hospital_count"),
        n.alias("hospital_count"),
        (F.count("*") - n).alias("excluded_hospital_count"),
        F.sum(F.coalesce("ambiguous_contract_count", F.lit(0))).alias("ambiguous_contract_count"),
        (n >= floor).alias("meets_threshold"),
        F.min("hospital_amount").alias("least"),
        F.max("hospital_amount").alias("most"),
        F.percentile("hospital_amount", quantiles).alias("q"),
        F.collect_list("hospital_amount").alias("votes"),  # one for each publisher
    )
    p10, p25, p50, p75, p90 = (F.col("q")[i] for i in range(5))
    fence = 1.5 * (p75 - p25)
    outside = F.size(F.filter("votes", lambda v: (v < p25 - fence) | (v > p75 + fence))).cast("long")
    shown = {
        "min_amount": F.col("least"), "p10_amount": p10, "p25_amount": p25, "median_amount": p50, "p75_amount": p75, "p90_amount": p90, "max_amount": F.col("most"), "iqr_amount": p75 - p25,
        "spread_p90_to_p10": F.when(p10 != 0, p90 / p10), "outlier_hospital_count": outside,
    }
    return own.withColumns({name: F.when(F.col("meets_threshold"), c) for name, c in shown.items()}).drop("least", "most", "q", "votes")


def peer_statistics(amounts: DataFrame, cohorts: dict[str, list[str]], value: str = "hospital_amount", floor: int = FLOOR) -> DataFrame:
    """For each cohort (name -> grouping columns): peers, median, percent rank and difference, withheld below the floor. Rows need a value.

    All cohorts begin with the context, so Spark sorts each window within one exchange by the widest common key.
    """
    own = amounts.filter(F.col(value).isNotNull())
    for name, columns in cohorts.items():
        group = Window.partitionBy(*columns)
        n = F.count("*").over(group)
        own = own.withColumn(f"peers_{name}", n)
        enough = F.col(f"peers_{name}") >= floor
        own = own.withColumn(f"median_{name}", F.when(enough, F.median(value).over(group)))
        own = own.withColumn(f"pct_rank_{name}", F.when(enough, F.percent_rank().over(group.orderBy(F.col(value).asc_nulls_last()))))
        own = own.withColumn(f"delta_{name}", F.when(enough, F.col(value) - F.col(f"median_{name}")))
        own = own.withColumn(f"pct_delta_{name}", F.when(F.col(f"median_{name}") != 0, F.col(f"delta_{name}") / F.col(f"median_{name}")))
    return own


def payer_amounts(representatives: DataFrame) -> DataFrame:
    """Median amount of each matched payer at each publisher in each context, with its contract counts."""
    matched = representatives.filter(F.col("payer_id").isNotNull() & (F.col("payer_id") != UNMATCHED))
    return matched.groupBy("payer_id", "hospital_id", "service_context_key").agg(
        F.min("service_code_key").alias("service_code_key"),
        F.min("comparison_methodology").alias("comparison_methodology"),
        F.count("*").alias("contract_count"),
        F.count("contract_amount").alias("valid_contract_count"),
        F.count_if("has_multiple_amounts").alias("ambiguous_contract_count"),
        F.median(F.col("contract_amount").cast("double")).alias("negotiated_dollar"),
    )


def payer_peers(representatives: DataFrame, floor: int = FLOOR) -> DataFrame:
    """A matched payer's price at each publisher among its prices at all publishers in the context: peers, median, percent rank, withheld below the floor."""
    own = payer_amounts(representatives).filter("negotiated_dollar is not null").select("payer_id", "hospital_id", "service_context_key", F.col("negotiated_dollar").alias("payer_hospital_amount"))
    group = Window.partitionBy("payer_id", "service_context_key")
    own = own.withColumn("payer_peer_hospital_count", F.count("*").over(group))
    enough = F.col("payer_peer_hospital_count") >= floor
    return own.withColumns({
        "payer_market_median": F.when(enough, F.median("payer_hospital_amount").over(group)), "payer_pct_rank": F.when(enough, F.percent_rank().over(group.orderBy("payer_hospital_amount"))),
    })


def cash_comparison(payers: DataFrame, cash: DataFrame, on: list[str]) -> DataFrame:
    """Payer amounts against the same publisher's cash price on nullable context columns; per diems and ambiguous contracts are not compared."""
    other = cash.select(*[F.col(c).alias(f"_{c}") for c in on], F.col("hospital_amount").alias("cash_amount"))
    condition = F.lit(True)
    for c in on:
        condition = condition & payers[c].eqNullSafe(other[f"_{c}"])
    own = payers.join(other, condition, "left").drop(*[f"_{c}" for c in on])
    fair = F.col("negotiated_dollar").isNotNull() & (F.col("comparison_methodology") != "per diem")
    status = (
        F.when(F.col("negotiated_dollar").isNull(), "ambiguous_negotiated_context")
        .when(F.col("comparison_methodology") == "per diem", "per_diem_incompatible")
        .when(F.col("cash_amount").isNull(), "cash_unavailable")
        .otherwise("comparable")
    )
    delta = F.col("negotiated_dollar") - F.col("cash_amount")
    return own.withColumns(
        {"cash_status": status, "delta_from_cash": F.when(fair, delta), "pct_delta_from_cash": F.when(fair & (F.col("cash_amount") != 0), delta / F.col("cash_amount"))}
    )
