"""What amounts, counts, plans and positions mean. Thresholds are arguments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_display_text, clean_text

#: Fixed values, in the published order.
PLAN_TYPES = ["ppo", "hmo", "pos", "epo", "pffs", "hdhp"]
METHODOLOGIES = ["case rate", "fee schedule", "percent of total billed charges", "per diem", "other"]
COMPARABLE_METHODOLOGIES = ["fee schedule", "case rate", "per diem"]
#: Fixed value: whole numbers from 11 up, as counts are published.
WHOLE_COUNT = "^(1[1-9]|[2-9][0-9]+|[1-9][0-9]{2,})$"


def plan_type(x: Column) -> Column:
    """The one plan type that the text names as a whole word; null for none or several."""
    hits = [F.coalesce(x.rlike(rf"(^|[^a-z0-9]){t}([^a-z0-9]|$)"), F.lit(False)) for t in PLAN_TYPES]
    total = sum((h.cast("int") for h in hits), F.lit(0))
    return F.when(total == 1, F.coalesce(*[F.when(h, t) for h, t in zip(hits, PLAN_TYPES)]))


def canonical_methodology(x: Column) -> Column:
    return F.when(clean_text(x).isin(METHODOLOGIES), clean_text(x))


def _count(x: Column, few: int) -> Column:
    text = clean_display_text(x)
    return F.when(text == "0", F.lit(0).cast("bigint")).when(text == "1 through 10", F.lit(few).cast("bigint")).when(text.rlike(WHOLE_COUNT), text.try_cast("bigint"))


def count_min(x: Column) -> Column:
    """Least count that the published text allows: '0', '1 through 10', or a whole number of 11 or more without leading zeros."""
    return _count(x, 1)


def count_max(x: Column) -> Column:
    return _count(x, 10)


def freshness(age_days: Column, bands: tuple[int, ...] = (90, 180, 365)) -> Column:
    out = F.lit(f">{bands[-1]}d")
    for b in reversed(bands):
        out = F.when(age_days <= b, f"<={b}d").otherwise(out)
    return F.when(age_days.isNull(), "unknown").otherwise(out)


def freshness_score(bucket: Column) -> Column:
    return F.when(bucket == "<=90d", 1.0).when(bucket == "<=180d", 0.75).when(bucket == "<=365d", 0.5).when(bucket == ">365d", 0.25).otherwise(0.0)


def amount_kind(dollar: Column, percentage: Column, algorithm: Column, estimated: Column) -> Column:
    """The most direct form in which a rate is stated."""
    return F.when(dollar.isNotNull(), "dollar").when(percentage.isNotNull(), "percentage").when(algorithm.isNotNull(), "algorithm").when(estimated.isNotNull(), "estimated").otherwise("none")


def amount_tier(kind: Column, methodology: Column, comparable: list[str] | None = None) -> Column:
    """Dollars count as comparable where the methodology is one of the direct ones, else as derived; percentages and algorithms are tiers of their own, estimates none."""
    dollar = F.when(methodology.isin(comparable or COMPARABLE_METHODOLOGIES), "comparable_dollar").otherwise("derived_dollar")
    return F.when(kind == "dollar", dollar).when(kind.isin("percentage", "algorithm"), kind).otherwise("none")


def chosen_source(**sources: Column) -> Column:
    """Name of the first source that has a value, as coalesce would take it."""
    return F.coalesce(*[F.when(c.isNotNull(), name) for name, c in sources.items()], F.lit("none"))


#: Fixed values: (relative difference to the median, percent rank) from which a price is far from, or off, the market.
FAR, OFF = (0.25, 0.10), (0.10, 0.25)


def price_position(peers: Column, rank: Column, delta: Column, floor: int = 3) -> Column:
    """very_low, low, near_market, high, very_high: by relative difference to the market's median or by percent rank, whichever says so, the lower side first."""
    at = lambda step, sign: (sign * delta >= step[0]) | ((rank <= step[1]) if sign < 0 else (rank >= 1 - step[1]))
    out = F.when(F.coalesce(peers, F.lit(0)) < floor, "insufficient_denominator")
    for sign, name in ((-1, "low"), (1, "high")):
        out = out.when(at(FAR, sign), f"very_{name}").when(at(OFF, sign), name)
    return out.otherwise("near_market")


def contract_position(amount: Column, peers: Column, delta: Column, floor: int = 3) -> Column:
    """Where a payer's price lies among the same payer's prices at other publishers, by relative difference to their median."""
    out = F.when(amount.isNull(), "ambiguous_negotiated_context").when(F.coalesce(peers, F.lit(0)) < floor, "insufficient_denominator")
    out = out.when(delta <= -FAR[0], "well_below_payer_market").when(delta <= -OFF[0], "below_payer_market")
    return out.when(delta >= FAR[0], "well_above_payer_market").when(delta >= OFF[0], "above_payer_market").otherwise("near_payer_market")


def cash_position(status: Column, amount: Column, cash: Column) -> Column:
    """Against the publisher's own cash price where that may be compared, else why it may not."""
    return F.when(status != "comparable", status).when(amount < cash, "below_cash").when(amount > cash, "above_cash").otherwise("equal_to_cash")


def comparison_confidence(enough: Column, hospitals: Column, described: Column) -> Column:
    """How solid a context's comparison is: by publishers, and whether its code has a description."""
    return F.when(~enough, "low").when((hospitals >= 10) & described, "high").when(hospitals >= 5, "moderate").otherwise("limited")


def variation(enough: Column, spread: Column) -> Column:
    """By the ratio of the 90th to the 10th percentile."""
    return F.when(enough & (spread >= 3), "very_high_variation").when(enough & (spread >= 2), "high_variation").when(enough, "moderate_variation").otherwise("not_ranked")


def data_confidence(score: Column) -> Column:
    return ladder(score, [(0.85, "high"), (0.70, "moderate"), (0.50, "limited")], "low", "low")


def ladder(x: Column, steps: list[tuple[float, str]], rest: str, missing: str) -> Column:
    """Label of the first step that x reaches, steps from the highest down."""
    out = F.lit(rest)
    for bound, label in reversed(steps):
        out = F.when(x >= bound, label).otherwise(out)
    return F.when(x.isNull(), missing).otherwise(out)
