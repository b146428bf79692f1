"""Validation rules: all rules of a grain in one scan, violations as rows, rejected keys, summaries.

A rule states when a row breaks it. Rows are tested against an array with an element per rule and exploded once, so a table is read once however many rules it has.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_display_text, quick_display_text
from .quantiles import exact_quantiles
from .reshape import once


@dataclass(frozen=True)
class Rule:
    """broken: when the row breaks the rule; raw: what was published; excludes: whether the row's entity is rejected. texts: columns that it reads cleaned, by cleaned()."""

    rule_id: str
    grain: str
    column: str
    broken: Column
    raw: Column
    severity: str = "error"
    disposition: str = "exclude_entity"
    message: str = ""
    texts: tuple[str, ...] = ()


def cleaned(name: str) -> Column:
    """A column's cleaned text, as evaluate computes it once for all rules that name it among their texts."""
    return F.lower(shown(name))


def shown(name: str) -> Column:
    """The same in the case in which it is published, which is enough to tell whether there is one, or a number."""
    return F.col(f"_shown_{name}")


def _texts(rules: list[Rule]) -> list[str]:
    return list(dict.fromkeys(n for r in rules for n in r.texts))


#: Texts that one step cleans: the code of a longer step is not compiled to the machine's.
_AT_ONCE = 5


def with_cleaned(frame: DataFrame, rules: list[Rule]) -> DataFrame:
    """The frame with the cleaned texts that the rules read, made once a row, for excluded() and for what the accepted rows say."""
    texts = _texts(rules)
    parts = [texts[i : i + _AT_ONCE] for i in range(0, len(texts), _AT_ONCE)]
    return reduce(lambda own, part: once(own, **{f"_shown_{n}": quick_display_text(F.col(n).cast("string")) for n in part}), parts, frame)


def excluded(rules: list[Rule]) -> Column:
    """Whether any rule excludes the row's entity, over a frame with_cleaned: what rejected_keys tells by rows and a join."""
    return reduce(lambda a, b: a | b, [F.coalesce(r.broken, F.lit(False)) for r in rules if r.disposition == "exclude_entity"])


def evaluate(frame: DataFrame, rules: list[Rule], keys: list[str]) -> DataFrame:
    """keys, rule_id, grain, column_name, raw_value, severity, disposition, message, excludes for each break.

    Texts are cleaned once a row, by one expression over their array; rules read the cleaned ones. An outer explode has no filter inferred that computes the tests again.
    """
    hits = [
        F.when(
            F.coalesce(r.broken, F.lit(False)),
            F.struct(
                F.lit(r.rule_id).alias("rule_id"), F.lit(r.grain).alias("grain"), F.lit(r.column).alias("column_name"), r.raw.cast("string").alias("raw_value"),
                F.lit(r.severity).alias("severity"), F.lit(r.disposition).alias("disposition"), F.lit(r.message).alias("message"), F.lit(r.disposition == "exclude_entity").alias("excludes"),
            ),
        )
        for r in rules
    ]
    texts = _texts(rules)
    if texts:
        frame = frame.withColumn("_shown", F.transform(F.array(*[F.col(n).cast("string") for n in texts]), lambda x: clean_display_text(x)))
        frame = frame.withColumns({f"_shown_{n}": F.col("_shown")[i] for i, n in enumerate(texts)})
    found = frame.select(*keys, F.explode_outer(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("hit"))
    return found.filter("hit is not null").select(*keys, "hit.*")


def rejected_keys(violations: DataFrame, keys: list[str]) -> DataFrame:
    return violations.filter("excludes").select(*keys).distinct()


def registry(frame: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rules as a table; frame only lends its session."""
    rows = [(r.rule_id, r.grain, r.severity, r.disposition) for r in rules]
    return frame.sparkSession.createDataFrame(rows, "rule_id string, grain string, severity string, disposition string")


def rule_summary(violations: DataFrame, rules: list[Rule]) -> DataFrame:
    """Breaks per rule, those without any included."""
    counts = violations.groupBy("rule_id").agg(F.count("*").alias("n"))
    own = F.broadcast(registry(violations, rules)).join(counts, "rule_id", "left")
    return own.select("rule_id", "grain", "severity", "disposition", F.coalesce("n", F.lit(0)).cast("long").alias("violation_count"))


def current_summary(violations: DataFrame, rules: list[Rule], current: DataFrame, publisher: str = "hospital_id", snapshot: str = "snapshot_id") -> DataFrame:
    """Breaks of each rule in the current snapshots, those without any included: how many, in how many snapshots, of how many publishers, and how many of them exclude.

    Broken rules are counted by snapshot first, so the distinct counts are over a row per rule and snapshot.
    """
    own = violations.join(current.select(snapshot).distinct(), snapshot, "left_semi")
    by_snapshot = own.groupBy("grain", "rule_id", snapshot).agg(F.min(publisher).alias("publisher"), F.count("*").alias("n"), F.count_if("excludes").alias("excluding"))
    counts = by_snapshot.groupBy("grain", "rule_id").agg(F.sum("n").alias("n"), F.count("*").alias("snapshots"), F.count_distinct("publisher").alias("publishers"), F.sum("excluding").alias("excluding"))
    known = registry(violations, rules).distinct().join(counts, ["grain", "rule_id"], "left")
    whole = {"n": "violation_count", "snapshots": "affected_snapshot_count", "publishers": "affected_hospital_count", "excluding": "rejected_violation_count"}
    return known.select("rule_id", "grain", "severity", "disposition", *[F.coalesce(c, F.lit(0)).cast("long").alias(name) for c, name in whole.items()])


def pass_rate(frame: DataFrame, violations: DataFrame, group: str) -> DataFrame:
    """Per group: records, violations and max(0, 1 - violations / records)."""
    records = frame.groupBy(group).agg(F.count("*").alias("record_count"))
    breaks = violations.groupBy(group).agg(F.count("*").alias("violation_count"))
    own = records.join(breaks, group, "left").withColumn("violation_count", F.coalesce("violation_count", F.lit(0)))
    return own.withColumn("pass_rate", F.greatest(F.lit(0.0), 1 - F.col("violation_count") / F.col("record_count")))


def numeric_profile(long: DataFrame) -> DataFrame:
    """Per (grain, column_name) of the long form: nulls, texts that are no number, distribution, zeros and negatives.

    Counts, sums and extremes are one grouping with partial sums; quantiles are exact, by selection over counted values, so no group holds a column.
    """
    x, keys = F.col("raw_value").try_cast("double"), ["grain", "column_name"]
    totals = long.groupBy(*keys).agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("raw_value").isNull()).alias("null_count"),
        F.count_if(F.col("raw_value").isNotNull() & x.isNull()).alias("non_numeric_count"),
        F.min(x).alias("min_value"),
        F.max(x).alias("max_value"),
        F.avg(x).alias("mean_value"),
        F.count_if(x == 0).alias("zero_count"),
        F.count_if(x < 0).alias("negative_count"),
    )
    points = exact_quantiles(long.select(*keys, x.alias("x")), keys, "x", {"p10_value": 0.1, "median_value": 0.5, "p90_value": 0.9})
    points = points.select(F.col("grain").alias("_grain"), F.col("column_name").alias("_column"), "p10_value", "median_value", "p90_value")
    return totals.join(points, F.col("grain").eqNullSafe(F.col("_grain")) & F.col("column_name").eqNullSafe(F.col("_column")), "left").drop("_grain", "_column")


def parse_diagnostics(frame: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Texts that should be numbers and are not: keys, column_name, raw_value."""
    cells = [F.when(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull(), F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("raw_value"))) for c in columns]
    return frame.select(*keys, F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("cell")).select(*keys, "cell.*")
