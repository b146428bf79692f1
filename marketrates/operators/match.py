"""Names to identities by alias tables and pattern rules. Matching runs over distinct inputs and is joined back; rule tables are small and stated by the caller."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: From the strictest to the loosest.
MATCH_TYPES = ["exact_clean", "payer_name", "token_contains", "plan_contains", "regex"]
#: Characters under which a rule of a plan's text is found.
GRAM = 3


def best_alias(names: DataFrame, aliases: DataFrame, name: str, region: str) -> DataFrame:
    """(name, region, canonical_id): an alias of equal text, state-scoped before global, verified before not, then the least alias_id.

    aliases: alias_id, alias, canonical_id, scope ('state' or 'global'), scope_region, verified.
    """
    own = names.select(name, region).distinct()
    hit = own.join(aliases, (own[name] == aliases["alias"]) & ((aliases["scope"] == "global") | (aliases["scope_region"] == own[region])))
    rank = Window.partitionBy(name, region).orderBy((F.col("scope") != "state").cast("int"), (~F.col("verified")).cast("int"), "alias_id")
    return hit.withColumn("rank", F.row_number().over(rank)).filter("rank = 1").select(name, region, "canonical_id")


def _grams(text: Column) -> Column:
    """The distinct pieces of one to GRAM characters."""
    of = lambda n: F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array())
    return F.array_distinct(F.flatten(F.array(*[of(n) for n in range(1, GRAM + 1)])))


def rule_hits(inputs: DataFrame, rules: DataFrame, payer: str, plan: str, region: str) -> DataFrame:
    """Each distinct (payer, plan, region) with each rule that it meets.

    Rules of equal text are hash joins. A rule of tokens stands in an inverted index under its longest token and meets the inputs that have it; one of a plan's text stands under its first GRAM characters
    and meets the inputs whose plan has them; both are then tested whole. Only patterns, and texts without a token or character, are tried on every input.
    """
    own = inputs.select(payer, plan, region).distinct()
    p, q, text = F.col(payer), F.col(plan), F.col("pattern")
    spaced = F.concat(F.lit(" "), F.regexp_replace(p, "[^a-z0-9]+", " "), F.lit(" "))
    in_scope = (F.col("scope") == "global") | (F.col("scope_region") == F.col(region))
    of = lambda kind: rules.filter(F.col("match_type") == kind)
    tokens = F.filter(F.split(text, " "), lambda x: x != "")
    longest = F.array_max(F.transform(tokens, lambda x: F.struct(F.length(x).alias("n"), x.alias("token"))))["token"]
    tests = {"token_contains": spaced.contains(F.concat(F.lit(" "), text, F.lit(" "))), "plan_contains": q.contains(text), "regex": F.rlike(F.concat_ws(" ", p, q), text)}

    by_token = of("token_contains").withColumn("_key", longest)
    by_gram = of("plan_contains").withColumn("_key", F.nullif(F.left(text, F.lit(GRAM)), F.lit("")))
    keyed = {"token_contains": (by_token, F.array_distinct(F.split(F.trim(spaced), " +"))), "plan_contains": (by_gram, _grams(q))}
    hits = [own.withColumn("_key", F.concat_ws(" ", p, q)).join(of("exact_clean").withColumn("_key", text), "_key"), own.withColumn("_key", p).join(of("payer_name").withColumn("_key", text), "_key")]
    hits += [own.withColumn("_key", F.explode(keys)).join(table.filter("_key is not null"), "_key").filter(tests[kind]) for kind, (table, keys) in keyed.items()]
    rest = of("regex").unionByName(by_token.filter("_key is null").drop("_key")).unionByName(by_gram.filter("_key is null").drop("_key"))
    met = reduce(lambda a, b: a | b, [(F.col("match_type") == kind) & test for kind, test in tests.items()])
    return reduce(lambda a, b: a.unionByName(b), [h.drop("_key") for h in hits], own.join(rest, met)).filter(in_scope)


def best_rule(inputs: DataFrame, rules: DataFrame, payer: str, plan: str, region: str, carry: list[str]) -> DataFrame:
    """(payer, plan, region, rule_id, carry): the rule that matches best, by priority, scope, type, length of pattern, rule_id.

    rules: rule_id, match_type, pattern, priority, scope, scope_region and the carried columns.
    """
    kind = F.array_position(F.array(*[F.lit(m) for m in MATCH_TYPES]), F.col("match_type"))
    rank = Window.partitionBy(payer, plan, region).orderBy("priority", (F.col("scope") != "state").cast("int"), kind, F.length("pattern").desc(), "rule_id")
    hit = rule_hits(inputs, rules, payer, plan, region)
    return hit.withColumn("rank", F.row_number().over(rank)).filter("rank = 1").select(payer, plan, region, "rule_id", *carry)


def attach(frame: DataFrame, found: DataFrame, on: list[str]) -> DataFrame:
    """Join matches back to the rows on nullable columns, nulls equal."""
    other = found.select(*[F.col(c).alias(f"_{c}") for c in on], *[c for c in found.columns if c not in on])
    condition = reduce(lambda a, b: a & b, [frame[c].eqNullSafe(other[f"_{c}"]) for c in on])
    return frame.join(other, condition, "left").drop(*[f"_{c}" for c in on])
