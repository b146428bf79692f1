"""Text cleaning, names, slugs and tokens: Column -> Column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values, in the published order: texts that stand for nothing.
NULL_TOKENS = ["", "null", "none", "n/a", "na", "not applicable", "not available", "unknown", "-"]


def _nothing(space: str, between: str) -> str:
    """A pattern of the texts that stand for nothing, in any case. U+212A is the one sign beyond ASCII whose lower case is an ASCII letter, k."""
    return rf"(?i)\A{space}*(?:" + "|".join(t.replace(" ", between).replace("k", "[k\u212a]") for t in NULL_TOKENS) + rf"){space}*\z"


def stated(x: Column) -> Column:
    """Whether a text stands for something: clean_text(x) is not null, told by one pattern without making the text."""
    return F.coalesce(~x.cast("string").rlike(_nothing(r"\s", r"\s+")), F.lit(False))


def clean_text(x: Column, lowercase: bool = True, collapse_ws: bool = True) -> Column:
    """Trimmed text with runs of white space made one space, null where it stands for nothing, in lower case if asked for."""
    x = x.cast("string")
    text = F.trim(F.regexp_replace(x, r"\s+", " ") if collapse_ws else x)
    return F.when(~x.rlike(_nothing(r"\s", r"\s+") if collapse_ws else _nothing(" ", " ")), F.lower(text) if lowercase else text)


def clean_display_text(x: Column) -> Column:
    return clean_text(x, lowercase=False)


def quick_display_text(x: Column) -> Column:
    """clean_display_text for tables' columns: few texts have white space to collapse, the others are told without a pattern. Within an array's lambda, which is not compiled, the plain form is faster."""
    odd = reduce(lambda a, b: a | b, [x.contains(s) for s in ("  ", "\t", "\n", "\x0b", "\f", "\r")])
    return F.when(~x.rlike(_nothing(r"\s", r"\s+")), F.trim(F.when(odd, F.regexp_replace(x, r"\s+", " ")).otherwise(x)))


def title_case(x: Column) -> Column:
    """Cleaned text with the first letter of each space-separated word in upper case, the rest in lower."""
    return F.initcap(clean_text(x))


def description_tokens(x: Column) -> Column:
    """Sorted distinct words of a description, with 'w/o', 'w/' and '&' spelt out and punctuation gone; null if none is left."""
    text = F.lower(x)
    for pattern, word in ((r"\bw/o\b", " without "), (r"\bw/", " with "), ("&", " and "), (r"[^a-z0-9]+", " ")):
        text = F.regexp_replace(text, pattern, word)
    words = F.array_sort(F.array_distinct(F.filter(F.split(text, " "), lambda w: w != "")))
    return F.when(F.size(words) > 0, F.array_join(words, " "))


def slug(x: Column) -> Column:
    """Lower case, each run of other than letters and digits one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def context_slug(name: Column, amount_kind: Column, methodology: Column, key: Column) -> Column:
    """Slug of a comparison context: the service, the kind of price, how it was agreed, ten characters of the key."""
    price = F.when(amount_kind == "negotiated_dollar", "negotiated").when(amount_kind == "discounted_cash", "cash").when(amount_kind == "gross_charge", "list").otherwise(amount_kind)
    how = F.when((methodology.isNotNull()) & (methodology != "not applicable"), slug(methodology))
    return F.concat_ws("-", slug(name), slug(price), how, F.substring(key, 1, 10))


def methodology_label(x: Column) -> Column:
    """What the public is told of a methodology; others are shown as they are."""
    #: Fixed values.
    labels = {"fee schedule": "Fee schedule (per item/service)", "case rate": "Case rate (per episode)", "per diem": "Per diem (per day)", "not applicable": "Not applicable"}
    out = x
    for value, label in labels.items():
        out = F.when(x == value, label).otherwise(out)
    return out


def description_availability(description: Column, restricted: Column) -> Column:
    return F.when(description.isNotNull(), "available").when(F.coalesce(restricted, F.lit(False)), "license_restricted").otherwise("not_loaded")


def schema_family(version: Column) -> Column:
    """2.1, 2.2 or 3.0 from a version's first characters."""
    version = clean_text(version)
    return F.when(version.like("2.1%"), "2.1").when(version.like("2.2%"), "2.2").when(version.like("3.%"), "3.0")


def format_family(source_format: Column) -> Column:
    return F.when(source_format == "json", "json").when(source_format.like("csv%"), "csv").otherwise("other")
