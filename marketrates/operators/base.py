"""Published records of both formats at one grain, held to the rules, and the base entities that are left.

stage_json and stage_csv bring item records and tall rows to the same five grains: items, codes, drugs, charges, rates. What a rule needs to know of a record's other
parts (how many codes, whether a payer states a dollar) is computed from the record's own arrays, in the scan that flattens it, not by joins. Violations are found in
one scan per grain; base entities are the staged rows without rejected keys, below entities that are there themselves. A CSV file repeats an item on many rows: rows
of equal description, codes and drug unit are one item, and rows of one item with equal charge texts are one charge.

There are two ways to base entities. charge_items, standard_charges and payer_rates take staged grains and rejected keys, as tables by key. Where the records are at hand, item_of, charge_of and rate_of
go down a record from its item to its rates and tell at each whether a rule excludes it: what is above a rate stands in its own row, so nothing is dealt or joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import safe_decimal
from ..functions.keys import modifier_signature, surrogate_key
from ..functions.text import clean_display_text, clean_text, quick_display_text, stated
from . import published_rules, scope
from .reshape import once, union_all
from .rules import Rule, cleaned, evaluate, excluded, rejected_keys, shown, with_cleaned

#: The texts of a charge and of a payer's rate.
CHARGE = ["minimum", "maximum", "gross_charge", "discounted_cash", "setting", "billing_class", "additional_generic_notes"]
RATE = ["payer_name", "plan_name", "methodology", "standard_charge_dollar", "standard_charge_percentage", "standard_charge_algorithm", "estimated_amount", "median_amount", "tenth_percentile", "ninetieth_percentile", "count", "additional_payer_notes"]
#: A rate's amounts and the texts they come from.
AMOUNTS = {"negotiated_dollar": "standard_charge_dollar", "negotiated_percentage": "standard_charge_percentage", "estimated_amount": "estimated_amount", "median_amount": "median_amount", "tenth_percentile": "tenth_percentile", "ninetieth_percentile": "ninetieth_percentile"}
#: Keys of each grain; source_id is the item record's, or the row's ordinal.
KEYS = {"items": ["format_family", "snapshot_id", "source_id"], "codes": ["format_family", "snapshot_id", "source_id", "code_ordinal"], "drugs": ["format_family", "snapshot_id", "source_id"]}
KEYS |= {"charges": ["format_family", "snapshot_id", "source_id", "charge_ordinal"], "rates": ["format_family", "snapshot_id", "source_id", "charge_ordinal", "payer_ordinal"]}


def _is_ndc(code: Column) -> Column:
    return F.coalesce(clean_text(code["type"]) == "ndc", F.lit(False))


def stage_json(items: DataFrame, record: str = "record", item_ordinal: str = "item_ordinal") -> dict[str, DataFrame]:
    """items: snapshot_id, hospital_id, schema_family, an ordinal and a parsed record (sources.ingest.ITEM)."""
    r = F.col(record)
    codes, charges = (F.coalesce(r[c], F.array()) for c in ("code_information", "standard_charges"))
    own = items.select(F.lit("json").alias("format_family"), "snapshot_id", "hospital_id", "schema_family", F.concat_ws("_", "snapshot_id", F.col(item_ordinal).cast("string")).alias("source_id"), r.alias("r"), codes.alias("codes"), charges.alias("charges"))
    head = ["format_family", "snapshot_id", "hospital_id", "schema_family", "source_id"]
    drug = F.col("r.drug_information")
    charge = own.select(*head, F.posexplode_outer("charges").alias("charge_ordinal", "c")).filter("charge_ordinal is not null")
    payers = F.coalesce(F.col("c.payers_information"), F.array())
    any_ = lambda name: F.exists(payers, lambda p: stated(p[name])).alias(f"has_payer_{name.removeprefix('standard_charge_')}")
    named = lambda p, n: p[{"tenth_percentile": "10th_percentile", "ninetieth_percentile": "90th_percentile"}.get(n, n)].alias(n)
    return {
        "items": own.select(
            *head, F.col("r.description").alias("description"), drug["unit"].alias("drug_unit"), drug["type"].alias("drug_unit_type"), F.size("codes").alias("code_count"), F.size("charges").alias("charge_count"),
            F.exists("codes", _is_ndc).alias("has_ndc"), drug.isNotNull().alias("has_drug"), F.lit(0).alias("unpaired_codes"), F.col("schema_family").alias("record_family"),
        ),
        "codes": own.select(*head, F.posexplode("codes").alias("code_ordinal", "x")).select(*head, "code_ordinal", "x.code", "x.type"),
        "drugs": own.filter(drug.isNotNull()).select(*head, drug["unit"].alias("unit"), drug["type"].alias("type")),
        "charges": charge.select(*head, "charge_ordinal", *[F.col(f"c.{n}").alias(n) for n in CHARGE], *[any_(f"standard_charge_{n}") for n in ("dollar", "percentage", "algorithm")]),
        "rates": charge.select(*head, "charge_ordinal", F.col("c.additional_generic_notes").alias("additional_generic_notes"), F.posexplode("c.payers_information").alias("payer_ordinal", "p")).select(
            *head, "charge_ordinal", "payer_ordinal", "additional_generic_notes", *[named(F.col("p"), n) for n in RATE]
        ),
    }


def stage_csv(rows: DataFrame, slots: list[tuple[str, str]]) -> dict[str, DataFrame]:
    """rows: snapshot_id, hospital_id, schema_family, row_ordinal and the texts of a tall file; slots: its (code, type) columns.

    A row is an item's, a charge's and, where it names a payer or states a rate, a rate's.
    """
    cells = [F.struct(F.lit(i).alias("code_ordinal"), F.col(c).alias("code"), F.col(t).alias("type")) for i, (c, t) in enumerate(slots)]
    own = rows.withColumns({"format_family": F.lit("csv"), "source_id": F.col("row_ordinal").cast("string"), "codes": F.filter(F.array(*cells), lambda x: stated(x["code"]) | stated(x["type"]))})
    head = ["format_family", "snapshot_id", "hospital_id", "schema_family", "source_id"]
    drug = stated(F.col("drug_unit_of_measurement")) | stated(F.col("drug_type_of_measurement"))
    zero = F.lit(0)
    charge = own.withColumns({"charge_ordinal": zero, "payer_ordinal": zero})
    any_ = lambda name: stated(F.col(name)).alias(f"has_payer_{name.removeprefix('standard_charge_')}")
    text = F.exists(F.array("payer_name", "plan_name", "methodology", "standard_charge_dollar", "standard_charge_percentage", "standard_charge_algorithm"), stated)
    return {
        "items": own.select(
            *head, "description", F.col("drug_unit_of_measurement").alias("drug_unit"), F.col("drug_type_of_measurement").alias("drug_unit_type"), F.size("codes").alias("code_count"), F.lit(1).alias("charge_count"),
            F.exists("codes", _is_ndc).alias("has_ndc"), drug.alias("has_drug"), F.size(F.filter("codes", lambda x: stated(x["code"]) != stated(x["type"]))).alias("unpaired_codes"), F.col("schema_family").alias("record_family"),
        ),
        "codes": own.select(*head, F.explode("codes").alias("x")).select(*head, "x.*"),
        "drugs": own.filter(drug).select(*head, F.col("drug_unit_of_measurement").alias("unit"), F.col("drug_type_of_measurement").alias("type")),
        "charges": charge.select(*head, "charge_ordinal", *CHARGE, *[any_(f"standard_charge_{n}") for n in ("dollar", "percentage", "algorithm")]),
        "rates": charge.filter(text).select(*head, "charge_ordinal", "payer_ordinal", "additional_generic_notes", *RATE),
    }


def _code(code: Column, kind: Column, shown_code: Column, shown_type: Column) -> Column:
    return F.struct(code.alias("code"), kind.alias("type"), shown_code.alias("_shown_code"), shown_type.alias("_shown_type"))


def json_records(items: DataFrame, record: str = "record", item_ordinal: str = "item_ordinal") -> DataFrame:
    """What stage_json takes, a row per record: its item's texts and counts, its codes as published and cleaned, its charges with their payers."""
    r = F.col(record)
    drug, codes, charges = r["drug_information"], *(F.coalesce(r[c], F.array()) for c in ("code_information", "standard_charges"))
    return items.select(
        F.lit("json").alias("format_family"), "snapshot_id", "hospital_id", "schema_family", F.concat_ws("_", "snapshot_id", F.col(item_ordinal).cast("string")).alias("source_id"), r["description"].alias("description"),
        drug["unit"].alias("drug_unit"), drug["type"].alias("drug_unit_type"), drug.isNotNull().alias("has_drug"), F.transform(codes, lambda x: _code(x["code"], x["type"], clean_display_text(x["code"]), clean_display_text(x["type"]))).alias("codes"),
        F.size(codes).alias("code_count"), F.size(charges).alias("charge_count"), F.lit(0).alias("unpaired_codes"), F.col("schema_family").alias("record_family"), charges.alias("charges"),
    )


def csv_records(rows: DataFrame, slots: list[tuple[str, str]]) -> DataFrame:
    """What stage_csv takes, a row per row, which is its item's, its charge's and its rate's."""
    pairs = [(f"_slot_{i}", F.col(c), F.col(t)) for i, (c, t) in enumerate(slots)]
    own = once(rows, **{name: _code(c, t, quick_display_text(c), quick_display_text(t)) for name, c, t in pairs})
    codes = F.filter(F.array(*[name for name, _, _ in pairs]), lambda x: x["_shown_code"].isNotNull() | x["_shown_type"].isNotNull())
    unpaired = reduce(lambda a, b: a + b, [(F.col(f"{name}._shown_code").isNull() != F.col(f"{name}._shown_type").isNull()).cast("int") for name, _, _ in pairs])
    drug = stated(F.col("drug_unit_of_measurement")) | stated(F.col("drug_type_of_measurement"))
    own = own.select(
        F.lit("csv").alias("format_family"), "snapshot_id", "hospital_id", "schema_family", F.col("row_ordinal").cast("string").alias("source_id"), "description", F.col("drug_unit_of_measurement").alias("drug_unit"),
        F.col("drug_type_of_measurement").alias("drug_unit_type"), drug.alias("has_drug"), codes.alias("codes"), unpaired.alias("unpaired_codes"), F.lit(1).alias("charge_count"), F.col("schema_family").alias("record_family"), *CHARGE, *RATE,
    )
    return own.withColumn("code_count", F.size("codes"))


#: What is carried down from a record to its charges and rates.
_HEAD = ["format_family", "snapshot_id", "hospital_id", "schema_family", "source_id"]
_PAYER_RATE = ["standard_charge_dollar", "standard_charge_percentage", "standard_charge_algorithm"]


def item_of(records: DataFrame) -> DataFrame:
    """Records with item_there, whether no rule excludes the item, and its charge_item_id, code_set_signature and cleaned texts. A code that a rule excludes is not the item's, nor a drug's texts."""
    texts = {"description": "description", "unit": "drug_unit", "type": "drug_unit_type"}
    own = once(records, _codes=F.col("codes"), **{f"_shown_{n}": quick_display_text(F.col(c)) for n, c in texts.items()})
    own = own.withColumn("has_ndc", F.exists("_codes", lambda x: F.coalesce(F.lower(x["_shown_type"]) == "ndc", F.lit(False))))
    kept = F.filter("_codes", lambda x: ~excluded(published_rules.code(lambda name: x[name])))
    kept = F.transform(kept, lambda x: F.concat_ws(":", F.coalesce(x["_shown_code"], F.lit("")), F.coalesce(F.lower(x["_shown_type"]), F.lit(""))))
    own = once(own, item_there=~excluded(published_rules.charge_item()), _kept=kept, _no_drug=F.col("has_drug") & excluded(published_rules.drug()))
    of_drug = lambda name: F.when(~F.col("_no_drug"), F.lower(f"_shown_{name}"))
    own = own.withColumns({
        "clean_description": F.col("_shown_description"), "code_set_signature": F.md5(F.when(F.size("_kept") > 0, F.array_join("_kept", "|")).otherwise("<no_codes>")),
        "drug_unit": of_drug("unit"), "clean_drug_unit_type": of_drug("type"),
    })
    csv = surrogate_key("snapshot_id", F.lit("csv"), surrogate_key("snapshot_id", "clean_description", "code_set_signature", "drug_unit", "clean_drug_unit_type"))
    own = own.withColumn("charge_item_id", F.when(F.col("format_family") == "csv", csv).otherwise(surrogate_key("snapshot_id", F.lit("json"), "source_id")))
    passed = [c for c in records.columns if c in ("charges", *CHARGE, *RATE)]
    return own.select(*_HEAD, "item_there", "charge_item_id", "clean_description", "code_set_signature", "drug_unit", "clean_drug_unit_type", *passed)


def _stated(name: str) -> str:
    return f"has_payer_{name.removeprefix('standard_charge_')}"


def charge_of(items: DataFrame) -> DataFrame:
    """item_of's rows by charge, with charge_there, whether the item is there and no rule excludes the charge, and its standard_charge_id, amounts and cleaned texts."""
    head = [*_HEAD, "item_there", "charge_item_id"]
    if "charges" in items.columns:
        payers = F.coalesce(F.col("c.payers_information"), F.array())
        own = items.select(*head, F.posexplode_outer("charges").alias("charge_ordinal", "c")).filter("charge_ordinal is not null")
        any_ = lambda name: F.exists(payers, lambda p: stated(p[name])).alias(_stated(name))
        own = own.select(*head, "charge_ordinal", *[F.col(f"c.{n}").alias(n) for n in CHARGE], payers.alias("payers"), *[any_(n) for n in _PAYER_RATE])
        passed = ["payers"]
    else:
        own = items.select(*head, F.lit(0).alias("charge_ordinal"), *CHARGE, *RATE, *[stated(F.col(n)).alias(_stated(n)) for n in _PAYER_RATE])
        passed = RATE
    own = once(with_cleaned(own, published_rules.standard_charge()), charge_there=F.col("item_there") & ~excluded(published_rules.standard_charge()))
    csv = surrogate_key("charge_item_id", *CHARGE)
    key = F.when(F.col("format_family") == "csv", csv).otherwise(surrogate_key("charge_item_id", "charge_ordinal"))
    amounts = [shown(n).try_cast("decimal(18,4)").alias(n) for n in CHARGE[:4]]
    return own.select(*_HEAD, "charge_ordinal", "charge_there", "charge_item_id", key.alias("standard_charge_id"), *amounts, cleaned("setting").alias("clean_setting"), cleaned("billing_class").alias("clean_billing_class"), "additional_generic_notes", *passed)


def rate_key() -> Column:
    return surrogate_key("snapshot_id", "format_family", "source_id", "charge_ordinal", "payer_ordinal")


def rate_of(charges: DataFrame) -> DataFrame:
    """charge_of's rows by rate, with rejected, whether a rule excludes the rate, and its payer_rate_id, amounts and cleaned texts. It is accepted where it is not, and its charge is there."""
    head = [*_HEAD, "charge_ordinal", "charge_there", "charge_item_id", "standard_charge_id", "additional_generic_notes"]
    if "payers" in charges.columns:
        names = {"tenth_percentile": "10th_percentile", "ninetieth_percentile": "90th_percentile"}
        own = charges.select(*head, F.posexplode("payers").alias("payer_ordinal", "p")).select(*head, "payer_ordinal", *[F.col("p")[names.get(n, n)].alias(n) for n in RATE])
    else:
        said = F.exists(F.array("payer_name", "plan_name", "methodology", *_PAYER_RATE), stated)
        own = charges.filter(said).select(*head, F.lit(0).alias("payer_ordinal"), *RATE)
    own = once(with_cleaned(own, published_rules.payer_rate()), rejected=excluded(published_rules.payer_rate()))
    amounts = [shown(c).try_cast("decimal(18,4)").alias(n) for n, c in AMOUNTS.items()]
    return own.select(
        rate_key().alias("payer_rate_id"), *KEYS["rates"], "hospital_id", "charge_there", "rejected", "charge_item_id", "standard_charge_id",
        *[cleaned(n).alias(f"clean_{n}") for n in ("payer_name", "plan_name", "methodology")], *amounts, shown("standard_charge_algorithm").alias("negotiated_algorithm"), F.col("count").alias("raw_count"),
    )


def union(*staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {grain: union_all([s[grain] for s in staged]) for grain in KEYS}


def rules_of(grain: str) -> list[Rule]:
    return {"items": published_rules.charge_item, "codes": published_rules.code, "drugs": published_rules.drug, "charges": published_rules.standard_charge, "rates": published_rules.payer_rate}[grain]()


def violations(staged: dict[str, DataFrame], grain: str) -> DataFrame:
    return evaluate(staged[grain], rules_of(grain), KEYS[grain])


def rejections(staged: dict[str, DataFrame], grain: str | None = None) -> dict[str, DataFrame] | DataFrame:
    """Keys that a rule excludes, by grain, or those of one grain."""
    return rejected_keys(violations(staged, grain), KEYS[grain]) if grain else {g: rejections(staged, g) for g in KEYS}


def _left(staged: dict[str, DataFrame], rejected: dict[str, DataFrame], grain: str) -> DataFrame:
    return scope.accepted(staged[grain], rejected[grain], KEYS[grain])


def charge_items(staged: dict[str, DataFrame], rejected: dict[str, DataFrame]) -> DataFrame:
    """Each accepted record or row with its item: charge_item_id, code_set_signature and the cleaned texts. Items of JSON are records, those of CSV are signatures."""
    good = _left(staged, rejected, "codes")
    text = F.concat_ws(":", F.coalesce(clean_display_text(F.col("code")), F.lit("")), F.coalesce(clean_text(F.col("type")), F.lit("")))
    signature = F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("code_ordinal", text.alias("text")))), lambda x: x["text"]), "|"))
    codes = good.groupBy(*KEYS["items"]).agg(signature.alias("code_set_signature"))
    # A rejected drug's texts do not tell items apart.
    drugs = rejected["drugs"].withColumn("no_drug", F.lit(True))
    own = _left(staged, rejected, "items").join(codes, KEYS["items"], "left").join(drugs, KEYS["drugs"], "left")
    kept = lambda c: F.when(F.col("no_drug").isNull(), c)
    own = own.select(
        *KEYS["items"], "hospital_id", "schema_family", F.col("description").alias("raw_description"), clean_display_text(F.col("description")).alias("clean_description"),
        F.coalesce("code_set_signature", F.md5(F.lit("<no_codes>"))).alias("code_set_signature"), kept(clean_text(F.col("drug_unit"))).alias("drug_unit"), kept(clean_text(F.col("drug_unit_type"))).alias("clean_drug_unit_type"),
    )
    csv = surrogate_key("snapshot_id", F.lit("csv"), surrogate_key("snapshot_id", "clean_description", "code_set_signature", "drug_unit", "clean_drug_unit_type"))
    return own.withColumn("charge_item_id", F.when(F.col("format_family") == "csv", csv).otherwise(surrogate_key("snapshot_id", F.lit("json"), "source_id")))


def standard_charges(staged: dict[str, DataFrame], rejected: dict[str, DataFrame], items: DataFrame) -> DataFrame:
    """Each accepted charge of an accepted item with its standard_charge_id; rows of a CSV item with equal charge texts share one."""
    own = _left(staged, rejected, "charges").join(items.select(*KEYS["items"], "charge_item_id"), KEYS["items"])
    csv = surrogate_key("charge_item_id", *CHARGE)
    key = F.when(F.col("format_family") == "csv", csv).otherwise(surrogate_key("charge_item_id", "charge_ordinal"))
    amounts = {n: safe_decimal(F.col(n)).alias(n) for n in CHARGE[:4]}
    return own.select(*KEYS["charges"], "hospital_id", "charge_item_id", key.alias("standard_charge_id"), *amounts.values(), clean_text(F.col("setting")).alias("clean_setting"), clean_text(F.col("billing_class")).alias("clean_billing_class"))


def rate_modifiers(rates: DataFrame, modifiers: DataFrame, on: str = "standard_charge_id", rate: str = "payer_rate_id") -> DataFrame:
    """(rate, modifier_signature, modifier_count): a charge's modifiers hold for every rate below it; rates without any have the marker's signature."""
    own = rates.select(rate, on).join(modifiers.select(on, "match_modifier_code"), on, "left")
    return own.groupBy(rate).agg(modifier_signature(F.col("match_modifier_code")).alias("modifier_signature"), F.count_distinct("match_modifier_code").alias("modifier_count"))


def metadata_children(tables: dict[str, DataFrame], broken: dict[str, DataFrame], keys: dict[str, list[str]], parents: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Locations, identifiers, provisions, modifiers and their payers as base tables: rows that a rule excludes are gone, and so are rows whose parent is.

    broken: the violations of a table, where it has rules; keys: what identifies a row there; parents: child -> parent, joined on the parent's keys.
    """
    kept = {name: scope.accepted(t, rejected_keys(broken[name], keys[name]), keys[name]) if name in broken else t for name, t in tables.items()}
    for child, parent in (parents or {}).items():
        kept[child] = kept[child].join(kept[parent].select(*keys[parent]).distinct(), keys[parent], "left_semi")
    return kept


def payer_rates(staged: dict[str, DataFrame], rejected: dict[str, DataFrame], charges: DataFrame) -> DataFrame:
    """Accepted rates of accepted charges, of both formats."""
    own = _left(staged, rejected, "rates").join(charges.select(*KEYS["charges"], "charge_item_id", "standard_charge_id"), KEYS["charges"])
    return own.select(
        rate_key().alias("payer_rate_id"), *KEYS["rates"], "hospital_id", "charge_item_id", "standard_charge_id",
        *[clean_text(F.col(n)).alias(f"clean_{n}") for n in ("payer_name", "plan_name", "methodology")], *[safe_decimal(F.col(c)).alias(n) for n, c in AMOUNTS.items()],
        clean_display_text(F.col("standard_charge_algorithm")).alias("negotiated_algorithm"), F.col("count").alias("raw_count"),
    )
