"""Published files to tables: nested JSON records, tall and wide CSV, headers, reference tables. One job for all files, per-record work in expressions.

JSON arrives as one item per line; a single document of many items has to be split before, as Spark would read it in one task. Every scalar is kept as text.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.text import clean_text
from .csv_records import with_cells

_PAYER = "struct<payer_name:string,plan_name:string,methodology:string,standard_charge_dollar:string,standard_charge_percentage:string,standard_charge_algorithm:string,estimated_amount:string,median_amount:string,`10th_percentile`:string,`90th_percentile`:string,count:string,additional_payer_notes:string>"
_CHARGE = f"struct<minimum:string,maximum:string,gross_charge:string,discounted_cash:string,setting:string,billing_class:string,additional_generic_notes:string,modifier_code:array<string>,payers_information:array<{_PAYER}>>"
#: Schema of one item: every leaf is text.
ITEM = f"struct<description:string,code_information:array<struct<code:string,type:string>>,drug_information:struct<unit:string,type:string>,standard_charges:array<{_CHARGE}>>"
HEADER = "struct<hospital_name:string,last_updated_on:string,version:string,hospital_location:array<string>,hospital_address:array<string>,license_information:struct<license_number:string,state:string>,type_2_npi:array<string>,attestation:struct<attestation:string,confirm_attestation:string,attester_name:string>>"
MODIFIER = "struct<code:string,description:string,setting:string,modifier_payer_information:array<struct<payer_name:string,plan_name:string,description:string>>>"


def snapshots_of(spark: SparkSession, root: str, schema: str | None = None, column: str = "snapshot_id") -> DataFrame:
    """Scan root/snapshot_id=*/, columns united by name; a typed empty table where there are no files."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(root)
    if schema and not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], f"{schema}, {column} string")
    reader = spark.read.option("mergeSchema", True)
    return (reader.schema(f"{schema}, {column} string") if schema else reader).parquet(root)


def _container_pattern(schema: str) -> str:
    """Where a record has an array or object under a key that the schema has as text, or inside a list of texts. Quotes within JSON texts follow a backslash, so keys are told apart."""
    scalars = sorted(set(re.findall(r"[<,]`?(\w+)`?:string", schema)) - set(re.findall(r"[<,]`?(\w+)`?:(?:struct|array)<", schema)))  # a name may be both
    lists = sorted(set(re.findall(r"[<,]`?(\w+)`?:array<string>", schema)))
    patterns = [rf'(?<!\\)"({"|".join(scalars)})"\s*:\s*[\[{{]'] + [rf'(?<!\\)"({"|".join(lists)})"\s*:\s*\[[^\]"]*(?:"(?:[^"\\]|\\.)*"[^\]"]*)*[\[{{]'] * bool(lists)
    return "|".join(patterns)


def _odd_bracket(schema: str) -> str:
    """A bracket after a key and a colon, unless right after the key of a container: all that _container_pattern finds have one, told much faster."""
    names = set(re.findall(r"[<,]`?(\w+)`?:(?:struct|array)<", schema)) - set(re.findall(r"[<,]`?(\w+)`?:(?:array<)?string", schema))
    known = rf'(?<!"(?:{"|".join(sorted(names))})":[\[{{])' if names else ""
    return rf'"\s*:\s*[\[{{]{known}'


def split_json(frame: DataFrame, column: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose record parses, with it under 'record'; rows whose record does not, or has a container where a scalar belongs). schema: a struct type.

    The record, and whether it has such a container, are exploded from an array of one, so that filters on them stay above and each text is made, parsed and searched once; moved below a projection,
    every use in a filter would do it again.
    """
    wide = schema.removesuffix(">") + ",_corrupt:string>"
    odd = F.col(column).rlike(_odd_bracket(schema)) & F.col(column).rlike(_container_pattern(schema))
    parsed = F.struct(F.from_json(column, wide, {"columnNameOfCorruptRecord": "_corrupt"}).alias("record"), odd.alias("odd"))
    own = frame.select("*", F.explode_outer(F.array(parsed)).alias("_parsed")).select("*", "_parsed.record", F.col("_parsed.odd").alias("_odd")).drop("_parsed")
    bad = F.col("record").isNull() | F.col("record._corrupt").isNotNull() | F.col("_odd")
    return own.filter(~bad).drop("_odd"), own.filter(bad).drop("record", "_odd")


def diagnostics(bad: DataFrame, keys: list[str], column: str, section: str) -> DataFrame:
    """A row for each quarantined record."""
    return bad.select(*keys, F.lit(section).alias("section"), F.lit("record does not parse").alias("error_summary"), F.col(column).alias("raw_record"))


def _signals(record: str) -> tuple[Column, Column]:
    """(of 3.0, of 2.2): whether a payer with a percentage or algorithm states counts or allowed amounts, or an estimate."""
    payers = F.flatten(F.transform(F.col(f"{record}.standard_charges"), lambda c: F.coalesce(c["payers_information"], F.array().cast(f"array<{_PAYER}>"))))
    some = lambda names: lambda p: (p["standard_charge_percentage"].isNotNull() | p["standard_charge_algorithm"].isNotNull()) & reduce(lambda a, b: a | b, [p[n].isNotNull() for n in names])
    v3 = F.coalesce(F.exists(payers, some(["count", "median_amount", "10th_percentile", "90th_percentile"])), F.lit(False))
    return v3, F.coalesce(F.exists(payers, some(["estimated_amount"])), F.lit(False))


def schema_family(record: str = "record", default: Column | None = None) -> Column:
    """The family that a record's payers show: 3.0, also where both show, or 2.2; else the header's."""
    v3, v2 = _signals(record)
    return F.when(v3, "3.0").when(v2, "2.2").otherwise(default if default is not None else F.lit(None).cast("string"))


def schema_conflict(record: str = "record") -> Column:
    """Whether a record's payers show both families: it is kept as published, for inspection."""
    v3, v2 = _signals(record)
    return v3 & v2


def flatten_items(items: DataFrame, record: str = "record", snapshot: str = "snapshot_id", ordinal: str = "item_ordinal") -> dict[str, DataFrame]:
    """Six child tables of item records, ordinals kept."""
    own = items.withColumn("charge_item_id", F.concat_ws("_", F.col(snapshot), F.col(ordinal).cast("string")))
    r = F.col(record)
    charges = own.select(snapshot, "charge_item_id", F.posexplode(r["standard_charges"]).alias("charge_ordinal", "c")).withColumn("standard_charge_id", F.concat_ws("_", "charge_item_id", F.col("charge_ordinal").cast("string")))
    payers = charges.select(snapshot, "standard_charge_id", F.posexplode("c.payers_information").alias("payer_ordinal", "p")).select(snapshot, "standard_charge_id", "payer_ordinal", "p.*")
    return {
        "standard_charge_info": own.select("charge_item_id", snapshot, r["description"].alias("description"), ordinal),
        "code_information": own.select(snapshot, "charge_item_id", F.posexplode(r["code_information"]).alias("code_ordinal", "x")).select(snapshot, "charge_item_id", "code_ordinal", "x.*"),
        "drug_information": own.filter(r["drug_information"].isNotNull()).select(snapshot, "charge_item_id", r["drug_information"]["unit"].alias("unit"), r["drug_information"]["type"].alias("type")),
        "standard_charges": charges.select("standard_charge_id", snapshot, "charge_item_id", "charge_ordinal", *[F.col(f"c.{n}") for n in ("minimum", "maximum", "gross_charge", "discounted_cash", "setting", "billing_class", "additional_generic_notes")]),
        "standard_charge_modifiers": charges.select(snapshot, "standard_charge_id", F.posexplode("c.modifier_code").alias("modifier_ordinal", "modifier_code")),
        "payers_information": payers,
    }


def flatten_headers(headers: DataFrame, record: str = "record", snapshot: str = "snapshot_id") -> dict[str, DataFrame]:
    r = F.col(record)
    names, places = F.coalesce(r["hospital_location"], F.array().cast("array<string>")), F.coalesce(r["hospital_address"], F.array().cast("array<string>"))
    located = headers.select(snapshot, F.posexplode(F.arrays_zip(names.alias("location_name"), places.alias("hospital_address"))).alias("location_ordinal", "x"))
    return {
        "hospital_mrf_snapshots": headers.select(
            snapshot, r["hospital_name"].alias("reported_hospital_name"), r["last_updated_on"].alias("published_last_updated_on"), r["version"].alias("schema_version"), r["license_information"]["license_number"].alias("license_number"),
            r["license_information"]["state"].alias("reported_state"), r["attestation"]["attestation"].alias("attestation"), r["attestation"]["confirm_attestation"].alias("confirm_attestation"), r["attestation"]["attester_name"].alias("attester_name"),
        ),
        "hospital_locations": located.select(snapshot, "location_ordinal", "x.*"),
        "type2_npi": headers.select(snapshot, F.posexplode(r["type_2_npi"]).alias("npi_ordinal", "npi")),
    }


def flatten_modifiers(sections: DataFrame, record: str = "record", snapshot: str = "snapshot_id") -> dict[str, DataFrame]:
    """record: an array of modifier structs. Children are kept even where a modifier has no payers."""
    own = sections.select(snapshot, F.posexplode(record).alias("ordinal", "m")).withColumn("modifier_code_id", F.concat_ws("_", F.col(snapshot), F.lit("mod"), F.col("ordinal").cast("string")))
    payers = own.select(snapshot, "modifier_code_id", F.posexplode("m.modifier_payer_information").alias("modifier_payer_ordinal", "p")).select(snapshot, "modifier_code_id", "modifier_payer_ordinal", "p.*")
    return {"modifiers": own.select("modifier_code_id", snapshot, "m.code", "m.description", "m.setting"), "modifier_payer_info": payers}


def flatten_provisions(sections: DataFrame, record: str = "record", snapshot: str = "snapshot_id") -> DataFrame:
    """record: an array of (payer_name, plan_name, provisions); rows stay even where the text is missing."""
    return sections.select(snapshot, F.posexplode_outer(record).alias("provision_ordinal", "p")).select(snapshot, "provision_ordinal", "p.*")


def _canonical(header: str) -> str:
    return re.sub(r"[^a-z0-9_]+", "_", header.strip().lower().replace("|", "_")).strip("_")


def code_slots(columns: list[str]) -> list[tuple[str, str]]:
    """(code, type) columns in order of N, from headers code|N and code|N|type."""
    found = sorted({int(m[1]) for c in columns if (m := re.fullmatch(r"code\|(\d+)(?:\|type)?", c.strip().lower()))})
    return [(f"code|{n}", f"code|{n}|type") for n in found]


def layout(columns: list[str]) -> str:
    """csv_wide where payers stand in the headers, csv_tall where they are columns, else unknown."""
    names = [c.strip().lower() for c in columns]
    if any(re.fullmatch(r"standard_charge\|[^|]+\|[^|]+\|.+", c) for c in names):
        return "csv_wide"
    return "csv_tall" if "payer_name" in names else "unknown"


#: Headers of tall files that are named otherwise in tables.
TALL_NAMES = {
    "standard_charge_gross": "gross_charge", "standard_charge_discounted_cash": "discounted_cash", "standard_charge_min": "minimum", "standard_charge_max": "maximum", "standard_charge_negotiated_dollar": "standard_charge_dollar",
    "standard_charge_negotiated_percentage": "standard_charge_percentage", "standard_charge_negotiated_algorithm": "standard_charge_algorithm", "standard_charge_methodology": "methodology", "10th_percentile": "tenth_percentile", "90th_percentile": "ninetieth_percentile",
}


def _canonical_names(names: str) -> Column:
    return F.transform(names, lambda x: F.regexp_replace(F.regexp_replace(F.lower(x), r"[^a-z0-9_\[\]]+", "_"), "^_+|_+$", ""))


def _heads(lines: DataFrame) -> DataFrame:
    """snapshot_id, keys, values, names: the cells of the first three lines, a row per file."""
    own = with_cells(lines.filter("line_ordinal < 3").select("snapshot_id", "line_ordinal", "line"), "line")
    cells = [F.max(F.when(F.col("line_ordinal") == n, F.col("cells"))).alias(c) for n, c in enumerate(("keys", "values", "names"))]
    return own.groupBy("snapshot_id").agg(*cells)


def _fields(names: Column) -> Column:
    """Positions and names of the cells that have a name; of equal names the last."""
    named = F.transform(names, lambda x, i: F.struct(i.alias("position"), x.alias("name")))
    return F.filter(named, lambda e: (e["name"] != "") & ~F.exists(F.slice(names, e["position"] + 2, F.size(names)), lambda y: y == e["name"]))


def _by_name(fields: str, cells: str) -> Column:
    """A map from names to cells, '' where there is none."""
    return F.map_from_arrays(F.col(f"{fields}.name"), F.transform(F.col(f"{fields}.position"), lambda p: F.coalesce(F.get(F.col(cells), p), F.lit(""))))


def csv_files(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """lines: snapshot_id, line_ordinal from 0, line (a record, which may hold line ends). Files' first two lines are the header's keys and values, the third names the columns.

    (snapshot_id, header, layout, version: a row per file; snapshot_id, row_ordinal from 0, cells: a row per line from the fourth on). header and cells are maps from
    canonical names to texts. Files of any layout and width go through together; what names the columns is a row per file, made canonical once.
    """
    heads = _heads(lines).withColumns({"key_fields": _fields(_canonical_names("keys")), "fields": _fields(_canonical_names("names"))})
    lower = F.transform("names", lambda x: F.lower(x))
    layout_ = F.when(F.array_contains(lower, "payer_name"), "csv_tall").when(F.exists(lower, lambda x: x.rlike(r"^standard_charge\|.*\|.*\|")), "csv_wide").otherwise("unknown")
    struct = F.filter(F.zip_with("keys", "values", lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda e: F.lower(e["a"]) == "version")
    headers = heads.select("snapshot_id", _by_name("key_fields", "values").alias("header"), layout_.alias("layout"), F.nullif(F.get(struct, F.lit(0))["b"], F.lit("")).alias("version"))
    body = with_cells(lines.filter("line_ordinal >= 3").select("snapshot_id", (F.col("line_ordinal") - 3).alias("row_ordinal"), "line"), "line")
    rows = body.join(heads.select("snapshot_id", "fields"), "snapshot_id")
    return headers, rows.select("snapshot_id", "row_ordinal", _by_name("fields", "cells").alias("cells"))


def csv_wide_rows(lines: DataFrame) -> DataFrame:
    """The rows of wide files, each by its own file's header: snapshot_id, row_ordinal, payer_name, plan_name, values, cells.

    values: a map from the names of a payer's columns in the tall layout to texts, those that are not blank; a row per payer with any, one with a null payer where no payer has any.
    cells: a map of the other columns, as csv_files gives it. A file's payer blocks are a list of (payer, plan, (name, position)s), a row per file, that is met with the row's cells by position.
    """
    heads = _heads(lines)
    named = heads.select("snapshot_id", F.posexplode("names").alias("position", "name"))
    part = lambda k: F.trim(F.get(F.split("name", r"\|"), F.lit(k)))
    word = lambda x: F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9_]+", "_"), "^_+|_+$", "")
    parts, first, third = F.size(F.split("name", r"\|")), F.lower(part(0)), F.lower(part(2))
    field = F.when((parts == 4) & (first == "standard_charge"), F.concat(F.lit("standard_charge_"), word(part(3)))).when((parts == 3) & (first != "code") & (third != "type"), word(part(0)))
    named = named.withColumns({"field": field, "payer": part(1), "plan": part(2)})
    cells = named.filter("field is not null").groupBy("snapshot_id", "payer", "plan", "field").agg(F.max("position").alias("position"))
    blocks = cells.groupBy("snapshot_id", "payer", "plan").agg(F.min("position").alias("first"), F.collect_list(F.struct(F.col("field").alias("name"), "position")).alias("fields"))
    blocks = blocks.groupBy("snapshot_id").agg(F.sort_array(F.collect_list(F.struct("first", "payer", "plan", "fields"))).alias("blocks"))
    other = F.transform("names", lambda x: F.when(F.size(F.split(x, r"\|")) < 3, x).when(F.lower(x).rlike(r"^\s*code\s*\||\|\s*type\s*$"), x).otherwise(""))
    plain = heads.select("snapshot_id", other.alias("names")).select("snapshot_id", _fields(_canonical_names("names")).alias("fields"))
    body = with_cells(lines.filter("line_ordinal >= 3").select("snapshot_id", (F.col("line_ordinal") - 3).alias("row_ordinal"), "line"), "line", "parsed")
    rows = body.join(plain.join(blocks, "snapshot_id"), "snapshot_id")

    cell = lambda f: F.coalesce(F.get(F.col("parsed"), f["position"]), F.lit(""))
    stated = F.filter("blocks", lambda x: F.exists(x["fields"], lambda f: cell(f) != ""))  # few of a file's payers have a value in a row: only theirs become maps

    def values(block: Column) -> Column:
        met = F.transform(block["fields"], lambda f: F.struct(f["name"].alias("name"), cell(f).alias("value")))
        return F.map_from_entries(F.filter(met, lambda e: e["value"] != ""))

    payers = F.transform(stated, lambda x: F.struct(x["payer"].alias("payer_name"), x["plan"].alias("plan_name"), values(x).alias("values")))
    rows = rows.select("snapshot_id", "row_ordinal", _by_name("fields", "parsed").alias("cells"), payers.alias("payers"))
    return rows.select("snapshot_id", "row_ordinal", F.explode_outer("payers").alias("p"), "cells").select("snapshot_id", "row_ordinal", "p.payer_name", "p.plan_name", F.coalesce("p.values", F.create_map().cast("map<string,string>")).alias("values"), "cells")


def csv_header_tables(headers: DataFrame) -> dict[str, DataFrame]:
    """A row per file, its locations and identifiers, from csv_files' headers; several values of one cell are parted by bars."""
    of = lambda name: F.nullif(F.try_element_at("header", F.lit(name)), F.lit(""))
    license_ = F.get(F.filter(F.map_keys("header"), lambda k: k.like("license_number%")), F.lit(0))
    parts = lambda name: F.transform(F.split(F.coalesce(of(name), F.lit("")), "[|]"), lambda x: F.trim(x))
    located = headers.select("snapshot_id", F.posexplode(F.arrays_zip(parts("location_name").alias("location_name"), parts("hospital_address").alias("hospital_address"))).alias("location_ordinal", "x"))
    return {
        "hospital_mrf_snapshots": headers.select(
            "snapshot_id", "layout", of("hospital_name").alias("reported_hospital_name"), of("last_updated_on").alias("published_last_updated_on"), F.col("version").alias("schema_version"),
            F.nullif(F.try_element_at("header", license_), F.lit("")).alias("license_number"), F.nullif(F.upper(F.regexp_extract(license_, "^license_number_(.+)$", 1)), F.lit("")).alias("reported_state"),
        ),
        "hospital_locations": located.select("snapshot_id", "location_ordinal", "x.*").filter("location_name <> '' or hospital_address <> ''"),
        "type2_npi": headers.select("snapshot_id", F.posexplode(parts("type_2_npi")).alias("npi_ordinal", "npi")).filter("npi <> ''"),
    }


def tall_rows(rows: DataFrame, names: list[str]) -> DataFrame:
    """csv_files' rows of tall files as columns of these names, blank texts null."""
    source = {v: k for k, v in TALL_NAMES.items()}
    return rows.select("snapshot_id", "row_ordinal", *[F.nullif(F.try_element_at("cells", F.lit(source.get(n, n))), F.lit("")).alias(n) for n in names])


def load_tall(frame: DataFrame) -> DataFrame:
    """Canonical names, blank texts null."""
    return frame.select(*[F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")).alias(_canonical(c)) for c in frame.columns])


def unpivot_wide(frame: DataFrame, ids: list[str]) -> DataFrame:
    """A row per payer block that has a value; one row with a null payer where no block has any. Columns are those of the tall layout."""
    groups: dict[tuple[str, str], dict[str, str]] = {}
    for c in frame.columns:
        parts = c.split("|")
        if len(parts) == 4 and parts[0] == "standard_charge":
            groups.setdefault((parts[1], parts[2]), {})[f"standard_charge_{_canonical(parts[3])}"] = c
        elif len(parts) == 3 and parts[0] not in ("code",) and parts[2] != "type":
            groups.setdefault((parts[1], parts[2]), {})[_canonical(parts[0])] = c
    names = sorted({n for g in groups.values() for n in g})
    blank = lambda c: F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit(""))
    cells = [F.struct(F.lit(p).alias("payer_name"), F.lit(q).alias("plan_name"), *[(blank(g[n]) if n in g else F.lit(None).cast("string")).alias(n) for n in names]) for (p, q), g in groups.items()]
    full = F.filter(F.array(*cells), lambda x: reduce(lambda a, b: a | b, [x[n].isNotNull() for n in names]))
    none = F.array(F.struct(F.lit(None).cast("string").alias("payer_name"), F.lit(None).cast("string").alias("plan_name"), *[F.lit(None).cast("string").alias(n) for n in names]))
    return frame.select(*ids, F.explode(F.when(F.size(full) > 0, full).otherwise(none)).alias("cell")).select(*ids, "cell.*")


def decoded(content: Column) -> Column:
    """Text of a file's bytes: UTF-8 without its mark, else Windows-1252."""
    high = [chr(b) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
    western = F.translate(F.decode(content, "iso-8859-1"), "".join(high), "".join(c.encode("latin-1").decode("cp1252") for c in high))
    text = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(western)
    return F.regexp_replace(text, "^﻿", "")


def arrivals(files: DataFrame, publisher: Column) -> DataFrame:
    """Of a binaryFile scan: publisher, path, time and SHA-256 of each file."""
    return files.select(publisher.alias("hospital_id"), "path", F.col("modificationTime").alias("ingested_at"), F.sha2("content", 256).alias("file_hash"))


def reference_table(lines: DataFrame, columns: list[str], code: str, width: int, edition: str) -> DataFrame:
    """A tab-delimited table of codes: title lines go, codes are zero-padded, Yes/No become booleans, the edition is added."""
    parts = F.split("value", "\t")
    own = lines.select(*[F.nullif(F.trim(F.get(parts, F.lit(i))), F.lit("")).alias(c) for i, c in enumerate(columns)])
    own = own.filter(F.col(code).rlike("^[0-9]+$")).withColumn(code, F.lpad(code, width, "0")).withColumn("code_edition", F.lit(edition))
    flag = lambda c: F.when(F.lower(c) == "yes", True).when(F.lower(c) == "no", False)
    return own.withColumns({c: flag(c) for c in columns if c.endswith("_drg")})


def conformed(reference: DataFrame, system: str, code: str, columns: dict[str, str]) -> DataFrame:
    """A reference table in the form that codes are matched in: code_system, match_code, code_edition, then columns (new name -> column)."""
    return reference.select(F.lit(system).alias("code_system"), codes.match_code(F.lit(system), clean_text(F.col(code), lowercase=False)).alias("match_code"), "code_edition", *[F.col(c).alias(n) for n, c in columns.items()])


def columns_like(frame: DataFrame, pattern: str, exclude: str | None = None) -> DataFrame:
    """The columns whose whole names match a pattern, but for those that match another."""
    return frame.select(*[F.col(f"`{c}`") for c in frame.columns if re.fullmatch(pattern, c) and not (exclude and re.fullmatch(exclude, c))])


def staged(frame: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Raw and clean twins of text columns, and casts: spec maps a column to text or to a type."""
    out = []
    for c, kind in spec.items():
        out += [F.col(c).alias(f"raw_{c}"), clean_text(F.col(c)).alias(f"clean_{c}")] if kind == "text" else [clean_text(F.col(c)).try_cast(kind).alias(c)]
    return frame.select(*out)
