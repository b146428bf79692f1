"""Billing codes: normal forms, layouts, statuses, comparability."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values, in the published order: code systems by how they are treated.
LOCAL_SYSTEMS = ["cdm", "local"]
DRG_SYSTEMS = ["drg", "ms-drg", "r-drg", "s-drg", "aps-drg", "ap-drg", "apr-drg", "tris-drg", "ms-ltc-drg"]
SPECIFIC_SYSTEMS = ["cpt", "hcpcs", "ndc", "cdt", "apc", "eapg", "hipps", "cmg", *DRG_SYSTEMS]
#: Layouts of ten digits that show which segment is short, and where its zero goes.
NDC_LAYOUTS = {"4-4-2": 0, "5-3-2": 5, "5-4-1": 9}
#: Forms that codes of a system must have to be valid; other systems are not validated.
VALID_FORMS = {"rc": "^[0-9]{4}$", "ms-drg": "^[0-9]{3}$", "cpt": "^[0-9]{4}[0-9A-Z]$", "hcpcs": "^([A-Z][0-9]{4}|[0-9]{4}[0-9A-Z])$", "ndc": "^[0-9]{11}$"}


def _layout(layout: str) -> str:
    return "^" + "-".join(f"[0-9]{{{n}}}" for n in layout.split("-")) + "$"


def ndc11(x: Column) -> Column:
    """Eleven digits where there are eleven, or where the layout of ten proves which segment is short; null otherwise."""
    digits = F.regexp_replace(x, "[^0-9]", "")
    out = F.when(F.length(digits) == 11, digits)
    for layout, at in NDC_LAYOUTS.items():
        out = out.when(x.rlike(_layout(layout)), F.concat(F.substring(digits, 1, at), F.lit("0"), F.substring(digits, at + 1, 10)))
    return out


def ndc_status(x: Column) -> Column:
    """How a drug code is written: canonical_11(_unhyphenated), padded_from_10_*, ambiguous_10_unhyphenated, invalid_layout, invalid_length; null for null."""
    digits = F.length(F.regexp_replace(x, "[^0-9]", ""))
    out = F.when(x.rlike("^[0-9]{11}$"), "canonical_11_unhyphenated").when(digits == 11, "canonical_11")
    for layout in NDC_LAYOUTS:
        out = out.when(x.rlike(_layout(layout)), "padded_from_10_" + layout.replace("-", "_"))
    return out.when(x.rlike("^[0-9]{10}$"), "ambiguous_10_unhyphenated").when(digits == 10, "invalid_layout").when(x.isNotNull(), "invalid_length")


def match_code(system: Column, code: Column) -> Column:
    """The form in which cleaned codes of a system are compared: zero-padded numbers, 11-digit drug codes, else upper case without white space."""
    padded = lambda systems, n: system.isin(systems) & code.rlike(f"^[0-9]{{1,{n}}}$")
    return (
        F.when(code.isNull(), None)
        .when(padded(["rc", "apc"], 4), F.lpad(code, 4, "0"))
        .when(padded(DRG_SYSTEMS, 3), F.lpad(code, 3, "0"))
        .when((system == "apc") & code.rlike("^0[0-9]{4}$"), F.substring(code, 2, 4))
        .when((system == "ndc") & ndc11(code).isNotNull(), ndc11(code))
        .otherwise(F.upper(F.regexp_replace(code, r"\s+", "")))
    )


def code_status(code: Column, kind: Column, system: Column, match: Column) -> Column:
    """missing_code, missing_code_system, unknown_code_system, valid, invalid_format or not_validated; kind is the cleaned type, system what it stands for."""
    out = F.when(code.isNull(), "missing_code").when(kind.isNull(), "missing_code_system").when(system.isNull(), "unknown_code_system")
    for name, form in VALID_FORMS.items():
        fits = ndc11(code).isNotNull() if name == "ndc" else match.rlike(form)
        out = out.when(system == name, F.when(fits, "valid").otherwise("invalid_format"))
    return out.otherwise("not_validated")


def comparable_across_publishers(system: Column) -> Column:
    return F.coalesce(~system.isin(LOCAL_SYSTEMS), F.lit(False))


def is_specific(system: Column, specific: list[str] | None = None) -> Column:
    return F.coalesce(system.isin(specific or SPECIFIC_SYSTEMS), F.lit(False))


def drug_unit_status(unit: Column, canonical: Column) -> Column:
    return F.when(unit.isNull(), "missing_unit").when(canonical.isNotNull(), "canonical").otherwise("unknown_unit")


def ndc_lacks_unit(has_ndc: Column, unit: Column, kind: Column) -> Column:
    """Whether an item with a drug code states no unit."""
    return F.coalesce(has_ndc, F.lit(False)) & (unit.isNull() | kind.isNull())


#: Statuses of drug units, the most informative first.
DRUG_UNIT_STATUSES = ["canonical", "unknown_unit", "missing_unit"]


def collapse_status(status: Column, order: list[str] | None = None) -> Column:
    """Aggregate: the foremost status that occurs; the last one where none of them does."""
    order = order or DRUG_UNIT_STATUSES
    names = F.array(*[F.lit(x) for x in order])
    rank = F.array_position(names, status)
    return F.element_at(names, F.coalesce(F.min(F.when(rank > 0, rank)), F.lit(len(order))).cast("int"))


def modifier_status(reference: Column) -> Column:
    return F.when(reference.isNotNull(), "known").otherwise("unknown")
