"""The rules that published price files are held to, by grain, for rules.evaluate.

Columns are the texts as published; a text that stands for nothing counts as absent. Frames carry format_family ('json' or 'csv') and schema_family ('2.1', '2.2',
'3.0'). A record that does not parse never gets here: ingest quarantines it, and structural() turns its diagnostic into a rule's row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.semantics import METHODOLOGIES, WHOLE_COUNT
from .rules import Rule, cleaned, shown

#: Fixed values, in the published order: accepted settings, classes, measures, methods, code types by family, states.
SETTINGS = ["inpatient", "outpatient", "both"]
BILLING_CLASSES = ["professional", "facility", "both"]
DRUG_TYPES = ["gr", "me", "ml", "un", "f2", "ea", "gm"]
CODE_TYPES = ["cpt", "ndc", "hcpcs", "rc", "icd", "drg", "ms-drg", "r-drg", "s-drg", "aps-drg", "ap-drg", "apr-drg", "apc", "local", "eapg", "hipps", "cdt", "cdm", "tris-drg", "cmg", "ms-ltc-drg"]
CODE_TYPES_SINCE_3 = ["cmg", "ms-ltc-drg"]
STATES = "al ak as az ar ca co ct de dc fm fl ga gu hi id il in ia ks ky la me mh md ma mi mn ms mo mt ne nv nh nj nm ny nc nd mp oh ok or pw pa pr ri sc sd tn tx ut vt vi va wa wv wi wy".split()
COUNT = "^(0|1 through 10)$|" + WHOLE_COUNT


def _has(name: str) -> Column:
    return shown(name).isNotNull()


def _text(name: str) -> Column:
    return cleaned(name)


def _number(name: str) -> Column:
    return shown(name).try_cast("double")


def _is(column: str, value: str) -> Column:
    return F.coalesce(F.col(column) == value, F.lit(False))


def _reading(texts: str, rules: list[Rule]) -> list[Rule]:
    return [replace(r, texts=tuple(texts.split())) for r in rules]


def _numbers(grain: str, prefix: str, names: list[str]) -> list[Rule]:
    out = []
    for n in names:
        out.append(Rule(f"{prefix}_numeric_parseable", grain, n, _has(n) & _number(n).isNull(), F.col(n), message=f"{n} is not a number"))
        out.append(Rule(f"{prefix}_numeric_positive", grain, n, _number(n) <= 0, F.col(n), message=f"{n} must be above zero"))
    return out


def header(attestation: str | None = None) -> list[Rule]:
    """Files' headers: report only. attestation: the exact text that is required, if it is to be checked."""
    r = lambda rule, column, broken, message: Rule(rule, "header", column, broken, F.col(column), "error", "report_only", message)
    json3 = _is("format_family", "json") & _is("schema_family", "3.0")
    json2 = _is("format_family", "json") & F.coalesce(F.col("schema_family").isin("2.1", "2.2"), F.lit(False))
    said = F.coalesce(F.col("attestation"), F.col("affirmation"))
    confirmed = F.lower(F.coalesce(F.col("confirm_attestation"), F.col("confirm_affirmation")))
    iso, slash = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"
    date = F.col("published_last_updated_on")
    out = [r("root_required_header_shape", c, F.col(c).isNull(), f"{c} is required") for c in ("reported_hospital_name", "published_last_updated_on", "schema_version", "reported_state")]
    out += [r("attestation_required_fields", c, json3 & ~_has(c), f"{c} is required") for c in ("attestation", "confirm_attestation", "attester_name")]
    out += [r("attestation_required_fields", c, json2 & ~_has(c), f"{c} is required") for c in ("affirmation", "confirm_affirmation")]
    out += [
        r("license_information_required_state", "reported_state", ~_has("reported_state"), "a state is required"),
        r("last_updated_on_iso_date", "published_last_updated_on", date.isNotNull() & ~(date.rlike(iso) | (~_is("format_family", "json") & date.rlike(slash))), "not a date"),
        r("state_two_letter_format", "reported_state", _has("reported_state") & ~_text("reported_state").rlike("^[a-z]{2}$"), "two letters"),
        r("state_valid_usps_code", "reported_state", _has("reported_state") & ~_text("reported_state").isin(STATES), "not a state"),
        r("attestation_confirmation_true", "confirm_attestation", F.coalesce(confirmed != "true", F.lit(False)), "must be confirmed"),
        r("required_header_text_non_empty", "reported_hospital_name", F.col("reported_hospital_name").isNotNull() & ~_has("reported_hospital_name"), "blank text"),
        r("csv_placeholder_headers_resolved", "license_number", _is("format_family", "csv") & F.coalesce(F.col("license_number").rlike(r"\[.+\]"), F.lit(False)), "placeholder left in"),
    ]
    if attestation:
        out.append(r("attestation_text_exact", "attestation", said.isNotNull() & (F.trim(said) != attestation), "text differs"))
    return _reading("attestation confirm_attestation attester_name affirmation confirm_affirmation reported_state reported_hospital_name", out)


def charge_item() -> list[Rule]:
    """Items with what is known of their children: code_count, charge_count, has_ndc, has_drug, unpaired_codes, record_family."""
    r = lambda rule, column, broken, severity="error", disposition="exclude_entity": Rule(rule, "charge_item", column, broken, F.col(column), severity, disposition)
    json, csv3 = _is("format_family", "json"), _is("format_family", "csv") & _is("schema_family", "3.0")
    return _reading("description", [
        r("charge_item_description_non_empty", "description", ~_has("description")),
        r("charge_item_required_arrays_non_empty", "code_count", json & (F.col("code_count") == 0)),
        r("charge_item_required_arrays_non_empty", "charge_count", json & (F.col("charge_count") == 0)),
        r("ndc_requires_drug_information", "has_drug", F.col("has_ndc") & ~F.col("has_drug") & F.col("schema_family").isin("2.2", "3.0")),
        r("csv_code_pair_required", "unpaired_codes", csv3 & ((F.col("unpaired_codes") > 0) | (F.col("code_count") == 0))),
        r("schema_version_header_record_mismatch", "record_family", json & (F.col("record_family") != F.col("schema_family")), "warn", "report_only"),
    ])


def code(of: Callable[[str], Column] = F.col) -> list[Rule]:
    """of: where the texts are found, for codes that are elements of a record's array."""
    r = lambda rule, column, broken: Rule(rule, "code", column, broken, of(column))
    code, type_, kind = of("code"), of("type"), F.lower(of("_shown_type"))
    return _reading("code type", [
        r("code_information_required_shape", "code", code.isNull() | type_.isNull()),
        r("code_text_non_empty", "code", (code.isNotNull() & of("_shown_code").isNull()) | (type_.isNotNull() & of("_shown_type").isNull())),
        r("code_type_allowed_values", "type", of("_shown_type").isNotNull() & ~kind.isin(CODE_TYPES)),
        r("code_type_family_specific_enum", "type", F.col("schema_family").isin("2.1", "2.2") & kind.isin(CODE_TYPES_SINCE_3)),
    ])


def drug() -> list[Rule]:
    r = lambda rule, column, broken: Rule(rule, "drug", column, broken, F.col(column))
    return _reading("unit type", [
        r("drug_information_required_shape_when_present", "unit", ~_has("unit") | ~_has("type")),
        r("drug_unit_numeric_parseable", "unit", _is("schema_family", "3.0") & _has("unit") & _number("unit").isNull()),
        r("drug_unit_positive", "unit", _number("unit") <= 0),
        r("drug_type_allowed_values", "type", _has("type") & ~_text("type").isin(DRUG_TYPES)),
    ])


def standard_charge() -> list[Rule]:
    """Charges with what their payers state: has_payer_dollar, has_payer_percentage, has_payer_algorithm."""
    r = lambda rule, column, broken, severity="error", disposition="exclude_entity": Rule(rule, "standard_charge", column, broken, F.col(column), severity, disposition)
    payer = F.col("has_payer_dollar") | F.col("has_payer_percentage") | F.col("has_payer_algorithm")
    return _reading("minimum maximum gross_charge discounted_cash setting billing_class", [
        *_numbers("standard_charge", "standard_charge", ["minimum", "maximum", "gross_charge", "discounted_cash"]),
        r("standard_charge_required_setting_shape", "setting", ~_has("setting")),
        r("setting_allowed_values", "setting", _has("setting") & ~_text("setting").isin(SETTINGS)),
        r("billing_class_allowed_values", "billing_class", _has("billing_class") & ~_text("billing_class").isin(BILLING_CLASSES), "warn", "report_only"),
        r("charge_requires_any_standard_charge_value", "gross_charge", ~_has("gross_charge") & ~_has("discounted_cash") & ~payer),
        r("payer_dollar_requires_minimum_and_maximum", "minimum", F.col("has_payer_dollar") & (~_has("minimum") | ~_has("maximum"))),
    ])


def payer_rate() -> list[Rule]:
    r = lambda rule, column, broken, severity="error", disposition="exclude_entity": Rule(rule, "payer_rate", column, broken, F.col(column), severity, disposition)
    dollar, percentage, algorithm = "standard_charge_dollar", "standard_charge_percentage", "standard_charge_algorithm"
    json, csv3, v3, v22 = _is("format_family", "json"), _is("format_family", "csv") & _is("schema_family", "3.0"), _is("schema_family", "3.0"), _is("schema_family", "2.2")
    indirect, count = _has(percentage) | _has(algorithm), _text("count")
    priced, named = _has(dollar) | indirect, _has("payer_name") & _has("plan_name") & _has("methodology")
    noted = _has("additional_payer_notes") | _has("additional_generic_notes")
    return _reading("payer_name plan_name methodology standard_charge_dollar standard_charge_percentage standard_charge_algorithm estimated_amount median_amount tenth_percentile ninetieth_percentile count additional_payer_notes additional_generic_notes", [
        *_numbers("payer_rate", "payer", [dollar, percentage, "estimated_amount", "median_amount", "tenth_percentile", "ninetieth_percentile"]),
        r("payer_required_identity_and_methodology", "payer_name", json & ~named),
        r("csv_payer_identity_required_with_rate", "payer_name", csv3 & priced & ~named),
        r("csv_payer_rate_required_with_identity", dollar, csv3 & (_has("payer_name") | _has("plan_name")) & ~priced),
        r("methodology_allowed_values", "methodology", _has("methodology") & ~_text("methodology").isin(METHODOLOGIES)),
        r("payer_requires_negotiated_charge", dollar, json & ~priced),
        r("methodology_other_requires_notes", "methodology", F.coalesce(_text("methodology") == "other", F.lit(False)) & ~noted),
        r("v2_2_percentage_or_algorithm_requires_estimated_amount", "estimated_amount", json & v22 & indirect & ~_has(dollar) & ~_has("estimated_amount")),
        r("v3_percentage_or_algorithm_requires_count", "count", v3 & indirect & count.isNull() & ~_has(dollar)),
        r("v3_algorithm_with_dollar_missing_count", "count", v3 & indirect & count.isNull() & _has(dollar), "warn", "report_only"),
        r("v3_count_allowed_format", "count", v3 & count.isNotNull() & ~count.rlike(COUNT)),
        r("v3_count_nonzero_requires_allowed_amounts", "median_amount", v3 & indirect & (count != "0") & ~(_has("median_amount") & _has("tenth_percentile") & _has("ninetieth_percentile"))),
        r("count_zero_requires_explanation", "count", v3 & indirect & (count == "0") & ~noted),
    ])


def modifier(strict: bool = False) -> list[Rule]:
    """Modifier definitions with payer_count, and CSV rows of modifiers only with has_amount_or_note. strict: either side missing breaks the row rule, not only both."""
    r = lambda rule, column, broken: Rule(rule, "modifier", column, broken, F.col(column))
    described, filled = _has("description"), F.col("has_amount_or_note")
    return _reading("code description setting", [
        r("modifier_required_shape", "code", _is("format_family", "json") & (~_has("code") | ~described | (F.col("payer_count") == 0))),
        r("modifier_setting_allowed_values", "setting", _is("format_family", "json") & _has("setting") & ~_text("setting").isin(SETTINGS)),
        r("csv_modifier_without_item_minimum_information", "code", _is("format_family", "csv") & _is("schema_family", "3.0") & _has("code") & ((~described | ~filled) if strict else (~described & ~filled))),
    ])


def modifier_payer() -> list[Rule]:
    return _reading("payer_name plan_name description", [Rule("modifier_payer_required_shape", "modifier_payer", "payer_name", ~_has("payer_name") | ~_has("plan_name") | ~_has("description"), F.col("payer_name"))])


def npi() -> list[Rule]:
    return [Rule("type_2_npi_ten_digit_numeric", "npi", "npi", ~F.coalesce(F.trim("npi").rlike("^[0-9]{10}$"), F.lit(False)), F.col("npi"))]


def provision() -> list[Rule]:
    return _reading("provisions", [Rule("general_contract_provisions_required_shape", "provision", "provisions", ~_has("provisions"), F.col("provisions"))])


def structural() -> list[Rule]:
    """Over ingest diagnostics: each quarantined record stays countable."""
    return [Rule("json_record_structural_parse_failed", "structural", "section", F.lit(True), F.col("section"), "error", "already_quarantined")]


def everything() -> list[Rule]:
    return [*header("text"), *charge_item(), *code(), *drug(), *standard_charge(), *payer_rate(), *modifier(), *modifier_payer(), *npi(), *provision(), *structural()]
