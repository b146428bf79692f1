from pyspark.sql import functions as F

from marketrates.operators import published_rules as P
from marketrates.operators import rules

RATE = ["format_family", "schema_family", "payer_name", "plan_name", "methodology", "standard_charge_dollar", "standard_charge_percentage", "standard_charge_algorithm", "estimated_amount", "median_amount", "tenth_percentile", "ninetieth_percentile", "count", "additional_payer_notes", "additional_generic_notes"]


def broken(spark, own, columns, **values):
    row = [values.get(c) for c in columns]
    kinds = {c: "boolean" if isinstance(v, bool) else "int" if isinstance(v, int) else "string" for c, v in values.items()}
    frame = spark.createDataFrame([tuple(row)], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in columns)).withColumn("k", F.lit(1))
    return sorted({r["rule_id"] for r in rules.evaluate(frame, own, ["k"]).collect()})


def test_payer_rates(spark):
    case = lambda **v: broken(spark, P.payer_rate(), RATE, **v)
    good = {"format_family": "json", "schema_family": "3.0", "payer_name": "p", "plan_name": "q", "methodology": "case rate", "standard_charge_dollar": "5"}
    assert case(**good) == []
    assert case(**good | {"standard_charge_dollar": "x"}) == ["payer_numeric_parseable"]
    assert case(**good | {"standard_charge_dollar": "-1"}) == ["payer_numeric_positive"]
    assert case(**good | {"methodology": "other"}) == ["methodology_other_requires_notes"]
    assert case(**good | {"methodology": "magic", "plan_name": "n/a"}) == ["methodology_allowed_values", "payer_required_identity_and_methodology"]
    share = {k: v for k, v in good.items() if k != "standard_charge_dollar"} | {"standard_charge_percentage": "40"}
    assert case(**share) == ["v3_percentage_or_algorithm_requires_count"]
    assert case(**share | {"standard_charge_dollar": "5"}) == ["v3_algorithm_with_dollar_missing_count"]
    assert case(**share | {"count": "0"}) == ["count_zero_requires_explanation"]
    assert case(**share | {"count": "5"}) == ["v3_count_allowed_format", "v3_count_nonzero_requires_allowed_amounts"]
    assert case(**share | {"count": "1 through 10", "median_amount": "1", "tenth_percentile": "1", "ninetieth_percentile": "1"}) == []
    assert case(**share | {"schema_family": "2.2"}) == ["v2_2_percentage_or_algorithm_requires_estimated_amount"]
    assert case(format_family="csv", schema_family="3.0", payer_name="p") == ["csv_payer_rate_required_with_identity"]
    assert case(format_family="csv", schema_family="3.0", standard_charge_dollar="5") == ["csv_payer_identity_required_with_rate"]


def test_other_grains(spark):
    assert broken(spark, P.code(), ["code", "type", "schema_family"], code="1", type="CMG", schema_family="2.1") == ["code_type_family_specific_enum"]
    assert broken(spark, P.code(), ["code", "type", "schema_family"], code=" ", type="zzz", schema_family="3.0") == ["code_text_non_empty", "code_type_allowed_values"]
    assert broken(spark, P.drug(), ["unit", "type", "schema_family"], unit="0", type="qq", schema_family="3.0") == ["drug_type_allowed_values", "drug_unit_positive"]
    assert broken(spark, P.npi(), ["npi"], npi="12345") == ["type_2_npi_ten_digit_numeric"] and broken(spark, P.npi(), ["npi"], npi="1234567890") == []
    assert broken(spark, P.provision(), ["provisions"], provisions=" ") == ["general_contract_provisions_required_shape"]
    charge = ["minimum", "maximum", "gross_charge", "discounted_cash", "setting", "billing_class", "has_payer_dollar", "has_payer_percentage", "has_payer_algorithm"]
    none = {"has_payer_dollar": False, "has_payer_percentage": False, "has_payer_algorithm": False}
    assert broken(spark, P.standard_charge(), charge, setting="home", billing_class="x", **none) == ["billing_class_allowed_values", "charge_requires_any_standard_charge_value", "setting_allowed_values"]
    assert broken(spark, P.standard_charge(), charge, setting="both", **none | {"has_payer_dollar": True}) == ["payer_dollar_requires_minimum_and_maximum"]
    item = ["format_family", "schema_family", "description", "code_count", "charge_count", "has_ndc", "has_drug", "unpaired_codes", "record_family"]
    base = {"format_family": "json", "schema_family": "3.0", "description": "d", "code_count": 1, "charge_count": 1, "has_ndc": False, "has_drug": False, "unpaired_codes": 0, "record_family": "3.0"}
    assert broken(spark, P.charge_item(), item, **base) == []
    assert broken(spark, P.charge_item(), item, **base | {"has_ndc": True, "record_family": "2.2", "charge_count": 0}) == ["charge_item_required_arrays_non_empty", "ndc_requires_drug_information", "schema_version_header_record_mismatch"]
    rows = ["format_family", "schema_family", "code", "description", "setting", "payer_count", "has_amount_or_note"]
    part = {"format_family": "csv", "schema_family": "3.0", "code": "26", "description": "d", "payer_count": 0, "has_amount_or_note": False}
    assert broken(spark, P.modifier(), rows, **part) == [] and broken(spark, P.modifier(strict=True), rows, **part) == ["csv_modifier_without_item_minimum_information"]


def test_headers(spark):
    columns = ["format_family", "schema_family", "reported_hospital_name", "published_last_updated_on", "schema_version", "reported_state", "attestation", "confirm_attestation", "attester_name", "affirmation", "confirm_affirmation", "license_number"]
    good = {"format_family": "json", "schema_family": "3.0", "reported_hospital_name": "h", "published_last_updated_on": "2025-01-31", "schema_version": "3.0.0", "reported_state": "TN", "attestation": "text", "confirm_attestation": "true", "attester_name": "n"}
    case = lambda **v: broken(spark, P.header("text"), columns, **good | v)
    assert case() == []
    assert case(published_last_updated_on="1/31/2025") == ["last_updated_on_iso_date"] and case(format_family="csv", published_last_updated_on="1/31/2025") == []
    assert case(reported_state="ZZ") == ["state_valid_usps_code"]
    assert case(confirm_attestation="false", attestation="other") == ["attestation_confirmation_true", "attestation_text_exact"]
    assert case(format_family="csv", license_number="12|[state]") == ["csv_placeholder_headers_resolved"]


def test_all_rules_that_can_be_emitted_are_there():
    assert len({r.rule_id for r in P.everything()}) == 51
