from pyspark.sql import functions as F

from marketrates.functions import casts, codes, keys, semantics, text
from marketrates.operators import identity


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_clean_text(spark):
    got = values(spark, [("  A \t b ",), ("N/A",), ("-",), ("",), (None,), ("Not  Applicable",), ("x",)], "x string", text.clean_text(F.col("x")))
    assert got == ["a b", None, None, None, None, None, "x"]
    assert values(spark, [(" A  b ",)], "x string", text.clean_display_text(F.col("x"))) == ["A b"]


def test_tokens_and_slugs(spark):
    got = values(spark, [("MRI w/o contrast & MRI",), ("CT w/contrast",), ("!!",), (None,)], "x string", text.description_tokens(F.col("x")))
    assert got == ["and contrast mri without", "contrast ct with", None, None]
    assert values(spark, [("--A b/C--",)], "x string", text.slug(F.col("x"))) == ["a-b-c"]
    assert values(spark, [("bcbs-tn ppo",)], "x string", text.title_case(F.col("x"))) == ["Bcbs-tn Ppo"]
    assert values(spark, [("n/a",), (" a  B ",)], "x string", text.title_case(F.col("x"))) == [None, "A B"]
    assert values(spark, [(" 2.2.1",), ("3.0",), ("1",)], "x string", text.schema_family(F.col("x"))) == ["2.2", "3.0", None]


def test_casts(spark):
    assert values(spark, [("1.5",), ("x",), (" ",), (None,)], "x string", casts.safe_double(F.col("x"))) == [1.5, None, None, None]
    assert values(spark, [(1, 0), (1, 2), (None, 2)], "a int, b int", casts.ratio(F.col("a"), F.col("b"))) == [None, 0.5, None]


def test_surrogate_key(spark):
    got = values(spark, [("a", None), ("a", "<null>"), (None, "a")], "a string, b string", keys.surrogate_key("a", "b"))
    assert got[0] == got[1] != got[2]


def test_plan_type(spark):
    rows = [("ppo",), ("cigna ppo hmo",), ("hmox - ppox",), ("cigna dhmo",), ("mcrppo",), (None,)]
    assert values(spark, rows, "x string", semantics.plan_type(F.col("x"))) == ["ppo", None, None, None, None, None]


def test_counts(spark):
    rows = [("0",), ("1 through 10",), ("10",), ("11",), ("many",), (None,), ("011",), (" 12 ",), ("12345678901",)]
    assert values(spark, rows, "x string", semantics.count_min(F.col("x"))) == [0, 1, None, 11, None, None, None, 12, 12345678901]
    assert values(spark, rows, "x string", semantics.count_max(F.col("x"))) == [0, 10, None, 11, None, None, None, 12, 12345678901]


def test_codes(spark):
    rows = [
        ("rc", "450", "0450", "valid", True, False, None), ("rc", "0450", "0450", "valid", True, False, None), ("ms-drg", "5", "005", "valid", True, True, None), ("tris-drg", "45", "045", "not_validated", True, True, None),
        ("ms-ltc-drg", "9", "009", "not_validated", True, True, None), ("apc", "604", "0604", "not_validated", True, True, None), ("apc", "05302", "5302", "not_validated", True, True, None), ("eapg", "12", "12", "not_validated", True, True, None),
        ("ndc", "1234-5678-90", "01234567890", "valid", True, True, "padded_from_10_4_4_2"), ("ndc", "12345-678-90", "12345067890", "valid", True, True, "padded_from_10_5_3_2"),
        ("ndc", "12345-6789-0", "12345678900", "valid", True, True, "padded_from_10_5_4_1"), ("ndc", "12345-6789-01", "12345678901", "valid", True, True, "canonical_11"),
        ("ndc", "12345678901", "12345678901", "valid", True, True, "canonical_11_unhyphenated"), ("ndc", "1234567890", "1234567890", "invalid_format", True, True, "ambiguous_10_unhyphenated"),
        ("ndc", "12345-67890", "12345-67890", "invalid_format", True, True, "invalid_layout"), ("ndc", "12345678", "12345678", "invalid_format", True, True, "invalid_length"), ("cdm", "ABC 123", "ABC123", "not_validated", False, False, None),
        ("local", "pharm 001", "PHARM001", "not_validated", False, False, None), ("hcpcs", "J1100", "J1100", "valid", True, True, None), ("hcpcs", "J1100TC26", "J1100TC26", "invalid_format", True, True, None),
        ("cpt", "99213", "99213", "valid", True, True, None), ("cpt", "0001U", "0001U", "valid", True, True, None), ("rc", None, None, "missing_code", True, False, None), (None, "123", "123", "missing_code_system", False, False, None),
        ("mystery code", "456", "456", "unknown_code_system", False, False, None),
    ]
    frame = spark.createDataFrame([(k, c) for k, c, *_ in rows], "k string, c string").withColumn("s", F.when(F.col("k") != "mystery code", F.col("k")))
    c, s = F.col("c"), F.col("s")
    m = codes.match_code(s, c)
    got = frame.select(m, codes.code_status(c, F.col("k"), s, m), codes.comparable_across_publishers(s), codes.is_specific(s), F.when(s == "ndc", codes.ndc_status(c))).collect()
    assert [tuple(g) for g in got] == [r[2:] for r in rows]


def test_item_identity(spark):
    """Signatures and ids as published for these items."""
    items = [("json-ct", "hosp-1", "CT ABDOMEN W/CONTRAST", None, None), ("csv-ct", "hosp-1", "CT W/CONTRAST ABDOMEN", None, None), ("cat", "hosp-1", "CLINIC VISIT LEVEL 1", None, None), ("unc", "hosp-1", "MISC SUPPLY", None, None),
             ("drug-1", "hosp-1", "AMOXICILLIN 500 MG CAP", "each", 1.0), ("drug-2", "hosp-1", "AMOXICILLIN 500 MG CAP", "each", 10.0)]
    named = [("json-ct", "cpt", "74160", True), ("json-ct", "rc", "0452", False), ("csv-ct", "cpt", "74160", True), ("csv-ct", "rc", "0450", False), ("cat", "rc", "0510", False), ("drug-1", "ndc", "12345678901", True), ("drug-2", "ndc", "12345678901", True)]
    coded = spark.createDataFrame([(i, k, k, c, x) for i, k, c, x in named], "item_id string, code_system string, code_type string, match_code string, code_is_specific boolean")
    frame = spark.createDataFrame(items, "item_id string, hospital_id string, description string, drug_unit_type string, drug_unit double")
    got = {r["item_id"]: r for r in identity.with_item_identity(frame, coded).collect()}
    of = lambda i: tuple(got[i][c] for c in ("description_token_signature", "code_signature_specific", "code_signature_all", "drug_signature", "identity_basis", "identity_confidence", "service_item_id"))
    ct = "2aaeb2cc67e8b2852e6c4029b949636c"
    assert of("json-ct") == ("e0d3e748cbdb9f005d8dc74123d6696f", "ab1b277550644f631d3fd49af7b672dd", "3172b9bfd26cfdce1dc7bb71ebafe6ff", None, "specific_code", "high", ct)
    assert of("csv-ct") == ("e0d3e748cbdb9f005d8dc74123d6696f", "ab1b277550644f631d3fd49af7b672dd", "c3dd9ca8d6eeed49e7eeba5f6dad550b", None, "specific_code", "high", ct)
    assert of("cat") == ("06e7ee1d29a9c0b841757fdc531d7774", None, "c3bf85991c901e2f462534e9e83e854c", None, "categorical_code", "medium", "6da820b2602a4a475a57a9d62ac670fa")
    assert of("unc") == ("2e06f5f011e2969663fe3f744f3e778c", None, None, None, "uncoded", "low", "df95060ad941f3a2587e2ff8a433bc9c")
    drug = ("0141d059c48262b4a76e29286bbacbf2", "f315472c792d27762937b94dbcabf5e1", "f315472c792d27762937b94dbcabf5e1", "940cde81163ef742db536a54a85dc7d5", "specific_code", "high", "63ea2d2cb6303d6d11228769f187c325")
    assert of("drug-1") == of("drug-2") == drug


def test_amounts_and_bands(spark):
    rows = [(1.0, None, None, "case rate"), (1.0, 50.0, None, "other"), (None, 50.0, None, None), (None, None, 7.0, "case rate"), (None, None, None, None)]
    kind = semantics.amount_kind(F.col("d"), F.col("p"), F.lit(None), F.col("e"))
    frame = spark.createDataFrame(rows, "d double, p double, e double, m string").withColumn("k", kind)
    want = [("dollar", "comparable_dollar"), ("dollar", "derived_dollar"), ("percentage", "percentage"), ("estimated", "none"), ("none", "none")]
    assert [tuple(r) for r in frame.select("k", semantics.amount_tier(F.col("k"), F.col("m"))).collect()] == want
    assert values(spark, [("Case Rate ",), ("other",), ("list",), (None,)], "x string", semantics.canonical_methodology(F.col("x"))) == ["case rate", "other", None, None]
    assert values(spark, [(0,), (91,), (365,), (366,), (None,)], "x int", semantics.freshness(F.col("x"))) == ["<=90d", "<=180d", "<=365d", ">365d", "unknown"]
    rows = [(2, 0.0, -1.0), (None, None, None), (3, 0.5, -0.3), (3, 0.1, 0.0), (3, 0.2, 0.0), (3, 0.5, -0.1), (3, 0.5, 0.0), (3, 0.5, 0.1), (3, 0.8, 0.0), (3, 0.9, 0.0), (3, 0.5, 0.25), (3, 0.95, -0.25), (3, 0.5, None)]
    want = ["insufficient_denominator", "insufficient_denominator", "very_low", "very_low", "low", "low", "near_market", "high", "high", "very_high", "very_high", "very_low", "near_market"]
    assert values(spark, rows, "n int, r double, d double", semantics.price_position(F.col("n"), F.col("r"), F.col("d"))) == want
    rows = [(None, 5, 0.0), (1.0, 2, 0.0), (1.0, 3, -0.25), (1.0, 3, -0.1), (1.0, 3, 0.0), (1.0, 3, 0.1), (1.0, 3, 0.25)]
    want = ["ambiguous_negotiated_context", "insufficient_denominator", "well_below_payer_market", "below_payer_market", "near_payer_market", "above_payer_market", "well_above_payer_market"]
    assert values(spark, rows, "a double, n int, d double", semantics.contract_position(F.col("a"), F.col("n"), F.col("d"))) == want
    rows = [("comparable", 1.0, 2.0), ("comparable", 2.0, 1.0), ("comparable", 1.0, 1.0), ("cash_unavailable", 1.0, None)]
    assert values(spark, rows, "s string, a double, c double", semantics.cash_position(F.col("s"), F.col("a"), F.col("c"))) == ["below_cash", "above_cash", "equal_to_cash", "cash_unavailable"]
    rows = [(True, 12, True, 3.5), (True, 12, False, 2.5), (True, 5, True, 1.5), (True, 3, True, None), (False, 2, True, 9.0)]
    both = F.concat_ws("/", semantics.comparison_confidence(F.col("e"), F.col("n"), F.col("d")), semantics.variation(F.col("e"), F.col("s")))
    want = ["high/very_high_variation", "moderate/high_variation", "moderate/moderate_variation", "limited/moderate_variation", "low/not_ranked"]
    assert values(spark, rows, "e boolean, n int, d boolean, s double", both) == want
