"""Items over time: a stable identity across snapshots, history, continuity, over-merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import signature_text, surrogate_key
from ..functions.text import description_tokens


#: What is known of an item whoever publishes it.
SIGNATURES = ["code_signature_specific", "code_signature_all", "description_token_signature", "drug_signature", "identity_basis", "identity_confidence"]


def with_signatures(items: DataFrame, codes: DataFrame) -> DataFrame:
    """Add the columns in SIGNATURES; items and codes are those of with_item_identity, without a publisher."""
    named = F.concat_ws(":", F.coalesce("code_system", "code_type", F.lit("unknown")), "match_code")
    of = lambda when: signature_text(F.when(when, named))
    signatures = codes.filter("match_code is not null").groupBy("item_id").agg(
        F.md5(of(F.col("code_is_specific") & F.col("code_system").isNotNull())).alias("code_signature_specific"),
        F.md5(of(F.lit(True))).alias("code_signature_all"),
        signature_text(F.when(F.col("code_system") == "ndc", F.col("match_code"))).alias("ndc_codes"),
    )
    own = items.join(signatures, "item_id", "left")
    specific, every = F.col("code_signature_specific"), F.col("code_signature_all")
    by = lambda a, b, c: F.when(specific.isNotNull(), a).when(every.isNotNull(), b).otherwise(c)
    drug = F.col("ndc_codes").isNotNull() | F.col("drug_unit_type").isNotNull() | F.col("drug_unit").isNotNull()
    own = own.withColumns({
        "description_token_signature": F.md5(description_tokens(F.col("description"))), "drug_signature": F.when(drug, surrogate_key("ndc_codes", "drug_unit_type")),
        "identity_basis": by("specific_code", "categorical_code", "uncoded"), "identity_confidence": by("high", "medium", "low"),
    })
    return own.drop("ndc_codes")


def service_item_id() -> Column:
    """Key of an item's identity at its publisher, of columns with_signatures."""
    rest = ["description_token_signature", "drug_signature"]
    every = F.col("code_signature_all")
    coded = surrogate_key("hospital_id", F.coalesce("code_signature_specific", every), *rest)
    return F.when(every.isNotNull(), coded).otherwise(surrogate_key("hospital_id", *rest))


def with_item_identity(items: DataFrame, codes: DataFrame) -> DataFrame:
    """Add description_token_signature, code_signature_specific, code_signature_all, drug_signature, identity_basis, identity_confidence and service_item_id.

    The identity is the publisher's, the item's specific codes (else all its codes), its description words and, of drugs, the drug codes and the unit; quantities are
    left out. items: hospital_id, item_id, description, drug_unit_type (canonical where known), drug_unit; codes: item_id, code_system, code_type, match_code, code_is_specific.
    """
    return with_signatures(items, codes).withColumn("service_item_id", service_item_id())


def item_history(observed: DataFrame) -> DataFrame:
    """Per service_item_id: first and last snapshot and description, how many snapshots and source items. observed has snapshot_id and valid_from."""
    at = F.struct("valid_from", "snapshot_id")
    named = F.struct(at.alias("at"), "description")  # apart, so that what needs no description does not carry it
    key = ["service_item_id", "hospital_id"]
    # Dealt once by the key. The first row of each snapshot and of each item is marked there, as distinct counts of two columns would expand the rows and deal them twice more.
    mark = lambda c, other: F.row_number().over(Window.partitionBy(*key, c).orderBy(other)) == 1
    own = observed.repartition(*key).withColumn("_item", mark("item_id", "snapshot_id")).withColumn("_snapshot", mark("snapshot_id", "item_id"))
    own = own.groupBy(*key).agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.count_if(F.col("_snapshot") & F.col("snapshot_id").isNotNull()).alias("snapshot_count"),
        F.count_if(F.col("_item") & F.col("item_id").isNotNull()).alias("source_item_count"), F.max(named).alias("named"),
    )
    return own.select(
        "service_item_id", "hospital_id", F.col("first.snapshot_id").alias("first_snapshot_id"), F.col("first.valid_from").alias("first_seen"), F.col("last.snapshot_id").alias("last_snapshot_id"),
        F.col("last.valid_from").alias("last_seen"), F.col("named.description").alias("description"), "snapshot_count", "source_item_count",
    )
