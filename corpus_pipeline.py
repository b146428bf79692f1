"""A training corpus from `documents`: quality rules, site-level quality, near duplicates, repeated passages, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read as the next one's docs.
All but the last return the columns of documents; a verdict is on a row, so rows that share a doc_id are told apart. Null and empty texts fail the quality rules.
Rows without a doc_id pass the near-duplicate stage, once each where they repeat whole; of the others one of each class stays. Texts of any length, ties and an
empty table go as the operators' docstrings say; other columns than those of documents are left out.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketrates.llm import bayes_quality, cost_packing, dart_minhash, ngram_quality, repeat_tree, store

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that fail the base rules or the n-gram regression go."""
    store.tune(spark)
    return ngram_quality.keep_good(docs.select(COLUMNS), ngram_quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that the hierarchical classifier rejects go, toxic ones among them."""
    store.tune(spark)
    return bayes_quality.keep_good(docs.select(COLUMNS), bayes_quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one document of each group stays, that of smallest doc_id."""
    store.tune(spark)
    return dart_minhash.keep_first(docs.select(COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: bytes of strings that also start elsewhere are cut out of the text, whole characters only."""
    store.tune(spark)
    cut = repeat_tree.cut_texts(docs.select(COLUMNS))
    return cut.withColumn("n_chars", F.when(F.col("cut"), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: what is left, in sequences of 1024 tokens."""
    import public_tokenizers

    store.tune(spark)
    return cost_packing.digest_query(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: The two quality stages are trained models, which SQL cannot express; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents, each result written to the shared folder and read again."""
    store.tune(spark)

    def step(docs: DataFrame, stage) -> DataFrame:
        out = stage[1](spark, docs, sf_dir)
        return store.written(out, f"stage-{stage[0]}")

    return functools.reduce(step, STAGES, spark.read.parquet(f"{sf_dir}/documents.parquet"))
