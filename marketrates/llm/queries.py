"""The registered queries of this subpackage, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bayes_quality, byte_bpe, chat_parts, cost_packing, dart_minhash, hard_negatives, merkle_manifest, ngram_quality, piece_bpe, pq_neighbours, rans_files, repeat_tree, warc_index
from .store import tune


def _table(name: str, run: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return run(spark.read.parquet(f"{sf_dir}/{name}.parquet"))

    return query


def _with_labels(run: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return run(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))

    return query


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_rans_token_files": _table("documents", lambda d: rans_files.digest_query(d, _tokenizer("byte_bpe_50k.json"))),
        "op2_bayes_quality": _with_labels(bayes_quality.quality),
        "op3_warc_index": _table("pages", warc_index.digest_query),
        "op4_repeat_tree": _table("documents", repeat_tree.digest_query),
        "op5_dart_minhash": _table("documents", dart_minhash.near_duplicates),
        "op6_cost_packing": _table("documents", lambda d: cost_packing.digest_query(d, _tokenizer("byte_bpe_50k.json"))),
        "op7_chat_parts": _table("conversations", chat_parts.digest_query),
        "op8_pq_neighbours": _table("embeddings", pq_neighbours.near_duplicates),
        "op9_ngram_quality": _with_labels(ngram_quality.quality),
        "op10_byte_bpe": _table("documents", lambda d: byte_bpe.digest_query(d, _tokenizer("byte_bpe_50k.tiktoken"))),
        "op11_piece_bpe": _table("documents", lambda d: piece_bpe.digest_query(d, _tokenizer("piece_bpe_32k.model"))),
        "op12_hard_negatives": _table("embeddings", hard_negatives.digest_query),
        "op13_merkle_manifest": _table("documents", merkle_manifest.digest_query),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc_index": warc_index.oracle(),
        "op5_dart_minhash": dart_minhash.oracle(),
        "op7_chat_parts": chat_parts.oracle(),
        "op8_pq_neighbours": pq_neighbours.oracle(),
        "op11_piece_bpe": _table("documents", lambda d: piece_bpe.digest_query(d, _tokenizer("piece_bpe_32k.model"))),
        "op12_hard_negatives": hard_negatives.oracle(),
        "op13_merkle_manifest": merkle_manifest.oracle(),
    }
