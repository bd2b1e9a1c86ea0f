"""The registered queries of the document operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marquee.llm import (
    bpe,
    classifier,
    divergence,
    jaccard,
    language,
    negatives,
    ordermh,
    packing,
    pii,
    quality,
    secrets,
    sentencepieces,
    sharding,
    sql,
)
from marquee.llm.common import documents, query

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


@query("op4_bpe_round_trip")
def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


@query("op7_two_pass_shards")
def op7_two_pass_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(documents(spark, sf_dir), shards=8)


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(documents(spark, sf_dir), public_tokenizers.path(WORD_BPE))
    return packing.best_fit(pieces)


@query("op3_secret_scan", sql.SECRETS)
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(documents(spark, sf_dir))


@query("op6_adaptive_rules", sql.QUALITY)
def op6_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir))


@query("op2_order_minhash")
def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermh.digest(documents(spark, sf_dir))


@query("op5_byte_network")
def op5_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op8_language_mixture")
def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.held_out_prediction(documents(spark, sf_dir))


@query("op1_chosen_path_join", sql.JACCARD)
def op1_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir))


@query("op10_disclosure_scan", sql.PRIVATE)
def op10_disclosure_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.private_digest(documents(spark, sf_dir))


@query("op11_source_divergence", sql.DIVERGENCE)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(documents(spark, sf_dir))


@query("op12_sentencepiece_round_trip")
def op12_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.round_trip(documents(spark, sf_dir), public_tokenizers.path(PIECE_BPE))


@query("op13_hard_negatives", sql.NEGATIVES)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
