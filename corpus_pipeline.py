"""The corpus pipeline: five stages from raw documents to packed sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marquee.llm import classifier, jaccard, packing, quality, secrets
from marquee.llm.common import documents
from marquee.session import scratch_mark, stored_alone

TOKENIZER = "word_bpe_49k.json"
#: Words whose ids a worker keeps: fewer than the operator alone, as workers of the stages before
#: may still be there.
REMEMBERED_WORDS = 100_000
#: Bytes of text that packing takes apart at a time, fewer for the same reason.
PACKED_AT_ONCE = 1 << 19


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a fixed rule or lie out of their group's range go."""
    return quality.passing(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network rejects go; it learns from the labels of those that are left."""
    return classifier.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by the name of their kind."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    path = public_tokenizers.path(TOKENIZER)
    pieces = packing.token_pieces(docs, path, remembered=REMEMBERED_WORDS, at_once=PACKED_AT_ONCE)
    return packing.best_fit(pieces)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secret_scan),
    ("best-fit packing", packing_stage),
]

#: The learned, sampled and tokenised stages cannot be expressed in SQL; tests hold them
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each stage's rows are written and read again, and what
    was written before them on the way goes."""
    docs = documents(spark, sf_dir)
    since = scratch_mark()
    for _, stage in STAGES[:-1]:
        docs = stored_alone(stage(spark, docs, sf_dir), since)
    return STAGES[-1][1](spark, docs, sf_dir)
