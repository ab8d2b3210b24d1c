"""Cleans `documents` and packs them into training sequences, stage by stage.

Each stage is (spark, docs, sf_dir) -> DataFrame. :func:`run` writes every stage's
result as Parquet under the cluster's shared folder and reads it back for the next
one, so a lost executor never costs more than the running stage. All stages but the
last return the columns of `documents`; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlake.llm import cotrain, exact_dedup, ngram_join, packing, pii
from crashlake.llm.common import materialise, release
from crashlake.llm.queries import tokenizer_file


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on `labels`, accepts."""
    return cotrain.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by links (five-word shingles, similarity 0.8 or more) the one with the smallest doc_id stays."""
    return ngram_join.keep_one(docs, width=5, percent=80)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; n_chars follows."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens, placed in sequences."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), capacity=1024)


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("pii", mask_pii),
    ("best_fit_packing", pack),
]

#: The classifier, tokenizer and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, materialise(stage(spark, docs, sf_dir), f"stage_{name}")
        if k:
            release(before)
    return docs
