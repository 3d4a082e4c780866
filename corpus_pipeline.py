"""Corpus pipeline: toxic documents go, copies and near copies go, personal data is masked, the rest is packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from statloom.llm import exact_dedup, near_dedup, packing, pii, toxicity
from statloom.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under one half; the labels that are not held out train the model."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest key."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest key."""
    return near_dedup.keep_first(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the text."""
    masked = pii.redact(docs)
    changed = F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens and their places in sequences."""
    pieces = packing.tokenise(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("personal data", mask_personal_data),
    ("packing", pack_sequences),
]

#: Trained models, signatures and a tokenizer are no SQL; tests hold the rows against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs)
    return docs
