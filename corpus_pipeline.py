"""From documents to packed sequences: language, quality, near copies, mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import language, mixing, packing, quality, simhash
from gleaner.session import materialised

#: SQL has no suffix automata, tokenizers or iteration to a fixed point.
ORACLE_SQL = None


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; null texts and texts without a letter go.

    Where no row tells its language, there is nothing to tell by: all texts with a letter stay.
    """
    models = language.learned(docs)
    if not models.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = docs.select(F.struct("*").alias("doc"), language.language_of(F.col("text"), models).alias("found"))
    return told.where(F.col("found.lang_pred") != language.UNKNOWN).select("doc.*")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are good by the label model."""
    return quality.good_documents(docs)


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of texts that a chain of fingerprints at most two bits apart joins."""
    return simhash.one_of_each(docs, words=3, bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row for each lap in which it takes some of a document."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and their place in it."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", keep_languages),
    ("quality", keep_quality),
    ("near_copies", keep_one_of_copies),
    ("mix", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
