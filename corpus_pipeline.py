"""From raw documents to training pieces, one operator per stage.

Each stage gets what the one before it kept, as a Parquet table, and all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsroster.llm import exact_dedup, jaccard_join, language, mixing, sampled_pieces
from newsroster.llm.common import stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without any language; a missing label becomes the predicted one."""
    known = language.with_language(docs, language.train(docs), name="__language").where(
        F.col("__language.lang_pred") != language.UNKNOWN)
    return known.withColumn("lang", F.coalesce("lang", "__language.lang_pred")).drop("__language")


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the one with the smallest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that hang together at 0.8 over five-word shingles, the smallest id stays."""
    return jaccard_join.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bring the sources near their target weights; a row is there as often as it is taken."""
    return mixing.mixed_rows(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents and their sampled pieces."""
    return sampled_pieces.with_pieces(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", dedup_exact),
    ("near dedup", dedup_near),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

# Language ID, near dedup and piece sampling have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
