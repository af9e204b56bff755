"""The training-data pipeline: quality rules, language, near duplicates, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm import langid, packing, quality, simhash
from tidewatch.llm.tables import store

LEAST_SHARE = 0.35


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the default policy of the rule ledger; a null or empty text does not."""
    return quality.keep_documents(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one main language, found by a mixture model learned from the stage's own labelled rows.

    Goes: a text without letters, one of which no language makes up ``LEAST_SHARE``, and one most of
    whose words no learned language explains; a text with a foreign passage or two stays.
    Where no row has a language there is nothing to judge by, and all stay.
    """
    model = langid.fit(docs.where(langid.teachable(F.col("doc_id"))))
    return langid.keep_identified(docs, model, LEAST_SHARE) if model.languages else docs


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints, the one with the least id."""
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, with their places in sequences of 4,096 tokens.

    Workers that ran the stages before have less memory to spare, so fewer words are remembered.
    """
    return packing.pack(docs, cached_words=60_000)


STAGES = [
    ("quality_rules", quality_rules), ("language", language), ("near_duplicates", near_duplicates), ("pack", pack),
]

#: Tokenizers, mixtures and fingerprints are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name).df
    return STAGES[-1][1](spark, docs, sf_dir)
