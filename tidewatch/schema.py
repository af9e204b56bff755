"""Ordered vocabularies and record schemas of the event model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

# Vocabularies in rank order.
CLASSIFICATIONS = ("UNCLASSIFIED", "CUI", "SECRET", "TOP_SECRET", "TS_SCI")
TOKEN_CLEARANCES = ("UNCLASSIFIED", "CUI", "SECRET", "TOP_SECRET")
API_CLASSIFICATIONS = ("UNCLASSIFIED", "CONFIDENTIAL", "SECRET", "TOP_SECRET")
THREAT_TIERS = ("INFORMATIONAL", "LOW", "MEDIUM", "HIGH", "CRITICAL")
PRIORITY_TIERS = ("FLASH", "IMMEDIATE", "PRIORITY", "ROUTINE")
STATUSES = ("INGESTED", "PROCESSING", "ENRICHED", "REVIEWED", "CLOSED")
PROCESSING_STATUSES = ("ACCEPTED", "PROCESSING", "COMPLETE", "FAILED")
STREAM_SOURCE_TYPES = ("sigint", "humint", "imint", "osint", "structured_db")
API_SOURCE_TYPES = ("SIGINT", "HUMINT", "IMINT", "OSINT", "MASINT")
HIGH_TIERS = ("HIGH", "CRITICAL")


def ordinal(value: Column, vocabulary: Sequence[str]) -> Column:
    """1-based rank of ``value`` in an ordered vocabulary; NULL when unknown."""
    words = F.array(*[F.lit(w) for w in vocabulary])
    return F.nullif(F.array_position(words, value), F.lit(0))


RAW_MESSAGE = T.StructType([
    T.StructField("source_type", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("raw_text", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

COUNTRY_DOC = T.StructType([
    T.StructField("name", T.StructType([
        T.StructField("common", T.StringType()),
        T.StructField("official", T.StringType()),
    ])),
    T.StructField("cca2", T.StringType()),
    T.StructField("cca3", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("subregion", T.StringType()),
    T.StructField("capital", T.ArrayType(T.StringType())),
    T.StructField("population", T.LongType()),
    T.StructField("languages", T.MapType(T.StringType(), T.StringType())),
    T.StructField("currencies", T.MapType(T.StringType(), T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("symbol", T.StringType()),
    ]))),
    T.StructField("borders", T.ArrayType(T.StringType())),
])
