"""The extension points, each filled with a small implementation."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidewatch.functions import hooks
from tidewatch.functions.scalar import exact_round
from tidewatch.functions.text import ASCII_WS
from tidewatch.functions.vector import DIMENSIONS
from tidewatch.plans import forecasting as FC
from tidewatch.suite import ingest, views as V
from tidewatch.suite.extraction import adapter_dispatch
from tidewatch.suite.registry import REGISTRY, query, rnd
from tidewatch.suite.retrieval import sql_vectors
from tidewatch.suite.timeseries import SQL_SERIES, hourly_series


def hashing_encoder():
    """The hashed bag-of-words model as a plain Python encoder."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), DIMENSIONS))
        for i, text in enumerate(texts):
            for word in text.lower().split():
                out[i, int(hashlib.md5(word.encode()).hexdigest()[:4], 16) % DIMENSIONS] += 1
        return out

    return encode


@query("ext_embedding", f"""
SELECT k AS event_id, CAST(i - 1 AS INTEGER) AS slot, {rnd('v[i]', 6)} AS weight
FROM ({sql_vectors('conversations_keyed', 'event_id', 'text')}), unnest(range(1, 65)) AS u(i)""".replace(
    "conversations_keyed", "(SELECT conv_id || '-' || turn AS event_id, text FROM conversations)"))
def ext_embedding(spark, d):
    embed = hooks.embedder(hashing_encoder)
    talk = V.load(spark, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("event_id"), "text")
    return talk.select("event_id", F.posexplode(embed("text")).alias("slot", "w")).select(
        "event_id", "slot", exact_round(F.col("w"), 6).alias("weight")
    )


@query("ext_ner", f"""
SELECT DISTINCT doc_id, name FROM (SELECT doc_id, unnest(list_filter(list_transform(
  regexp_split_to_array(text, '{ASCII_WS}'), lambda t: regexp_replace(t, '[^a-z]', '', 'g')), lambda t: length(t) > 12)) AS name
FROM documents)""")
def ext_ner(spark, d):
    def long_words(text):
        letters = F.transform(F.split(text, ASCII_WS), lambda t: F.regexp_replace(t, "[^a-z]", ""))
        return F.array_distinct(F.filter(letters, lambda t: F.length(t) > 12))

    return hooks.extract_entities(V.load(spark, d, "documents"), "doc_id", "text", long_words)


@query("ext_series_model", f"""
SELECT series_id, count(*) AS n, {rnd('avg(value)', 6)} AS level FROM ({SQL_SERIES}) WHERE step >= 24 GROUP BY 1""")
def ext_series_model(spark, d):
    """A constant-level model: the mean target, no weights."""

    def level(rows: pd.DataFrame) -> pd.DataFrame:
        k = len(FC.FEATURES)
        none, ones = [np.zeros(k)] * len(rows), [np.ones(k)] * len(rows)
        mean = np.vstack(rows["sums"])[:, k] / rows["n"] + rows["centre"]
        return pd.DataFrame({
            "series_id": rows["series_id"], "n": rows["n"], "x_mean": none, "x_scale": ones, "y_mean": mean, "y_scale": 1.0,
            "weights": none, "residual_std": 0.0})

    models = FC.fit_models(hourly_series(spark, d), level)
    return models.select("series_id", "n", exact_round(F.col("y_mean"), 6).alias("level"))



query("ext_trigger", REGISTRY["snapshot_audit"].sql)(ingest.snapshot_audit)
query("ext_adapter", REGISTRY["adapter_dispatch"].sql)(adapter_dispatch)
