"""Extension points: embedding model, entity extraction and series model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewatch.functions import text as X

Encoder = Callable[[list[str]], np.ndarray]


def embedder(load_model: Callable[[], Encoder]) -> Callable[[Column], Column]:
    """A text-to-vector function from a model that is loaded once per task.

    ``load_model`` returns a function from a list of texts to a matrix; vectors
    are scaled to unit length.
    """

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load_model()
        for texts in batches:
            matrix = np.asarray(encode(texts.fillna("").tolist()), dtype=np.float64)
            norms = np.linalg.norm(matrix, axis=1, keepdims=True)
            unit = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)
            yield pd.Series(list(unit))

    return embed


def extract_entities(
    events: DataFrame, key: str, text: str, extractor: Callable[[Column], Column] = X.entity_tokens
) -> DataFrame:
    """``(key, name)`` edges from any column expression or pandas UDF that yields an array of names."""
    return events.select(key, F.explode(extractor(F.col(text))).alias("name"))
