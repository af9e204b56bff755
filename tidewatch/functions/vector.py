"""Hashed bag-of-words vectors (stand-in for a sentence model)."""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewatch.functions.scalar import computed_once

DIMENSIONS = 64

#: Bound of the words whose slots a worker remembers.
REMEMBERED = 1 << 20


class _Slots(dict):
    """Stable vector slot of a word, before the dimensions are known: the first four hex digits of its MD5."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        slot = self[word] = int.from_bytes(md5(word.encode(), usedforsecurity=False).digest()[:2], "big")
        return slot


_slot = _Slots().__getitem__


def _word_counts(texts: pa.Array, dimensions: int) -> np.ndarray:
    """How many words of each lower-cased text are in each slot; ``str.split`` cuts where ``text.WS`` does."""
    counts = np.zeros((len(texts), dimensions), np.int64)
    for row, text in zip(counts, texts.to_pylist()):
        words = (text or "").split()
        if words:
            row[:] = np.bincount(np.fromiter(map(_slot, words), np.int64, len(words)) % dimensions, minlength=dimensions)
    return counts


def _lists(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(rows.reshape(-1)))


def text_vector(text: Column, dimensions: int = DIMENSIONS) -> Column:
    """Unit-length hashed term counts of each row's text, all zero for a blank or null one; held against no other row."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def vectors(texts: pa.Array) -> pa.Array:
        counts = _word_counts(texts, dimensions)
        norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True).astype(np.float64))
        return _lists(np.divide(counts, norms, out=np.zeros(counts.shape), where=norms > 0))

    return vectors(F.lower(text))


def hashed_embedding(df: DataFrame, key: str, text: str, dimensions: int = DIMENSIONS, out: str = "embedding") -> DataFrame:
    """``(key, embedding)``: unit-length hashed term counts, an all-zero vector for blank text.

    A text is counted where it is read, and only its ``dimensions`` numbers are grouped by key. Rows of one
    key get the vector of all their texts together, those without a key a zero vector.
    """

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def counted(texts: pa.Array) -> pa.Array:
        return _lists(_word_counts(texts, dimensions))

    counts = computed_once(df.select(key, text), _n=counted(F.lower(F.col(text))))
    slots = [f"_{i}" for i in range(dimensions)]
    of_key = counts.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(F.col("_n")[i]).alias(s) for i, s in enumerate(slots)])
    squares = sum((F.col(s) * F.col(s) for s in slots[1:]), F.col(slots[0]) * F.col(slots[0]))
    scaled = computed_once(of_key, _norm=F.when(F.col(key).isNotNull(), F.sqrt(squares)))
    dense = F.array(*[F.when(F.col("_norm") > 0, F.col(s) / F.col("_norm")).otherwise(0.0) for s in slots])
    return computed_once(scaled, _v=dense).select(key, F.col("_v").alias(out), F.explode(F.sequence(F.lit(1), F.col("_rows"))).alias("_row")).drop("_row")
