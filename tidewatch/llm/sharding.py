"""Sharding by jump consistent hashing: no ring table, and growth moves only what it must."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.window import Window

#: Rows of one slot-numbering group, on average.
SLOT_GROUP_ROWS = 50_000

# Fixed values of the published hash.
_MULTIPLIER = np.uint64(2862933555777941757)
_RANGE = float(1 << 31)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key.

    A key jumps from shard to shard; its pseudo-random sequence does not depend
    on ``shards``, which only says where to stop. So a key's shard for n + 1
    shards is either its shard for n or the new one.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    at = np.zeros(len(keys), np.int64)
    ahead = np.zeros(len(keys), np.int64)
    live = np.arange(len(keys))
    while len(live):
        at[live] = ahead[live]
        state[live] = state[live] * _MULTIPLIER + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[live] = ((at[live] + 1) * (_RANGE / draw)).astype(np.int64)
        live = live[ahead[live] < shards]
    return at.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a row, from its key's 64-bit hash alone; a null key has a shard of its own hash like any other."""
    @pandas_udf("int")
    def place(hashes: pd.Series) -> pd.Series:
        return pd.Series(jump(hashes.to_numpy(np.int64).view(np.uint64), shards))

    return place(F.xxhash64(key))


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A place for every row: (key, size, text_crc32, shard, slot, grown_shard).

    ``shard`` follows from the key and ``shards``; ``grown_shard`` is the shard
    with one more. Slots are numbered from 0 without gaps in each shard. Only
    keys, sizes and checksums are shuffled, and numbering works inside groups of
    about ``SLOT_GROUP_ROWS`` rows, so one shard is numbered by many tasks.

    A null text counts as empty. Rows with one key, repeated rows included, share a
    shard and have slots of their own. An empty table gives an empty result;
    further columns are dropped.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    placed = docs.select(
        F.col(key).alias("key"), (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        shard_of(F.col(key), shards).alias("shard"), shard_of(F.col(key), shards + 1).alias("grown_shard"),
    )
    groups = max(1, -(-docs.count() // (SLOT_GROUP_ROWS * shards)))
    return number_slots(placed, groups).select(
        F.col("key").alias(key), "size", "text_crc32", "shard", "slot", "grown_shard")


def number_slots(placed: DataFrame, groups: int) -> DataFrame:
    """Adds ``slot``: gapless numbers from 0 in each ``shard``, counted in ``groups`` parts."""
    parts = placed.withColumn("part", F.pmod(F.xxhash64("key", "text_crc32", "size"), F.lit(groups)).cast("int"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.groupBy("shard", "part").count().select(
        "shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard", "part").orderBy("key", "text_crc32", "size")
    return parts.withColumn("place", F.row_number().over(within) - 1).join(base, ["shard", "part"]).withColumn(
        "slot", F.col("base") + F.col("place")).drop("part", "base", "place")


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id", max_rows: int = 1_000_000) -> None:
    """Write whole rows as one folder per shard, ``shard_id=<n>``, in files of at most ``max_rows`` rows.

    A column of ``docs`` that is named ``shard_id`` is refused.
    """
    if "shard_id" in docs.columns:
        raise ValueError("docs has a column shard_id already")
    docs.withColumn("shard_id", shard_of(F.col(key), shards)).write.option("maxRecordsPerFile", max_rows).partitionBy(
        "shard_id").parquet(path)
