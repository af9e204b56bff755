"""Row-frame windows over long ordered series, cut into blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

BLOCK_ROWS = 100_000


def blocked_window(
    df: DataFrame,
    keys: Sequence[str],
    step: str,
    look_back: int,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add window columns that look at most ``look_back`` rows behind.

    ``step`` numbers the rows of a key without gaps. A series is cut into blocks
    of ``block_rows``; the last ``look_back`` rows of a block are copied into the
    next one as context, so a series of any length is spread over many tasks.
    Each entry of ``columns`` builds its column from the ordered window.
    """
    if look_back >= block_rows:
        raise ValueError("look_back must be smaller than block_rows")
    block = F.floor(F.col(step) / block_rows)
    tail = F.pmod(F.col(step), F.lit(block_rows)) >= block_rows - look_back
    blocks = F.when(tail, F.array(block, block + 1)).otherwise(F.array(block))
    spread = df.withColumn("_block", F.explode(blocks))
    w = W.partitionBy(*keys, "_block").orderBy(step)
    with_columns = spread.select("*", *[build(w).alias(name) for name, build in columns.items()])
    return with_columns.filter(F.col("_block") == block).drop("_block")


def budget_prefix(df: DataFrame, keys: Sequence[str], rank: str, cost: Column, budget: int) -> DataFrame:
    """The ranked prefix of each key whose running cost stays within ``budget``.

    Ranks count from 1. A cost that is null or below one counts as one, so rows
    ranked past the budget cannot fit and are dropped before the running sum;
    the prefix ends at the first overflow because the running cost only grows.
    """
    w = W.partitionBy(*keys).orderBy(rank).rowsBetween(W.unboundedPreceding, 0)
    priced = df.filter(F.col(rank) <= budget).withColumn("_cost", F.greatest(F.coalesce(cost, F.lit(1)), F.lit(1)))
    return priced.withColumn("running_cost", F.sum("_cost").over(w)).filter(F.col("running_cost") <= budget).drop("_cost")
