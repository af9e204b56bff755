"""Co-occurring pairs inside groups, without one task ever holding a whole hot group."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

BLOCK = 512
SEEDS = 64


def pair_rows(edges: DataFrame, group: str, item: str, payload: list[str], block: int = BLOCK) -> DataFrame:
    """``(group, payload, item_a < item_b)`` for items sharing a group.

    Items must be unique within a group. A group larger than ``block`` is cut
    into item blocks, and each pair of blocks becomes a join key of its own, so
    the largest unit of work is ``block x block`` whatever the group's size.
    """
    sized = edges.select(group, item, *payload).join(
        edges.groupBy(group).agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") > 1), group
    )
    blocks = F.ceil(F.col("_size") / block).cast("int")
    mine = F.pmod(F.xxhash64(item), blocks).cast("int")
    cells = F.when(blocks > 1, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(F.lit(0)))
    sized = sized.withColumn("_mine", mine).withColumn("_other", F.explode(cells))
    low, high = F.least("_mine", "_other"), F.greatest("_mine", "_other")
    sized = sized.select(group, item, *payload, "_mine", low.alias("_i"), high.alias("_j"))

    left = sized.withColumnRenamed(item, "item_a").withColumnRenamed("_mine", "_mine_a")
    right = sized.select(group, "_i", "_j", F.col(item).alias("item_b"), F.col("_mine").alias("_mine_b"))
    own_cell = (F.col("_i") != F.col("_j")) & (F.col("_mine_a") == F.col("_mine_b"))
    return (
        left.join(right, [group, "_i", "_j"])
        .filter((F.col("item_a") < F.col("item_b")) & ~own_cell)
        .select(group, *payload, "item_a", "item_b")
    )


def top_pairs(
    edges: DataFrame,
    item: str,
    bounds: Mapping[str, Column],
    stats: Callable[[DataFrame], DataFrame],
    limit: int,
    minimum: Mapping[str, int],
    seeds: int = SEEDS,
) -> DataFrame:
    """Pair statistics that hold at least the best ``limit`` pairs by the ``bounds`` columns.

    ``bounds`` are aggregates over the edges of one item that no pair with this
    item can exceed in the column of that name of ``stats``. First the pairs of
    the ``seeds`` strongest items alone are counted, at most ``seeds`` per group;
    their ``limit``-th best pair is a floor. An item whose own bounds are below the
    floor, or below ``minimum``, cannot be in the answer and forms no pairs: a huge
    group of items that occur nowhere else costs nothing.
    """
    order = [F.desc(name) for name in bounds]
    score = F.struct(*bounds)
    enough = F.lit(True)
    for name, least in minimum.items():
        enough = enough & (F.col(name) >= least)
    potential = edges.groupBy(item).agg(*[c.alias(name) for name, c in bounds.items()]).filter(enough)
    strongest = potential.orderBy(*order, item).limit(seeds).select(item)
    best = stats(edges.join(strongest, item, "left_semi")).filter(enough).orderBy(*order).limit(limit)
    floor = best.agg(F.when(F.count(F.lit(1)) == limit, F.min(score))).scalar()
    contenders = potential.filter(F.coalesce(score >= floor, F.lit(True))).select(item)
    return stats(edges.join(contenders, item, "left_semi")).filter(enough)
