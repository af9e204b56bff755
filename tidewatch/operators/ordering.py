"""Ranks, row numbers and exact quantiles without a single-task global sort.

A plain ``OVER (ORDER BY x)`` or a percentile over a hot key sends everything to
one task. Here values are first counted (map-side combined), and the driver asks how many
distinct values the fullest key has. A key with few is one bucket. The values of any other key are dealt into cells of their range on
a logarithmic scale, as many as their number asks for, and cells that came out too full into
cells of their own range; the ranges are rows that the values meet in joins. Only
the cells' totals are accumulated in one place, and the order inside a cell is
resolved by a window on that cell alone, so ranks and quantiles are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewatch.session import materialize

#: Distinct values of a bucket; a key with more gets cells.
BUCKET_ROWS = 50_000
_CELLS_PER_BUCKET = 2
_PLACE = ["_cell", "_part"]


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_freq"))


def _ranges(rows: DataFrame, by: Sequence[str], measure: Column, prefix: str) -> DataFrame:
    """Per group: distinct values, rows, and the range of the finite values."""
    finite = F.when(~F.isnan(measure) & (F.abs(measure) < float("inf")), measure)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias(f"{prefix}n"), F.sum("_freq").alias(f"{prefix}rows"), F.min(finite).alias(f"{prefix}lo"), F.max(finite).alias(f"{prefix}hi"))


def _cell(measure: Column, prefix: str, bucket_rows: int) -> Column:
    """Number of the cell of a range that a value falls into; nulls, then infinities and not-a-number have cells of their own."""
    lo, hi = F.col(f"{prefix}lo") / 2, F.col(f"{prefix}hi") / 2  # halves, whose difference is finite
    cells = F.ceil(F.col(f"{prefix}n") / F.lit(bucket_rows)) * _CELLS_PER_BUCKET
    inside = F.least(F.floor(F.try_divide(measure / 2 - lo, hi - lo) * cells), cells - 1)
    odd = F.when(measure.isNull(), -2).when(measure == float("-inf"), -1).when(F.isnan(measure), cells + 1).when(measure == float("inf"), cells)
    return F.coalesce(odd, inside, F.lit(0)).cast("long")


def _fullest(counts: DataFrame, keys: Sequence[str]) -> int:
    """The largest number of distinct values of a key; a job that sends one number to the driver."""
    return counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def _bucketed(counts: DataFrame, keys: Sequence[str], value: str, bucket_rows: int) -> DataFrame:
    """Add ``_large`` and the place of the bucket, ``_cell`` and ``_part``; a key of few distinct values has one bucket."""
    v = F.col(value).cast("double")
    spread = F.signum(v) * F.log1p(F.abs(v))
    ranges = _ranges(counts, keys, spread, "_k").where(F.col("_kn") > bucket_rows)
    joined = counts.join(ranges, list(keys), "left") if keys else counts.crossJoin(F.broadcast(ranges))  # one row at most
    large = F.col("_kn").isNotNull()
    celled = joined.withColumns({
        "_large": large, "_cell": F.when(large, _cell(spread, "_k", bucket_rows)).otherwise(F.lit(0).cast("long"))})
    full = _ranges(celled.where("_large"), [*keys, "_cell"], v, "_c").where(F.col("_cn") > bucket_rows)
    part = F.when(F.col("_cn").isNotNull(), _cell(v, "_c", bucket_rows)).otherwise(F.lit(0).cast("long")).alias("_part")
    return celled.join(full, [*keys, "_cell"], "left").select(*counts.columns, "_large", "_cell", part, "_krows")


def _placed(counts: DataFrame, keys: Sequence[str], value: str, bucket_rows: int) -> DataFrame:
    """Value counts with ``_total``, their bucket, its rows (``_in_bucket``) and the key's rows ``_before`` it.

    Where each key has few distinct values the key itself is the bucket. Else the counts are
    stored, since several joins read them.
    """
    own = W.partitionBy(*keys, *_PLACE)
    if _fullest(counts, keys) <= bucket_rows:
        here = F.lit(0).cast("long")
        return counts.select("*", here.alias("_cell"), here.alias("_part"), here.alias("_before")).withColumn(
            "_in_bucket", F.sum("_freq").over(own)).withColumn("_total", F.col("_in_bucket"))
    bucketed = materialize(_bucketed(materialize(counts, "value-counts"), keys, value, bucket_rows), "value-buckets")
    totals = bucketed.where("_large").groupBy(*keys, *_PLACE).agg(F.sum("_freq").alias("_n"))
    before = W.partitionBy(*keys).orderBy(*_PLACE).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return (
        bucketed.join(offsets, [*keys, *_PLACE], "left")
        .withColumn("_in_bucket", F.sum("_freq").over(own))
        .withColumns({"_total": F.coalesce("_krows", "_in_bucket"), "_before": F.coalesce("_offset", F.lit(0))})
        .drop("_krows", "_offset", "_large")
    )


def _below(keys: Sequence[str], order: Sequence[str]) -> Column:
    inside = W.partitionBy(*keys, *_PLACE).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return F.col("_before") + F.coalesce(F.sum("_freq").over(inside), F.lit(0))


def with_cumulative(
    counts: DataFrame, keys: Sequence[str], value: str, then: Sequence[str] = (), bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Add ``_below`` (rows of the key with a smaller value, or an equal one and less by ``then``) and ``_total`` to value counts."""
    placed = _placed(counts, keys, value, bucket_rows)
    return placed.withColumn("_below", _below(keys, [value, *then])).drop(*_PLACE, "_in_bucket", "_before")


def rank_map(df: DataFrame, value: str, out: str, descending: bool = True, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(value, RANK())`` of every distinct non-null value over the whole table."""
    counts = value_counts(df.filter(F.col(value).isNotNull()), [], value)
    ranked = with_cumulative(counts, [], value, bucket_rows=bucket_rows)
    rank = F.col("_total") - F.col("_below") - F.col("_freq") + 1 if descending else F.col("_below") + 1
    return ranked.select(value, rank.alias(out))


def with_rank(df: DataFrame, value: str, out: str, descending: bool = True) -> DataFrame:
    return df.join(rank_map(df, value, out, descending), value, "left")


def with_row_number(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str], out: str, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """``ROW_NUMBER()`` by columns that together are unique within each key; the first one deals the rows out."""
    first, *then = [order] if isinstance(order, str) else order
    counts = df.withColumn("_freq", F.lit(1).cast("bigint"))
    return with_cumulative(counts, keys, first, then, bucket_rows).withColumn(out, F.col("_below") + 1).drop("_freq", "_below", "_total")


def _positions(probability: float, total: Column, method: str) -> Column:
    """0-based fractional position of a quantile in the sorted values."""
    if method == "inclusive":
        return F.lit(probability) * (total - 1)
    place = F.lit(probability) * (total + 1) - 1
    return F.greatest(F.lit(0.0), F.least(place, (total - 1).cast("double")))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    method: str = "inclusive",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Exact interpolated quantiles per key, one output column per entry.

    ``inclusive`` is ``PERCENTILE_CONT``; ``exclusive`` puts the quantile at
    ``p * (n + 1)``. Only the buckets that hold a wanted position are sorted.
    """
    counts = materialize(value_counts(df.filter(F.col(value).isNotNull()), keys, value), "value-counts")
    placed = _placed(counts, keys, value, bucket_rows)
    places = [_positions(p, F.col("_total"), method) for p in probabilities.values()]
    wanted = [F.floor(p).cast("bigint") for p in places] + [F.ceil(p).cast("bigint") for p in places]
    hits = F.lit(False)
    for w in wanted:
        hits = hits | ((w >= F.col("_before")) & (w < F.col("_before") + F.col("_in_bucket")))

    located = placed.filter(hits).withColumn("_below", _below(keys, [value]))
    v = F.col(value).cast("double")

    def at(position: Column) -> Column:
        found = (position >= F.col("_below")) & (position < F.col("_below") + F.col("_freq"))
        return F.max(F.when(found, v))

    columns = []
    for name, place in zip(probabilities, places):
        low, high = at(F.floor(place).cast("bigint")), at(F.ceil(place).cast("bigint"))
        part = F.max(place - F.floor(place))
        columns.append((low + (high - low) * part).alias(name))
    return located.groupBy(*keys).agg(*columns)
