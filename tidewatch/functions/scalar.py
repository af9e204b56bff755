"""Numeric, time and vector column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def exact_round(value: Column, digits: int) -> Column:
    """Half-up rounding on a decimal, so float noise cannot flip a tie."""
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def seconds_between(later: Column, earlier: Column) -> Column:
    """``later - earlier`` in seconds with the fraction kept."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / F.lit(1_000_000.0)


def time_bucket(ts: Column, unit: str = "hour") -> Column:
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def ts(literal: str) -> Column:
    """A zone-less timestamp literal (folds, so it reaches the scan)."""
    return F.expr(f"TIMESTAMP_NTZ '{literal}'")


def since(column: Column, as_of: Column, lookback: str) -> Column:
    """``column >= as_of - lookback`` with an explicit clock."""
    return column >= as_of - F.expr(f"INTERVAL {lookback}")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return numerator / F.nullif(denominator, F.lit(0))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column, b: Column) -> Column:
    return dot(a, b) / F.nullif(l2_norm(a) * l2_norm(b), F.lit(0.0))


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections read but never recompute.

    The optimizer copies an ordinary projected expression into every filter and
    explode above it; the output of a generator is a barrier to that, which matters
    for regexes and token arrays.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
