"""Table layouts: monthly partitions, clustered files, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MONTH = "event_month"


def month_of(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM")


def write_monthly(df: DataFrame, path: str, time: str = "occurred_at", mode: str = "overwrite") -> None:
    """Parquet partitioned by month.

    The rebalance hint groups a month's rows into files of the advisory size and
    lets adaptive execution split a month that is larger than the others.
    """
    df.withColumn(MONTH, month_of(F.col(time))).hint("rebalance", MONTH).write.mode(mode).partitionBy(MONTH).parquet(path)


def read_months(spark: SparkSession, path: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Read a monthly table; bounds are ``yyyy-MM`` and prune partitions."""
    df = spark.read.parquet(path).withColumn(MONTH, F.col(MONTH).cast("string"))
    if since is not None:
        df = df.filter(F.col(MONTH) >= since)
    if until is not None:
        df = df.filter(F.col(MONTH) <= until)
    return df


def write_clustered(df: DataFrame, path: str, segment: Sequence[str], order: Sequence[str | Column],
                    mode: str = "overwrite") -> None:
    """Rows of a segment side by side and sorted, so row-group statistics prune well."""
    df.hint("rebalance", *segment).sortWithinPartitions(*segment, *order).write.mode(mode).parquet(path)


def retained(df: DataFrame, as_of: Column, keep: str = "2 years", time: str = "occurred_at") -> DataFrame:
    """Drop whole months that ended before ``as_of - keep``."""
    oldest = F.date_trunc("month", as_of - F.expr(f"INTERVAL {keep}")).cast("timestamp_ntz")
    return df.filter(F.col(time) >= oldest)
