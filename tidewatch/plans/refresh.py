"""Batch refresh of the hourly aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.plans.analytics import hourly_threat_stats
from tidewatch.session import materialize


def refresh_hourly_stats(
    stored: DataFrame, events: DataFrame, *, as_of: Column, start: str = "3 days", end: str = "1 hour"
) -> DataFrame:
    """Recompute the buckets in ``[as_of - start, as_of - end)`` and keep every other one.

    The time range is pushed into the event scan, so a refresh reads only its window.
    """
    low, high = as_of - F.expr(f"INTERVAL {start}"), as_of - F.expr(f"INTERVAL {end}")
    first = F.date_trunc("hour", low).cast("timestamp_ntz")
    first = F.when(first < low, first + F.expr("INTERVAL 1 HOUR")).otherwise(first)
    inside = (F.col("bucket") >= first) & (F.col("bucket") < high)
    recent = events.filter((F.col("occurred_at") >= low) & (F.col("occurred_at") < high + F.expr("INTERVAL 1 HOUR")))
    fresh = hourly_threat_stats(recent).filter(inside)
    return stored.filter(~inside).unionByName(fresh)


def refresh_stored_stats(spark: SparkSession, path: str, events: DataFrame, *, as_of: Column, start: str = "3 days", end: str = "1 hour") -> None:
    """The same refresh on a store partitioned by ``day``: only the partitions that the window touches are read and overwritten."""
    low, high = as_of - F.expr(f"INTERVAL {start}"), as_of - F.expr(f"INTERVAL {end}")
    touched = (F.col("day") >= low.cast("date")) & (F.col("day") <= high.cast("date"))
    stored = spark.read.parquet(path)
    fresh = refresh_hourly_stats(stored.filter(touched).drop("day"), events, as_of=as_of, start=start, end=end)
    staged = materialize(fresh.withColumn("day", F.to_date("bucket")), "refresh")
    staged.select(*stored.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
