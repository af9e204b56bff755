"""Small reports over loaded reference data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def region_summary(countries: DataFrame, region: str = "region") -> DataFrame:
    """Rows per region, largest first; a missing region is 'Unknown'."""
    return (
        countries.groupBy(F.coalesce(region, F.lit("Unknown")).alias("region"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "region")
    )
