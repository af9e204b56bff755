"""Features and forecasts over the hourly counts of every event type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.functions.scalar import exact_round, time_bucket, ts
from tidewatch.plans import forecasting as FC
from tidewatch.plans.analytics import hourly_threat_stats
from tidewatch.plans.refresh import refresh_hourly_stats as refresh, refresh_stored_stats as refresh_store
from tidewatch.session import materialize, work_dir
from tidewatch.suite import views as V
from tidewatch.suite.registry import query, rnd


def hourly_series(spark: SparkSession, d: str) -> DataFrame:
    hour = (F.unix_micros(time_bucket(F.col("ts")).cast("timestamp")) / 3_600_000_000).cast("bigint")
    counts = V.load(spark, d, "events").groupBy("event_type", hour.alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return FC.as_series(counts, "event_type", "hour", "n")


SQL_SERIES = """
SELECT event_type AS series_id, n::DOUBLE AS value, row_number() OVER (PARTITION BY event_type ORDER BY b) - 1 AS step
FROM (SELECT event_type, date_trunc('hour', ts) AS b, count(*) AS n FROM events GROUP BY 1, 2)"""

SQL_FEATURES = f"""
SELECT series_id, step, {', '.join(f'lag(value, {i}) OVER o AS lag_{i}' for i in range(6, 0, -1))},
  {rnd('avg(value) OVER w', 6)} AS w_mean, {rnd('stddev_pop(value) OVER w', 6)} AS w_std, min(value) OVER w AS w_min,
  max(value) OVER w AS w_max, lag(value, 1) OVER o - lag(value, 24) OVER o AS w_trend,
  {rnd('quantile_cont(value, 0.5) OVER w', 6)} AS w_median, {rnd('quantile_cont(value, 0.25) OVER w', 6)} AS w_p25,
  {rnd('quantile_cont(value, 0.75) OVER w', 6)} AS w_p75, value AS target
FROM ({SQL_SERIES}) WINDOW o AS (PARTITION BY series_id ORDER BY step),
  w AS (PARTITION BY series_id ORDER BY step ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)"""


@query("window_features", f"SELECT * FROM ({SQL_FEATURES}) WHERE step >= 24")
def window_features(spark, d):
    out = FC.window_features(hourly_series(spark, d))
    return out.withColumns({
        c: exact_round(F.col(c), 6) for c in ("w_mean", "w_std", "w_median", "w_p25", "w_p75")
    })


@query("ridge_fit_job")
def ridge_fit_job(spark, d):
    return FC.ridge_fit(hourly_series(spark, d))


@query("forecast")
def forecast(spark, d):
    return FC.forecast(hourly_series(spark, d))


@query("backtest_residuals")
def backtest_residuals(spark, d):
    series = hourly_series(spark, d)
    return FC.backtest_residuals(series, FC.ridge_fit(series))


SQL_TARGETS = f"SELECT series_id, value AS target FROM ({SQL_SERIES}) WHERE step >= 24"


@query("ridge_fit_check", f"""
SELECT series_id, count(*) AS n, {rnd('avg(target)', 6)} AS y_mean, {rnd('stddev_pop(target)', 6)} AS y_scale,
  TRUE AS solved FROM ({SQL_TARGETS}) GROUP BY 1""")
def ridge_fit_check(spark, d):
    """The models' moments, and whether their weights solve the normal equations over the feature rows."""
    series = hourly_series(spark, d)
    models = FC.ridge_fit(series)
    rows = FC.window_features(series).join(models, "series_id")
    z = [(F.col(c) - F.get("x_mean", F.lit(i))) / F.get("x_scale", F.lit(i)) for i, c in enumerate(FC.FEATURES)]
    miss = sum((z[i] * F.get("weights", F.lit(i)) for i in range(len(z))), F.lit(0.0)) - (F.col("target") - F.col("y_mean")) / F.col("y_scale")
    gradient = rows.groupBy("series_id", "n", "y_mean", "y_scale", "weights").agg(*[F.sum(z[i] * miss).alias(f"g{i}") for i in range(len(z))])
    worst = F.greatest(*[F.abs(F.col(f"g{i}") + FC.ALPHA * F.get("weights", F.lit(i))) for i in range(len(z))])
    return gradient.select("series_id", "n", exact_round(F.col("y_mean"), 6).alias("y_mean"),
                           exact_round(F.col("y_scale"), 6).alias("y_scale"), (worst <= 1e-5 * F.col("n")).alias("solved"))


@query("forecast_check", f"""
SELECT series_id, CAST(step AS INTEGER) AS step, TRUE AS banded, TRUE AS first_is_fit, TRUE AS second_is_fit
FROM (SELECT DISTINCT series_id FROM ({SQL_TARGETS})), range(1, 13) AS r(step)""")
def forecast_check(spark, d):
    """Every modelled series has twelve steps in an even band; step one is the stored weights on the last window, step two on that and step one."""
    series = materialize(hourly_series(spark, d), "series")
    models = materialize(FC.ridge_fit(series), "models")
    ahead = materialize(FC.forecast(series, 12, models=models), "ahead")
    ends = series.groupBy("series_id").agg(F.max("step").alias("last"))

    def fit_of_next(known: DataFrame, after: int, name: str) -> DataFrame:
        row = ends.select("series_id", (F.col("last") + after).alias("step"), F.lit(0.0).alias("value"))
        features = FC.window_features(known.unionByName(row)).join(row.select("series_id", "step"), ["series_id", "step"], "left_semi")
        z = [(F.col(c) - F.get("x_mean", F.lit(i))) / F.get("x_scale", F.lit(i)) * F.get("weights", F.lit(i)) for i, c in enumerate(FC.FEATURES)]
        return features.join(models, "series_id").select("series_id", (F.col("y_mean") + F.col("y_scale") * sum(z, F.lit(0.0))).alias(name))

    first = ahead.where("step = 1").join(ends, "series_id").select("series_id", (F.col("last") + 1).alias("step"), F.col("prediction").alias("value"))
    one = fit_of_next(series, 1, "one")
    two = fit_of_next(series.select("series_id", "step", "value").unionByName(first), 2, "two")
    band = F.abs(F.col("upper") - F.col("prediction") - 1.96 * F.col("residual_std")) + F.abs(
        F.col("prediction") - F.col("lower") - 1.96 * F.col("residual_std"))

    def fits(step: int, name: str) -> Column:
        return (F.col("step") != step) | (F.abs(F.col("prediction") - F.col(name)) <= 1e-3)

    return ahead.join(one, "series_id").join(two, "series_id").join(models.select("series_id", "residual_std"), "series_id").select(
        "series_id", "step", (band <= 1e-3).alias("banded"), fits(1, "one").alias("first_is_fit"), fits(2, "two").alias("second_is_fit"))


@query("backtest_check", f"SELECT series_id, count(*) AS n, TRUE AS equal FROM ({SQL_TARGETS}) GROUP BY 1")
def backtest_check(spark, d):
    """The spread over the feature rows is the one that the fit derives from its moments."""
    series = hourly_series(spark, d)
    models = FC.ridge_fit(series)
    spread = FC.backtest_residuals(series, models).withColumnRenamed("residual_std", "walked")
    return spread.join(models.select("series_id", "residual_std"), "series_id").select(
        "series_id", "n", (F.abs(F.col("walked") - F.col("residual_std")) <= 1e-6 * (1 + F.col("walked"))).alias("equal"))


@query("forecast_rejects", f"""
SELECT series_id, count(*) AS length, '{FC.TOO_SHORT}' AS reject_reason FROM (
  SELECT CAST(user_id AS VARCHAR) AS series_id, date_trunc('day', ts) FROM events GROUP BY ALL) GROUP BY 1 HAVING count(*) <= 24""")
def forecast_rejects(spark, d):
    """Daily series per user that are too short for a model."""
    day = F.date_diff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date"))
    daily = V.load(spark, d, "events").groupBy(F.col("user_id").cast("string").alias("user"), day.alias("day")).agg(F.sum("value").alias("total"))
    return FC.short_series(FC.as_series(daily, "user", "day", "total"))


SQL_REFRESHED = V.with_views(f"""
WITH old AS (SELECT date_trunc('hour', occurred_at) AS bucket, source_id, threat_tier, count(*) AS event_count,
    0::BIGINT AS closed_count FROM web_events GROUP BY 1, 2, 3),
fresh AS (SELECT date_trunc('hour', occurred_at) AS bucket, source_id, threat_tier, count(*) AS event_count,
    count(*) FILTER (status = 'CLOSED') AS closed_count FROM web_events GROUP BY 1, 2, 3)
SELECT * FROM old WHERE NOT (bucket >= TIMESTAMP '2024-01-20 10:00:00' AND bucket < TIMESTAMP '2024-01-23 08:30:00')
UNION ALL
SELECT * FROM fresh WHERE bucket >= TIMESTAMP '2024-01-20 10:00:00' AND bucket < TIMESTAMP '2024-01-23 08:30:00'
""", "web_events")


@query("refresh_hourly_stats", SQL_REFRESHED)
def refresh_hourly_stats(spark, d):
    events = V.web_events(spark, d)
    stale = hourly_threat_stats(events).withColumn("closed_count", F.lit(0).cast("bigint"))
    return refresh(stale, events, as_of=ts("2024-01-23 09:30:00"))


@query("refresh_stored_stats", SQL_REFRESHED)
def refresh_stored_stats(spark, d):
    """The refresh on a stored table, of which only the touched days are rewritten."""
    events = V.web_events(spark, d)
    path = work_dir(spark, "hourly")
    stale = hourly_threat_stats(events).withColumn("closed_count", F.lit(0).cast("bigint"))
    stale.withColumn("day", F.to_date("bucket")).write.partitionBy("day").parquet(path)
    refresh_store(spark, path, events, as_of=ts("2024-01-23 09:30:00"))
    return spark.read.parquet(path).drop("day")
