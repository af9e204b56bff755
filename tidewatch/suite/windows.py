"""One query per window construct, on whole tables."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from tidewatch.functions.scalar import exact_round, safe_ratio, time_bucket
from tidewatch.operators.ordering import with_rank, with_row_number
from tidewatch.operators.windows import blocked_window, budget_prefix
from tidewatch.suite import views as V
from tidewatch.suite.registry import query, rnd


def _hourly(spark, d, *keys):
    return V.load(spark, d, "events").groupBy(*keys, time_bucket(F.col("ts")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("total")
    )


SQL_HOURLY = "SELECT date_trunc('hour', ts) AS bucket, count(*) AS total FROM events GROUP BY 1"
SQL_TYPED = "SELECT event_type, date_trunc('hour', ts) AS bucket, count(*) AS total FROM events GROUP BY 1, 2"


@query("win_rank", "SELECT o_orderkey, o_totalprice, rank() OVER (ORDER BY o_totalprice DESC) AS price_rank FROM orders")
def win_rank(spark, d):
    return with_rank(V.load(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "price_rank")


@query("win_rank_over_agg", """
SELECT o_custkey, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS volume_rank FROM orders GROUP BY 1""")
def win_rank_over_agg(spark, d):
    counted = V.load(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return with_rank(counted, "n", "volume_rank")


@query("win_row_number", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders")
def win_row_number(spark, d):
    return with_row_number(V.load(spark, d, "orders").select("o_orderkey"), [], "o_orderkey", "rn")


@query("win_lag", f"""
SELECT event_type, bucket, total, total - lag(total) OVER (PARTITION BY event_type ORDER BY bucket) AS delta
FROM ({SQL_TYPED})""")
def win_lag(spark, d):
    w = W.partitionBy("event_type").orderBy("bucket")
    return _hourly(spark, d, "event_type").withColumn("delta", F.col("total") - F.lag("total").over(w))


@query("win_rolling_sum", f"""
SELECT bucket, total, CAST(sum(total) OVER (ORDER BY bucket ROWS 23 PRECEDING) AS BIGINT) AS rolling FROM ({SQL_HOURLY})""")
def win_rolling_sum(spark, d):
    hour = (F.unix_micros(F.col("bucket").cast("timestamp")) / 3_600_000_000).cast("bigint")
    numbered = with_row_number(_hourly(spark, d).withColumn("hour", hour), [], "hour", "step").drop("hour")
    return blocked_window(
        numbered, [], "step", 23, {"rolling": lambda w: F.sum("total").over(w.rowsBetween(-23, 0))}
    ).drop("step")


@query("win_global_stats", f"""
SELECT bucket, {rnd('(total - avg(total) OVER ()) / nullif(stddev(total) OVER (), 0)', 6)} AS z FROM ({SQL_HOURLY})""")
def win_global_stats(spark, d):
    hourly = _hourly(spark, d)
    s = hourly.agg(F.struct(F.avg("total").alias("mean"), F.stddev_samp("total").alias("std"))).scalar()
    z = safe_ratio(F.col("total") - F.col("_s.mean"), F.col("_s.std"))
    return hourly.withColumn("_s", s).select("bucket", exact_round(z, 6).alias("z"))


@query("win_rolling_stats", f"""
SELECT event_type, bucket, {rnd('avg(total) OVER w', 6)} AS mean, {rnd('stddev(total) OVER w', 6)} AS std
FROM ({SQL_TYPED}) WINDOW w AS (PARTITION BY event_type ORDER BY bucket ROWS 168 PRECEDING)""")
def win_rolling_stats(spark, d):
    w = W.partitionBy("event_type").orderBy("bucket").rowsBetween(-168, 0)
    return _hourly(spark, d, "event_type").select(
        "event_type", "bucket", exact_round(F.avg("total").over(w), 6).alias("mean"),
        exact_round(F.stddev_samp("total").over(w), 6).alias("std"),
    )


@query("win_budget_prefix", """
SELECT conv_id, turn, CAST(running AS BIGINT) AS running_cost FROM (
  SELECT *, sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn) AS running FROM conversations)
WHERE running <= 1000""")
def win_budget_prefix(spark, d):
    talk = V.load(spark, d, "conversations").select("conv_id", "turn", F.length("text").alias("size"))
    return budget_prefix(talk, ["conv_id"], "turn", F.col("size") + 1, 1000).drop("size")


@query("win_feature_frame", f"""
SELECT event_type, bucket, {rnd('avg(total) OVER w', 6)} AS mean, min(total) OVER w AS low, max(total) OVER w AS high,
  lag(total, 6) OVER (PARTITION BY event_type ORDER BY bucket) AS lag_6
FROM ({SQL_TYPED}) WINDOW w AS (PARTITION BY event_type ORDER BY bucket ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)""")
def win_feature_frame(spark, d):
    ordered = W.partitionBy("event_type").orderBy("bucket")
    w = ordered.rowsBetween(-24, -1)
    return _hourly(spark, d, "event_type").select(
        "event_type", "bucket", exact_round(F.avg("total").over(w), 6).alias("mean"),
        F.min("total").over(w).alias("low"), F.max("total").over(w).alias("high"),
        F.lag("total", 6).over(ordered).alias("lag_6"),
    )
