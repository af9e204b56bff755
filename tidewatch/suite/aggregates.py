"""One query per aggregate the reports use, on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.scalar import count_where, exact_round
from tidewatch.operators.ordering import exact_quantiles
from tidewatch.plans.summary import region_summary as summarise
from tidewatch.suite import views as V
from tidewatch.suite.registry import query, rnd


def _orders(spark, d):
    return V.load(spark, d, "orders")


@query("agg_count", V.with_views("""
SELECT source_id, count(*) AS events, count(resolved_at) AS resolved FROM intel_events GROUP BY 1""", "intel_events"))
def agg_count(spark, d):
    return V.intel_events(spark, d, lines=True).groupBy("source_id").agg(
        F.count(F.lit(1)).alias("events"), F.count("resolved_at").alias("resolved")
    )


@query("agg_count_filter", V.with_views("""
SELECT source_id, count(*) FILTER (threat_tier = 'CRITICAL') AS critical,
  count(*) FILTER (threat_tier IN ('HIGH', 'CRITICAL') AND status <> 'CLOSED') AS open_high FROM intel_base GROUP BY 1
""", "intel_base"))
def agg_count_filter(spark, d):
    t = F.col("threat_tier")
    return V.intel_events(spark, d).groupBy("source_id").agg(
        count_where(t == "CRITICAL").alias("critical"),
        count_where(t.isin("HIGH", "CRITICAL") & (F.col("status") != "CLOSED")).alias("open_high"),
    )


@query("agg_count_distinct", """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1""")
def agg_count_distinct(spark, d):
    return V.load(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts")
    )


@query("agg_avg_filter", f"""
SELECT l_suppkey, {rnd('avg(l_discount)', 6)} AS discount,
  {rnd("avg(l_tax) FILTER (l_returnflag = 'A')", 6)} AS tax_a FROM lineitem GROUP BY 1""")
def agg_avg_filter(spark, d):
    return V.load(spark, d, "lineitem").groupBy("l_suppkey").agg(
        exact_round(F.avg("l_discount"), 6).alias("discount"),
        exact_round(F.avg(F.when(F.col("l_returnflag") == "A", F.col("l_tax"))), 6).alias("tax_a"),
    )


@query("agg_pivot_sum", V.with_views("""
WITH h AS (SELECT date_trunc('day', occurred_at) AS bucket, threat_tier, count(*) AS n FROM web_events GROUP BY 1, 2)
SELECT CAST(bucket AS TIMESTAMP) AS bucket,
  CAST(sum(n) FILTER (threat_tier = 'CRITICAL') AS BIGINT) AS critical,
  CAST(sum(n) FILTER (threat_tier = 'HIGH') AS BIGINT) AS high,
  CAST(sum(n) FILTER (threat_tier = 'LOW') AS BIGINT) AS low FROM h GROUP BY 1""", "web_events"))
def agg_pivot_sum(spark, d):
    daily = V.web_events(spark, d).groupBy(
        F.date_trunc("day", "occurred_at").cast("timestamp_ntz").alias("bucket"), "threat_tier"
    ).agg(F.count(F.lit(1)).alias("n"))

    def total(tier):
        return F.sum(F.when(F.col("threat_tier") == tier, F.col("n"))).alias(tier.lower())

    return daily.groupBy("bucket").agg(total("CRITICAL"), total("HIGH"), total("LOW"))


@query("agg_min_max", """
SELECT o_custkey, min(o_orderdate) AS first_seen, max(o_orderdate) AS last_seen FROM orders GROUP BY 1""")
def agg_min_max(spark, d):
    return _orders(spark, d).groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_seen"), F.max("o_orderdate").alias("last_seen")
    )


@query("agg_percentile_cont", f"""
SELECT o_orderpriority, {rnd('quantile_cont(o_totalprice, 0.5)', 6)} AS p50, {rnd('quantile_cont(o_totalprice, 0.95)', 6)} AS p95
FROM orders GROUP BY 1""")
def agg_percentile_cont(spark, d):
    out = exact_quantiles(_orders(spark, d), ["o_orderpriority"], "o_totalprice", {"p50": 0.5, "p95": 0.95})
    return out.select("o_orderpriority", *[exact_round(F.col(c), 6).alias(c) for c in ("p50", "p95")])


@query("agg_array_distinct", """
SELECT l_suppkey, array_to_string(list_sort(array_agg(DISTINCT l_returnflag)), ',') AS flags,
  array_to_string(list_sort(array_agg(DISTINCT l_linestatus) FILTER (l_discount > 0.08)), ',') AS discounted
FROM lineitem GROUP BY 1""")
def agg_array_distinct(spark, d):
    some = F.collect_set(F.when(F.col("l_discount") > 0.08, F.col("l_linestatus")))
    out = V.load(spark, d, "lineitem").groupBy("l_suppkey").agg(F.collect_set("l_returnflag").alias("f"), some.alias("s"))
    # An empty set is NULL, as ARRAY_AGG over no rows.
    return out.select(
        "l_suppkey", F.array_join(F.sort_array("f"), ",").alias("flags"),
        F.when(F.size("s") > 0, F.array_join(F.sort_array("s"), ",")).alias("discounted"),
    )


@query("agg_stddev", f"""
SELECT o_custkey, {rnd('stddev_samp(o_totalprice)', 4)} AS spread FROM orders GROUP BY 1""")
def agg_stddev(spark, d):
    return _orders(spark, d).groupBy("o_custkey").agg(exact_round(F.stddev_samp("o_totalprice"), 4).alias("spread"))


@query("agg_having", """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderstatus = 'F') >= 3""")
def agg_having(spark, d):
    return _orders(spark, d).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), count_where(F.col("o_orderstatus") == "F").alias("closed")
    ).filter("closed >= 3").drop("closed")


@query("agg_group_expr", """
SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS month, CAST(floor(o_totalprice / 100000) AS BIGINT) AS band,
  count(*) AS n FROM orders GROUP BY 1, 2""")
def agg_group_expr(spark, d):
    return _orders(spark, d).groupBy(
        F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month"),
        F.floor(F.col("o_totalprice") / 100000).alias("band"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("region_summary", """
WITH c AS (SELECT CASE WHEN r_name <> 'ASIA' THEN r_name END AS region FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT coalesce(region, 'Unknown') AS region, count(*) AS n FROM c GROUP BY 1""")
def region_summary(spark, d):
    places = V.load(spark, d, "nation").join(V.load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    named = V.load(spark, d, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(F.col("r_name") != "ASIA", F.col("r_name")).alias("region")
    )
    return summarise(named)


@query("p95_exclusive", f"""
WITH s AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i,
    count(*) OVER (PARTITION BY event_type) AS n FROM events),
p AS (SELECT *, greatest(0, least(0.95::DOUBLE * (n + 1) - 1, n - 1)) AS pos FROM s)
SELECT event_type, {rnd('''max(CASE WHEN i = floor(pos) THEN value END) + (max(CASE WHEN i = ceil(pos) THEN value END)
  - max(CASE WHEN i = floor(pos) THEN value END)) * max(pos - floor(pos))''', 6)} AS p95 FROM p GROUP BY 1""")
def p95_exclusive(spark, d):
    out = exact_quantiles(V.load(spark, d, "events"), ["event_type"], "value", {"p95": 0.95}, method="exclusive")
    return out.select("event_type", exact_round(F.col("p95"), 6).alias("p95"))


@query("agg_population_stats", f"""
SELECT event_type, {rnd('stddev_pop(value)', 6)} AS std, {rnd('quantile_cont(value, 0.5)', 6)} AS median,
  {rnd('quantile_cont(value, 0.25)', 6)} AS p25, {rnd('quantile_cont(value, 0.75)', 6)} AS p75 FROM events GROUP BY 1""")
def agg_population_stats(spark, d):
    events = V.load(spark, d, "events").select("event_type", "value")
    std = events.groupBy("event_type").agg(exact_round(F.stddev_pop("value"), 6).alias("std"))
    q = exact_quantiles(events, ["event_type"], "value", {"median": 0.5, "p25": 0.25, "p75": 0.75})
    return std.join(q, "event_type").select(
        "event_type", "std", *[exact_round(F.col(c), 6).alias(c) for c in ("median", "p25", "p75")]
    )
