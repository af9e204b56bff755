"""Join shapes, sorts, top-k and set operations on whole tables."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from tidewatch.operators.pairs import pair_rows
from tidewatch.suite import views as V
from tidewatch.suite.registry import query


@query("join_inner", V.with_views("""
SELECT event_id, source_name, threat_tier FROM intel_base JOIN sources USING (source_id)""", "intel_base", "sources"))
def join_inner(spark, d):
    names = V.sources(spark, d).select("source_id", "source_name")
    return V.intel_events(spark, d).join(names, "source_id").select("event_id", "source_name", "threat_tier")


@query("join_left", V.with_views("""
SELECT s.source_id, s.source_name, count(event_id) AS events FROM sources s LEFT JOIN intel_base b
ON b.source_id = s.source_id AND b.status = 'PROCESSING' GROUP BY 1, 2""", "intel_base", "sources"))
def join_left(spark, d):
    counts = V.intel_events(spark, d).filter("status = 'PROCESSING'").groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))
    return V.sources(spark, d).join(counts, "source_id", "left").select(
        "source_id", "source_name", F.coalesce("n", F.lit(0)).alias("events")
    )


@query("join_composite", V.with_views("""
SELECT ee.event_id, e.canonical_name, e.entity_type, b.occurred_at
FROM (SELECT event_entities.*, o_orderdate AS occurred_at FROM event_entities JOIN orders ON o_orderkey = event_id) ee
JOIN entities e ON e.entity_id = ee.entity_id
JOIN intel_base b ON b.event_id = ee.event_id AND b.occurred_at = ee.occurred_at""",
    "intel_base", "entities", "event_entities"))
def join_composite(spark, d):
    when = V.load(spark, d, "orders").select(F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").alias("occurred_at"))
    edges = V.event_entities(spark, d).join(when, "event_id")
    return (
        edges.join(V.intel_events(spark, d).select("event_id", "occurred_at"), ["event_id", "occurred_at"])
        .join(V.entities(spark, d), "entity_id")
        .select("event_id", "canonical_name", "entity_type", "occurred_at")
    )


@query("join_self_pairs", V.with_views("""
SELECT a.entity_id AS item_a, b.entity_id AS item_b, count(*) AS shared FROM event_entities a
JOIN event_entities b ON b.event_id = a.event_id AND b.entity_id > a.entity_id GROUP BY 1, 2""", "event_entities"))
def join_self_pairs(spark, d):
    return pair_rows(V.event_entities(spark, d), "event_id", "entity_id", []).groupBy("item_a", "item_b").agg(
        F.count(F.lit(1)).alias("shared")
    )


@query("join_full_outer", """
WITH v AS (SELECT o_custkey AS id, count(*) AS urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
t AS (SELECT o_custkey AS id, count(*) AS low FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1)
SELECT id, coalesce(urgent, 0) AS urgent, coalesce(low, 0) AS low FROM v FULL JOIN t USING (id)""")
def join_full_outer(spark, d):
    orders = V.load(spark, d, "orders")

    def counted(priority, name):
        return orders.filter(F.col("o_orderpriority") == priority).groupBy(F.col("o_custkey").alias("id")).agg(
            F.count(F.lit(1)).alias(name)
        )

    both = counted("1-URGENT", "urgent").join(counted("5-LOW", "low"), "id", "full")
    return both.select("id", F.coalesce("urgent", F.lit(0)).alias("urgent"), F.coalesce("low", F.lit(0)).alias("low"))


@query("join_rehydrate", """
WITH top AS (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50)
SELECT o.o_orderkey, o_orderdate, o_orderpriority FROM top JOIN orders o USING (o_orderkey)""")
def join_rehydrate(spark, d):
    orders = V.load(spark, d, "orders")
    top = orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)
    return orders.select("o_orderkey", "o_orderdate", "o_orderpriority").join(top.select("o_orderkey"), "o_orderkey", "left_semi")


@query("subquery_correlated", V.with_views("""
WITH ev AS (SELECT DISTINCT canonical_name AS name, event_id FROM event_entities JOIN entities USING (entity_id)),
p AS (SELECT DISTINCT a.name AS name_a, b.name AS name_b FROM ev a JOIN ev b ON a.event_id = b.event_id AND a.name < b.name)
SELECT name_a, name_b, count(DISTINCT event_id) AS either FROM p JOIN ev ON ev.name IN (name_a, name_b) GROUP BY 1, 2
""", "entities", "event_entities"))
def subquery_correlated(spark, d):
    """Events of either name, as |A| + |B| - |A and B| instead of a nested-loop join."""
    names = V.entities(spark, d).select("entity_id", F.col("canonical_name").alias("name"))
    ev = V.event_entities(spark, d).join(names, "entity_id").select("name", "event_id").distinct()
    size = ev.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    both = pair_rows(ev, "event_id", "name", []).groupBy(
        F.col("item_a").alias("name_a"), F.col("item_b").alias("name_b")
    ).agg(F.count(F.lit(1)).alias("n_both"))
    return (
        both.join(size.toDF("name_a", "n_a"), "name_a").join(size.toDF("name_b", "n_b"), "name_b")
        .select("name_a", "name_b", (F.col("n_a") + F.col("n_b") - F.col("n_both")).alias("either"))
    )


@query("subquery_scalar", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)""")
def subquery_scalar(spark, d):
    orders = V.load(spark, d, "orders")
    mean = orders.agg(F.avg("o_totalprice")).scalar()
    return orders.filter(F.col("o_totalprice") > mean).select("o_orderkey", "o_totalprice")


@query("join_semi_anti", """
SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS known FROM customer""")
def join_semi_anti(spark, d):
    customer = V.load(spark, d, "customer").select("c_custkey")
    orders = V.load(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    known = customer.join(orders, "c_custkey", "left_semi").withColumn("known", F.lit(True))
    return known.unionByName(customer.join(orders, "c_custkey", "left_anti").withColumn("known", F.lit(False)))


@query("sort_multi_key", "SELECT o_orderkey, o_orderpriority, o_orderdate, o_totalprice FROM orders")
def sort_multi_key(spark, d):
    return V.load(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice").orderBy(
        "o_orderpriority", F.desc("o_orderdate"), F.desc("o_totalprice"), "o_orderkey"
    )


@query("top_k_global", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def top_k_global(spark, d):
    return V.load(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("top_k_per_query", """
SELECT o_orderpriority, o_orderkey, o_totalprice, rn FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rn
  FROM orders) WHERE rn <= 8""")
def top_k_per_query(spark, d):
    w = W.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return V.load(spark, d, "orders").select(
        "o_orderpriority", "o_orderkey", "o_totalprice", F.row_number().over(w).alias("rn")
    ).filter("rn <= 8")


@query("id_set_union", """
SELECT DISTINCT id FROM (SELECT o_custkey AS id FROM orders UNION ALL SELECT c_custkey FROM customer)""")
def id_set_union(spark, d):
    a = V.load(spark, d, "orders").select(F.col("o_custkey").alias("id")).distinct()
    return a.join(V.load(spark, d, "customer").select(F.col("c_custkey").alias("id")), "id", "full")


@query("set_difference", """
SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""")
def set_difference(spark, d):
    closed = V.load(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return V.load(spark, d, "customer").select("c_custkey").join(closed, "c_custkey", "left_anti")
