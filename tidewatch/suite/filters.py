"""Filters, access rules and text search over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.scalar import exact_round, since, ts
from tidewatch.operators import filters as FL, ingest as I
from tidewatch.suite import views as V
from tidewatch.suite.registry import query, rnd


@query("lookback_filter", V.with_views(f"""
SELECT event_id, occurred_at FROM intel_base WHERE occurred_at >= {V.SQL_FROM}""", "intel_base"))
def lookback_filter(spark, d):
    e = V.intel_events(spark, d)
    return e.filter(since(F.col("occurred_at"), V.as_of(), V.LOOKBACK)).select("event_id", "occurred_at")


@query("optional_filters", V.with_views("""
SELECT event_id, int_type, occurred_at FROM web_events
WHERE int_type IN ('T1', 'T3') AND occurred_at >= TIMESTAMP '2024-01-05' AND occurred_at <= TIMESTAMP '2024-01-20'
""", "web_events"))
def optional_filters(spark, d):
    return FL.optional_filters(
        V.web_events(spark, d), kinds=["T1", "T3"], min_time=ts("2024-01-05 00:00:00"),
        max_time=ts("2024-01-20 00:00:00"), time="occurred_at",
    ).select("event_id", "int_type", "occurred_at")


@query("event_list_filter", V.with_views("""
SELECT event_id, source_type, threat_tier, ingested_at FROM (
  SELECT b.event_id, s.source_type, b.threat_tier, b.ingested_at FROM intel_base b JOIN sources s USING (source_id))
WHERE lower(source_type) = 'building' AND lower(threat_tier) = 'high'
ORDER BY ingested_at DESC, event_id LIMIT 20""", "intel_base", "sources"))
def event_list_filter(spark, d):
    kinds = V.sources(spark, d).select("source_id", "source_type")
    events = V.intel_events(spark, d).join(kinds, "source_id")
    return FL.event_list(events, source_type="Building", threat_tier="high").select(
        "event_id", "source_type", "threat_tier", "ingested_at"
    )


@query("like_search", """
SELECT p_partkey AS sequence, p_type AS vessel, p_name AS description FROM part
WHERE p_type ILIKE '%small%' AND p_name ILIKE '%r_ng%'""")
def like_search(spark, d):
    rows = V.load(spark, d, "part").select(
        F.col("p_partkey").alias("sequence"), F.col("p_type").alias("vessel"), F.col("p_name").alias("description")
    )
    return FL.like_search(rows, vessel="small", keyword="r_ng")


@query("multi_column_contains", """
SELECT doc_id FROM documents
WHERE contains(lower(text), 'ation') OR contains(lower(lang), 'ation') OR contains(lower(source), 'ation')""")
def multi_column_contains(spark, d):
    return FL.multi_column_contains(V.load(spark, d, "documents"), "ATION", ["text", "lang", "source"]).select("doc_id")


@query("point_lookup", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderkey = 77")
def point_lookup(spark, d):
    return FL.point_lookup(V.load(spark, d, "orders"), "o_orderkey", 77).select("o_orderkey", "o_custkey", "o_orderdate")


@query("next_sequence", """
SELECT event_id, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY event_id) AS sequence FROM events""")
def next_sequence(spark, d):
    stored = V.load(spark, d, "orders").select(F.col("o_orderkey").alias("sequence"))
    return I.append_with_sequence(stored, V.load(spark, d, "events").select("event_id"), "event_id")


@query("clearance_filter", V.with_views(f"""
SELECT event_id, classification FROM intel_base
WHERE {V.sql_ordinal('classification')} <=
  (SELECT {V.sql_ordinal('clearance_level')} FROM analysts WHERE analyst_id = 2)""", "intel_base", "analysts"))
def clearance_filter(spark, d):
    return FL.clearance_filter(V.intel_events(spark, d), V.analysts(spark, d), 2).select("event_id", "classification")


@query("clearance_visible_counts", V.with_views(f"""
SELECT analyst_id, (SELECT count(*) FROM intel_base
  WHERE {V.sql_ordinal('classification')} <= {V.sql_ordinal('clearance_level')}) AS visible_events
FROM analysts""", "intel_base", "analysts"))
def clearance_visible_counts(spark, d):
    return FL.visible_counts(V.intel_events(spark, d), V.analysts(spark, d))


@query("updatable_filter", V.with_views(f"""
SELECT event_id, classification, status FROM intel_events
WHERE analyst_id = 3 AND status <> 'CLOSED' AND {V.sql_ordinal('classification')} <=
  (SELECT {V.sql_ordinal('clearance_level')} FROM analysts WHERE analyst_id = 3)""", "intel_events", "analysts"))
def updatable_filter(spark, d):
    events = V.intel_events(spark, d, lines=True)
    return FL.updatable_filter(events, V.analysts(spark, d), 3).select("event_id", "classification", "status")


@query("service_bypass", V.with_views("SELECT event_id, classification FROM intel_base", "intel_base"))
def service_bypass(spark, d):
    out = FL.clearance_filter(V.intel_events(spark, d), V.analysts(spark, d), None, role="service")
    return out.select("event_id", "classification")


@query("partial_predicates", V.with_views("""
SELECT count(*) FILTER (status <> 'CLOSED') AS open_events, count(*) FILTER (geo_lat IS NOT NULL) AS located,
  count(*) FILTER (status = 'INGESTED') AS awaiting,
  (SELECT count(*) FROM audit_log WHERE action IN ('EXPORT', 'DELETE')) AS audited
FROM intel_base""", "intel_base", "audit_log"))
def partial_predicates(spark, d):
    audited = V.audit_log(spark, d).agg(F.count_if(FL.audited_action())).scalar()
    return V.intel_events(spark, d).agg(
        F.count_if(FL.open_events()).alias("open_events"),
        F.count_if(FL.has_geo()).alias("located"),
        F.count_if(FL.awaiting()).alias("awaiting"),
    ).withColumn("audited", audited)


@query("status_queue", V.with_views("""
SELECT event_id, ingested_at FROM intel_base WHERE status = 'INGESTED'""", "intel_base"))
def status_queue(spark, d):
    return FL.status_queue(V.intel_events(spark, d)).select("event_id", "ingested_at")


@query("tag_join_filter", """
WITH tags AS (SELECT DISTINCT p_type AS tag_name, CASE WHEN p_type IN ('LARGE', 'SMALL', 'MEDIUM') THEN 'DOMAIN'
  ELSE 'CAMPAIGN' END AS tag_category FROM part),
event_tags AS (SELECT DISTINCT l_orderkey AS event_id, p_type AS tag_name FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT DISTINCT o_orderkey AS event_id FROM orders JOIN event_tags ON event_id = o_orderkey JOIN tags USING (tag_name)
WHERE tag_category = 'DOMAIN'""")
def tag_join_filter(spark, d):
    part = V.load(spark, d, "part")
    category = F.when(F.col("p_type").isin("LARGE", "SMALL", "MEDIUM"), "DOMAIN").otherwise("CAMPAIGN")
    tags = part.select(F.col("p_type").alias("tag_name"), category.alias("tag_category")).distinct()
    event_tags = V.load(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("event_id"), F.col("p_type").alias("tag_name")
    )
    tagged = event_tags.join(tags.filter("tag_category = 'DOMAIN'"), "tag_name", "left_semi")
    return V.load(spark, d, "orders").select(F.col("o_orderkey").alias("event_id")).join(tagged, "event_id", "left_semi")


@query("alias_lookup", """
SELECT p_brand AS name, p_type AS entity_type, CAST(count(DISTINCT p_name) AS INTEGER) AS aliases FROM part
GROUP BY 1, 2 HAVING list_contains(array_agg(p_name), 'large ring')""")
def alias_lookup(spark, d):
    names = V.load(spark, d, "part").select(
        F.col("p_brand").alias("name"), F.col("p_type").alias("entity_type"), F.col("p_name").alias("alias")
    )
    found = FL.alias_lookup(names, "large ring")
    return names.join(found, ["name", "entity_type"], "left_semi").groupBy("name", "entity_type").agg(
        F.count_distinct("alias").cast("int").alias("aliases")
    )


_GRAMS = """(SELECT DISTINCT s AS s, substr('  ' || w || ' ', i, 3) AS g FROM (
  SELECT s, unnest(list_filter(regexp_split_to_array(lower(s), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')) AS w
  FROM (SELECT DISTINCT {0} AS s FROM {1})), unnest(range(1, length(w) + 2)) AS u(i))"""


@query("trigram_name_match", f"""
WITH n AS {_GRAMS.format('p_name', 'part')}, t AS {_GRAMS.format('p_type', 'part')},
nc AS (SELECT s, count(*) AS c FROM n GROUP BY 1), tc AS (SELECT s, count(*) AS c FROM t GROUP BY 1),
j AS (SELECT n.s AS p_name, t.s AS p_type, count(*) AS k FROM n JOIN t ON n.g = t.g GROUP BY 1, 2)
SELECT p_name, p_type, {rnd('k / (nc.c + tc.c - k)::DOUBLE', 6)} AS similarity
FROM j JOIN nc ON nc.s = p_name JOIN tc ON tc.s = p_type WHERE k / (nc.c + tc.c - k)::DOUBLE >= 0.3""")
def trigram_name_match(spark, d):
    part = V.load(spark, d, "part")
    out = FL.trigram_match(part, part, "p_name", "p_type")
    return out.withColumn("similarity", exact_round(F.col("similarity"), 6))
