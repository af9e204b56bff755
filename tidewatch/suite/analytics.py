"""The composite analytics queries over the whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.scalar import exact_round, ts
from tidewatch.plans import analytics as A
from tidewatch.suite import views as V
from tidewatch.suite.registry import query, rnd



# Checks are stated per output column: one small aggregate for each figure, joined by key,
# and a rank as one more than the number of larger values.
@query("source_dashboard", V.with_views(f"""
WITH seen AS (SELECT source_id, threat_tier, status, date_diff('second', ingested_at, resolved_at) AS secs
  FROM intel_events WHERE occurred_at >= {V.SQL_FROM} AND source_id IN (SELECT source_id FROM sources WHERE is_active)),
tiers AS (PIVOT (SELECT source_id, threat_tier FROM seen) ON threat_tier IN ('CRITICAL', 'HIGH', 'MEDIUM') USING count(*)),
volume AS (SELECT source_id, count(*) AS n FROM seen GROUP BY source_id),
closed AS (SELECT source_id, count(*) AS n FROM seen WHERE status = 'CLOSED' GROUP BY source_id),
waits AS (SELECT source_id, sum(secs) / count(*) / 3600.0 AS hours FROM seen WHERE secs IS NOT NULL GROUP BY source_id),
figures AS (SELECT volume.source_id, volume.n, coalesce(closed.n, 0) AS closed_n, hours, tiers.* EXCLUDE (source_id)
  FROM volume JOIN tiers USING (source_id) LEFT JOIN closed USING (source_id) LEFT JOIN waits USING (source_id)),
listed AS (SELECT * FROM figures ORDER BY n DESC, source_id LIMIT 20)
SELECT sources.source_name, sources.source_type, sources.reliability, l.n AS total_events,
  l.CRITICAL AS critical_count, l.HIGH AS high_count, l.MEDIUM AS medium_count,
  {rnd('l.hours', 1)} AS avg_resolution_hrs, {rnd('100.0 * l.closed_n / l.n', 1)} AS pct_closed,
  (SELECT count(*) + 1 FROM figures f WHERE f.n > l.n) AS volume_rank,
  (SELECT count(*) + 1 FROM figures f WHERE f.CRITICAL > l.CRITICAL) AS criticality_rank
FROM listed l JOIN sources USING (source_id)""", "sources", "intel_events"))
def source_dashboard(spark, d):
    return A.source_dashboard(
        V.sources(spark, d), V.intel_events(spark, d, lines=True), as_of=V.as_of(), lookback=V.LOOKBACK
    )


def _workload_sql(violation: str) -> str:
    return V.with_views(f"""
WITH staff AS (SELECT analyst_id, display_name, clearance_level FROM analysts WHERE is_active),
duty AS (SELECT staff.*, status = 'CLOSED' AS done, threat_tier, classification, occurred_at, date_diff('second', ingested_at, resolved_at) AS secs
  FROM intel_events JOIN staff USING (analyst_id)),
backlog AS (SELECT analyst_id, count(*) AS n FROM duty WHERE NOT done GROUP BY analyst_id),
urgent AS (SELECT analyst_id, count(*) AS n FROM duty WHERE NOT done AND threat_tier IN ('HIGH', 'CRITICAL') GROUP BY analyst_id),
finished AS (SELECT analyst_id, count(*) AS n FROM duty WHERE done AND occurred_at >= {V.SQL_FROM} GROUP BY analyst_id),
breaches AS (SELECT analyst_id, count(*) AS n FROM duty WHERE {violation} GROUP BY analyst_id),
sorted AS (SELECT analyst_id, list_sort(list(secs)) AS s FROM duty WHERE secs IS NOT NULL GROUP BY analyst_id),
spots AS (SELECT analyst_id, s, p, 1 + CAST(floor(p * (len(s) - 1)) AS BIGINT) AS i FROM sorted, (VALUES (0.5::DOUBLE), (0.95::DOUBLE)) v(p)),
quantiles AS (SELECT analyst_id, p, (s[i] + (p * (len(s) - 1) - (i - 1)) * (s[least(i + 1, len(s))] - s[i])) / 3600 AS hours FROM spots)
SELECT display_name AS analyst, clearance_level, coalesce(backlog.n, 0) AS open_events, coalesce(finished.n, 0) AS closed_last_7d,
  coalesce(urgent.n, 0) AS open_high_critical, {rnd('half.hours', 6)} AS median_resolution_hrs, {rnd('most.hours', 6)} AS p95_resolution_hrs,
  coalesce(breaches.n, 0) AS clearance_violations
FROM staff LEFT JOIN backlog USING (analyst_id) LEFT JOIN urgent USING (analyst_id) LEFT JOIN finished USING (analyst_id)
  LEFT JOIN breaches USING (analyst_id) LEFT JOIN (FROM quantiles WHERE p = 0.5) half USING (analyst_id)
  LEFT JOIN (FROM quantiles WHERE p = 0.95) most USING (analyst_id)""", "analysts", "intel_events")


def _workload(spark, d, compare):
    out = A.analyst_workload(
        V.analysts(spark, d), V.intel_events(spark, d, lines=True),
        as_of=V.as_of(), recent=V.LOOKBACK, compare=compare,
    )
    for c in ("median_resolution_hrs", "p95_resolution_hrs"):
        out = out.withColumn(c, exact_round(F.col(c), 6))
    return out


@query("analyst_workload",
       _workload_sql(f"{V.sql_ordinal('classification')} > {V.sql_ordinal('clearance_level')}"))
def analyst_workload(spark, d):
    return _workload(spark, d, "ordinal")


@query("analyst_workload_lexical", _workload_sql("classification > clearance_level"))
def analyst_workload_lexical(spark, d):
    return _workload(spark, d, "lexical")


@query("entity_correlation", V.with_views(f"""
WITH held AS (SELECT event_id, list(DISTINCT entity_id ORDER BY entity_id) AS ids FROM event_entities GROUP BY event_id),
couples AS (SELECT event_id, unnest(flatten(list_transform(ids, lambda x: list_transform(
    list_filter(ids, lambda y: y > x), lambda y: {{'x': x, 'y': y}}))), recursive := true) FROM held),
facts AS (SELECT couples.x, couples.y, b.event_id, b.source_id, b.occurred_at, b.threat_tier IN ('HIGH', 'CRITICAL') AS severe
  FROM couples JOIN intel_base b USING (event_id) WHERE b.occurred_at >= {V.SQL_FROM}),
events_of AS (SELECT x, y, count(*) AS n, max(occurred_at) AS latest FROM facts GROUP BY x, y),
sources_of AS (SELECT x, y, count(*) AS n FROM (SELECT DISTINCT x, y, source_id FROM facts) GROUP BY x, y HAVING count(*) > 1),
severe_of AS (SELECT x, y, count(*) AS n FROM facts WHERE severe GROUP BY x, y),
best AS (SELECT e.x, e.y, e.n AS shared, e.latest, s.n AS backing, coalesce(h.n, 0) AS severe
  FROM sources_of s JOIN events_of e USING (x, y) LEFT JOIN severe_of h USING (x, y)
  ORDER BY backing DESC, shared DESC, x, y LIMIT 50)
SELECT one.canonical_name AS entity_a, two.canonical_name AS entity_b, one.entity_type AS type_a, two.entity_type AS type_b,
  best.shared AS shared_events, best.backing AS corroborating_sources, best.severe AS high_threat_events,
  best.latest AS most_recent,
  {rnd('(1 - exp(-0.7 * best.backing)) * (1 - exp(-0.3 * best.shared))', 4)} AS correlation_confidence
FROM best JOIN entities one ON one.entity_id = best.x JOIN entities two ON two.entity_id = best.y
""", "intel_base", "entities", "event_entities"))
def entity_correlation(spark, d):
    return A.entity_correlation(
        V.event_entities(spark, d), V.entities(spark, d), V.intel_events(spark, d),
        as_of=V.as_of(), lookback=V.LOOKBACK,
    )


@query("threat_density_timeseries", V.with_views(f"""
WITH hourly AS (
  SELECT date_trunc('hour', occurred_at) AS bucket,
    count(*) FILTER (threat_tier = 'CRITICAL') AS critical, count(*) FILTER (threat_tier = 'HIGH') AS high,
    count(*) FILTER (threat_tier = 'MEDIUM') AS medium, count(*) FILTER (threat_tier = 'LOW') AS low,
    count(*) AS total
  FROM web_events WHERE occurred_at >= {V.WEB_SQL_FROM} GROUP BY 1)
SELECT bucket, critical, high, medium, low, total,
  CAST(sum(total) OVER (ORDER BY bucket ROWS 23 PRECEDING) AS BIGINT) AS rolling_24h_total,
  {rnd('(total - avg(total) OVER ()) / nullif(stddev(total) OVER (), 0)', 6)} AS z_score,
  {rnd('(total - lag(total) OVER (ORDER BY bucket)) * 100.0 / nullif(lag(total) OVER (ORDER BY bucket), 0)', 1)}
    AS pct_change_vs_prior_hour
FROM hourly""", "web_events"))
def threat_density_timeseries(spark, d):
    out = A.threat_density_timeseries(V.web_events(spark, d), as_of=ts(V.WEB_AS_OF), lookback=V.WEB_LOOKBACK)
    return out.withColumn("z_score", exact_round(F.col("z_score"), 6))


SQL_CELL_SOURCES = f"""
SELECT CAST(floor(geo_lat) AS BIGINT) AS lat_grid, CAST(floor(geo_lon) AS BIGINT) AS lon_grid, geo_region, source_id, count(*) AS events,
  sum((threat_tier = 'CRITICAL')::INT)::BIGINT AS critical, sum((threat_tier = 'HIGH')::INT)::BIGINT AS high,
  min(occurred_at) AS first_seen, max(occurred_at) AS last_seen, sum(geo_lat) AS lat, sum(geo_lon) AS lon
FROM intel_base WHERE occurred_at >= {V.SQL_FROM} GROUP BY ALL"""


@query("geo_cell_sources", V.with_views(f"SELECT * EXCLUDE (lat, lon) FROM ({SQL_CELL_SOURCES})", "intel_base"))
def geo_cell_sources(spark, d):
    """The child table of the clusters: what each source reported in each cell."""
    return A.geo_cell_sources(V.intel_events(spark, d), as_of=V.as_of(), lookback=V.LOOKBACK).drop("lat", "lon")


@query("geo_clusters", V.with_views(f"""
WITH per_source AS MATERIALIZED ({SQL_CELL_SOURCES}),
cells AS (SELECT lat_grid, lon_grid, geo_region, sum(events)::BIGINT AS total_events, sum(critical)::BIGINT AS critical, sum(high)::BIGINT AS high,
  sum(lat) AS lat, sum(lon) AS lon, min(first_seen) AS first_seen, max(last_seen) AS last_seen FROM per_source GROUP BY ALL),
serious AS (SELECT lat_grid, lon_grid, geo_region, string_agg(source_id::VARCHAR, ',' ORDER BY source_id::VARCHAR) AS high_threat_sources
  FROM per_source WHERE critical > 0 OR high > 0 GROUP BY ALL)
SELECT lat_grid, lon_grid, geo_region, total_events, critical, high, {rnd('lat / total_events', 4)} AS centroid_lat,
  {rnd('lon / total_events', 4)} AS centroid_lon, first_seen, last_seen, high_threat_sources
FROM cells JOIN serious USING (lat_grid, lon_grid, geo_region) WHERE critical + high > 2""", "intel_base"))
def geo_clusters(spark, d):
    out = A.geo_clusters(V.intel_events(spark, d), as_of=V.as_of(), lookback=V.LOOKBACK)
    return out.withColumn("high_threat_sources", F.array_join("high_threat_sources", ","))


def _audit_sql(rule: str) -> str:
    over = " OR ".join(f"coalesce({rule.format(c)}, FALSE)" for c in ("old_class", "new_class"))
    return V.with_views(f"""
SELECT logged_at AS logged_utc, display_name AS analyst, clearance_level, action, table_name, row_id, ip_address,
  session_id, {over} AS potential_over_access
FROM audit_log JOIN analysts USING (analyst_id)
WHERE action IN ('EXPORT', 'DELETE') AND logged_at >= {V.SQL_FROM}""", "audit_log", "analysts")


@query("audit_trail", _audit_sql(
    V.sql_ordinal("{0}") + " > " + V.sql_ordinal("clearance_level")))
def audit_trail(spark, d):
    return A.audit_trail(V.audit_log(spark, d), V.analysts(spark, d), as_of=V.as_of(), lookback=V.LOOKBACK)


@query("audit_trail_lexical", _audit_sql("{0} > clearance_level"))
def audit_trail_lexical(spark, d):
    return A.audit_trail(
        V.audit_log(spark, d), V.analysts(spark, d), as_of=V.as_of(), lookback=V.LOOKBACK, compare="lexical"
    )


@query("analyst_throughput", V.with_views(f"""
WITH work AS (SELECT analyst_id, threat_tier, status, date_diff('second', occurred_at, resolved_at) AS secs
  FROM intel_events WHERE occurred_at >= {V.SQL_FROM}),
volume AS (SELECT analyst_id, count(*) AS n FROM work WHERE analyst_id IN (SELECT analyst_id FROM analysts) GROUP BY analyst_id),
sorted AS (SELECT analyst_id, list_sort(list(secs)) AS s FROM work WHERE secs IS NOT NULL GROUP BY analyst_id),
middle AS (SELECT analyst_id, list_sum(s) / len(s)::DOUBLE AS mean, (s[(len(s) + 1) // 2] + s[len(s) // 2 + 1]) / 2.0 AS median FROM sorted)
SELECT analysts.analyst_id, analysts.username, analysts.clearance_level, volume.n AS events_reviewed_30d,
  (SELECT count(*) FROM work w WHERE w.analyst_id = volume.analyst_id AND w.threat_tier = 'CRITICAL') AS critical_events,
  (SELECT count(*) FROM work w WHERE w.analyst_id = volume.analyst_id AND w.status = 'CLOSED') AS actioned_count,
  {rnd('middle.mean / 60', 1)} AS avg_response_min, {rnd('middle.median / 60', 6)} AS median_response_min,
  (SELECT count(*) + 1 FROM volume v WHERE v.n > volume.n) AS throughput_rank
FROM volume JOIN analysts USING (analyst_id) LEFT JOIN middle USING (analyst_id)""", "analysts", "intel_events"))
def analyst_throughput(spark, d):
    events = V.intel_events(spark, d, lines=True).select(
        "threat_tier",
        F.when(F.col("status") == "CLOSED", "ACTIONED").otherwise(F.col("status")).alias("status"),
        F.col("occurred_at").alias("event_time"),
        F.col("analyst_id").alias("assigned_analyst"),
        F.col("occurred_at").alias("assigned_at"),
        F.col("resolved_at").alias("actioned_at"),
    )
    out = A.analyst_throughput(V.analysts(spark, d), events, as_of=V.as_of(), lookback=V.LOOKBACK)
    return out.withColumn("median_response_min", exact_round(F.col("median_response_min"), 6))


@query("entity_network", V.with_views(f"""
WITH serious AS (SELECT event_id, occurred_at, threat_tier, source_type FROM intel_base JOIN sources USING (source_id)
  WHERE occurred_at >= {V.SQL_FROM} AND threat_tier IN ('HIGH', 'CRITICAL')),
held AS (SELECT event_id, list(DISTINCT entity_id) AS ids FROM event_entities WHERE event_id IN (SELECT event_id FROM serious) GROUP BY event_id),
couples AS (SELECT event_id, unnest(flatten(list_transform(ids, lambda x: list_transform(
    list_filter(ids, lambda y: y > x), lambda y: {{'x': x, 'y': y}}))), recursive := true) FROM held),
known AS (SELECT x, y, list(DISTINCT event_id) AS events FROM couples GROUP BY x, y HAVING count(DISTINCT event_id) > 2),
spans AS (SELECT x, y, min(occurred_at) AS first_seen, max(occurred_at) AS last_seen,
    array_to_string(list_sort(list(DISTINCT source_type)), ',') AS source_types,
    array_to_string(list_sort(list(DISTINCT threat_tier)), ',') AS threat_tiers
  FROM (SELECT x, y, unnest(events) AS event_id FROM known) JOIN serious USING (event_id) GROUP BY x, y),
by_name AS MATERIALIZED (SELECT canonical_name AS name, list(DISTINCT event_id) AS events FROM event_entities JOIN entities USING (entity_id)
  WHERE event_id IN (SELECT event_id FROM serious) GROUP BY 1)
SELECT one.canonical_name AS entity_a, two.canonical_name AS entity_b, one.entity_type AS type_a, two.entity_type AS type_b,
  len(known.events)::BIGINT AS shared_events,
  {rnd('len(known.events) / len(list_distinct(list_concat(n1.events, n2.events)))::DOUBLE', 4)} AS jaccard_similarity,
  first_seen, last_seen, source_types, threat_tiers
FROM known JOIN spans USING (x, y) JOIN entities one ON one.entity_id = x JOIN entities two ON two.entity_id = y
  JOIN by_name n1 ON n1.name = one.canonical_name JOIN by_name n2 ON n2.name = two.canonical_name
ORDER BY shared_events DESC, jaccard_similarity DESC, x, y LIMIT 50
""", "intel_base", "sources", "entities", "event_entities"))
def entity_network(spark, d):
    kinds = V.sources(spark, d).select("source_id", F.col("source_type").alias("int_type"))
    events = V.intel_events(spark, d).join(kinds, "source_id")
    out = A.entity_network(
        V.event_entities(spark, d), V.entities(spark, d), events, as_of=V.as_of(), lookback=V.LOOKBACK
    )
    for c in ("source_types", "threat_tiers"):
        out = out.withColumn(c, F.array_join(c, ","))
    return out


# The limits of the grades and the order in which they hold are the contract of this report.
@query("source_reliability", V.with_views(f"""
WITH reports AS (SELECT source_id, occurred_at, confidence_score AS conf, corroborated_by IS NOT NULL AS backed, threat_tier = 'LOW' AS refuted
  FROM intel_events WHERE occurred_at >= {V.SQL_FROM}),
tally AS (SELECT source_id, CAST(sum(n) AS BIGINT) AS n, CAST(coalesce(sum(n) FILTER (backed), 0) AS BIGINT) AS good,
    CAST(coalesce(sum(n) FILTER (refuted), 0) AS BIGINT) AS poor, max(latest) AS latest, sum(total) / sum(rated) AS conf
  FROM (SELECT source_id, backed, refuted, count(*) AS n, max(occurred_at) AS latest, sum(conf) AS total, count(conf) AS rated
    FROM reports GROUP BY source_id, backed, refuted) GROUP BY source_id)
SELECT sources.source_name, sources.source_type, tally.n AS total_events, tally.good AS corroborated_events,
  tally.poor AS refuted_events, {rnd('100.0 * tally.good / tally.n', 1)} AS corroboration_pct, {rnd('tally.conf', 3)} AS avg_confidence,
  CASE WHEN tally.good > 0.8 * tally.n AND tally.poor < 5 THEN 'A' WHEN tally.good > 0.6 * tally.n THEN 'B'
    WHEN tally.poor > 0.3 * tally.n THEN 'D' ELSE 'C' END AS reliability_grade,
  tally.latest AS last_report_time
FROM tally JOIN sources USING (source_id)""", "sources", "intel_events"))
def source_reliability(spark, d):
    events = V.intel_events(spark, d, lines=True).select(
        "source_id", "corroborated_by", "confidence_score",
        F.col("occurred_at").alias("event_time"),
        F.when(F.col("threat_tier") == "LOW", "REFUTED").otherwise(F.col("status")).alias("status"),
    )
    return A.source_reliability(V.sources(spark, d), events, as_of=V.as_of(), lookback=V.LOOKBACK)


# The rolling mean and deviation are differences of running sums, 169 rows apart.
@query("threat_density_anomaly", V.with_views(f"""
WITH tallies AS (SELECT date_trunc('hour', occurred_at) AS bucket, event_type AS source_id, int_type, status AS threat_tier, count(*) AS n
  FROM web_events WHERE occurred_at >= {V.WEB_SQL_FROM} GROUP BY ALL),
lined AS (SELECT *, row_number() OVER o AS r, sum(n) OVER o AS s1, sum(n * n) OVER o AS s2
  FROM tallies WINDOW o AS (PARTITION BY source_id ORDER BY bucket, int_type, threat_tier)),
framed AS (SELECT l.*, p.n AS before, least(l.r, 169) AS k, l.s1 - coalesce(o.s1, 0) AS f1, l.s2 - coalesce(o.s2, 0) AS f2
  FROM lined l LEFT JOIN lined o ON o.source_id = l.source_id AND o.r = l.r - 169
    LEFT JOIN lined p ON p.source_id = l.source_id AND p.r = l.r - 1),
spread AS (SELECT *, f1 / k::DOUBLE AS mean, CASE WHEN k > 1 THEN sqrt((k * f2 - f1 * f1)::DOUBLE / (k * (k - 1))) END AS deviation FROM framed),
scored AS (SELECT *, {rnd('coalesce((n - mean) / nullif(deviation, 0), 0)', 8)} AS z FROM spread),
levels AS (SELECT * FROM (VALUES (3, 'CRITICAL_SPIKE'), (2, 'HIGH_ANOMALY')) v(above, anomaly_level))
SELECT bucket, source_id, int_type, threat_tier, n AS event_count, {rnd('mean', 1)} AS rolling_avg, {rnd('z', 2)} AS z_score,
  n - before AS delta_vs_prev_hour, arg_max(anomaly_level, above) AS anomaly_level
FROM scored JOIN levels ON z > above GROUP BY ALL
ORDER BY max(z) DESC, bucket DESC, source_id, int_type, threat_tier LIMIT 100""", "web_events"))
def threat_density_anomaly(spark, d):
    events = V.web_events(spark, d).select(
        F.col("occurred_at").alias("event_time"), F.col("event_type").alias("source_id"), "int_type",
        F.col("status").alias("threat_tier"),
    )
    return A.threat_density_anomaly(events, as_of=ts(V.WEB_AS_OF), lookback=V.WEB_LOOKBACK)


@query("hourly_threat_stats", V.with_views("""
SELECT date_trunc('hour', occurred_at) AS bucket, source_id, threat_tier, count(*) AS event_count,
  count(*) FILTER (status = 'CLOSED') AS closed_count
FROM web_events GROUP BY ALL""", "web_events"))
def hourly_threat_stats(spark, d):
    return A.hourly_threat_stats(V.web_events(spark, d))
