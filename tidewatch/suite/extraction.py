"""Text-extraction jobs over texts rendered from every row of the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.functions.text import ASCII_WS, DISTANCE, DTG, FLASH, LATLON, REPORT_LINE, SPEED
from tidewatch.operators import extract as E
from tidewatch.session import spread
from tidewatch.suite import views as V
from tidewatch.suite.ingest import sql_strip
from tidewatch.suite.registry import query


def signal_messages(spark: SparkSession, d: str) -> DataFrame:
    """One signal text per event: marker, activity, position and date-time group depend on its kind."""
    kind, key = F.col("event_type"), F.col("event_id")
    marker = F.when(kind == "error", "FLASH: ").otherwise("")
    activity = F.when(kind == "purchase", "Strike imminent").when(kind == "click", "Movement observed").otherwise("Routine contact")
    stamp = F.concat(F.date_format("ts", "ddHHmm"), F.lit("Z "), F.date_format("ts", "MMMyy"))
    dtg = F.when(kind == "view", "").when((kind == "signup") & (F.col("value") < 10), "310000ZFEB24").otherwise(stamp)
    position = F.concat(
        F.lit(" at "), (key % 90).cast("string"), F.lit(".5"), F.when(key % 2 == 0, "N").otherwise("S"), F.lit(", "),
        (key % 180).cast("string"), F.lit(".25"), F.when(key % 3 == 0, "E").otherwise("W"),
    )
    return spread(V.load(spark, d, "events")).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("source_id"),
        F.concat(marker, activity, F.lit(" "), key.cast("string"), F.when(kind == "signup", "").otherwise(position), F.lit(" "), dtg, F.lit("  ")).alias("raw_text"),
        F.col("ts").alias("received_at"),
        F.when(key % 7 == 0, F.create_map(F.lit("classification"), V.level(key % 5))).otherwise(
            F.create_map().cast("map<string,string>")
        ).alias("metadata"),
    )


SQL_SIGNALS = f"""
SELECT 'u' || user_id AS source_id,
  CASE event_type WHEN 'error' THEN 'FLASH: ' ELSE '' END ||
  CASE event_type WHEN 'purchase' THEN 'Strike imminent' WHEN 'click' THEN 'Movement observed' ELSE 'Routine contact' END
  || ' ' || event_id ||
  CASE WHEN event_type = 'signup' THEN '' ELSE ' at ' || (event_id % 90) || '.5' ||
    CASE WHEN event_id % 2 = 0 THEN 'N' ELSE 'S' END || ', ' || (event_id % 180) || '.25' ||
    CASE WHEN event_id % 3 = 0 THEN 'E' ELSE 'W' END END || ' ' ||
  CASE WHEN event_type = 'view' THEN '' WHEN event_type = 'signup' AND value < 10 THEN '310000ZFEB24'
    ELSE strftime(ts, '%d%H%MZ %b%y') END || '  ' AS raw_text,
  ts AS received_at, CASE WHEN event_id % 7 = 0 THEN {V.sql_level('event_id % 5')} ELSE 'SECRET' END AS classification
FROM events"""

_PART = "regexp_extract(txt, '{0}', {1})"
SQL_PARSED = f"""
SELECT *, coalesce(dtg, received_at) AS event_time, {sql_strip(f"regexp_replace(txt, '{FLASH}', '', 'g')")} AS clean
FROM (SELECT *, CASE WHEN has THEN try_cast('20' || {_PART.format(DTG, 5)} || '-' || lpad(CAST(list_position(
    ['JAN','FEB','MAR','APR','MAY','JUN','JUL','AUG','SEP','OCT','NOV','DEC'], upper({_PART.format(DTG, 4)})) AS VARCHAR), 2, '0')
    || '-' || {_PART.format(DTG, 1)} || ' ' || {_PART.format(DTG, 2)} || ':' || {_PART.format(DTG, 3)} || ':00' AS TIMESTAMP) END AS dtg
  FROM (SELECT *, regexp_matches(txt, '{DTG}') AS has FROM (SELECT *, {sql_strip('raw_text')} AS txt FROM ({SQL_SIGNALS}))))"""

SQL_TIER = """CASE WHEN regexp_matches(lower(clean), 'imminent|attack|strike|flash') THEN 'CRITICAL'
  WHEN regexp_matches(lower(clean), 'movement|surveillance|observed') THEN 'HIGH' ELSE 'MEDIUM' END"""


def _degrees(number: int, letter: int, negative: str) -> str:
    return (
        f"CASE WHEN regexp_extract(txt, '{LATLON}', {letter}) = '{negative}' THEN -1 ELSE 1 END * "
        f"try_cast(nullif(regexp_extract(txt, '{LATLON}', {number}), '') AS DOUBLE)"
    )


@query("signal_normalize_job", f"""
SELECT source_id, event_time, classification, {SQL_TIER} AS threat_tier, raw_text, clean AS normalized_text,
  {_degrees(1, 2, 'S')} AS geo_lat, {_degrees(3, 4, 'W')} AS geo_lon, sha256(source_id || raw_text) AS fingerprint
FROM ({SQL_PARSED}) WHERE NOT (has AND dtg IS NULL)""")
def signal_normalize_job(spark, d):
    return E.normalize_signals(signal_messages(spark, d)).accepted


@query("signal_normalize_rejects", f"""
SELECT source_id, raw_text, 'impossible date-time group' AS reject_reason FROM ({SQL_PARSED}) WHERE has AND dtg IS NULL""")
def signal_normalize_rejects(spark, d):
    return E.normalize_signals(signal_messages(spark, d)).rejected.select("source_id", "raw_text", "reject_reason")


@query("signal_normalize_rollup", f"""
SELECT source_id, {SQL_TIER} AS threat_tier, date_trunc('hour', event_time) AS hour, count(*) AS events
FROM ({SQL_PARSED}) WHERE NOT (has AND dtg IS NULL) GROUP BY 1, 2, 3""")
def signal_normalize_rollup(spark, d):
    return E.normalize_signals(signal_messages(spark, d)).rollup


def report_texts(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    number = F.concat(F.col("event_id").cast("string"), F.lit(". "))
    clock = F.concat(F.date_format("ts", "dd/HHmm"), F.lit("Z: "))
    ship = F.when(kind == "error", "Patrol ship ALPHA ONE closed ").when(kind == "click", "BRAVO kept station ").otherwise("Contact held course ")
    where = F.when(kind == "click", "on the Port Quarter ").otherwise("")
    speed = F.when(kind == "purchase", F.concat(F.lit(" at "), F.floor(F.col("value") % 40).cast("string"), F.lit(" knots"))).otherwise("")
    text = F.concat(clock, ship, where, F.lit("at "), (F.col("event_id") % 30).cast("string"), F.lit(".5NM"), speed, F.lit("."))
    return V.load(spark, d, "events").select(
        F.when(kind == "view", F.concat(F.lit("Note "), text)).otherwise(F.concat(number, text)).alias("line")
    )


SQL_REPORTS = """
SELECT CASE WHEN event_type = 'view' THEN 'Note ' ELSE event_id || '. ' END || strftime(ts, '%d/%H%MZ: ') ||
  CASE event_type WHEN 'error' THEN 'Patrol ship ALPHA ONE closed ' WHEN 'click' THEN 'BRAVO kept station '
    ELSE 'Contact held course ' END || CASE event_type WHEN 'click' THEN 'on the Port Quarter ' ELSE '' END ||
  'at ' || (event_id % 30) || '.5NM' || CASE event_type WHEN 'purchase'
    THEN ' at ' || CAST(floor(value % 40) AS BIGINT) || ' knots' ELSE '' END || '.' AS line FROM events"""

SQL_TIMELINE = f"""
SELECT CAST(regexp_extract(line, '{REPORT_LINE}', 1) AS BIGINT) AS sequence,
  '2024-01-' || lpad(CAST(CAST(regexp_extract(line, '{REPORT_LINE}', 2) AS INTEGER) AS VARCHAR), 2, '0') || 'T' ||
    left(regexp_extract(line, '{REPORT_LINE}', 3), 2) || ':' || substr(regexp_extract(line, '{REPORT_LINE}', 3), 3, 2)
    || ':00Z' AS "timestamp",
  CASE WHEN contains(upper(line), 'ALPHA ONE') THEN 'ALPHA ONE' WHEN contains(upper(line), 'BRAVO') THEN 'BRAVO'
    ELSE 'UNKNOWN' END AS vessel,
  CASE WHEN contains(lower(line), 'port quarter') THEN 'port quarter' END AS bearing,
  try_cast(nullif(regexp_extract(line, '{DISTANCE}', 1), '') AS DOUBLE) AS distance_nm,
  try_cast(nullif(regexp_extract(line, '{SPEED}', 1), '') AS DOUBLE) AS speed_kts,
  regexp_extract(line, '{REPORT_LINE}', 4) AS description, line AS raw
FROM ({SQL_REPORTS}) WHERE regexp_matches(line, '{REPORT_LINE}')"""


def _timeline(spark, d):
    return E.report_timeline(report_texts(spark, d), default_vessel="UNKNOWN", vessels=["ALPHA ONE", "BRAVO"])


@query("report_timeline_job", SQL_TIMELINE)
def report_timeline_job(spark, d):
    return _timeline(spark, d).accepted.orderBy("sequence")


@query("report_timeline_rejects", f"SELECT line FROM ({SQL_REPORTS}) WHERE NOT regexp_matches(line, '{REPORT_LINE}')")
def report_timeline_rejects(spark, d):
    return _timeline(spark, d).rejected.select("line")


@query("report_timeline_rollup", f"""
SELECT vessel, count(*) AS lines, min(distance_nm) AS min_distance_nm, max(speed_kts) AS max_speed_kts,
  min("timestamp") AS first_time, max("timestamp") AS last_time FROM ({SQL_TIMELINE}) GROUP BY 1""")
def report_timeline_rollup(spark, d):
    return _timeline(spark, d).rollup


SQL_ENRICHED = f"""
SELECT *, list_filter(e, lambda x, i: list_position(e, x) = i)[1:10] AS entities FROM (
  SELECT doc_id, lang AS source_type, text, list_filter(list_transform(regexp_split_to_array(text, '{ASCII_WS}'),
    lambda t: regexp_replace(t, '[^A-Z]', '', 'g')), lambda t: length(t) BETWEEN 2 AND 8) AS e FROM documents)"""


def _enriched(spark, d):
    return E.enrich_events(spread(V.load(spark, d, "documents")).select(
        "doc_id", F.col("lang").alias("source_type"), F.col("text").alias("raw_content")
    ))


@query("enrich_events_job", f"""
SELECT doc_id, source_type, CASE WHEN contains(upper(text), 'FLASH') THEN 'FLASH'
    WHEN contains(upper(text), 'IMMEDIATE') THEN 'IMMEDIATE' WHEN contains(upper(text), 'PRIORITY') THEN 'PRIORITY'
    ELSE 'ROUTINE' END AS threat_tier,
  array_to_string(entities, ',') AS entities, CASE WHEN {sql_strip('text')} = '' THEN '' WHEN length(f) > 120 THEN left(f, 117) || '...'
    ELSE f END AS summary, 'ACCEPTED' AS processing_status
FROM (SELECT *, CASE WHEN instr(text, '.') > 1 THEN left(text, instr(text, '.')) ELSE text END AS f
  FROM ({SQL_ENRICHED}))""")
def enrich_events_job(spark, d):
    out = _enriched(spark, d).accepted
    return out.withColumn("entities", F.array_join("entities", ",")).drop("raw_content")


@query("enrich_events_rollup", f"""
SELECT source_type, entity, count(*) AS events FROM (
  SELECT source_type, unnest(entities) AS entity FROM ({SQL_ENRICHED})) GROUP BY 1, 2""")
def enrich_events_rollup(spark, d):
    return _enriched(spark, d).rollup


@query("adapter_dispatch", f"""
SELECT event_id, event_type, CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'click' THEN 'LOW' WHEN 'view' THEN 'LOW' END AS threat_tier,
  CASE WHEN event_type = 'click' THEN value * 2 END AS score,
  CASE WHEN event_type IS NULL OR event_type NOT IN ('error', 'click', 'view') THEN '{E.UNKNOWN_KIND}' END AS reject_reason FROM events""")
def adapter_dispatch(spark, d):
    low = F.lit("LOW")
    return E.dispatch(V.load(spark, d, "events"), {
        "error": {"threat_tier": F.lit("CRITICAL")},
        "click": {"threat_tier": low, "score": F.col("value") * 2},
        "view": {"threat_tier": low},
    }, keep=["event_id", "event_type"], column="event_type")
