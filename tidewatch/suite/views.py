"""Canonical event model over the driver tables, in Spark and as SQL for the check.

Every view covers its whole base table; ``FIXTURES.md`` explains the mapping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.functions.scalar import ts
from tidewatch.schema import CLASSIFICATIONS

AS_OF = "2001-08-01 00:00:00"
LOOKBACK = "365 days"
SQL_FROM = f"TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY"


def as_of() -> Column:
    return ts(AS_OF)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def level(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in CLASSIFICATIONS]), number.cast("int") + 1)


def tier(priority: Column) -> Column:
    return (
        F.when(priority == "1-URGENT", "CRITICAL")
        .when(priority == "2-HIGH", "HIGH")
        .when(priority == "3-MEDIUM", "MEDIUM")
        .when(priority == "5-LOW", "LOW")
        .otherwise("INFORMATIONAL")
    )


def status(code: Column) -> Column:
    return F.when(code == "F", "CLOSED").when(code == "P", "PROCESSING").otherwise("INGESTED")


def intel_events(spark: SparkSession, sf_dir: str, lines: bool = False) -> DataFrame:
    """One event per order; ``lines`` adds what has to be aggregated from lineitem."""
    key = F.col("o_orderkey")
    events = load(spark, sf_dir, "orders").select(
        key.alias("event_id"),
        F.col("o_orderdate").alias("occurred_at"),
        F.col("o_orderdate").alias("ingested_at"),
        F.col("o_custkey").alias("source_id"),
        tier(F.col("o_orderpriority")).alias("threat_tier"),
        status(F.col("o_orderstatus")).alias("status"),
        level(key % 5).alias("classification"),
        ((key % 400) / 100.0 - 2.0).alias("geo_lat"),
        ((key * 7 % 600) / 100.0 - 3.0).alias("geo_lon"),
        F.concat(F.lit("REGION_"), (F.col("o_custkey") % 5).cast("string")).alias("geo_region"),
    )
    if not lines:
        return events
    per_order = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("event_id")).agg(
        F.min("l_suppkey").alias("analyst_id"),
        F.max("l_shipdate").alias("last_ship"),
        F.avg("l_discount").alias("confidence_score"),
        F.bool_or(F.col("l_returnflag") == "A").alias("corroborated"),
    )
    resolved = F.when(
        (F.col("status") == "CLOSED") & (F.col("last_ship") >= F.col("occurred_at")), F.col("last_ship")
    )
    return events.join(per_order, "event_id", "left").select(
        events["*"],
        "analyst_id",
        resolved.alias("resolved_at"),
        "confidence_score",
        F.when(F.col("corroborated"), F.col("event_id")).alias("corroborated_by"),
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("source_id"),
        F.col("c_name").alias("source_name"),
        F.col("c_mktsegment").alias("source_type"),
        (1 + F.col("c_custkey") % 5).alias("reliability"),
        (F.col("c_acctbal") > 0).alias("is_active"),
    )


def analysts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("analyst_id"),
        F.lower("s_name").alias("username"),
        F.col("s_name").alias("display_name"),
        level(F.col("s_suppkey") % 5).alias("clearance_level"),
        (F.col("s_acctbal") > 0).alias("is_active"),
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        F.concat_ws("/", "p_brand", "p_type").alias("entity_id"),
        F.col("p_brand").alias("canonical_name"),
        F.col("p_type").alias("entity_type"),
    ).distinct()


def event_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.concat_ws("/", "p_brand", "p_type").alias("entity_id"),
    )
    return (
        load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event_id"), "l_partkey")
        .join(part, "l_partkey")
        .select("event_id", "entity_id")
        .distinct()
    )


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status F rows are EXPORTs, P rows DELETEs, O rows INSERTs of one event each."""
    e = intel_events(spark, sf_dir)
    code = F.col("status")
    payload = F.to_json(F.struct("event_id", "classification"))
    return e.select(
        F.col("event_id").alias("log_id"),
        F.col("occurred_at").alias("logged_at"),
        (F.col("source_id") % 10).alias("analyst_id"),
        F.when(code == "CLOSED", "EXPORT").when(code == "PROCESSING", "DELETE").otherwise("INSERT").alias("action"),
        F.lit("intel_events").alias("table_name"),
        F.col("event_id").cast("string").alias("row_id"),
        F.when(code != "INGESTED", payload).alias("old_values"),
        F.when(code == "INGESTED", payload).alias("new_values"),
        F.concat(F.lit("10.0.0."), (F.col("event_id") % 256).cast("string")).alias("ip_address"),
        F.concat(F.lit("s-"), F.col("source_id").cast("string")).alias("session_id"),
    )


def sql_level(expression: str) -> str:
    names = ", ".join(f"'{c}'" for c in CLASSIFICATIONS)
    return f"([{names}])[CAST({expression} AS INTEGER) + 1]"


def sql_ordinal(expression: str) -> str:
    names = ", ".join(f"'{c}'" for c in CLASSIFICATIONS)
    return f"list_position([{names}], {expression})"


_EVENTS_SQL = f"""
SELECT o_orderkey AS event_id, o_orderdate AS occurred_at, o_orderdate AS ingested_at, o_custkey AS source_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'HIGH' WHEN '3-MEDIUM' THEN 'MEDIUM'
    WHEN '5-LOW' THEN 'LOW' ELSE 'INFORMATIONAL' END AS threat_tier,
  CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'P' THEN 'PROCESSING' ELSE 'INGESTED' END AS status,
  {sql_level('o_orderkey % 5')} AS classification,
  CAST(o_orderkey % 400 AS DOUBLE) / 100.0::DOUBLE - 2.0::DOUBLE AS geo_lat,
  CAST(o_orderkey * 7 % 600 AS DOUBLE) / 100.0::DOUBLE - 3.0::DOUBLE AS geo_lon,
  'REGION_' || (o_custkey % 5) AS geo_region
FROM orders"""

SQL_VIEWS = {
    "intel_base": _EVENTS_SQL,
    "intel_events": f"""
SELECT b.*, p.analyst_id,
  CASE WHEN b.status = 'CLOSED' AND p.last_ship >= b.occurred_at THEN p.last_ship END AS resolved_at,
  p.confidence_score, CASE WHEN p.corroborated THEN b.event_id END AS corroborated_by
FROM ({_EVENTS_SQL}) b LEFT JOIN (
  SELECT l_orderkey, min(l_suppkey) AS analyst_id, max(l_shipdate) AS last_ship,
    avg(l_discount) AS confidence_score, bool_or(l_returnflag = 'A') AS corroborated
  FROM lineitem GROUP BY l_orderkey) p ON p.l_orderkey = b.event_id""",
    "sources": """
SELECT c_custkey AS source_id, c_name AS source_name, c_mktsegment AS source_type,
  1 + c_custkey % 5 AS reliability, c_acctbal > 0 AS is_active FROM customer""",
    "analysts": f"""
SELECT s_suppkey AS analyst_id, lower(s_name) AS username, s_name AS display_name,
  {sql_level('s_suppkey % 5')} AS clearance_level, s_acctbal > 0 AS is_active FROM supplier""",
    "entities": """
SELECT DISTINCT p_brand || '/' || p_type AS entity_id, p_brand AS canonical_name, p_type AS entity_type FROM part""",
    "event_entities": """
SELECT DISTINCT l_orderkey AS event_id, p_brand || '/' || p_type AS entity_id
FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "audit_log": f"""
SELECT event_id AS log_id, occurred_at AS logged_at, source_id % 10 AS analyst_id,
  CASE status WHEN 'CLOSED' THEN 'EXPORT' WHEN 'PROCESSING' THEN 'DELETE' ELSE 'INSERT' END AS action,
  'intel_events' AS table_name, CAST(event_id AS VARCHAR) AS row_id,
  CASE WHEN status <> 'INGESTED' THEN classification END AS old_class,
  CASE WHEN status = 'INGESTED' THEN classification END AS new_class,
  '10.0.0.' || (event_id % 256) AS ip_address, 's-' || source_id AS session_id
FROM ({_EVENTS_SQL})""",
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the named canonical views as CTEs."""
    ctes = ",\n".join(f"{n} AS ({SQL_VIEWS[n]})" for n in names)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


WEB_AS_OF = "2024-01-31 00:00:00"
WEB_LOOKBACK = "31 days"
WEB_SQL_FROM = f"TIMESTAMP '{WEB_AS_OF}' - INTERVAL 31 DAY"


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clickstream as hourly-density events: kind gives the tier, value the status."""
    kind = F.col("event_type")
    return load(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("occurred_at"),
        F.col("user_id").alias("source_id"),
        kind,
        F.concat(F.lit("T"), (F.col("user_id") % 4).cast("string")).alias("int_type"),
        F.when(kind == "error", "CRITICAL").when(kind == "purchase", "HIGH").when(kind == "signup", "MEDIUM")
        .when(kind == "click", "LOW").otherwise("INFORMATIONAL").alias("threat_tier"),
        F.when(F.col("value") >= 50, "CLOSED").otherwise("INGESTED").alias("status"),
        level(F.col("event_id") % 5).alias("classification"),
        "value",
    )


SQL_VIEWS["web_events"] = f"""
SELECT event_id, ts AS occurred_at, user_id AS source_id, event_type, 'T' || (user_id % 4) AS int_type,
  CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'purchase' THEN 'HIGH' WHEN 'signup' THEN 'MEDIUM'
    WHEN 'click' THEN 'LOW' ELSE 'INFORMATIONAL' END AS threat_tier,
  CASE WHEN value >= 50 THEN 'CLOSED' ELSE 'INGESTED' END AS status,
  {sql_level('event_id % 5')} AS classification, value
FROM events"""
