"""Streams over whole tables, drained and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.session import work_dir
from tidewatch.sources import readers
from tidewatch.streaming import pipelines as P
from tidewatch.suite import views as V
from tidewatch.suite.extraction import SQL_PARSED, SQL_TIER, signal_messages
from tidewatch.suite.registry import query


def table_stream(spark: SparkSession, d: str, table: str) -> DataFrame:
    """The files of a table as a stream, whether the table is one file or a folder of files.

    The path is a pattern that only the table's own name fits: as a plain path a stream takes folders only.
    """
    schema = V.load(spark, d, table).schema
    return spark.readStream.schema(schema).parquet(f"{d}/{table}.parque[t]")


def landed_messages(spark: SparkSession, raw: DataFrame) -> str:
    """Raw events as JSON message files, as a broker dump would leave them."""
    path = work_dir(spark, "messages")
    readers.messages_of(raw).write.text(path)
    return path


@query("stream_json_source", """
SELECT role AS source_type, CAST(conv_id AS VARCHAR) AS source_id, text AS raw_text, CAST(turn AS VARCHAR) AS turn
FROM conversations""")
def stream_json_source(spark, d):
    raw = V.load(spark, d, "conversations").select(
        F.col("role").alias("source_type"), F.col("conv_id").cast("string").alias("source_id"), F.col("text").alias("raw_text"),
        F.create_map(F.lit("turn"), F.col("turn").cast("string")).alias("metadata"),
    )
    stream = readers.message_files(spark, landed_messages(spark, raw), max_files=100).select(
        "source_type", "source_id", "raw_text", F.try_element_at("metadata", F.lit("turn")).alias("turn")
    )
    return P.drain(stream, work_dir(spark, "raw"), work_dir(spark, "ckpt"))


@query("stream_fingerprint_dedup", "SELECT DISTINCT sha256(source || text) AS fingerprint FROM documents")
def stream_fingerprint_dedup(spark, d):
    raw = table_stream(spark, d, "documents").select(
        F.col("source").alias("source_id"), F.col("text").alias("raw_text"))
    unique = P.fingerprint_stream(raw).select("fingerprint")
    return P.drain(unique, work_dir(spark, "unique"), work_dir(spark, "ckpt"))


@query("stream_hourly_stats", V.with_views("""
SELECT date_trunc('hour', occurred_at) AS bucket, source_id, threat_tier, count(*) AS event_count,
  count(*) FILTER (status = 'CLOSED') AS closed_count
FROM web_events GROUP BY 1, 2, 3""", "web_events"))
def stream_hourly_stats(spark, d):
    kind = F.col("event_type")
    events = table_stream(spark, d, "events").select(
        F.col("ts").cast("timestamp").alias("occurred_at"), F.col("user_id").alias("source_id"),
        F.when(kind == "error", "CRITICAL").when(kind == "purchase", "HIGH").when(kind == "signup", "MEDIUM")
        .when(kind == "click", "LOW").otherwise("INFORMATIONAL").alias("threat_tier"),
        F.when(F.col("value") >= 50, "CLOSED").otherwise("INGESTED").alias("status"),
    )
    target = work_dir(spark, "hourly")
    P.hourly_stats_stream(events, target, work_dir(spark, "ckpt")).awaitTermination()
    return P.hourly_stats(spark, target).withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


def ingested(spark: SparkSession, d: str) -> str:
    """Run the whole ingest stream over every signal message; returns the table folder."""
    raw = signal_messages(spark, d)
    stamped = raw.withColumn(
        "metadata", F.map_concat("metadata", F.create_map(F.lit("received_at"), F.col("received_at").cast("string")))
    ).withColumn("source_type", F.lit("sigint"))
    stream = readers.message_files(spark, landed_messages(spark, stamped), max_files=100).select(
        "source_type", "source_id", "raw_text", "metadata",
        F.try_element_at("metadata", F.lit("received_at")).cast("timestamp_ntz").alias("received_at"),
    )
    target = work_dir(spark, "store")
    P.ingest_stream(stream, target, work_dir(spark, "ckpt")).awaitTermination()
    return target


@query("stream_ingest", f"""
SELECT DISTINCT sha256(source_id || raw_text) AS event_id, source_id, {SQL_TIER} AS threat_tier, classification,
  clean AS normalized_text FROM ({SQL_PARSED}) WHERE NOT (has AND dtg IS NULL)""")
def stream_ingest(spark, d):
    return P.event_store(spark, ingested(spark, d)).read("events").select(
        "event_id", "source_id", "threat_tier", "classification", "normalized_text"
    )


@query("event_persist", f"""
WITH e AS (SELECT DISTINCT sha256(source_id || raw_text) AS event_id, clean FROM ({SQL_PARSED}) WHERE NOT (has AND dtg IS NULL)),
t AS (SELECT event_id, unnest(list_transform(regexp_split_to_array(clean, '\\s+'), lambda x: regexp_replace(x, '[^A-Z]', '', 'g'))) AS name FROM e)
SELECT name, 'TOKEN' AS entity_type, count(DISTINCT event_id) AS events FROM t WHERE length(name) BETWEEN 2 AND 8 GROUP BY 1""")
def event_persist(spark, d):
    target = ingested(spark, d)
    edges = P.event_store(spark, target).read("event_entities").select("event_id", "entity_id")
    return edges.join(P.stored_entities(spark, target), "entity_id").groupBy("name", "entity_type").agg(F.count(F.lit(1)).alias("events"))


@query("event_persist_columns", f"""
SELECT DISTINCT sha256(source_id || raw_text) AS event_id, 'SIGINT' AS int_type, TRUE AS has_metadata, TRUE AS has_unit_vector,
  CAST(len(list_filter(regexp_split_to_array(clean, '\\s+'), lambda x: length(regexp_replace(x, '[^A-Z]', '', 'g')) BETWEEN 2 AND 8)) > 0 AS BOOLEAN) AS linked
FROM ({SQL_PARSED}) WHERE NOT (has AND dtg IS NULL)""")
def event_persist_columns(spark, d):
    """Every stored event with its type, metadata, vector and, where its text has any, entity edges of a known role."""
    target = ingested(spark, d)
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    edges = P.event_store(spark, target).read("event_entities").where("role = 'MENTIONED' AND confidence = 1.0").select("event_id").distinct()
    events = P.event_store(spark, target).read("events").join(edges.withColumn("edge", F.lit(True)), "event_id", "left")
    return events.select(
        "event_id", "int_type", F.element_at("metadata", "received_at").isNotNull().alias("has_metadata"),
        (F.abs(norm - 1.0) < 1e-9).alias("has_unit_vector"), F.coalesce("edge", F.lit(False)).alias("linked"))
