"""One small query per scalar function the reports rely on."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions import lexemes as L
from tidewatch.functions import text as X
from tidewatch.functions.scalar import cosine_similarity, exact_round, safe_ratio, seconds_between, time_bucket
from tidewatch.schema import CLASSIFICATIONS, ordinal
from tidewatch.session import spread
from tidewatch.suite import views as V
from tidewatch.suite.ingest import sql_strip
from tidewatch.suite.registry import query, rnd


@query("fn_round", f"""
SELECT l_orderkey, l_linenumber, l_partkey, {rnd('l_extendedprice / l_quantity', 1)} AS unit_1,
  {rnd('l_extendedprice / l_quantity', 4)} AS unit_4 FROM lineitem""")
def fn_round(spark, d):
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return V.load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", exact_round(unit, 1).alias("unit_1"), exact_round(unit, 4).alias("unit_4")
    )


@query("fn_exp", f"""
SELECT l_quantity, l_discount, {rnd('(1 - exp(-l_quantity * 0.7)) * (1 - exp(-l_discount * 0.3))', 8)} AS score,
  count(*) AS n FROM lineitem GROUP BY ALL""")
def fn_exp(spark, d):
    score = (1 - F.exp(-F.col("l_quantity") * 0.7)) * (1 - F.exp(-F.col("l_discount") * 0.3))
    return V.load(spark, d, "lineitem").groupBy("l_quantity", "l_discount").agg(F.count(F.lit(1)).alias("n")).select(
        "l_quantity", "l_discount", exact_round(score, 8).alias("score"), "n"
    )


@query("fn_floor", V.with_views("""
SELECT event_id, CAST(floor(geo_lat) AS BIGINT) AS lat_cell, CAST(floor(geo_lon) AS BIGINT) AS lon_cell FROM intel_base
""", "intel_base"))
def fn_floor(spark, d):
    return V.intel_events(spark, d).select("event_id", F.floor("geo_lat").alias("lat_cell"), F.floor("geo_lon").alias("lon_cell"))


@query("fn_nullif", f"""
SELECT l_orderkey, l_linenumber, l_partkey, {rnd('l_tax / nullif(l_discount, 0)', 6)} AS ratio FROM lineitem""")
def fn_nullif(spark, d):
    ratio = safe_ratio(F.col("l_tax"), F.col("l_discount"))
    return V.load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", exact_round(ratio, 6).alias("ratio"))


@query("fn_coalesce", """
SELECT c_custkey, coalesce(max(o_totalprice), 0.0) AS largest FROM customer LEFT JOIN orders ON o_custkey = c_custkey
GROUP BY 1""")
def fn_coalesce(spark, d):
    largest = V.load(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_totalprice").alias("m"))
    return V.load(spark, d, "customer").join(largest, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", F.coalesce("m", F.lit(0.0)).alias("largest")
    )


@query("fn_case", """
SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'A' WHEN o_totalprice > 200000 THEN 'B'
  WHEN o_orderstatus = 'F' THEN 'D' ELSE 'C' END AS grade FROM orders""")
def fn_case(spark, d):
    price = F.col("o_totalprice")
    grade = F.when(price > 400000, "A").when(price > 200000, "B").when(F.col("o_orderstatus") == "F", "D").otherwise("C")
    return V.load(spark, d, "orders").select("o_orderkey", grade.alias("grade"))


@query("fn_cast", """
SELECT event_id, CAST(event_id AS VARCHAR) AS as_text, CAST(json_extract_string(props, '$.k') AS INTEGER) AS as_int,
  TRY_CAST(event_type AS INTEGER) AS bad_int FROM events""")
def fn_cast(spark, d):
    return V.load(spark, d, "events").select(
        "event_id", F.col("event_id").cast("string").alias("as_text"),
        F.get_json_object("props", "$.k").cast("int").alias("as_int"),
        F.col("event_type").try_cast("int").alias("bad_int"),
    )


@query("fn_epoch_diff", f"""
SELECT event_id, {rnd("epoch(ts - TIMESTAMP '2024-01-01')", 6)} AS secs FROM events""")
def fn_epoch_diff(spark, d):
    secs = seconds_between(F.col("ts"), F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'"))
    return V.load(spark, d, "events").select("event_id", exact_round(secs, 6).alias("secs"))


@query("fn_time_bucket", "SELECT date_trunc('hour', ts) AS bucket, count(*) AS n FROM events GROUP BY 1")
def fn_time_bucket(spark, d):
    return V.load(spark, d, "events").groupBy(time_bucket(F.col("ts")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("fn_at_timezone", """
SELECT event_id, CAST((ts AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS TIMESTAMP) AS utc FROM events""")
def fn_at_timezone(spark, d):
    local = F.to_utc_timestamp(F.col("ts").cast("timestamp"), "America/New_York")
    return V.load(spark, d, "events").select("event_id", local.cast("timestamp_ntz").alias("utc"))


@query("fn_date_bounds", """
SELECT event_id, CAST(ts AS DATE) AS day, ts - INTERVAL 90 MINUTE AS earlier FROM events
WHERE ts >= DATE '2024-01-03' AND ts < DATE '2024-01-03' + INTERVAL 20 DAY""")
def fn_date_bounds(spark, d):
    start = F.expr("TIMESTAMP_NTZ '2024-01-03 00:00:00'")
    return V.load(spark, d, "events").filter(
        (F.col("ts") >= start) & (F.col("ts") < start + F.expr("INTERVAL 20 DAYS"))
    ).select("event_id", F.to_date("ts").alias("day"), (F.col("ts") - F.expr("INTERVAL 90 MINUTES")).alias("earlier"))


@query("fn_json", """
SELECT event_id, json_extract_string(props, '$.k') AS k, coalesce(json_extract_string(props, '$.none'), 'SECRET') AS label,
  CAST(json_object('event_id', event_id, 'event_type', event_type) AS VARCHAR) AS image FROM events""")
def fn_json(spark, d):
    bag = F.from_json("props", "map<string,string>")
    return V.load(spark, d, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"),
        F.coalesce(F.try_element_at(bag, F.lit("none")), F.lit("SECRET")).alias("label"),
        F.to_json(F.struct("event_id", "event_type")).alias("image"),
    )


@query("fn_left", "SELECT doc_id, left(text, 300) AS excerpt FROM documents")
def fn_left(spark, d):
    return V.load(spark, d, "documents").select("doc_id", X.excerpt(F.col("text")).alias("excerpt"))


@query("fn_string", f"""
SELECT p_partkey, lower(p_type) AS low, upper(p_name) AS up, string_split(p_name, ' ')[2] AS word,
  contains(p_name, 'ring') AS has_ring, regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits,
  {sql_strip("'  ' || p_name || chr(9)")} AS stripped FROM part""")
def fn_string(spark, d):
    return V.load(spark, d, "part").select(
        "p_partkey", F.lower("p_type").alias("low"), F.upper("p_name").alias("up"),
        F.try_element_at(F.split("p_name", " "), F.lit(2)).alias("word"),
        F.col("p_name").contains("ring").alias("has_ring"),
        F.regexp_replace("p_brand", "[^0-9]", "").alias("digits"),
        X.strip(F.concat(F.lit("  "), "p_name", F.lit("\t"))).alias("stripped"),
    )


@query("fn_sha256", "SELECT doc_id, sha256(text) AS content_hash FROM documents")
def fn_sha256(spark, d):
    return V.load(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"))


@query("fn_array", """
WITH a AS (SELECT doc_id, list_slice(string_split(text, ' '), 1, 10) || [lang, source, lang] AS t FROM documents)
SELECT doc_id, list_contains(t, 'the') AS has_the,
  array_to_string(list_filter(t, lambda x, i: list_position(t, x) = i), ' ') AS uniq FROM a""")
def fn_array(spark, d):
    ten = F.slice(F.split("text", " "), 1, 10)
    t = F.concat(ten, F.array("lang", "source", "lang"))
    return V.load(spark, d, "documents").select(
        "doc_id", F.array_contains(t, "the").alias("has_the"), F.array_join(F.array_distinct(t), " ").alias("uniq")
    )


@query("fn_map_explode", """
SELECT c_custkey, code, name FROM (
  SELECT c_custkey, 'seg' AS code, c_mktsegment AS name FROM customer UNION ALL
  SELECT c_custkey, 'nat', CAST(c_nationkey AS VARCHAR) FROM customer)""")
def fn_map_explode(spark, d):
    bag = F.create_map(F.lit("seg"), "c_mktsegment", F.lit("nat"), F.col("c_nationkey").cast("string"))
    return V.load(spark, d, "customer").select("c_custkey", F.explode(bag).alias("code", "name"))


@query("fn_cosine", f"""
WITH c AS (SELECT label, list(m ORDER BY i) AS mean FROM (
  SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings, unnest(range(1, 65)) AS u(i) GROUP BY 1, 2)
  GROUP BY 1)
SELECT vec_id, {rnd('1 - list_cosine_similarity(CAST(embedding AS DOUBLE[]), mean)', 6)} AS distance
FROM embeddings JOIN c USING (label)""")
def fn_cosine(spark, d):
    vectors = V.load(spark, d, "embeddings")
    per_dim = vectors.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(
        F.avg(F.col("x").cast("double")).alias("m")
    )
    mean = per_dim.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "m"))).getField("m").alias("mean"))
    return vectors.join(mean, "label").select(
        "vec_id", exact_round(1 - cosine_similarity(F.col("embedding"), F.col("mean")), 6).alias("distance")
    )


@query("fn_ordinal", V.with_views(f"""
SELECT event_id, CAST({V.sql_ordinal('classification')} AS BIGINT) AS rank FROM intel_base""", "intel_base"))
def fn_ordinal(spark, d):
    return V.intel_events(spark, d).select("event_id", ordinal(F.col("classification"), CLASSIFICATIONS).cast("bigint").alias("rank"))


@query("fn_text_match", f"""
SELECT doc_id, list_has_all(list_transform(list_filter(regexp_extract_all(lower(text), '{L.WORD}'),
    lambda w: w NOT IN {L.sql_stop_words()}), lambda w: {L.sql_stem('w')}), ['tion', 're']) AS matched FROM documents""")
def fn_text_match(spark, d):
    """Documents that hold the terms of a question; its stop words and suffixes do not count."""
    return spread(V.load(spark, d, "documents").select("doc_id", "text")).select("doc_id", L.matches(F.col("text"), F.lit("What of the tions, re?")).alias("matched"))
