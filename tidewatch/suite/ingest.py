"""Sources, ingestion, upserts and sinks over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.functions.scalar import ts
from tidewatch.functions.text import WS
from tidewatch.operators import entities as E, ingest as I
from tidewatch.operators.extract import normalize_countries
from tidewatch.operators.ordering import with_row_number
from tidewatch.plans.audit import audited
from tidewatch.session import work_dir
from tidewatch.schema import COUNTRY_DOC
from tidewatch.sources import layout, readers
from tidewatch.streaming.store import BatchStore
from tidewatch.suite import views as V
from tidewatch.suite.registry import query


def sql_strip(expression: str) -> str:
    return f"regexp_replace({expression}, '^{WS}|{WS}$', '', 'g')"


def sql_words(expression: str) -> str:
    stripped = sql_strip(expression)
    return f"list_filter(regexp_split_to_array({stripped}, '{WS}'), lambda w: w <> '')"


def country_docs(spark: SparkSession, d: str) -> DataFrame:
    """One nested document per customer; debtors have a blank three-letter code."""
    nation = V.load(spark, d, "nation").join(
        V.load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("c_custkey").cast("string")
    seg = F.col("c_mktsegment")
    debtor = F.col("c_acctbal") < 0
    return V.load(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.struct(F.when(~debtor, F.col("c_name")).alias("common"), F.concat(seg, F.lit(" "), "c_name").alias("official")).alias("name"),
        F.concat(F.lit(" K"), key).alias("cca2"),
        F.when(debtor, "  ").otherwise(F.concat(F.lit("KX"), key)).alias("cca3"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("subregion"),
        F.when(seg == "BUILDING", F.array().cast("array<string>")).otherwise(F.array("n_name", "r_name")).alias("capital"),
        F.floor("c_acctbal").cast("bigint").alias("population"),
        F.create_map(F.substring(seg, 1, 3), seg, F.substring("n_name", 8, 2), F.col("n_name")).alias("languages"),
        F.create_map(F.substring("r_name", 1, 2), F.struct(F.col("r_name").alias("name"), F.lit("$").alias("symbol"))).alias("currencies"),
        F.array(F.concat(F.lit("KX"), (F.col("c_custkey") + 1).cast("string")), F.concat(F.lit("KN"), F.col("c_nationkey").cast("string"))).alias("borders"),
    )


SQL_COUNTRY = """
SELECT CASE WHEN c_acctbal < 0 THEN '' ELSE 'KX' || c_custkey END AS cca3, 'K' || c_custkey AS cca2,
  CASE WHEN c_acctbal >= 0 THEN c_name ELSE '' END AS common_name, c_mktsegment || ' ' || c_name AS official_name,
  r_name AS region, n_name AS subregion, CASE WHEN c_mktsegment <> 'BUILDING' THEN n_name END AS capital,
  CAST(floor(c_acctbal) AS BIGINT) AS population, c_custkey, c_mktsegment, n_name, r_name, c_nationkey
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def land_countries(spark: SparkSession, d: str) -> str:
    """Country documents as files of all three forms, and every hundredth one again as a line that breaks off."""
    path = work_dir(spark, "countries")
    docs = country_docs(spark, d)
    keyed = docs.select(F.regexp_extract("cca2", "[0-9]+", 0).cast("bigint").alias("key"), F.to_json(F.struct(*docs.columns)).alias("value"))
    alone, listed = F.col("key") % 100 == 0, F.col("key") % 3 == 1
    keyed.filter(alone).write.partitionBy("key").text(f"{path}/objects")
    lists = keyed.filter(~alone & listed).groupBy((F.col("key") % 16).alias("part")).agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list("value"), ",\n"), F.lit("]")).alias("value"))
    lists.write.partitionBy("part").text(f"{path}/lists")
    broken = keyed.filter(F.col("key") % 100 == 1).select(F.expr("left(value, length(value) - 1)").alias("value"))
    keyed.filter(~alone & ~listed).select("value").union(broken).write.text(f"{path}/lines")
    return path


@query("country_json_source", f"""
WITH c AS ({SQL_COUNTRY})
SELECT ' ' || cca2 AS cca2, CASE WHEN cca3 = '' THEN '  ' ELSE cca3 END AS cca3, region, population,
  nullif(common_name, '') AS common_name, CAST(CASE WHEN capital IS NULL THEN 0 ELSE 2 END AS INTEGER) AS capitals,
  array_to_string(list_sort([c_mktsegment, n_name]), ',') AS languages, '$' AS symbol FROM c""")
def country_json_source(spark, d):
    docs = readers.country_documents(spark, land_countries(spark, d))
    return docs.select(
        "cca2", "cca3", "region", "population", F.col("name.common").alias("common_name"),
        F.size("capital").alias("capitals"),
        F.array_join(F.array_sort(F.map_values("languages")), ",").alias("languages"),
        F.element_at(F.map_values("currencies"), 1).getField("symbol").alias("symbol"),
    )


@query("country_json_quarantine", f"""
SELECT ' K' || c_custkey AS cca2, 'no JSON' AS reject_reason FROM ({SQL_COUNTRY}) WHERE c_custkey % 100 = 1""")
def country_json_quarantine(spark, d):
    """The documents that break off; the others of their files are read."""
    bad = readers.json_documents(spark, land_countries(spark, d), COUNTRY_DOC)[1]
    return bad.select(F.regexp_extract("payload", '"cca2":"([^"]*)"', 1).alias("cca2"), "reject_reason")


@query("country_normalize_job", f"""
WITH c AS (SELECT * FROM ({SQL_COUNTRY}) WHERE cca3 <> ''),
lang AS (SELECT cca2, count(*) AS languages, string_agg(code || '=' || name, ',' ORDER BY code) AS language_list FROM (
  SELECT cca2, left(c_mktsegment, 3) AS code, c_mktsegment AS name FROM c UNION ALL
  SELECT cca2, substr(n_name, 8, 2), n_name FROM c) GROUP BY 1)
SELECT cca2, cca3, common_name, official_name, region, subregion, capital, population, languages, language_list,
  left(r_name, 2) || ':' || r_name || ':$' AS currency, 'KN' || c_nationkey || ',KX' || (c_custkey + 1) AS borders
FROM c JOIN lang USING (cca2)""")
def country_normalize_job(spark, d):
    t = normalize_countries(country_docs(spark, d))
    pairs = F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "code", "name"))), ",")
    lang = t.languages.groupBy("cca2").agg(F.count(F.lit(1)).alias("languages"), pairs.alias("language_list"))
    cur = t.currencies.groupBy("cca2").agg(F.max(F.concat_ws(":", "code", "name", "symbol")).alias("currency"))
    near = t.borders.groupBy("cca2").agg(F.array_join(F.sort_array(F.collect_list("border_cca3")), ",").alias("borders"))
    return t.countries.join(lang, "cca2").join(cur, "cca2").join(near, "cca2")


@query("country_normalize_rejects", f"SELECT cca2, official_name FROM ({SQL_COUNTRY}) WHERE cca3 = ''")
def country_normalize_rejects(spark, d):
    return normalize_countries(country_docs(spark, d)).rejected.select("cca2", F.col("name.official").alias("official_name"))


@query("dry_run_validate", f"""
SELECT count(*) AS fetched, count(*) FILTER (cca3 = '') AS errors FROM ({SQL_COUNTRY})""")
def dry_run_validate(spark, d):
    docs = country_docs(spark, d)
    blank = (F.trim("cca2") == "") | (F.trim("cca3") == "")
    return docs.agg(F.count(F.lit(1)).alias("fetched"), F.count_if(blank).alias("errors"))


def raw_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents as raw events; one source name is treated as missing and German ones have no clock."""
    return V.load(spark, d, "documents").select(
        "doc_id",
        F.col("lang").alias("source_type"),
        F.nullif(F.col("source"), F.lit("src0")).alias("source_id"),
        F.col("text").alias("raw_text"),
        F.when(F.col("lang") != "de", F.expr("TIMESTAMP '2024-01-01 00:00:00'")).alias("received_at"),
    )


@query("text_file_source", """
SELECT item_id, CASE WHEN item_id % 10 <> 0 THEN text || chr(10) END AS text,
  CASE WHEN item_id % 10 = 0 THEN 'refused file type .json' END AS reject_reason FROM benchmark""")
def text_file_source(spark, d):
    """The benchmark texts landed as a file each, every tenth with a suffix that is refused."""
    items = V.load(spark, d, "benchmark").select("item_id", "text")
    path = work_dir(spark, "texts")
    items.filter("item_id % 10 <> 0").write.partitionBy("item_id").text(path)
    items.filter("item_id % 10 = 0").write.mode("append").partitionBy("item_id").json(path)
    good, bad = readers.text_files(spark, path)
    item = F.regexp_extract("source_path", "item_id=([0-9]+)", 1).cast("bigint").alias("item_id")
    none = F.lit(None).cast("string")
    return good.select(item, "text", none.alias("reject_reason")).unionByName(bad.select(item, none.alias("text"), "reject_reason"))


@query("report_line_source", r"""
SELECT doc_id, CAST(n - 1 AS INTEGER) AS line_no, lines[n] AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents) t,
  unnest(range(1, len(lines) + 1)) AS u(n)""")
def report_line_source(spark, d):
    return readers.report_lines(V.load(spark, d, "documents"), "text", "doc_id")


@query("series_ingest", """
WITH s AS (SELECT event_type AS series_id, date_trunc('day', ts) AS ingest_ts, ts, value,
    row_number() OVER (PARTITION BY event_type, date_trunc('day', ts) ORDER BY ts, event_id) AS step FROM events),
n AS (SELECT series_id, ingest_ts FROM s GROUP BY 1, 2 HAVING count(*) >= 10),
l AS (SELECT series_id, max(ingest_ts) AS ingest_ts FROM n GROUP BY 1)
SELECT series_id, CAST(ingest_ts AS TIMESTAMP) AS ingest_ts, step, value FROM s JOIN l USING (series_id, ingest_ts)""")
def series_ingest(spark, d):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    rows = V.load(spark, d, "events").select(
        F.col("event_type").alias("series_id"), day.alias("ingest_ts"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        "event_id", "value",
    )
    numbered = with_row_number(rows, ["series_id", "ingest_ts"], ["at", "event_id"], "step")
    return I.latest_submission(numbered.select("series_id", "ingest_ts", "step", "value"))


@query("validate_raw_event", f"""
SELECT doc_id, CASE WHEN length({sql_strip('text')}) < 10 THEN 'text shorter than the minimum'
  WHEN source = 'src0' THEN 'no source given'
  WHEN lang = 'de' THEN 'no usable receive time' END AS reject_reason FROM documents""")
def validate_raw_event(spark, d):
    accepted, refused = I.validate_raw_events(raw_documents(spark, d))
    return accepted.select("doc_id", F.lit(None).cast("string").alias("reject_reason")).unionByName(
        refused.select("doc_id", "reject_reason")
    )


@query("validate_contract", """
WITH r AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'OSINT' WHEN 'fr' THEN 'HUMINT' WHEN 'de' THEN 'RADIO' END AS st,
  text, CASE doc_id % 5 WHEN 0 THEN 'UNCLASSIFIED' WHEN 1 THEN 'CUI' WHEN 2 THEN 'SECRET' WHEN 3 THEN 'TOP_SECRET'
    ELSE 'TS_SCI' END AS cl, doc_id % 400 - 200.0 AS lat, doc_id % 1000 - 500.0 AS lon,
  CASE WHEN doc_id % 3 = 0 THEN '071430ZAPR26' WHEN doc_id % 3 = 1 THEN '7 APR' END AS dtg FROM documents)
SELECT doc_id, array_to_string(list_filter([
  CASE WHEN st IS NULL THEN 'source_type required' END,
  CASE WHEN st = 'RADIO' THEN 'source_type not allowed' END,
  CASE WHEN length(text) < 1 THEN 'raw_content too short' END,
  CASE WHEN length(text) > 32768 THEN 'raw_content too long' END,
  CASE WHEN cl IN ('CUI', 'TS_SCI') THEN 'classification_level not allowed' END,
  CASE WHEN NOT regexp_matches(dtg, '^[0-9]{6}[A-Z][0-9A-Za-z_]{3}[0-9]{2}$') THEN 'dtg malformed' END,
  CASE WHEN lat < -90 OR lat > 90 THEN 'latitude out of range' END,
  CASE WHEN lon < -180 OR lon > 180 THEN 'longitude out of range' END], lambda x: x IS NOT NULL), ';') AS violations
FROM r""")
def validate_contract(spark, d):
    key = F.col("doc_id")
    requests = V.load(spark, d, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "en", "OSINT").when(F.col("lang") == "fr", "HUMINT").when(F.col("lang") == "de", "RADIO").alias("source_type"),
        F.col("text").alias("raw_content"),
        V.level(key % 5).alias("classification_level"),
        (key % 400 - 200.0).alias("latitude"),
        (key % 1000 - 500.0).alias("longitude"),
        F.when(key % 3 == 0, "071430ZAPR26").when(key % 3 == 1, "7 APR").alias("dtg"),
    )
    return requests.select("doc_id", F.array_join(I.contract_violations(), ";").alias("violations"))


@query("fingerprint_dedup", """
SELECT sha256(source || text) AS fingerprint, min(doc_id) AS doc_id FROM documents GROUP BY 1""")
def fingerprint_dedup(spark, d):
    raw = V.load(spark, d, "documents").select("doc_id", F.col("source").alias("source_id"), F.col("text").alias("raw_text"))
    return I.fingerprint_dedup(raw, order=["doc_id"]).select("fingerprint", "doc_id")


def entity_log(spark, d) -> DataFrame:
    """The log of two batches of parts, small ones before large ones, the first of them stored twice."""
    part = V.load(spark, d, "part").select(
        F.col("p_brand").alias("name"), F.col("p_type").alias("entity_type"), F.col("p_partkey").alias("seq"), F.col("p_name").alias("alias"),
        F.when(F.col("p_size") % 10 != 0, F.format_string('{"size":%d}', "p_size")).alias("metadata"), "p_size")
    store = BatchStore(spark, work_dir(spark, "entities"), {})
    for number, rows in ((0, part.filter("p_size <= 25")), (0, part.filter("p_size <= 25")), (1, part.filter("p_size > 25"))):
        store.commit(number, {"log": E.entity_log(rows.drop("p_size"), number, ts(f"2024-01-0{number + 1} 00:00:00"))})
    return store.read("log")


SQL_ENTITY_LOG = """
SELECT sha256(p_type || chr(10) || p_brand) AS entity_id, p_brand AS name, p_type AS entity_type, (p_size > 25)::INTEGER AS batch,
  p_partkey AS seq, p_name AS alias, CASE WHEN p_size % 10 <> 0 THEN '{"size":' || p_size || '}' END AS metadata FROM part"""


@query("entity_upsert", f"""
WITH log AS ({SQL_ENTITY_LOG}),
said AS (SELECT entity_id, metadata, row_number() OVER (PARTITION BY entity_id ORDER BY batch DESC, seq DESC) AS back FROM log WHERE metadata IS NOT NULL),
names AS (SELECT DISTINCT entity_id, name, entity_type FROM log),
sizes AS (SELECT entity_id, count(*) AS n_aliases, TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * min(batch) AS created_at FROM log GROUP BY 1)
SELECT entity_id, name, entity_type, created_at, metadata, n_aliases
FROM names JOIN sizes USING (entity_id) LEFT JOIN (SELECT entity_id, metadata FROM said WHERE back = 1) USING (entity_id)""")
def entity_upsert(spark, d):
    """One row per entity after two batches and a replay."""
    return E.entities(entity_log(spark, d))


@query("entity_upsert_aliases", f"SELECT entity_id, batch, seq, alias FROM ({SQL_ENTITY_LOG})")
def entity_upsert_aliases(spark, d):
    """Every alias of every entity, in the order in which they came."""
    return E.aliases(entity_log(spark, d))


@query("entity_upsert_distinct", f"""
SELECT entity_id, batch, seq, alias FROM (
  SELECT *, row_number() OVER (PARTITION BY entity_id, alias ORDER BY batch, seq) AS copy FROM ({SQL_ENTITY_LOG})) WHERE copy = 1""")
def entity_upsert_distinct(spark, d):
    return E.aliases(entity_log(spark, d), distinct=True)


@query("event_entity_link", """
WITH e AS (SELECT DISTINCT l_orderkey AS event_id, p_brand || '/' || p_type AS entity_id, l_returnflag = 'R' AS old
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT DISTINCT event_id, entity_id FROM e WHERE NOT old
  AND (event_id, entity_id) NOT IN (SELECT (event_id, entity_id) FROM e WHERE old)""")
def event_entity_link(spark, d):
    part = V.load(spark, d, "part").select("p_partkey", F.concat_ws("/", "p_brand", "p_type").alias("entity_id"))
    edges = V.load(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("event_id"), "entity_id", "l_returnflag"
    )
    old = edges.filter("l_returnflag = 'R'").select("event_id", "entity_id")
    return I.new_edges(old, edges.filter("l_returnflag <> 'R'").select("event_id", "entity_id"), ["event_id", "entity_id"])


def _parents(spark, d):
    stored = V.load(spark, d, "customer").filter("c_acctbal >= 1000").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("label")
    )
    batch = V.load(spark, d, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("label"), F.col("o_orderkey").alias("seq")
    )
    return stored, batch


SQL_UPSERT = """
WITH old AS (SELECT c_custkey AS key, c_mktsegment AS label FROM customer WHERE c_acctbal >= 1000),
new AS (SELECT o_custkey AS key, max_by(o_orderpriority, o_orderkey) AS label, count(*) AS n FROM orders GROUP BY 1)
SELECT key, coalesce(new.label, old.label) AS label,
  CASE WHEN new.key IS NULL THEN 'kept' WHEN old.key IS NULL THEN 'inserted' ELSE 'updated' END AS action,
  CASE WHEN new.key IS NOT NULL AND old.key IS NULL THEN 1::BIGINT ELSE 0::BIGINT END AS inserted,
  CASE WHEN new.key IS NULL THEN 0::BIGINT WHEN old.key IS NULL THEN n - 1 ELSE n END AS updated
FROM old FULL JOIN new USING (key)"""


@query("upsert_parent", SQL_UPSERT)
def upsert_parent(spark, d):
    return I.upsert(*_parents(spark, d), key="key", order="seq")


@query("run_log", f"""
SELECT 'customer_load' AS job, (SELECT count(*) FROM orders) AS records_fetched,
  CAST(sum(inserted) AS BIGINT) AS records_inserted, CAST(sum(updated) AS BIGINT) AS records_updated,
  0::BIGINT AS records_skipped, 'completed' AS status, CAST(NULL AS VARCHAR) AS error, TRUE AS in_order FROM ({SQL_UPSERT})""")
def run_log(spark, d):
    actions = I.upsert(*_parents(spark, d), key="key", order="seq")
    counted = actions.select(
        (F.col("inserted") + F.col("updated")).alias("fetched"), "inserted", "updated",
        F.lit(0).cast("bigint").alias("skipped"),
    )
    log = I.run_log(counted, job="customer_load", started=F.current_timestamp())
    return log.withColumn("in_order", F.col("started_at") <= F.col("finished_at")).drop("started_at", "finished_at")


@query("replace_children", """
WITH kept AS (SELECT l_orderkey AS parent, l_linenumber AS code, l_partkey AS name FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')),
fresh AS (SELECT l_orderkey AS parent, l_linenumber AS code, min(l_suppkey) AS name FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P' GROUP BY 1, 2)
SELECT * FROM kept UNION ALL SELECT * FROM fresh""")
def replace_children(spark, d):
    line = V.load(spark, d, "lineitem")
    touched = V.load(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("parent"))
    key = [F.col("l_orderkey").alias("parent"), F.col("l_linenumber").alias("code")]
    stored = line.select(*key, F.col("l_partkey").alias("name"))
    fresh = line.select(*key, F.col("l_suppkey").alias("name")).join(touched.hint("shuffle_hash"), "parent", "left_semi")
    return I.replace_children(stored, fresh, touched, "parent", ["parent", "code"], ["name"])


def forecast_log(spark, d):
    return V.load(spark, d, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("series_id"), F.col("ts").alias("created_at"),
        F.lit(12).alias("horizon"), F.col("value").alias("latency_ms"), F.lit("v1.0").alias("model_ver"),
    )


@query("forecast_log", """
SELECT event_id AS id, event_type AS series_id, ts AS created_at, 12 AS horizon, value AS latency_ms,
  'v1.0' AS model_ver FROM events""")
def forecast_log_append(spark, d):
    path = work_dir(spark, "forecasts")
    log = forecast_log(spark, d)
    log.filter("series_id <> 'view'").write.mode("append").parquet(path)
    log.filter("series_id = 'view'").write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query("forecast_history", """
SELECT id, series_id, created_at, horizon, latency_ms FROM (
  SELECT event_id AS id, event_type AS series_id, ts AS created_at, 12 AS horizon, value AS latency_ms,
    row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn <= 20""")
def forecast_history(spark, d):
    return I.forecast_history(forecast_log(spark, d)).select("id", "series_id", "created_at", "horizon", "latency_ms")


@query("snapshot_audit", """
WITH old AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS p FROM orders WHERE o_orderpriority <> '5-LOW'),
new AS (SELECT o_orderkey AS k, CASE WHEN o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS s,
  o_orderpriority AS p FROM orders WHERE o_orderstatus <> 'P')
SELECT CASE WHEN old.k IS NULL THEN 'INSERT' WHEN new.k IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action,
  CAST(coalesce(old.k, new.k) AS VARCHAR) AS row_id,
  CASE WHEN old.k IS NOT NULL THEN CAST(json_object('k', old.k, 's', old.s, 'p', old.p) AS VARCHAR) END AS old_values,
  CASE WHEN new.k IS NOT NULL THEN CAST(json_object('k', new.k, 's', new.s, 'p', new.p) AS VARCHAR) END AS new_values
FROM old FULL JOIN new ON old.k = new.k WHERE old.k IS NULL OR new.k IS NULL OR old.s <> new.s""")
def snapshot_audit(spark, d):
    orders = V.load(spark, d, "orders")
    cols = [F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p")]
    old = orders.filter("o_orderpriority <> '5-LOW'").select(*cols)
    new = orders.filter("o_orderstatus <> 'P'").select(*cols)
    new = new.withColumn("s", F.when(F.col("p") == "1-URGENT", "F").otherwise(F.col("s")))
    return I.snapshot_audit(old, new, "k")


@query("monthly_partition_layout", """
SELECT strftime(o_orderdate, '%Y-%m') AS event_month, count(*) AS events, min(o_orderdate) AS first_seen
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1""")
def monthly_partition_layout(spark, d):
    path = work_dir(spark, "monthly")
    layout.write_monthly(V.intel_events(spark, d), path)
    return layout.read_months(spark, path, since="1998-01").groupBy("event_month").agg(
        F.count(F.lit(1)).alias("events"), F.min("occurred_at").alias("first_seen")
    )


@query("clustered_layout", V.with_views("""
SELECT source_id, threat_tier, count(*) AS events, max(occurred_at) AS last_seen FROM intel_base GROUP BY 1, 2
""", "intel_base"))
def clustered_layout(spark, d):
    path = work_dir(spark, "clustered")
    layout.write_clustered(
        V.intel_events(spark, d), path, ["source_id", "threat_tier"], [F.desc("occurred_at")]
    )
    return spark.read.parquet(path).groupBy("source_id", "threat_tier").agg(
        F.count(F.lit(1)).alias("events"), F.max("occurred_at").alias("last_seen")
    )


@query("retention_filter", V.with_views(f"""
SELECT event_id, occurred_at FROM intel_base
WHERE occurred_at >= date_trunc('month', TIMESTAMP '{V.AS_OF}' - INTERVAL 2 YEAR)""", "intel_base"))
def retention_filter(spark, d):
    return layout.retained(V.intel_events(spark, d), V.as_of()).select("event_id", "occurred_at")


@query("action_audit_check", V.with_views("""
SELECT 'service' AS analyst_id, 'EXPORT' AS action, 'intel_events' AS resource_type, count(*) AS row_count, TRUE AS timed FROM intel_base""", "intel_base"))
def action_audit_check(spark, d):
    return action_audit(spark, d).select(
        "analyst_id", "action", "resource_type", "row_count", (F.col("duration_ms") >= 0).alias("timed"))


@query("action_audit")
def action_audit(spark, d):
    return audited(V.intel_events(spark, d), action="EXPORT", resource="intel_events", path=work_dir(spark, "export"))
