"""Quality rules on whole tables; several of them do find broken rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.scalar import exact_round
from tidewatch.operators import ingest as I, quality as Q
from tidewatch.operators.extract import normalize_countries
from tidewatch.suite import views as V
from tidewatch.suite.ingest import SQL_COUNTRY, country_docs
from tidewatch.suite.registry import query, rnd


def _row_rule_sql(table: str, key: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER ({broken}) AS failed, "
        f"CAST(min(CASE WHEN {broken} THEN {key} END) AS VARCHAR) AS sample FROM {table}"
        for name, broken in rules.items()
    )


@query("dq_row_count", """
SELECT 'row count' AS rule, CASE WHEN count(*) < 20000 THEN 1 ELSE 0 END::BIGINT AS failed,
  CAST(count(*) AS VARCHAR) AS sample FROM orders""")
def dq_row_count(spark, d):
    return Q.row_count(V.load(spark, d, "orders"), 20_000)


@query("dq_required", _row_rule_sql(f"({SQL_COUNTRY})", "cca2", {
    "common_name required": "c_custkey IS NOT NULL AND common_name = '' ", "capital required": "capital IS NULL",
    "region required": "region IS NULL"}))
def dq_required(spark, d):
    docs = country_docs(spark, d).select(
        F.trim("cca2").alias("cca2"), F.col("name.common").alias("common_name"),
        F.try_element_at("capital", F.lit(1)).alias("capital"), "region",
    )
    return Q.expect(docs, Q.required("common_name", "capital", "region"), "cca2")


@query("dq_format", _row_rule_sql("customer", "c_custkey", {
    "c_name format": "NOT regexp_matches(c_name, '^Customer#[0-9]{9}$')",
    "c_mktsegment format": "NOT regexp_matches(c_mktsegment, '^[A-Z]{8,9}$')"}))
def dq_format(spark, d):
    rules = [Q.matches("c_name", "^Customer#[0-9]{9}$"), Q.matches("c_mktsegment", "^[A-Z]{8,9}$")]
    return Q.expect(V.load(spark, d, "customer"), rules, "c_custkey")


@query("dq_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_unique(spark, d):
    return Q.duplicates(V.load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_allowed", _row_rule_sql("orders", "o_orderkey", {
    "o_orderstatus allowed": "o_orderstatus NOT IN ('F', 'O')",
    "o_orderpriority allowed": "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')"}))
def dq_allowed(spark, d):
    rules = [
        Q.allowed("o_orderstatus", ["F", "O"]),
        Q.allowed("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]),
    ]
    return Q.expect(V.load(spark, d, "orders"), rules, "o_orderkey")


@query("dq_group_consistency", """
SELECT n_name, count(*) FILTER (c_mktsegment <> 'BUILDING') AS failed FROM customer JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1 HAVING count(*) FILTER (c_mktsegment <> 'BUILDING') > 0""")
def dq_group_consistency(spark, d):
    rows = V.load(spark, d, "customer").join(V.load(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return Q.group_values(rows.withColumn("want", F.lit("BUILDING")), "n_name", "c_mktsegment", "want")


@query("dq_range", _row_rule_sql("lineitem", "l_orderkey", {
    "l_discount range": "NOT (l_discount BETWEEN 0 AND 0.05)", "l_quantity range": "NOT (l_quantity BETWEEN 1 AND 50)"}))
def dq_range(spark, d):
    rules = [Q.in_range("l_discount", 0, 0.05), Q.in_range("l_quantity", 1, 50)]
    return Q.expect(V.load(spark, d, "lineitem"), rules, "l_orderkey")


@query("dq_top_contains", """
SELECT 'top 2 by n' AS rule, CASE WHEN count(*) FILTER (r_name IN ('ASIA', 'EUROPE')) = 0 THEN 1 ELSE 0 END::BIGINT AS failed,
  CAST(count(*) FILTER (r_name IN ('ASIA', 'EUROPE')) AS VARCHAR) AS sample FROM (
  SELECT r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1 ORDER BY n DESC, r_name LIMIT 2)""")
def dq_top_contains(spark, d):
    places = V.load(spark, d, "nation").join(V.load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    counts = V.load(spark, d, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("r_name").agg(
        F.count(F.lit(1)).alias("n")
    )
    return Q.top_contains(counts, "n", "r_name", ["ASIA", "EUROPE"])


@query("dq_members", """
SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def dq_members(spark, d):
    expected = V.load(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return Q.missing_members(V.load(spark, d, "customer").filter("c_acctbal > 0"), expected, "c_custkey")


@query("dq_non_blank", _row_rule_sql("documents", "doc_id", {
    "text non-blank": "trim(text) = ''", "source non-blank": "trim(source) = ''"}))
def dq_non_blank(spark, d):
    return Q.expect(V.load(spark, d, "documents"), [Q.non_blank("text"), Q.non_blank("source")], "doc_id")


@query("dq_projection", """
SELECT o_custkey AS key, max(o_orderdate) AS latest FROM orders GROUP BY 1""")
def dq_projection(spark, d):
    out = V.load(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.max("o_orderdate").alias("latest"))
    if not Q.projection(out, ["key", "latest"]).isEmpty():
        raise ValueError("projection differs")
    return out


@query("dq_p95", f"""
WITH s AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i,
    0.95::DOUBLE * (count(*) OVER (PARTITION BY event_type) + 1) - 1 AS pos FROM events),
p AS (SELECT event_type, max(CASE WHEN i = floor(pos) THEN value END) AS lo, max(CASE WHEN i = ceil(pos) THEN value END) AS hi,
  max(pos - floor(pos)) AS part FROM s GROUP BY 1)
SELECT event_type, {rnd('lo + (hi - lo) * part', 6)} AS p95, lo + (hi - lo) * part <= 150 AS within FROM p""")
def dq_p95(spark, d):
    out = Q.p95_within(V.load(spark, d, "events"), ["event_type"], "value", 150.0)
    return out.withColumn("p95", exact_round(F.col("p95"), 6))


@query("dq_idempotent", f"""
SELECT count(*) AS loaded, 0::BIGINT AS changed FROM ({SQL_COUNTRY}) WHERE cca3 <> ''""")
def dq_idempotent(spark, d):
    """Load the same documents twice; the second load must change nothing."""
    batch = normalize_countries(country_docs(spark, d)).countries.withColumn("seq", F.lit(0))
    fields = [c for c in batch.columns if c != "seq"]
    once = I.upsert(batch.filter("false").drop("seq"), batch, "cca2", "seq").select(*fields)
    twice = I.upsert(once, batch, "cca2", "seq").select(*fields)
    changed = Q.changed_rows(once, twice, "cca2").agg(F.count(F.lit(1))).scalar()
    return twice.agg(F.count(F.lit(1)).alias("loaded")).withColumn("changed", changed)


@query("dq_ddl_constraints", V.with_views("""
SELECT 'reliability range' AS rule, count(*) FILTER (NOT reliability BETWEEN 1 AND 4) AS failed FROM sources UNION ALL
SELECT 'confidence range', count(*) FILTER (NOT confidence_score BETWEEN 0 AND 0.05) FROM intel_events UNION ALL
SELECT 'source_id reference', count(*) FROM intel_base WHERE source_id NOT IN (SELECT source_id FROM sources WHERE is_active)
""", "sources", "intel_events", "intel_base"))
def dq_ddl_constraints(spark, d):
    sources = V.sources(spark, d)
    reliability = Q.expect(sources, [Q.in_range("reliability", 1, 4)], "source_id")
    confident = V.intel_events(spark, d, lines=True).filter("confidence_score IS NOT NULL")
    confidence = Q.expect(confident.withColumnRenamed("confidence_score", "confidence"), [Q.in_range("confidence", 0, 0.05)], "event_id")
    lost = Q.orphans(V.intel_events(spark, d), sources.filter("is_active"), "source_id", "source_id").agg(
        F.lit("source_id reference").alias("rule"), F.count(F.lit(1)).alias("failed")
    )
    return reliability.unionByName(confidence).drop("sample").unionByName(lost)
