"""Dashboards, correlation, density and audit reports over the event model.

Events are always aggregated by their own key before they meet a dimension, so a
source or analyst that owns a large share of all events costs no shuffle of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewatch.functions.scalar import count_where, exact_round, safe_ratio, seconds_between, since, time_bucket
from tidewatch.operators.ordering import exact_quantiles, rank_map, with_rank
from tidewatch.operators.pairs import pair_rows, top_pairs
from tidewatch.session import materialize
from tidewatch.schema import CLASSIFICATIONS, HIGH_TIERS, ordinal



def source_dashboard(
    sources: DataFrame, events: DataFrame, *, as_of: Column, lookback: str = "30 days", limit: int = 20
) -> DataFrame:
    resolution = seconds_between(F.col("resolved_at"), F.col("ingested_at"))
    per_source = (
        events.filter(since(F.col("occurred_at"), as_of, lookback))
        .groupBy("source_id")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            count_where(F.col("threat_tier") == "CRITICAL").alias("critical_count"),
            count_where(F.col("threat_tier") == "HIGH").alias("high_count"),
            count_where(F.col("threat_tier") == "MEDIUM").alias("medium_count"),
            count_where(F.col("status") == "CLOSED").alias("closed_count"),
            (F.avg(resolution) / 3600).alias("avg_resolution"),
        )
    )
    stats = materialize(sources.filter("is_active").join(per_source, "source_id"), "source-stats")
    order = [F.desc("total_events"), F.asc("source_id")]
    top = stats.orderBy(*order).limit(limit)
    # Rows above a top-k row in the sort are in the top k too, so its own rank needs no other rows.
    top = top.withColumn("volume_rank", F.rank().over(W.orderBy(F.desc("total_events"))).cast("bigint"))
    return (
        top.join(rank_map(stats, "critical_count", "criticality_rank"), "critical_count")
        .orderBy(*order)
        .select(
            "source_name", "source_type", "reliability", "total_events", "critical_count", "high_count",
            "medium_count",
            exact_round(F.col("avg_resolution"), 1).alias("avg_resolution_hrs"),
            exact_round(safe_ratio(F.col("closed_count") * 100.0, F.col("total_events")), 1).alias("pct_closed"),
            "volume_rank", "criticality_rank",
        )
    )


def _exceeds(value: Column, limit: Column, compare: str) -> Column:
    if compare == "lexical":
        return value > limit
    if compare == "ordinal":
        return ordinal(value, CLASSIFICATIONS) > ordinal(limit, CLASSIFICATIONS)
    raise ValueError(f"compare must be 'ordinal' or 'lexical', not {compare!r}")


def analyst_workload(
    analysts: DataFrame, events: DataFrame, *, as_of: Column, recent: str = "7 days", compare: str = "ordinal"
) -> DataFrame:
    open_ = F.col("status") != "CLOSED"
    owned = events.filter(F.col("analyst_id").isNotNull())
    per_level = owned.groupBy("analyst_id", "classification").agg(
        count_where(open_).alias("open_events"),
        count_where((F.col("status") == "CLOSED") & since(F.col("occurred_at"), as_of, recent)).alias("closed_recent"),
        count_where(open_ & F.col("threat_tier").isin(*HIGH_TIERS)).alias("open_high"),
        F.count(F.lit(1)).alias("n"),
    )
    seconds = owned.select(
        "analyst_id", seconds_between(F.col("resolved_at"), F.col("ingested_at")).alias("secs")
    )
    quantiles = exact_quantiles(seconds, ["analyst_id"], "secs", {"q50": 0.5, "q95": 0.95})
    active = analysts.filter("is_active").select("analyst_id", "display_name", "clearance_level")
    over = _exceeds(F.col("classification"), F.col("clearance_level"), compare)
    counted = (
        active.join(per_level, "analyst_id", "left")
        .groupBy("analyst_id", "display_name", "clearance_level")
        .agg(
            F.coalesce(F.sum("open_events"), F.lit(0)).alias("open_events"),
            F.coalesce(F.sum("closed_recent"), F.lit(0)).alias("closed_last_7d"),
            F.coalesce(F.sum("open_high"), F.lit(0)).alias("open_high_critical"),
            F.coalesce(F.sum(F.when(over, F.col("n"))), F.lit(0)).alias("clearance_violations"),
        )
    )
    return (
        counted.join(quantiles, "analyst_id", "left")
        .orderBy(F.desc("open_high_critical"), F.desc("open_events"), "analyst_id")
        .select(
            F.col("display_name").alias("analyst"), "clearance_level", "open_events", "closed_last_7d",
            "open_high_critical",
            (F.col("q50") / 3600).alias("median_resolution_hrs"),
            (F.col("q95") / 3600).alias("p95_resolution_hrs"),
            "clearance_violations",
        )
    )


def _linked(event_entities: DataFrame, events: DataFrame, keys: Sequence[str]) -> DataFrame:
    edges = event_entities.select(*keys, "entity_id").dropDuplicates()
    return edges.join(events, list(keys))


def _named_pairs(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    named = entities.select("entity_id", "canonical_name", "entity_type")
    a = named.toDF("item_a", "entity_a", "type_a")
    b = named.toDF("item_b", "entity_b", "type_b")
    return pairs.join(a, "item_a").join(b, "item_b")


def entity_correlation(
    event_entities: DataFrame,
    entities: DataFrame,
    events: DataFrame,
    *,
    as_of: Column,
    lookback: str = "90 days",
    min_sources: int = 2,
    limit: int = 50,
    event_keys: Sequence[str] = ("event_id",),
) -> DataFrame:
    recent = events.filter(since(F.col("occurred_at"), as_of, lookback)).select(
        *{*event_keys, "event_id", "occurred_at", "source_id", "threat_tier"}
    )
    edges = materialize(_linked(event_entities, recent, event_keys), "edges")

    def stats(edges: DataFrame) -> DataFrame:
        rows = pair_rows(edges, "event_id", "entity_id", ["occurred_at", "source_id", "threat_tier"])
        per_source = rows.groupBy("item_a", "item_b", "source_id").agg(
            F.count(F.lit(1)).alias("n"),
            count_where(F.col("threat_tier").isin(*HIGH_TIERS)).alias("high"),
            F.max("occurred_at").alias("latest"),
        )
        return per_source.groupBy("item_a", "item_b").agg(
            F.sum("n").alias("shared_events"),
            F.count(F.lit(1)).alias("corroborating_sources"),
            F.sum("high").alias("high_threat_events"),
            F.max("latest").alias("most_recent"),
        )

    bounds = {"corroborating_sources": F.count_distinct("source_id"), "shared_events": F.count(F.lit(1))}
    top = (
        top_pairs(edges, "entity_id", bounds, stats, limit, {"corroborating_sources": min_sources})
        .orderBy(F.desc("corroborating_sources"), F.desc("shared_events"), "item_a", "item_b")
        .limit(limit)
    )
    confidence = (1 - F.exp(F.col("corroborating_sources") * -0.7)) * (1 - F.exp(F.col("shared_events") * -0.3))
    return _named_pairs(top, entities).select(
        "entity_a", "entity_b", "type_a", "type_b", "shared_events", "corroborating_sources",
        "high_threat_events", "most_recent", exact_round(confidence, 4).alias("correlation_confidence"),
    )


def threat_density_timeseries(
    events: DataFrame, *, as_of: Column, lookback: str = "7 days", bucket: str = "hour", frame_rows: int = 24
) -> DataFrame:
    """The windows run over one row per bucket, whatever the number of events."""
    pivoted = (
        events.filter(since(F.col("occurred_at"), as_of, lookback))
        .groupBy(time_bucket(F.col("occurred_at"), bucket).alias("bucket"))
        .agg(
            *[count_where(F.col("threat_tier") == t).alias(t.lower()) for t in ("CRITICAL", "HIGH", "MEDIUM", "LOW")],
            F.count(F.lit(1)).alias("total"),
        )
    )
    by_time = W.orderBy("bucket")
    previous = F.lag("total").over(by_time)
    overall = pivoted.agg(F.struct(F.avg("total").alias("mean"), F.stddev_samp("total").alias("std"))).scalar()
    return (
        pivoted.withColumn("_all", overall)
        .select(
            "bucket", "critical", "high", "medium", "low", "total",
            F.sum("total").over(by_time.rowsBetween(1 - frame_rows, 0)).alias("rolling_24h_total"),
            safe_ratio(F.col("total") - F.col("_all.mean"), F.col("_all.std")).alias("z_score"),
            exact_round(safe_ratio((F.col("total") - previous) * 100.0, previous), 1).alias("pct_change_vs_prior_hour"),
        )
        .orderBy(F.desc("bucket"))
    )


_CELL = ["lat_grid", "lon_grid", "geo_region"]


def geo_cell_sources(events: DataFrame, *, as_of: Column, lookback: str = "30 days") -> DataFrame:
    """What each source reported in each cell: a row per cell and source, so a crowded cell is spread over its sources."""
    located = events.filter(
        F.col("geo_lat").isNotNull() & F.col("geo_lon").isNotNull() & since(F.col("occurred_at"), as_of, lookback)
    )
    return located.groupBy(
        F.floor("geo_lat").alias("lat_grid"), F.floor("geo_lon").alias("lon_grid"), "geo_region", "source_id"
    ).agg(
        F.count(F.lit(1)).alias("events"),
        count_where(F.col("threat_tier") == "CRITICAL").alias("critical"),
        count_where(F.col("threat_tier") == "HIGH").alias("high"),
        F.sum(F.col("geo_lat").cast("decimal(18,6)")).alias("lat"),
        F.sum(F.col("geo_lon").cast("decimal(18,6)")).alias("lon"),
        F.min("occurred_at").alias("first_seen"),
        F.max("occurred_at").alias("last_seen"),
    )


def geo_cells(per_source: DataFrame, *, min_high: int = 3) -> DataFrame:
    """Cells with enough grave events, from the rows of :func:`geo_cell_sources`; the sources stay in that table."""
    return (
        per_source.groupBy(*_CELL)
        .agg(
            F.sum("events").alias("total_events"), F.sum("critical").alias("critical"), F.sum("high").alias("high"),
            F.count_if(F.col("critical") + F.col("high") > 0).alias("n_high_sources"),
            F.sum("lat").alias("lat"), F.sum("lon").alias("lon"),
            F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        )
        .filter(F.col("critical") + F.col("high") >= min_high)
        .select(
            *_CELL, "total_events", "critical", "high", "n_high_sources",
            exact_round(F.col("lat") / F.col("total_events"), 4).alias("centroid_lat"),
            exact_round(F.col("lon") / F.col("total_events"), 4).alias("centroid_lon"),
            "first_seen", "last_seen",
        )
    )


def geo_clusters(
    events: DataFrame, *, as_of: Column, lookback: str = "30 days", min_high: int = 3
) -> DataFrame:
    """The cells' report, with the list of each cell's sources of grave events.

    The list is part of the report and as long as the cell has such sources; where that may be
    very many, take :func:`geo_cells` and read the sources from :func:`geo_cell_sources`.
    """
    per_source = geo_cell_sources(events, as_of=as_of, lookback=lookback)
    grave = per_source.filter(F.col("critical") + F.col("high") > 0).groupBy(*_CELL).agg(
        F.sort_array(F.collect_list(F.col("source_id").cast("string"))).alias("high_threat_sources"))
    return geo_cells(per_source, min_high=min_high).drop("n_high_sources").join(grave, _CELL).orderBy(
        F.desc("critical"), F.desc("total_events"), *_CELL)


def audit_trail(
    audit_log: DataFrame,
    analysts: DataFrame,
    *,
    as_of: Column,
    lookback: str = "90 days",
    actions: Sequence[str] = ("EXPORT", "DELETE"),
    compare: str = "ordinal",
) -> DataFrame:
    clearance = F.col("clearance_level")
    over = F.lit(False)
    for side in ("old_values", "new_values"):
        label = F.get_json_object(side, "$.classification")
        over = over | F.coalesce(_exceeds(label, clearance, compare), F.lit(False))
    return (
        audit_log.filter(F.col("action").isin(*actions) & since(F.col("logged_at"), as_of, lookback))
        .join(analysts.select("analyst_id", "display_name", "clearance_level"), "analyst_id")
        .select(
            F.col("logged_at").alias("logged_utc"), F.col("display_name").alias("analyst"), "clearance_level",
            "action", "table_name", "row_id", "ip_address", "session_id", over.alias("potential_over_access"),
        )
        .orderBy(F.desc("logged_utc"), "row_id")
    )


def analyst_throughput(
    analysts: DataFrame, events: DataFrame, *, as_of: Column, lookback: str = "30 days"
) -> DataFrame:
    recent = events.filter(
        since(F.col("event_time"), as_of, lookback) & F.col("assigned_analyst").isNotNull()
    ).withColumn("secs", seconds_between(F.col("actioned_at"), F.col("assigned_at")))
    counted = recent.groupBy("assigned_analyst").agg(
        F.count(F.lit(1)).alias("events_reviewed_30d"),
        count_where(F.col("threat_tier") == "CRITICAL").alias("critical_events"),
        count_where(F.col("status") == "ACTIONED").alias("actioned_count"),
        F.avg("secs").alias("avg_secs"),
    )
    median = exact_quantiles(recent, ["assigned_analyst"], "secs", {"median_secs": 0.5})
    stats = analysts.join(counted, analysts.analyst_id == F.col("assigned_analyst")).join(
        median, "assigned_analyst", "left"
    )
    return (
        with_rank(stats, "events_reviewed_30d", "throughput_rank")
        .select(
            "analyst_id", "username", "clearance_level", "events_reviewed_30d", "critical_events",
            "actioned_count",
            exact_round(F.col("avg_secs") / 60, 1).alias("avg_response_min"),
            (F.col("median_secs") / 60).alias("median_response_min"),
            "throughput_rank",
        )
        .orderBy(F.desc("events_reviewed_30d"), "analyst_id")
    )


def entity_network(
    event_entities: DataFrame,
    entities: DataFrame,
    events: DataFrame,
    *,
    as_of: Column,
    lookback: str = "30 days",
    min_shared: int = 3,
    limit: int = 50,
    tiers: Sequence[str] = HIGH_TIERS,
) -> DataFrame:
    """Pairs by shared events with the Jaccard similarity of their *names*.

    A name may carry several types, so union and intersection are counted per
    name; only names of pairs that can reach the top ``limit`` are looked at, and
    their events need no pairs beyond those names.
    """
    recent = events.filter(since(F.col("occurred_at"), as_of, lookback) & F.col("threat_tier").isin(*tiers)).select(
        "event_id", "occurred_at", "int_type", "threat_tier"
    )
    linked = materialize(_linked(event_entities, recent, ["event_id"]), "edges")

    def stats(edges: DataFrame) -> DataFrame:
        rows = pair_rows(edges, "event_id", "entity_id", ["occurred_at", "int_type", "threat_tier"])
        return rows.groupBy("item_a", "item_b").agg(
            F.count(F.lit(1)).alias("shared_events"),
            F.min("occurred_at").alias("first_seen"),
            F.max("occurred_at").alias("last_seen"),
            F.sort_array(F.collect_set("int_type")).alias("source_types"),
            F.sort_array(F.collect_set("threat_tier")).alias("threat_tiers"),
        )

    bounds = {"shared_events": F.count(F.lit(1))}
    shared = top_pairs(linked, "entity_id", bounds, stats, limit, {"shared_events": min_shared})
    shared = materialize(shared, "pairs")
    floor = shared.select("shared_events").orderBy(F.desc("shared_events")).limit(limit)
    floor = floor.agg(F.min("shared_events")).scalar()
    candidates = materialize(_named_pairs(shared.filter(F.col("shared_events") >= floor), entities), "candidates")

    names = candidates.select(F.explode(F.array("entity_a", "entity_b")).alias("canonical_name")).distinct()
    by_name = (
        linked.join(entities.select("entity_id", "canonical_name"), "entity_id")
        .select("event_id", "canonical_name").distinct()
        .join(names, "canonical_name", "left_semi")
    )
    sizes = by_name.groupBy("canonical_name").agg(F.count(F.lit(1)).alias("n"))
    both = (
        pair_rows(by_name, "event_id", "canonical_name", [])
        .groupBy(F.col("item_a").alias("name_lo"), F.col("item_b").alias("name_hi"))
        .agg(F.count(F.lit(1)).alias("n_both"))
    )
    a, b = F.col("entity_a"), F.col("entity_b")
    union = F.when(a == b, F.col("n_a")).otherwise(F.col("n_a") + F.col("n_b") - F.coalesce("n_both", F.lit(0)))
    return (
        candidates.withColumn("name_lo", F.least(a, b)).withColumn("name_hi", F.greatest(a, b))
        .join(both, ["name_lo", "name_hi"], "left")
        .join(sizes.toDF("entity_a", "n_a"), "entity_a")
        .join(sizes.toDF("entity_b", "n_b"), "entity_b")
        .withColumn("jaccard_similarity", exact_round(safe_ratio(F.col("shared_events"), union), 4))
        .orderBy(F.desc("shared_events"), F.desc("jaccard_similarity"), "item_a", "item_b")
        .limit(limit)
        .select(
            "entity_a", "entity_b", "type_a", "type_b", "shared_events", "jaccard_similarity",
            "first_seen", "last_seen", "source_types", "threat_tiers",
        )
    )


def source_reliability(
    sources: DataFrame, events: DataFrame, *, as_of: Column, lookback: str = "90 days"
) -> DataFrame:
    per_source = (
        events.filter(since(F.col("event_time"), as_of, lookback))
        .groupBy("source_id")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count("corroborated_by").alias("corroborated_events"),
            count_where(F.col("status") == "REFUTED").alias("refuted_events"),
            F.avg("confidence_score").alias("avg_conf"),
            F.max("event_time").alias("last_report_time"),
        )
    )
    share = safe_ratio(F.col("corroborated_events").cast("double"), F.col("total_events"))
    grade = (
        F.when((share > 0.8) & (F.col("refuted_events") < 5), "A")
        .when(share > 0.6, "B")
        .when(F.col("refuted_events") > F.col("total_events") * 0.3, "D")
        .otherwise("C")
    )
    return (
        sources.join(per_source, "source_id")
        .select(
            "source_name", "source_type", "total_events", "corroborated_events", "refuted_events",
            exact_round(share * 100, 1).alias("corroboration_pct"),
            exact_round(F.col("avg_conf"), 3).alias("avg_confidence"),
            grade.alias("reliability_grade"),
            "last_report_time",
        )
        .orderBy(F.desc("corroboration_pct"), F.desc("total_events"), "source_name")
    )


def threat_density_anomaly(
    events: DataFrame,
    *,
    as_of: Column,
    lookback: str = "7 days",
    frame_rows: int = 169,
    min_z: float = 2.0,
    limit: int = 100,
) -> DataFrame:
    hourly = (
        events.filter(since(F.col("event_time"), as_of, lookback))
        .groupBy(time_bucket(F.col("event_time")).alias("bucket"), "source_id", "int_type", "threat_tier")
        .agg(F.count(F.lit(1)).alias("event_count"))
    )
    ordered = W.partitionBy("source_id").orderBy("bucket", "int_type", "threat_tier")
    frame = ordered.rowsBetween(1 - frame_rows, 0)
    std = F.col("std")
    z = F.when(std > 0, (F.col("event_count") - F.col("mean")) / std).otherwise(0.0)
    scored = (
        hourly.withColumn("mean", F.avg("event_count").over(frame))
        .withColumn("std", F.stddev_samp("event_count").over(frame))
        .withColumn("previous", F.lag("event_count").over(ordered))
        .withColumn("z", exact_round(z, 8))
        .filter(F.col("z") > min_z)
    )
    level = (
        F.when(F.col("z") > 3, "CRITICAL_SPIKE")
        .when(F.col("z") > 2, "HIGH_ANOMALY")
        .when(F.col("z") > 1, "ELEVATED")
        .otherwise("NORMAL")
    )
    return (
        scored.orderBy(F.desc("z"), F.desc("bucket"), "source_id", "int_type", "threat_tier")
        .limit(limit)
        .select(
            "bucket", "source_id", "int_type", "threat_tier", "event_count",
            exact_round(F.col("mean"), 1).alias("rolling_avg"),
            exact_round(F.col("z"), 2).alias("z_score"),
            (F.col("event_count") - F.col("previous")).alias("delta_vs_prev_hour"),
            level.alias("anomaly_level"),
        )
    )


def hourly_threat_stats(events: DataFrame, *, bucket: str = "hour") -> DataFrame:
    return events.groupBy(time_bucket(F.col("occurred_at"), bucket).alias("bucket"), "source_id", "threat_tier").agg(
        F.count(F.lit(1)).alias("event_count"),
        count_where(F.col("status") == "CLOSED").alias("closed_count"),
    )
