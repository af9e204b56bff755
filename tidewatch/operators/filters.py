"""Row filters: access rules, optional parameters and text search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.schema import CLASSIFICATIONS, ordinal


def optional_filters(
    df: DataFrame,
    *,
    kinds: Sequence[str] | None = None,
    min_time: Column | None = None,
    max_time: Column | None = None,
    kind: str = "int_type",
    time: str = "event_time",
) -> DataFrame:
    """Apply only the filters that are given."""
    if kinds is not None:
        df = df.filter(F.col(kind).isin(*kinds))
    if min_time is not None:
        df = df.filter(F.col(time) >= min_time)
    if max_time is not None:
        df = df.filter(F.col(time) <= max_time)
    return df


def event_list(
    events: DataFrame,
    *,
    source_type: str | None = None,
    threat_tier: str | None = None,
    limit: int = 20,
    tie: str = "event_id",
) -> DataFrame:
    """Newest events of a type and tier, compared without case."""
    if not 1 <= limit <= 100:
        raise ValueError("limit must be within 1..100")
    for column, wanted in (("source_type", source_type), ("threat_tier", threat_tier)):
        if wanted is not None:
            events = events.filter(F.lower(column) == wanted.lower())
    return events.orderBy(F.desc("ingested_at"), tie).limit(limit)


def like_search(events: DataFrame, *, vessel: str | None = None, keyword: str | None = None) -> DataFrame:
    """Substring search; ``%`` and ``_`` in the term keep their LIKE meaning, a backslash stands for itself."""
    for column, term in (("vessel", vessel), ("description", keyword)):
        if term:
            events = events.filter(F.col(column).ilike("%" + term.replace("\\", "\\\\") + "%"))
    return events.orderBy("sequence")


def multi_column_contains(df: DataFrame, term: str, columns: Sequence[str]) -> DataFrame:
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.lower(F.col(c)).contains(term.lower())
    return df.filter(hit)


def point_lookup(df: DataFrame, key: str, value: object) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def clearance_filter(
    events: DataFrame,
    analysts: DataFrame,
    analyst_id: object,
    *,
    role: str = "analyst",
    vocabulary: Sequence[str] = CLASSIFICATIONS,
) -> DataFrame:
    """Events at or below the analyst's clearance; none for an unknown analyst.

    The service role bypasses the rule.
    """
    if role == "service":
        return events
    allowed = analysts.filter(F.col("analyst_id") == F.lit(analyst_id)).agg(
        F.max(ordinal(F.col("clearance_level"), vocabulary))
    ).scalar()
    return events.filter(ordinal(F.col("classification"), vocabulary) <= allowed)


def updatable_filter(
    events: DataFrame, analysts: DataFrame, analyst_id: object, vocabulary: Sequence[str] = CLASSIFICATIONS
) -> DataFrame:
    own = events.filter((F.col("analyst_id") == F.lit(analyst_id)) & (F.col("status") != "CLOSED"))
    return clearance_filter(own, analysts, analyst_id, vocabulary=vocabulary)


def visible_counts(events: DataFrame, analysts: DataFrame, vocabulary: Sequence[str] = CLASSIFICATIONS) -> DataFrame:
    """How many events each analyst may read, from one count per classification.

    The levels are exploded from the vocabulary, so the join stays an equi-join.
    """
    per_level = events.groupBy("classification").agg(F.count(F.lit(1)).alias("n"))
    rank = ordinal(F.col("clearance_level"), vocabulary)
    readable = F.slice(F.array(*[F.lit(v) for v in vocabulary]), F.lit(1), F.coalesce(rank, F.lit(0)).cast("int"))
    return (
        analysts.select("analyst_id", F.explode_outer(readable).alias("classification"))
        .join(per_level, "classification", "left")
        .groupBy("analyst_id")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("visible_events"))
    )


def alias_lookup(aliases: DataFrame, alias: str, keys: Sequence[str] = ("name", "entity_type")) -> DataFrame:
    """Entities that carry an alias, from one row per alias; no alias list is built."""
    return aliases.filter(F.col("alias") == alias).select(*keys).distinct()


def open_events() -> Column:
    return F.col("status") != "CLOSED"


def has_geo() -> Column:
    return F.col("geo_lat").isNotNull()


def awaiting() -> Column:
    return F.col("status") == "INGESTED"


def audited_action() -> Column:
    return F.col("action").isin("EXPORT", "DELETE")


def status_queue(events: DataFrame, tie: str = "event_id") -> DataFrame:
    return events.filter(awaiting()).orderBy("ingested_at", tie)


def trigrams(text: Column) -> Column:
    """Distinct three-letter windows of every word, padded with two spaces before and one after."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(
        padded, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, F.lit(3)))
    )
    return F.array_distinct(F.flatten(grams))


def _rare_first(side: DataFrame, key: str, frequency: DataFrame, threshold: float) -> DataFrame:
    """``(key, size, gram)``: the rarest grams of every name, as many as a similar name must share one of."""
    rows = side.select(key, F.size("_grams").alias("_size"), F.explode("_grams").alias("_gram")).join(frequency, "_gram")
    ordered = rows.groupBy(key, "_size").agg(F.array_sort(F.collect_list(F.struct("_n", "_gram"))).alias("_by_rarity"))
    needed = (F.col("_size") - F.ceil(F.col("_size") * threshold - 1e-9) + 1).cast("int")
    return ordered.select(key, "_size", F.explode(F.slice("_by_rarity", F.lit(1), needed)).alias("_g")).select(
        key, "_size", F.col("_g._gram").alias("_gram"))


def trigram_candidates(left: DataFrame, right: DataFrame, name: str, term: str, threshold: float) -> DataFrame:
    """Pairs of ``left`` (name, _grams) and ``right`` (term, _grams) that can reach the threshold.

    Two such sets share one of the rarest grams of each, and neither is too short
    for the other. So common grams, which nearly all names have, form no pairs.
    """
    grams = left.select(F.explode("_grams").alias("_gram")).union(right.select(F.explode("_grams")))
    frequency = grams.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    a = _rare_first(left, name, frequency, threshold)
    b = _rare_first(right, term, frequency, threshold).withColumnRenamed("_size", "_other")
    shorter, longer = F.least("_size", "_other"), F.greatest("_size", "_other")
    return a.join(b, "_gram").filter(shorter >= longer * threshold - 1e-9).select(name, term).distinct()


def trigram_match(names: DataFrame, terms: DataFrame, name: str, term: str, threshold: float = 0.3) -> DataFrame:
    """Names similar to each search term by trigram Jaccard similarity, for a threshold above 0.

    Names are first reduced to distinct values. Rare-first prefixes give the
    candidates, and each candidate's sets are compared whole. A name without letters and digits is like none.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    left = names.select(name).distinct().withColumn("_grams", trigrams(F.col(name)))
    right = terms.select(term).distinct().withColumn("_grams", trigrams(F.col(term)))
    pairs = trigram_candidates(left, right, name, term, threshold)
    both = pairs.join(left, name).join(right.withColumnRenamed("_grams", "_wanted"), term)
    shared = F.size(F.array_intersect("_grams", "_wanted"))
    score = shared / (F.size("_grams") + F.size("_wanted") - shared)
    return both.select(name, term, score.alias("similarity")).filter(F.col("similarity") >= threshold)
