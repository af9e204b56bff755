"""Validation, exact de-duplication, upserts and snapshot audit."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewatch.functions import text as X
from tidewatch.operators.ordering import with_row_number
from tidewatch.schema import API_CLASSIFICATIONS, API_SOURCE_TYPES


def reject_reason(shortest: int = 10) -> Column:
    """Why a raw event is refused, or NULL; the first failing rule wins."""
    stripped = F.coalesce(F.length(X.strip(F.col("raw_text"))), F.lit(0))
    return (
        F.when(stripped < shortest, "text shorter than the minimum")
        .when(F.coalesce(F.col("source_id"), F.lit("")) == "", "no source given")
        .when(F.col("received_at").isNull(), "no usable receive time")
    )


def validate_raw_events(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into accepted rows and a quarantine with ``reject_reason``."""
    checked = raw.withColumn("reject_reason", reject_reason())
    return checked.filter("reject_reason IS NULL").drop("reject_reason"), checked.filter("reject_reason IS NOT NULL")


def contract_violations(
    source_types: Sequence[str] = API_SOURCE_TYPES,
    classifications: Sequence[str] = API_CLASSIFICATIONS,
    longest: int = 32768,
) -> Column:
    """Array of the contract rules an ingest request breaks, in rule order."""
    size = F.length("raw_content")
    lat, lon = F.col("latitude"), F.col("longitude")
    rules = [
        (F.col("source_type").isNull(), "source_type required"),
        (~F.col("source_type").isin(*source_types), "source_type not allowed"),
        (F.col("raw_content").isNull(), "raw_content required"),
        (size < 1, "raw_content too short"),
        (size > longest, "raw_content too long"),
        (F.col("classification_level").isNull(), "classification_level required"),
        (~F.col("classification_level").isin(*classifications), "classification_level not allowed"),
        (~F.col("dtg").rlike(r"^[0-9]{6}[A-Z][0-9A-Za-z_]{3}[0-9]{2}$"), "dtg malformed"),
        ((lat < -90) | (lat > 90), "latitude out of range"),
        ((lon < -180) | (lon > 180), "longitude out of range"),
    ]
    found = F.array(*[F.when(F.coalesce(bad, F.lit(False)), name) for bad, name in rules])
    return F.array_compact(found)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of every key.

    ``row_number() = 1`` is planned with a group limit below the exchange, so a
    key with many copies leaves each task as one row.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def fingerprint_dedup(raw: DataFrame, *, order: Sequence[str], existing: DataFrame | None = None) -> DataFrame:
    """Exact content de-duplication by SHA-256 over source and text."""
    marked = raw.withColumn("fingerprint", X.fingerprint(F.col("source_id"), F.col("raw_text")))
    return without_stored(first_per_key(marked, ["fingerprint"], order), existing, "fingerprint")


def without_stored(batch: DataFrame, stored: DataFrame | None, key: str) -> DataFrame:
    """Batch rows whose key is not stored.

    The store is reduced to the keys of the batch first: a small batch is broadcast
    to the scan of the store's key column, and the store itself is never shuffled.
    """
    if stored is None:
        return batch
    seen = stored.select(key).join(batch.select(key), key, "left_semi")
    return batch.join(seen, key, "left_anti")


def new_edges(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-if-absent: incoming rows whose key is not stored, one per key."""
    return incoming.dropDuplicates(list(keys)).join(existing.select(*keys), list(keys), "left_anti")


def upsert(existing: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """Rows after an update-or-insert with the action taken and the repeats seen.

    The last incoming row of a key wins. ``inserted`` and ``updated`` count the
    incoming records: a new key is one insert, its repeats are updates.
    """
    fields = [c for c in incoming.columns if c not in (key, order)]
    latest = incoming.groupBy(key).agg(
        F.max_by(F.struct(*fields), order).alias("_new"), F.count(F.lit(1)).alias("_records")
    )
    old = existing.select(key, F.struct(*fields).alias("_old"))
    joined = old.join(latest, key, "full")
    is_new, touched = F.col("_old").isNull(), F.col("_new").isNotNull()
    return joined.select(
        key,
        *[F.when(touched, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in fields],
        F.when(~touched, "kept").when(is_new, "inserted").otherwise("updated").alias("action"),
        F.when(touched & is_new, 1).otherwise(0).cast("bigint").alias("inserted"),
        F.when(touched, F.col("_records") - is_new.cast("bigint")).otherwise(0).alias("updated"),
    )


def replace_children(existing: DataFrame, incoming: DataFrame, touched: DataFrame, parent: str,
                     key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Drop every child of a touched parent, then add the new set, first row per key.

    A task holds the touched parents of its share, and sorts none of the children that stay.
    """
    kept = existing.join(touched.select(parent).distinct().hint("shuffle_hash"), parent, "left_anti")
    return kept.unionByName(first_per_key(incoming, key, order).select(*existing.columns))


def run_log(actions: DataFrame, *, job: str, started: Column, fetched: str = "fetched", error: str | None = None) -> DataFrame:
    """One-row job record from a DataFrame with fetched/inserted/updated/skipped counters.

    The run ends when the record is made; with an ``error`` its status is ``failed``,
    and ``partial`` where rows were skipped.
    """
    skipped = F.sum("skipped") > 0
    return actions.agg(
        F.lit(job).alias("job"),
        F.sum(fetched).alias("records_fetched"),
        F.sum("inserted").alias("records_inserted"),
        F.sum("updated").alias("records_updated"),
        F.sum("skipped").alias("records_skipped"),
        F.lit("failed").alias("status") if error else F.when(skipped, "partial").otherwise("completed").alias("status"),
        F.lit(error).cast("string").alias("error"),
        started.alias("started_at"),
        F.current_timestamp().alias("finished_at"),
    )


def append_with_sequence(existing: DataFrame, batch: DataFrame, order: str, out: str = "sequence") -> DataFrame:
    """Number an appended batch from ``coalesce(max(sequence), 0) + 1`` on."""
    start = existing.agg(F.coalesce(F.max(out), F.lit(0))).scalar()
    return with_row_number(batch, [], order, out).withColumn(out, F.col(out) + start)


def snapshot_audit(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """INSERT / UPDATE / DELETE rows with before and after images, from two snapshots."""
    def image(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.struct(*df.columns).alias(name))

    both = image(old, "_old").join(image(new, "_new"), key, "full")
    action = (
        F.when(F.col("_old").isNull(), "INSERT")
        .when(F.col("_new").isNull(), "DELETE")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "UPDATE")
    )
    return both.withColumn("action", action).filter("action IS NOT NULL").select(
        "action",
        F.col(key).cast("string").alias("row_id"),
        F.to_json("_old").alias("old_values"),
        F.to_json("_new").alias("new_values"),
    )


def forecast_history(log: DataFrame, limit: int = 20, series_id: str | None = None) -> DataFrame:
    """Latest ``limit`` forecasts, newest first, of one series or of every series."""
    if series_id is not None:
        return log.filter(F.col("series_id") == series_id).orderBy(F.desc("created_at"), "id").limit(limit)
    w = W.partitionBy("series_id").orderBy(F.desc("created_at"), "id")
    return log.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit).drop("_rn")


def latest_submission(submissions: DataFrame, *, shortest: int = 10) -> DataFrame:
    """Series after last-write-wins ingestion of ``(series_id, ingest_ts, step, value)``.

    Submissions shorter than ``shortest`` are refused and never replace a series.
    """
    sizes = submissions.groupBy("series_id", "ingest_ts").agg(F.count(F.lit(1)).alias("_n"))
    last = sizes.filter(F.col("_n") >= shortest).groupBy("series_id").agg(F.max("ingest_ts").alias("ingest_ts"))
    return submissions.join(last, ["series_id", "ingest_ts"], "left_semi")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
