"""Streaming ingestion, de-duplication and hourly statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.functions import text as X
from tidewatch.functions.scalar import computed_once
from tidewatch.functions.vector import text_vector
from tidewatch.operators.entities import entity_id
from tidewatch.operators.extract import UNKNOWN_KIND, normalize_signals, signal_fingerprints
from tidewatch.operators.ingest import first_per_key, validate_raw_events
from tidewatch.schema import STREAM_SOURCE_TYPES
from tidewatch.streaming.store import BatchStore

DEFAULT_CLASSIFICATION = "SECRET"


def write_stream(df: DataFrame, path: str, checkpoint: str, mode: str = "append", continuous: str | None = None) -> StreamingQuery:
    """Start a Parquet sink; without an interval it drains what is available and stops."""
    writer = df.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()


def drain(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream to the end of its input and read the sink."""
    write_stream(df, path, checkpoint).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fingerprint_stream(raw: DataFrame) -> DataFrame:
    """Drop every later repeat of (source, text), however late it comes.

    The fingerprints are the operator's state; ``build_session`` keeps it in
    RocksDB, on the executors' disks and in the checkpoint. A row without source or text has
    no fingerprint and is told apart by all its columns.
    """
    mark = X.fingerprint(F.col("source_id"), F.col("raw_text"))
    marked = raw.withColumn("fingerprint", F.coalesce(mark, F.concat(F.lit("row-"), F.sha2(F.to_json(F.struct(*raw.columns)), 256))))
    return marked.dropDuplicates(["fingerprint"])


HOURLY = ["bucket", "source_id", "threat_tier"]


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*HOURLY).agg(F.sum("event_count").alias("event_count"), F.sum("closed_count").alias("closed_count"))


def hourly_store(spark: SparkSession, target: str) -> BatchStore:
    return BatchStore(spark, target, {"hourly": _summed})


def hourly_stats_stream(events: DataFrame, target: str, checkpoint: str, time: str = "occurred_at") -> StreamingQuery:
    """Hourly counts per source and tier, batch by batch; read them with :func:`hourly_stats`.

    Each batch commits its own partial counts, which the store adds up to larger
    parts as they become many. No watermark is needed, so late events count whenever they come,
    and the current hour is there after each batch.
    """
    def add(batch: DataFrame, number: int) -> None:
        counted = batch.groupBy(F.date_trunc("hour", time).alias("bucket"), "source_id", "threat_tier").agg(
            F.count(F.lit(1)).alias("event_count"), F.count_if(F.col("status") == "CLOSED").alias("closed_count"))
        hourly_store(batch.sparkSession, target).commit(number, {"hourly": counted})

    return events.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly_stats(spark: SparkSession, target: str) -> DataFrame:
    """The counts of all batches: added-up parts and fresh ones as one table."""
    return hourly_store(spark, target).merged("hourly")


def _checked(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and refused ones with a reason: malformed, or of a source type that no adapter knows."""
    good, bad = validate_raw_events(raw)
    known = F.coalesce(F.col("source_type").isin(*STREAM_SOURCE_TYPES), F.lit(False))
    unknown = good.filter(~known).withColumn("reject_reason", F.lit(UNKNOWN_KIND))
    return good.filter(known), bad.unionByName(unknown)


def _sorted_out(raw: DataFrame, default_classification: str) -> tuple[DataFrame, DataFrame]:
    """Normalised events with their fingerprints, and refused rows with a reason; repeats are in both."""
    good, bad = _checked(raw)
    done = normalize_signals(good, default_classification=default_classification, keep=["source_type", "metadata"])
    names = ["source_id", "raw_text", "reject_reason"]
    return done.accepted, bad.select(*names).unionByName(done.rejected.select(*names))


def _quarantine(refused: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One refused row of each (source, text), and the others counted per reason; without source or text every row is its own."""
    whole = F.col("source_id").isNotNull() & F.col("raw_text").isNotNull()
    counted = refused.where(whole).groupBy("source_id", "raw_text", "reject_reason").agg(F.count(F.lit(1)).alias("copies"))
    order = W.partitionBy("source_id", "raw_text").orderBy("reject_reason")
    first = F.row_number().over(order) == 1
    ranked = counted.withColumn("_first", first)
    firsts = ranked.where("_first").select(*refused.columns)
    repeats = ranked.withColumn("copies", F.col("copies") - F.col("_first").cast("long")).where("copies > 0").drop("_first")
    return firsts.unionByName(refused.where(~whole)), repeats


def event_store(spark: SparkSession, target: str) -> BatchStore:
    """The tables of :func:`persist_batch`: events, entities, event_entities, quarantine and quarantine_repeats."""
    return BatchStore(spark, target, {"entities": lambda rows: rows.distinct()})


def stored_entities(spark: SparkSession, target: str) -> DataFrame:
    """Every entity once, whichever batches it came in."""
    return event_store(spark, target).merged("entities")


def persist_batch(raw: DataFrame, batch_id: int, target: str, default_classification: str = DEFAULT_CLASSIFICATION,
                  embed: Callable[[DataFrame], DataFrame] | None = None, fresh: DataFrame | None = None) -> None:
    """Validate, normalise and store one micro-batch; of accepted copies within it the earliest event stays.

    ``fresh`` holds the ``fingerprint`` of every event that no earlier batch has stored; without it all are.
    ``embed`` makes ``(event_id, embedding)`` of the normalised texts, for instance by a model from ``functions.hooks``;
    without it each text gets its hashed stand-in where it is, and the events meet nothing.

    The five tables become visible together, by one manifest: after a failure between two
    of them nothing of the batch is there, and a batch that is there is not stored again. Malformed rows go to the quarantine and never
    stop the stream; further copies of a refused source and text are counted per
    reason in ``quarantine_repeats``.
    """
    store = event_store(raw.sparkSession, target)
    if batch_id <= store.manifest()["batch"]:
        return
    if fresh is None:  # a stream's batch is kept already
        raw = raw.persist()
    accepted, refused = _sorted_out(raw, default_classification)
    if fresh is not None:
        accepted = accepted.join(fresh, "fingerprint", "left_semi")
    unique = first_per_key(accepted, ["fingerprint"], ["event_time", "raw_text"])
    named = unique.withColumn("event_id", F.col("fingerprint")).withColumn("int_type", F.upper("source_type"))
    if embed is None:
        named = named.withColumn("embedding", text_vector(F.col("normalized_text")))
    else:
        named = named.join(embed(named), "event_id")
    events = named.select("event_id", *[c for c in named.columns if c != "event_id"]).withColumn("batch_id", F.lit(batch_id))

    # Entities and edges are derived from the stored events, so all tables agree.
    def names(written: Callable[[str], DataFrame]) -> DataFrame:
        found = computed_once(written("events").select("event_id", "normalized_text"), _names=X.entity_tokens(F.col("normalized_text")))
        return found.select("event_id", F.explode("_names").alias("name"), F.lit("TOKEN").alias("entity_type"))

    def entities(written: Callable[[str], DataFrame]) -> DataFrame:
        distinct = names(written).select("name", "entity_type").distinct()
        return distinct.select(entity_id().alias("entity_id"), "name", "entity_type")

    def edges(written: Callable[[str], DataFrame]) -> DataFrame:
        return names(written).select("event_id", entity_id().alias("entity_id"), "name", "entity_type",
                                     F.lit("MENTIONED").alias("role"), F.lit(1.0).alias("confidence"))

    refused = refused.persist()  # looked at twice, and few where most messages are good
    firsts, repeats = _quarantine(refused)
    store.commit(batch_id, {
        "events": events, "entities": entities, "event_entities": edges,
        "quarantine": firsts.withColumn("batch_id", F.lit(batch_id)), "quarantine_repeats": repeats.withColumn("batch_id", F.lit(batch_id))})
    refused.unpersist()
    if fresh is None:
        raw.unpersist()


def ingest_stream(raw: DataFrame, target: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Ingest a stream of raw events batch by batch; progress is committed after the batch is stored.

    Only accepted events are remembered, so a refused message never hides a
    corrected one, and every refused row is stored. The stream's own state tells
    which fingerprints are new, so no batch reads the store; for that a message is only looked at as far as it can be refused.
    """
    marks = signal_fingerprints(_checked(raw)[0], default_classification=DEFAULT_CLASSIFICATION)
    new = marks.select(F.col("fingerprint").alias("_fresh")).dropDuplicates(["_fresh"])
    both = raw.withColumn("_fresh", F.lit(None).cast("string")).unionByName(new, allowMissingColumns=True)

    def persist(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # the state must not be asked twice
        fresh = batch.where("_fresh IS NOT NULL").select(F.col("_fresh").alias("fingerprint"))
        persist_batch(batch.where("_fresh IS NULL").drop("_fresh"), number, target, fresh=fresh)
        batch.unpersist()

    writer = both.writeStream.foreachBatch(persist).option("checkpointLocation", checkpoint)
    return writer.trigger(**({"processingTime": every} if every else {"availableNow": True})).start()
