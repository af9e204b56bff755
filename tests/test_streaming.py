"""Streams from files, compared with their batch results."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.vector import hashed_embedding
from tidewatch.operators import entities as EN
from tidewatch.sources import readers
from tidewatch.streaming import pipelines as P
from tidewatch.streaming.store import BatchStore
from tidewatch.suite import REGISTRY
from tidewatch.suite.streams import table_stream


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))


def message(source, text):
    return {"source_type": "sigint", "source_id": source, "raw_text": text, "metadata": {"received_at": "2024-01-01 00:00:00"}}


def stream(spark, folder):
    return readers.message_files(spark, str(folder)).withColumn(
        "received_at", F.try_element_at("metadata", F.lit("received_at")).cast("timestamp_ntz"))


def test_ingest_over_batches(spark, tmp_path):
    folder, target, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    land(folder, "1.json", [message("a", "ALPHA moved to the north"), message("a", "ALPHA moved to the north"), message("a", "short"), "not json"])
    P.ingest_stream(stream(spark, folder), target, ckpt).awaitTermination()
    land(folder, "2.json", [message("a", "ALPHA moved to the north"), message("b", "BRAVO at 310000ZFEB24 again"), message("b", "BRAVO held its course")])
    P.ingest_stream(stream(spark, folder), target, ckpt).awaitTermination()

    events = P.event_store(spark, target).read("events")
    assert sorted(r.raw_text for r in events.collect()) == ["ALPHA moved to the north", "BRAVO held its course"]
    edges = P.event_store(spark, target).read("event_entities")
    assert sorted(r.name for r in edges.collect()) == ["ALPHA", "BRAVO"]
    reasons = sorted(r.reject_reason for r in P.event_store(spark, target).read("quarantine").collect())
    assert reasons == ["impossible date-time group", "text shorter than the minimum", "text shorter than the minimum"]


def test_replayed_batch_is_idempotent(spark, tmp_path):
    rows = [("sigint", "a", "ALPHA moved to the north", dt.datetime(2024, 1, 1), {})] * 3
    batch = spark.createDataFrame(rows, "source_type string, source_id string, raw_text string, received_at timestamp_ntz, metadata map<string,string>")
    for _ in range(2):
        P.persist_batch(batch, 0, str(tmp_path / "t"))
    assert P.event_store(spark, str(tmp_path / "t")).read("events").count() == 1


def test_hourly_stats_equal_batch_with_late_events(spark, tmp_path):
    """Over two runs, the second with events a year late; the newest hour is there too."""
    names = "t string, source_id string, threat_tier string, status string"
    early = [(f"2024-01-0{d} 0{h}:30:00", "s", "HIGH", "CLOSED" if h % 2 else "INGESTED") for d in (1, 2) for h in range(6) for _ in range(h + 1)]
    late = [("2023-01-01 00:10:00", "s", "LOW", "CLOSED"), ("2024-01-02 05:59:59", "s", "HIGH", "CLOSED")]
    folder, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    for rows in (early, late):
        batch = spark.createDataFrame(rows, names).withColumn("occurred_at", F.col("t").cast("timestamp")).drop("t")
        batch.coalesce(1).write.mode("append").parquet(folder)
        events = spark.readStream.schema(batch.schema).parquet(folder)
        P.hourly_stats_stream(events, out, ckpt).awaitTermination()
    want = spark.read.parquet(folder).groupBy(F.date_trunc("hour", "occurred_at").alias("bucket"), "threat_tier").agg(
        F.count("*").alias("n"), F.count_if(F.col("status") == "CLOSED").alias("c"))
    got = P.hourly_stats(spark, out)
    assert sorted((r.bucket, r.threat_tier, r.event_count, r.closed_count) for r in got.collect()) == sorted(map(tuple, want.collect()))


def test_stream_dedup_has_no_horizon(spark, tmp_path):
    folder, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    for name, source in (("a.json", "a"), ("b.json", "b"), ("c.json", "a")):
        land(folder, name, [message(source, "same text here")] * 2)
        got = P.drain(P.fingerprint_stream(stream(spark, folder)).select("source_id"), out, ckpt)
    assert sorted(r.source_id for r in got.collect()) == ["a", "b"]


def test_unknown_types_and_labels_are_refused(spark, tmp_path):
    odd = {"source_type": "carrier_pigeon", "source_id": "p", "raw_text": "a message of some length", "metadata": {"received_at": "2024-01-01 00:00:00"}}
    label = {**odd, "source_type": "sigint", "metadata": {**odd["metadata"], "classification": "BANANA"}}
    land(tmp_path / "in", "a.json", [odd, label])
    target = str(tmp_path / "t")
    P.ingest_stream(stream(spark, tmp_path / "in"), target, str(tmp_path / "c")).awaitTermination()
    assert P.event_store(spark, target).read("events").count() == 0
    # both have one source and text, so the second is a repeat of the first
    assert [r.reject_reason for r in P.event_store(spark, target).read("quarantine").collect()] in (
        ["no adapter for this kind"], ["classification not in the vocabulary"])


def test_refused_copy_does_not_hide_a_corrected_one(spark, tmp_path):
    """In one batch and over batches; every refused row is stored, and the earliest of accepted copies."""
    folder, target, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    text = "ALPHA moved to the north"
    wrong = {**message("a", text), "source_type": "carrier_pigeon"}
    undated = {**message("a", text), "metadata": {}}
    late = {**message("b", text), "metadata": {"received_at": "2025-01-01 00:00:00"}}
    for name, rows in (("1.json", [wrong, undated, wrong]), ("2.json", [wrong, message("a", text), late, message("b", text)]),
                       ("3.json", [wrong, late, message("a", text)])):
        land(folder, name, rows)
        P.ingest_stream(stream(spark, folder), target, ckpt).awaitTermination()
    events = P.event_store(spark, target).read("events").select("source_id", "raw_text", F.col("event_time").cast("string"), "batch_id").collect()
    assert sorted(map(tuple, events)) == [("a", text, "2024-01-01 00:00:00", 1), ("b", text, "2024-01-01 00:00:00", 1)]
    refused = P.event_store(spark, target).read("quarantine").withColumn("copies", F.lit(1)).select("batch_id", "reject_reason", "copies").union(
        P.event_store(spark, target).read("quarantine_repeats").select("batch_id", "reject_reason", "copies"))
    found = refused.groupBy("batch_id", "reject_reason").agg(F.sum("copies")).collect()
    assert sorted(map(tuple, found)) == [(0, "no adapter for this kind", 2), (0, "no usable receive time", 1),
                                         (1, "no adapter for this kind", 1), (2, "no adapter for this kind", 1)]


def test_a_batch_is_there_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    """A writer that dies between two tables leaves nothing to be read; the replay then stores the batch once."""
    kinds = "source_type string, source_id string, raw_text string, received_at timestamp_ntz, metadata map<string,string>"
    batch = lambda text: spark.createDataFrame([("sigint", "a", text, dt.datetime(2024, 1, 1), {})], kinds)
    target = str(tmp_path / "t")
    P.persist_batch(batch("ALPHA moved to the north"), 0, target)
    add, calls = BatchStore._added, []

    def dying(self, *args):
        calls.append(args[1])
        if len(calls) == 3:
            raise RuntimeError("lost")
        return add(self, *args)

    monkeypatch.setattr(BatchStore, "_added", dying)
    with pytest.raises(RuntimeError):
        P.persist_batch(batch("BRAVO held its course"), 1, target)
    store = P.event_store(spark, target)
    assert calls == ["events", "entities", "event_entities"] and store.read("events").count() == 1 and store.manifest()["batch"] == 0
    monkeypatch.setattr(BatchStore, "_added", add)
    for _ in range(2):
        P.persist_batch(batch("BRAVO held its course"), 1, target)
    assert store.read("events").count() == 2 and store.read("event_entities").count() == 2


def test_parts_are_merged_as_they_become_many(spark, tmp_path):
    """Reading touches a number of folders that grows with the logarithm of the batches; sums stay the same."""
    store = P.hourly_store(spark, str(tmp_path / "s"))
    one = lambda n: spark.sql(f"SELECT TIMESTAMP_NTZ '2024-01-01 0{n % 3}:00:00' AS bucket, 's' AS source_id, 'LOW' AS threat_tier, "  # noqa: E731
                              f"CAST({n} AS BIGINT) AS event_count, CAST(1 AS BIGINT) AS closed_count")
    for n in range(20):
        store.commit(n, {"hourly": one(n)})
    live = store.manifest()["tables"]["hourly"]["live"]
    assert sorted(level for _, level in live) == [0] * 4 + [1] * 2
    got = {r.bucket.hour: (r.event_count, r.closed_count) for r in store.merged("hourly").collect()}
    assert got == {h: (sum(range(h, 20, 3)), len(range(h, 20, 3))) for h in range(3)}
    store.commit(7, {"hourly": one(1000)})  # an old batch comes again
    assert store.merged("hourly").agg(F.sum("event_count")).first()[0] == sum(range(20))
    assert store.vacuum() == 16 and store.merged("hourly").count() == 3


def test_entity_log(spark):
    """Two batches and a replay give one row per entity, aliases in order, the latest metadata."""
    names = "name string, entity_type string, seq int, alias string, metadata string"
    first = spark.createDataFrame([("Al", "P", 1, "A1", None), ("Al", "P", 2, "A2", '{"v":1}'), ("Al", "Q", 1, None, None), (None, "P", 1, "x", None)], names)
    second = spark.createDataFrame([("Al", "P", 1, "A1", '{"v":2}'), ("Bo", "P", 1, "A1", None)], names)
    when = lambda d: F.lit(dt.datetime(2024, 1, d)).cast("timestamp_ntz")
    once = EN.entity_log(first, 0, when(1)).union(EN.entity_log(second, 1, when(2)))
    rows = {(r.name, r.entity_type): r for r in EN.entities(once).collect()}
    assert {k: (r.created_at.day, r.metadata, r.n_aliases) for k, r in rows.items()} == {
        ("Al", "P"): (1, '{"v":2}', 3), ("Al", "Q"): (1, None, 0), ("Bo", "P"): (2, None, 1)}
    assert len({r.entity_id for r in rows.values()}) == 3
    of = rows["Al", "P"].entity_id
    in_order = lambda df: [r.alias for r in df.where(F.col("entity_id") == of).orderBy("batch", "seq").collect()]
    assert in_order(EN.aliases(once)) == ["A1", "A2", "A1"] and in_order(EN.aliases(once, distinct=True)) == ["A1", "A2"]
    found = EN.by_alias(once, spark.createDataFrame([("A1",), ("Bo",), ("A1",)], "called string"), "called")
    assert sorted((r.called, r.name, r.entity_type) for r in found.collect()) == [("A1", "Al", "P"), ("A1", "Bo", "P"), ("Bo", "Bo", "P")]


def test_table_streams_of_a_file_and_of_a_folder(spark, tmp_path):
    """A table may be one file or a folder of files; its neighbours are not read."""
    rows = spark.createDataFrame([(i, "web", f"text {i % 7}") for i in range(20)], "doc_id long, source string, text string")
    rows.repartition(3).write.parquet(str(tmp_path / "many" / "documents.parquet"))
    rows.write.parquet(str(tmp_path / "many" / "pages.parquet"))
    (tmp_path / "one").mkdir()
    rows.toPandas().to_parquet(tmp_path / "one" / "documents.parquet")
    for d in ("many", "one"):
        assert REGISTRY["stream_fingerprint_dedup"].build(spark, str(tmp_path / d)).distinct().count() == 7
        read = table_stream(spark, str(tmp_path / d), "documents")
        assert P.drain(read, str(tmp_path / f"{d}-out"), str(tmp_path / f"{d}-ckpt")).count() == 20


def test_a_batch_is_parsed_once_and_stored_once(spark, tmp_path):
    """However many columns and filters read a message it is parsed in one place; events are written once, and
    a text's own vector is that of a given embedder."""
    lines = spark.createDataFrame([(json.dumps(message("a", f"ALPHA {i} ALPHA held")),) for i in range(5)] + [("no json",)], "value string")
    raw = readers.parse_messages(lines).withColumn("received_at", F.try_element_at("metadata", F.lit("received_at")).cast("timestamp_ntz"))
    used = raw.where("length(raw_text) > 3 AND source_id <> ''")
    assert used._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    there = set(Path(spark.conf.get("spark.checkpoint.dir")).iterdir())
    P.persist_batch(raw, 0, str(tmp_path / "own"))
    assert set(Path(spark.conf.get("spark.checkpoint.dir")).iterdir()) == there
    P.persist_batch(raw, 0, str(tmp_path / "given"), embed=lambda events: hashed_embedding(events, "event_id", "normalized_text"))
    own, given = (P.event_store(spark, str(tmp_path / n)) for n in ("own", "given"))
    for table, n in (("events", 5), ("entities", 1), ("event_entities", 5), ("quarantine", 1), ("quarantine_repeats", 0)):
        rows = [sorted(map(str, s.read(table).select(*sorted(own.read(table).columns)).collect())) for s in (own, given)]
        assert rows[0] == rows[1] and len(rows[0]) == n
