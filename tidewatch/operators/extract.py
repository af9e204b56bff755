"""Text-extraction jobs: accepted rows, rejected rows with a reason, and a rollup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions import text as X
from tidewatch.functions.scalar import computed_once, time_bucket
from tidewatch.schema import CLASSIFICATIONS


@dataclass(frozen=True)
class Extracted:
    accepted: DataFrame
    rejected: DataFrame
    rollup: DataFrame


def _label(default_classification: str) -> Column:
    return F.coalesce(F.try_element_at("metadata", F.lit("classification")), F.lit(default_classification))


def _dated(raw: DataFrame, default_classification: str) -> tuple[DataFrame, Column]:
    """Signals with trimmed text and date-time group, and why one of them is refused, or null."""
    text = F.col("_text")
    dated = computed_once(computed_once(raw, _text=X.strip(F.col("raw_text"))), _dtg=X.dtg_match(text))
    return dated, F.when((F.col("_dtg") != "") & X.dtg_time(F.col("_dtg")).isNull(), "impossible date-time group").when(
        ~_label(default_classification).isin(*CLASSIFICATIONS), "classification not in the vocabulary")


def signal_fingerprints(raw: DataFrame, *, default_classification: str = "SECRET") -> DataFrame:
    """``fingerprint`` of every signal that :func:`normalize_signals` accepts, found without normalising it."""
    dated, refused = _dated(raw, default_classification)
    return dated.filter(refused.isNull()).select(X.fingerprint(F.col("source_id"), F.col("raw_text")).alias("fingerprint"))


def normalize_signals(
    raw: DataFrame, *, signed: bool = True, classify_on: str = "clean", default_classification: str = "SECRET",
    keep: Sequence[str] = (),
) -> Extracted:
    """``(source_id, raw_text, received_at, metadata)`` to normalised signal events.

    Without a date-time group the receive time stands in; an impossible one, or a label
    outside the vocabulary, is a reject. Columns in ``keep`` are handed through.
    """
    dated, refused = _dated(raw, default_classification)
    text, time, label = F.col("_text"), X.dtg_time(F.col("_dtg")), _label(default_classification)
    rejected = dated.filter(refused.isNotNull()).select(*raw.columns, refused.alias("reject_reason"))
    parsed = computed_once(dated.filter(refused.isNull()), _position=X.position_match(text), normalized_text=X.strip_flash(text))
    accepted = parsed.select(
        "source_id",
        F.coalesce(time, F.col("received_at")).alias("event_time"),
        label.alias("classification"),
        X.keyword_tier(F.col("normalized_text" if classify_on == "clean" else "_text")).alias("threat_tier"),
        "raw_text",
        "normalized_text",
        X.coordinate(F.col("_position"), "lat", signed).alias("geo_lat"),
        X.coordinate(F.col("_position"), "lon", signed).alias("geo_lon"),
        X.fingerprint(F.col("source_id"), F.col("raw_text")).alias("fingerprint"),
        *keep,
    )
    rollup = accepted.groupBy("source_id", "threat_tier", time_bucket(F.col("event_time")).alias("hour")).agg(
        F.count(F.lit(1)).alias("events")
    )
    return Extracted(accepted, rejected, rollup)


def report_timeline(
    lines: DataFrame,
    *,
    default_vessel: str,
    vessels: Sequence[str],
    bearings: Sequence[str] = ("port quarter",),
    year: int = 2024,
    month: int = 1,
) -> Extracted:
    """Numbered report lines (column ``line``) to timeline records and a rollup per vessel."""
    raw = F.col("_raw")
    parsed = computed_once(
        computed_once(lines, _raw=X.strip(F.col("line"))),
        **{f"_{i}": F.regexp_extract(raw, X.REPORT_LINE, i) for i in range(1, 5)},
    )
    matched = F.coalesce(F.col("_1") != "", F.lit(False))
    rejected = parsed.filter(~matched).select(*lines.columns, F.lit("not a report line").alias("reject_reason"))
    clock = F.col("_3")
    stamp = F.concat(
        F.lit(f"{year:04d}-{month:02d}-"), F.lpad(F.col("_2").cast("int").cast("string"), 2, "0"),
        F.lit("T"), F.substring(clock, 1, 2), F.lit(":"), F.substring(clock, 3, 2), F.lit(":00Z"),
    )
    vessel = X.first_match([(F.upper("description").contains(n.upper()), n) for n in vessels], default_vessel)
    bearing = X.first_match([(F.lower("description").contains(b.lower()), b) for b in bearings], None)
    accepted = (
        parsed.filter(matched)
        .select(
            F.col("_1").cast("bigint").alias("sequence"),
            stamp.alias("timestamp"),
            X.strip(F.col("_4")).alias("description"),
            raw.alias("raw"),
        )
        .select(
            "sequence", "timestamp",
            vessel.alias("vessel"),
            bearing.alias("bearing"),
            X.group_or_null(F.col("description"), X.DISTANCE, 1).cast("double").alias("distance_nm"),
            X.group_or_null(F.col("description"), X.SPEED, 1).cast("double").alias("speed_kts"),
            "description", "raw",
        )
    )
    rollup = accepted.groupBy("vessel").agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("distance_nm").alias("min_distance_nm"),
        F.max("speed_kts").alias("max_speed_kts"),
        F.min("timestamp").alias("first_time"),
        F.max("timestamp").alias("last_time"),
    )
    return Extracted(accepted, rejected, rollup)


def enrich_events(requests: DataFrame) -> Extracted:
    """``(source_type, raw_content, ..)`` plus tier, entities, summary and status; nothing is rejected."""
    content = F.col("raw_content")
    accepted = requests.select(
        "*",
        X.priority_tier(content).alias("threat_tier"),
        X.entity_tokens(content).alias("entities"),
        X.summary(content).alias("summary"),
        F.lit("ACCEPTED").alias("processing_status"),
    )
    rollup = (
        accepted.select("source_type", F.explode("entities").alias("entity"))
        .groupBy("source_type", "entity")
        .agg(F.count(F.lit(1)).alias("events"))
    )
    return Extracted(accepted, requests.limit(0).withColumn("reject_reason", F.lit("")), rollup)


@dataclass(frozen=True)
class CountryTables:
    countries: DataFrame
    languages: DataFrame
    currencies: DataFrame
    borders: DataFrame
    rejected: DataFrame


def _code(name: str) -> Column:
    return F.coalesce(X.strip(F.col(name)), F.lit(""))


def normalize_countries(docs: DataFrame) -> CountryTables:
    """Nested country documents to one parent and three child tables; blank codes are rejected."""
    docs = docs.withColumn("cca2", _code("cca2")).withColumn("cca3", _code("cca3"))
    valid = (F.col("cca2") != "") & (F.col("cca3") != "")
    good = docs.filter(valid)
    countries = good.select(
        "cca2", "cca3",
        F.coalesce("name.common", F.lit("")).alias("common_name"),
        F.col("name.official").alias("official_name"),
        "region", "subregion",
        F.try_element_at("capital", F.lit(1)).alias("capital"),
        "population",
    )
    languages = good.select("cca2", F.explode("languages").alias("code", "name"))
    currencies = good.select("cca2", F.explode("currencies").alias("code", "_c")).select(
        "cca2", "code", "_c.name", "_c.symbol"
    )
    borders = good.select("cca2", F.explode("borders").alias("border_cca3"))
    return CountryTables(countries, languages, currencies, borders, docs.filter(~valid))


Adapter = Mapping[str, Column]

UNKNOWN_KIND = "no adapter for this kind"


def dispatch(raw: DataFrame, adapters: Mapping[str, Adapter], keep: Sequence[str], column: str = "source_type") -> DataFrame:
    """Every row of ``raw`` through the adapter of its kind: ``keep``, the adapters' columns and ``reject_reason``.

    An adapter maps output columns to expressions; a column that an adapter does
    not give is null. Rows whose kind has no adapter, or is null, come out with a
    reason and nulls, so that none is lost. One pass over the input, whatever the number of kinds.
    """
    if not adapters:
        raise ValueError("no adapters given")
    kind = F.col(column)
    names = list(dict.fromkeys(name for adapter in adapters.values() for name in adapter))

    def chosen(name: str) -> Column:
        given = [(k, adapter[name]) for k, adapter in adapters.items() if name in adapter]
        out = F.when(kind == given[0][0], given[0][1])
        for k, value in given[1:]:
            out = out.when(kind == k, value)
        return out.alias(name)

    known = F.coalesce(kind.isin(*adapters), F.lit(False))
    return raw.select(*keep, *map(chosen, names), F.when(~known, UNKNOWN_KIND).alias("reject_reason"))
