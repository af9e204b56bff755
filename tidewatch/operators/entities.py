"""Entities as a log of what each batch said about them, merged on reading.

A batch appends a row per alias. An entity has one id for its name and type, so the
same entity from any batch, or a batch stored twice, is the same row when read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KEY = ["entity_id", "name", "entity_type"]


def entity_id(name: str = "name", entity_type: str = "entity_type") -> Column:
    """The same id for the same name and type in every batch."""
    return F.sha2(F.concat_ws("\n", entity_type, name), 256)


def entity_log(incoming: DataFrame, batch: int, created: Column) -> DataFrame:
    """Log rows (entity_id, name, entity_type, batch, seq, alias, metadata, created_at) of an incoming batch.

    ``incoming`` is (name, entity_type, seq, alias, metadata): aliases in the order of ``seq``, a null
    alias for an entity that has none; metadata as JSON text or null. Rows without name or type are left out.
    """
    return incoming.filter("name IS NOT NULL AND entity_type IS NOT NULL").select(
        entity_id().alias("entity_id"), "name", "entity_type", F.lit(batch).alias("batch"), F.col("seq").cast("long").alias("seq"), "alias",
        "metadata", created.alias("created_at"))


def entities(log: DataFrame) -> DataFrame:
    """A row per entity: its id, name, type, when it was first stored, its latest metadata, and how many aliases it has.

    A count, not the list: an entity may have very many; :func:`aliases` has them one a row, in order.
    """
    latest = F.max_by("metadata", F.when(F.col("metadata").isNotNull(), F.struct("batch", "seq")))
    return log.groupBy(*KEY).agg(F.min("created_at").alias("created_at"), latest.alias("metadata"), F.count("alias").alias("n_aliases"))


def aliases(log: DataFrame, *, distinct: bool = False) -> DataFrame:
    """(entity_id, batch, seq, alias): ``old || new`` of every entity in this order; ``distinct`` keeps first copies."""
    rows = log.filter("alias IS NOT NULL").select("entity_id", "batch", "seq", "alias")
    if distinct:
        first = F.min(F.struct("batch", "seq"))
        return rows.groupBy("entity_id", "alias").agg(first.alias("f")).select("entity_id", "f.batch", "f.seq", "alias")
    return rows


def by_alias(log: DataFrame, wanted: DataFrame, alias: str) -> DataFrame:
    """Entities that go by one of the wanted names or aliases, a row for each: (alias, entity_id, name, entity_type)."""
    names = log.select(F.col("name").alias(alias), *KEY).union(log.select(F.col("alias").alias(alias), *KEY)).distinct()
    return names.join(wanted.select(alias).distinct(), alias)
