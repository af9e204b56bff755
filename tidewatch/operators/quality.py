"""Data-quality rules as aggregates: ``(rule, failed, sample)`` rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.operators.ordering import exact_quantiles


@dataclass(frozen=True)
class Rule:
    """A named condition that is true for a row that breaks the rule."""

    name: str
    broken: Column


def required(*columns: str) -> list[Rule]:
    return [Rule(f"{c} required", F.col(c).isNull()) for c in columns]


def matches(column: str, pattern: str) -> Rule:
    return Rule(f"{column} format", ~F.coalesce(F.col(column).rlike(pattern), F.lit(False)))


def allowed(column: str, values: Sequence[object]) -> Rule:
    return Rule(f"{column} allowed", ~F.coalesce(F.col(column).isin(*values), F.lit(False)))


def in_range(column: str, low: float, high: float) -> Rule:
    return Rule(f"{column} range", ~F.coalesce(F.col(column).between(low, high), F.lit(False)))


def non_blank(column: str) -> Rule:
    return Rule(f"{column} non-blank", F.coalesce(F.trim(column), F.lit("")) == "")


def expect(df: DataFrame, rules: Sequence[Rule], key: str) -> DataFrame:
    """Check every row rule in one pass; ``sample`` is the smallest key that fails."""
    counted = df.agg(F.array(*[
        F.struct(
            F.lit(r.name).alias("rule"),
            F.count_if(r.broken).alias("failed"),
            F.min(F.when(r.broken, F.col(key))).cast("string").alias("sample"),
        )
        for r in rules
    ]).alias("r"))
    return counted.select(F.inline("r"))


def row_count(df: DataFrame, low: int, high: int | None = None) -> DataFrame:
    """One row; ``failed`` is 1 when the number of rows is outside the range."""
    n = F.col("n")
    bad = n < low if high is None else ~n.between(low, high)
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("row count").alias("rule"), _flag(bad), n.cast("string").alias("sample")
    )


def _flag(bad: Column) -> Column:
    return F.when(bad, 1).otherwise(0).cast("bigint").alias("failed")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def group_values(df: DataFrame, group: str, value: str, expected: str) -> DataFrame:
    """Groups whose rows do not all carry the group's expected value."""
    return df.groupBy(group).agg(F.count_if(~F.col(value).eqNullSafe(F.col(expected))).alias("failed")).filter("failed > 0")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows without a parent; a NULL reference is no orphan."""
    refs = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.filter(F.col(child_key).isNotNull()).join(refs, child_key, "left_anti")


def top_contains(df: DataFrame, measure: str, name: str, expected: Sequence[str], k: int = 2) -> DataFrame:
    """Whether the ``k`` largest rows by ``measure`` contain one of the expected names."""
    top = df.select(name, measure).orderBy(F.desc(measure), name).limit(k)
    hits = F.count_if(F.col(name).isin(*expected))
    return top.agg(hits.alias("n")).select(
        F.lit(f"top {k} by {measure}").alias("rule"), _flag(F.col("n") == 0), F.col("n").cast("string").alias("sample")
    )


def missing_members(df: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Expected members that the data lacks."""
    return expected.select(key).distinct().join(df.select(key), key, "left_anti")


def projection(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Compare the columns with the asked ones: ``(column, problem)``, empty when equal."""
    wanted, got = set(columns), set(df.columns)
    found = [(c, "missing") for c in sorted(wanted - got)] + [(c, "unexpected") for c in sorted(got - wanted)]
    return df.sparkSession.createDataFrame(found, "column string, problem string")


def p95_within(df: DataFrame, keys: Sequence[str], value: str, limits: Mapping[str, float] | float) -> DataFrame:
    """Exclusive 95th percentile per key against one limit or a limit per first key."""
    out = exact_quantiles(df, keys, value, {"p95": 0.95}, method="exclusive")
    if isinstance(limits, Mapping):
        table = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
        limit = F.try_element_at(table, F.col(keys[0]))
    else:
        limit = F.lit(float(limits))
    return out.select(*keys, "p95", (F.col("p95") <= limit).alias("within"))


def changed_rows(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Keys of the rows that differ between two loads, repeated rows counted; none when the load is idempotent."""
    def comparable(df: DataFrame) -> DataFrame:  # maps have no equality; their sorted entries do
        maps = {c for c, kind in df.dtypes if kind.startswith("map<")}
        return df.select(*[F.array_sort(F.map_entries(c)).alias(c) if c in maps else F.col(c) for c in first.columns])

    one, two = comparable(first), comparable(second)
    return one.exceptAll(two).select(key).union(two.exceptAll(one).select(key)).distinct()
