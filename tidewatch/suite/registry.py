"""Named queries over the driver tables, each with its SQL check where one exists."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    key: str
    build: Builder
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(key: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def register(build: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"duplicate query {key}")
        REGISTRY[key] = Query(key, build, sql)
        return build

    return register


def rnd(expression: str, digits: int) -> str:
    """SQL twin of ``functions.scalar.exact_round``."""
    return f"CAST(round(CAST({expression} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"
