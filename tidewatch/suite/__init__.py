"""The query suite: importing it fills the registry."""

from importlib import import_module

from tidewatch.suite.registry import REGISTRY, Query, query

for _module in (
    "analytics", "ingest", "filters", "functions", "extraction", "joins", "aggregates", "windows",
    "retrieval", "timeseries", "streams", "quality", "extensions",
):
    import_module(f"tidewatch.suite.{_module}")

__all__ = ["REGISTRY", "Query", "query"]
