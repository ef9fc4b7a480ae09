"""Named queries over the driver tables, each paired with an independent SQL
oracle (DuckDB dialect) that computes the same answer from the original
columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def wrap(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle.strip() if oracle else None)
        return fn
    return wrap


MODULES = ("text_queries", "keyed_queries", "table_queries", "weblog_queries", "xml_queries",
           "ride_queries", "stream_queries", "graph_queries", "rank_queries", "sink_queries",
           "file_queries")


def load_all() -> dict[str, Query]:
    """Import every query module (importing registers its queries)."""
    import importlib
    import importlib.util
    for m in MODULES:
        mod = f"tallgrass.plans.{m}"
        if importlib.util.find_spec(mod) is not None:
            importlib.import_module(mod)
    return REGISTRY
