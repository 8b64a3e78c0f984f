"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and, where the
result is SQL-expressible, an independent DuckDB oracle computed from the source columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}


def register(name: str, oracle: str | None = None, covers: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        COVERS[name] = covers
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their ``register`` calls run."""
    from . import (asset_queries, endpoint_queries, firewall_queries, inventory_queries,  # noqa: F401
                   metrics_queries, misc_queries, quality_queries, sensor_queries, sidefeed_queries, table_queries)
