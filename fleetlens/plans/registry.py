"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole driver tables.
Computed columns are aliased identically in the Spark result and the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetlens.sources.fixtures import with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: tuple[str, ...] = ()):
    """Register a query builder; ``sql`` is wrapped with the DuckDB fixture CTEs named in ``ctes``."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:  # None: oracle shared later or rows-only
            ORACLE[name] = with_ctes(sql, *ctes) if ctes else sql
        return fn

    return deco
