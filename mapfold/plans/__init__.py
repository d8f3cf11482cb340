"""Query registry: every operator ID of the survey inventory maps to a Spark
plan builder ``(spark, sf_dir) -> DataFrame`` and, where SQL can express it,
an independent oracle SQL text (DuckDB dialect) over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mapfold.fixtures import with_fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(qid: str, oracle: str | None = None):
    """Register a query builder under ``qid`` with its oracle SQL."""

    def deco(fn: QueryFn) -> QueryFn:
        if qid in QUERIES:
            raise ValueError(f"duplicate query id {qid}")
        QUERIES[qid] = fn
        if oracle is not None:
            ORACLE[qid] = with_fixtures(oracle)
        return fn

    return deco


def load_all() -> None:
    """Import every plan module so that their queries register."""
    from mapfold.plans import admin, catalog, discovery, documents, geometry, io, lines, linework, osm, polygons, raster, rules, schema_ops, spatial, streams  # noqa: F401


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
