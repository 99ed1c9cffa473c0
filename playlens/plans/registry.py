"""Named queries over the given tables and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playlens.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def add(name: str, build: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    """Register ``build`` under ``name``; without ``sql`` only its rows are checked."""
    if name in QUERIES:
        raise ValueError(f"duplicate query {name}")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Tables(spark, sf_dir))

    QUERIES[name] = run
    if sql is not None:
        ORACLES[name] = sql


def load() -> None:
    """Import every module that registers queries."""
    from playlens.plans import (  # noqa: F401
        audit_queries,
        cleaning_queries,
        engagement_queries,
        enrich_queries,
        evaluation_queries,
        feature_queries,
        io_queries,
        ranking_queries,
        streaming_queries,
        temporal_queries,
    )
