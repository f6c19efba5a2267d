"""Registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB SQL)."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> tuple[dict, dict]:
    from stratum.proxies import q_sources, q_predicates, q_relational, q_builders, q_reports  # noqa: F401
    return QUERIES, ORACLE
