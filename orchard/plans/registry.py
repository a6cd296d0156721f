"""Registry of named queries: a Spark builder plus, where SQL can say it, a DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def _bigint_count_if(sql: str) -> str:
    """DuckDB types count_if as HUGEINT; Spark's count is BIGINT. Cast every count_if(...)."""
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(token)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = _bigint_count_if(sql[j + len(token):k - 1])
        out.append(sql[i:j] + f"CAST({token}{inner}) AS BIGINT)")
        i = k


def register(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key`` with its oracle SQL."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = _bigint_count_if(sql)
        return fn

    return deco


def load_all() -> None:
    """Import every catalog module so that its queries register."""
    from orchard.plans import (  # noqa: F401
        catalog_interactions,
        catalog_profile,
        catalog_metrics,
        catalog_recommend,
        catalog_monitoring,
        catalog_features,
        catalog_experiments,
        catalog_extensions,
        catalog_streaming,
        catalog_models,
        catalog_invariants,
        catalog_io,
    )
