"""Registry of named queries: each is a Spark callable ``(spark, sf_dir) -> DataFrame``
plus, when the operator is deterministic and SQL-expressible, the DuckDB SQL
that must give the same rows (tables are the driver's parquet views).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, ops: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing the modules registers their queries
    from cribble.plans import q_drift, q_metrics, q_models, q_prep, q_stream, q_text  # noqa: F401
    return REGISTRY
