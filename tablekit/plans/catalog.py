"""Registry of named queries: a Spark builder plus its DuckDB oracle SQL.

Each entry reads the driver tables (through the fixture views) over whole
tables; its oracle is independent SQL over the same parquet files.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None, covers: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, tuple(covers.split()))
        return fn
    return deco


def _load_all() -> None:
    # importing the modules fills REGISTRY
    from tablekit.plans import (  # noqa: F401
        q_query, q_mutate, q_conflicts, q_quality, q_evolve, q_text, q_sinks)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: e.fn for k, e in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: e.sql for k, e in REGISTRY.items() if e.sql is not None}
