"""Query registry: every registered query reads the driver tables from a
scale-factor folder and returns a DataFrame; most carry a DuckDB twin."""

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
    bench: bool = False


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, bench: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, bench)
        return fn

    return deco


def load_all() -> dict[str, Entry]:
    """Import every catalog module (registration happens at import)."""
    from . import catalog  # noqa: F401
    return REGISTRY
