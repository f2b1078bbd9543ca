"""Registry of named queries: a Spark builder and (usually) its DuckDB twin.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the given
tables.  The twin is one DuckDB statement over the same tables (registered as
views by the checker) that must give the same rows, column names and values.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ladle.session import configure

Builder = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(key: str, sql: str | None = None):
    """Register ``fn`` as query ``key`` with its oracle SQL (None: rows-only check)."""
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        REGISTRY[key] = (run, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    """Import every query module so that all keys are registered."""
    from ladle.plans import (  # noqa: F401
        q_io,
        q_pair,
        q_render,
        q_score,
        q_split,
        q_text,
        q_validate,
    )
    return REGISTRY
