"""Registry of named queries and their DuckDB oracle SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from nestfold.session import tuned

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` is
    the equivalent DuckDB query over the driver's tables, or ``None`` when the
    operator has no SQL form (the check is then rows-only)."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            sf_dir = sf_dir.rstrip("/")
            return fn(tuned(spark, sf_dir), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco
