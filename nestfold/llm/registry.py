"""Registry of the corpus queries and their DuckDB SQL."""

from __future__ import annotations

import functools

from nestfold.llm.common import corpus_session

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            return fn(corpus_session(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco
