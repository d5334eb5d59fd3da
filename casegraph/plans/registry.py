"""The registered queries and their DuckDB counterparts, by name."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) under its name, with SQL for the same rows where there is some."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register
