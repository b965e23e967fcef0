"""Registry of named queries: a Spark builder and, where SQL can say it, the
DuckDB oracle that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, Callable[[], str] | str] = {}


def register(name: str, oracle: Callable[[], str] | str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def oracle_sql(name: str) -> str:
    o = ORACLES[name]
    return o() if callable(o) else o
