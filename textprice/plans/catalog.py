"""Query catalog: every registered query is a callable (spark, sf_dir) -> DataFrame over the
driver's tables, paired (where SQL can express it) with oracle SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from .oracle import with_fixtures

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_fixtures(oracle)
        return fn
    return deco


_LOADED = False


def load_all() -> None:
    global _LOADED
    if _LOADED:
        return
    from . import (queries_io, queries_models, queries_relational, queries_series,  # noqa: F401
                   queries_stream, queries_text)
    _LOADED = True
