"""How a module of queries collects them."""

from __future__ import annotations

from collections.abc import Callable


def registrar() -> tuple[dict, dict, Callable]:
    """(queries, SQL twins, decorator) of one module."""
    queries: dict = {}
    oracle: dict = {}

    def register(name: str, sql: str | None = None):
        def add(fn):
            queries[name] = fn
            if sql is not None:
                oracle[name] = sql
            return fn

        return add

    return queries, oracle, register
