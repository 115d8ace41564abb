"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
