"""All registered queries and oracles, gathered from the plan modules."""

from __future__ import annotations

from . import io_queries, runlog_queries, similarity_queries

_MODULES = (similarity_queries, io_queries, runlog_queries)


def queries() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.ORACLES)
    return out
