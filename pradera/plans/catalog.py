"""Query catalog: every registered query and its DuckDB oracle SQL."""

from __future__ import annotations

from . import (function_queries, herd_queries, io_queries, job_queries, landed_herd_queries, legacy_queries,
               landed_paddock_queries, load_queries, paddock_queries,
               series_queries)

_MODULES = [paddock_queries, series_queries, herd_queries, function_queries, io_queries, job_queries,
            landed_paddock_queries, landed_herd_queries, load_queries, legacy_queries]


def queries():
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql():
    out = {}
    for m in _MODULES:
        out.update(m.SQL)
    return out
