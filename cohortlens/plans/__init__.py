"""Registered queries (``catalog``, ``exact``, ``modelling``) and their DuckDB twins (``oracle``)."""

from __future__ import annotations


def all_queries():
    from . import catalog, exact, modelling  # noqa: F401  (the others register further keys)
    return dict(catalog.QUERIES)


def all_oracle_sql():
    from . import catalog
    all_queries()
    return dict(catalog.ORACLE)
