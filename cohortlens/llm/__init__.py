"""Operators of a training-data pipeline over documents and embeddings.

Nothing else in the package imports this subpackage. ``queries()`` and
``oracle_sql()`` list its registered queries.
"""

from __future__ import annotations


def queries():
    from . import registered
    return dict(registered.QUERIES)


def oracle_sql():
    from . import oracle
    return dict(oracle.ORACLE)
