"""Operations of a training-data pipeline, one module each.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries when it can be imported.
"""

from __future__ import annotations

from .queries import ORACLE_SQL, QUERIES

__all__ = ["queries", "oracle_sql"]


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE_SQL)
