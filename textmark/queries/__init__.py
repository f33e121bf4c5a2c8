"""Every operator as a query over the given tables, most with an SQL twin."""

from textmark.queries import (
    ensemble,
    features,
    files,
    guarded,
    learners,
    metrics,
    pages,
    sampling,
    scoring,
    text,
)
from textmark.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
