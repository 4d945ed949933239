"""Registry of named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..sources.portfolio import Portfolio
from .views import with_views

PortfolioQuery = Callable[[Portfolio], DataFrame]

QUERIES: dict[str, PortfolioQuery] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[PortfolioQuery], PortfolioQuery]:
    """Register a query; ``sql`` is its check on the same tables, where SQL can express it."""

    def register(fn: PortfolioQuery) -> PortfolioQuery:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = with_views(sql)
        return fn

    return register
