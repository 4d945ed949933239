"""All named queries and their checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.store import StoredPortfolio
from . import contract, model_queries, report_queries, rule_queries, table_queries  # noqa: F401  (register)
from .registry import CHECKS, QUERIES


def _on_folder(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(StoredPortfolio(spark, folder))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _on_folder(fn) for name, fn in QUERIES.items()}


def checks() -> dict[str, str]:
    return dict(CHECKS)
