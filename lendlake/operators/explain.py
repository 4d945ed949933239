"""Linear attribution of a score to its features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import round_half_even
from ..sources.slices import SlicedTable
from .model import LinearModel
from .training import TrainingRows

DRIVER_COLUMNS = {
    "top_shap_feature_1": "string",
    "top_shap_value_1": "double",
    "top_shap_feature_2": "string",
    "top_shap_value_2": "double",
}
VALUE_DIGITS = 6


def background_means(background: DataFrame | TrainingRows, model: LinearModel) -> dict[str, float]:
    """Mean of every model input over the background rows: one pass, one row (packed rows were summed when they were packed)."""
    columns = [t.column for t in model.index.terms]
    if isinstance(background, TrainingRows):
        means = background.means()
        return {c: means[c] for c in columns}
    row = background.selectExpr(*[f"avg({c}) as m{i}" for i, c in enumerate(columns)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(columns)}


def contributions(model: LinearModel, means: dict[str, float]) -> Column:
    """Array of (size, name, value): weight x (input - background mean), on the log-odds scale."""
    return model.index.contributions(means, model.names)


def top_by_size(parts: Column, rank: int) -> Column:
    """The rank-th largest entry by absolute value; equal sizes are ordered by name."""
    return F.element_at(F.sort_array(parts, asc=False), rank)


def with_top_drivers(df: DataFrame, model: LinearModel, means: dict[str, float]) -> DataFrame:
    """The two strongest drivers of every row; a column expression, so all rows can have it.

    The strongest is the greatest entry, so rows are only sorted where the second is read too.
    """
    parts = contributions(model, means)
    ranked = df.withColumn("_strongest", F.array_max(parts)).withColumn("_drivers", F.sort_array(parts, asc=False))
    out = []
    for k, driver in enumerate(("_strongest", "_drivers[1]"), 1):
        value = round_half_even.sql(f"{driver}.value", VALUE_DIGITS)
        out += [f"{driver}.name as top_shap_feature_{k}", f"{value} as top_shap_value_{k}"]
    return ranked.selectExpr("*", *out).drop("_strongest", "_drivers")


def write_drivers(table: SlicedTable, explained: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """Write the drivers back to one model version's slice of the audit table."""
    return table.update(explained.select(*key, *DRIVER_COLUMNS), version, key, DRIVER_COLUMNS)
