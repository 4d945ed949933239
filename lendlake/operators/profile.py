"""Descriptive statistics: frequencies, numeric profiles, many-column means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import literal, round_half_up, rounded_mean
from .ordering import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def frequencies(df: DataFrame, col: str) -> DataFrame:
    """Count and share of each value; NULL is left out."""
    counted = df.groupBy(col).agg(F.count(col).alias("rows")).where(F.col("rows") > 0)
    total = counted.agg(F.sum("rows")).scalar()
    return counted.withColumn("_total", total).select(
        col, "rows", round_half_up("(rows / _total)", 6).alias("share")
    )


def numeric_profile(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum of each column, one row each."""
    quartiles = exact_quantiles(df, cols, QUARTILES)
    measures = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    one = df.selectExpr(
        *[f"count({c}) as count_{c}" for c in cols],
        *[f"{f}({c}) as {name}_{c}" for c in cols for name, f in measures.items()],
    )

    def entry(c: str) -> str:
        values = {
            "mean": f"mean_{c}",
            "std": f"std_{c}",
            "min": f"min_{c}",
            **{n: f"cast({literal(q)} as double)" for n, q in zip(("q25", "q50", "q75"), quartiles[c])},
            "max": f"max_{c}",
        }
        rounded = [f"'{n}', {round_half_up.sql(v, digits)}" for n, v in values.items()]
        return f"named_struct('column_name', '{c}', 'count', count_{c}, {', '.join(rounded)})"

    return one.selectExpr(f"inline(array({', '.join(map(entry, cols))}))")


def group_means(df: DataFrame, by: Sequence[str], cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Means of many columns; booleans count as 0 and 1."""
    kinds = dict(df.dtypes)
    value = {c: f"cast({c} as int)" if kinds[c] == "boolean" else c for c in cols}
    return df.groupBy(*by).agg(
        *[rounded_mean(v, digits).alias(f"avg_{c}") for c, v in value.items()]
    )


def group_maxima(df: DataFrame, by: Sequence[str], cols: Sequence[str], digits: int = 4) -> DataFrame:
    return df.groupBy(*by).agg(*[round_half_up(f"max({c})", digits).alias(f"max_{c}") for c in cols])
