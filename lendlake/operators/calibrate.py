"""Isotonic calibration of default probabilities and its write-back."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import first_match, literal, round_half_even
from ..sources.slices import SlicedTable
from .model import PD_DIGITS, calibrated_band


def score_groups(df: DataFrame, score: str, label: str) -> DataFrame:
    """Rows and outcome rate per exact score."""
    return df.groupBy(F.col(score).alias("score")).agg(
        F.expr("cast(count(*) as double)").alias("weight"),
        F.expr(f"avg(cast({label} as int))").alias("outcome"),
    )


def fit_isotonic(groups: DataFrame) -> IsotonicRegressionModel:
    """Monotone fit on grouped scores. Its last step runs in one task, on groups only."""
    return IsotonicRegression(
        featuresCol="score", labelCol="outcome", weightCol="weight", isotonic=True
    ).fit(groups)


def apply_isotonic(df: DataFrame, model: IsotonicRegressionModel, score: str, name: str) -> DataFrame:
    """Interpolated calibrated value, clipped outside the fitted range."""
    return (
        model.copy()
        .setFeaturesCol(score)
        .setPredictionCol(name)
        .transform(df)
    )


@dataclass(frozen=True)
class Curve:
    """A stored calibration curve with few knots, applied as a column expression."""

    knots: Sequence[tuple[float, float]]

    def value_sql(self, score: str) -> str:
        """Linear interpolation between the knots, constant outside them."""
        (x0, y0), (xn, yn) = self.knots[0], self.knots[-1]
        cases = [(f"{score} <= {literal(x0)}", literal(y0))]
        for (xa, ya), (xb, yb) in zip(self.knots, self.knots[1:]):
            slope = literal((yb - ya) / (xb - xa))
            line = f"{literal(ya)} + ({score} - {literal(xa)}) * {slope}"
            cases.append((f"{score} <= {literal(xb)}", line))
        return first_match.sql([*cases, (f"{score} > {literal(xn)}", literal(yn))])

    def value(self, score: str) -> Column:
        return F.expr(self.value_sql(score))


def with_calibration(df: DataFrame, calibrated: str = "raw_calibrated_pd") -> DataFrame:
    """Stored calibrated probability and its band (band first, rounding after)."""
    return df.withColumns(
        {
            "calibrated_pd": round_half_even(calibrated, PD_DIGITS),
            "calibrated_risk_band": calibrated_band(calibrated),
        }
    )


def write_calibration(table: SlicedTable, calibrated: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """Write calibrated values back to one model version's slice of the audit table."""
    columns = {"calibrated_pd": "double", "calibrated_risk_band": "string"}
    return table.update(calibrated.select(*key, *columns), version, key, columns)
