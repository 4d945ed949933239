"""The model's life-cycle as one path: split, fit, score, calibrate, explain, compare."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import staged
from . import features as ft
from .calibrate import apply_isotonic, fit_isotonic, score_groups, with_calibration
from .evaluate import compare_scores
from .explain import background_means, with_top_drivers
from .model import FittedModel, fit_default_model, risk_band
from .training import TrainingRows

PARTS = {"train": 0.60, "calibration": 0.20, "test": 0.20}


@dataclass(frozen=True)
class FittedRun:
    """A fitted model and calibrator, with the data set's scored rows (``part`` tells the slice of a row)."""

    fitted: FittedModel
    calibrator: IsotonicRegressionModel
    background: Mapping[str, float]
    scored: DataFrame

    def audit(self) -> DataFrame:
        """Every row with raw and calibrated probability, both bands, and its two strongest drivers."""
        calibrated = with_calibration(self.scored).withColumn("risk_band", risk_band("raw_pd"))
        return with_top_drivers(calibrated, self.fitted.model, self.background)

    def held_out(self, target: str = ft.TARGET) -> DataFrame:
        """AUC and Brier score of the raw and the calibrated probability on the test slice."""
        test = self.scored.where(F.col("part") == "test").select(
            target, F.col("raw_pd"), F.col("raw_calibrated_pd").alias("calibrated_pd")
        )
        return compare_scores(staged(test, "test-scores"), ["raw_pd", "calibrated_pd"], target)


def run_lifecycle(
    dataset: DataFrame,
    key: Sequence[str],
    numeric: Sequence[str] = tuple(ft.NUMERIC_FEATURES),
    categorical: Sequence[str] = tuple(ft.CATEGORICAL_FEATURES),
    target: str = ft.TARGET,
    parts: Mapping[str, float] = PARTS,
) -> FittedRun:
    """Fit on the training slice, calibrate on the calibration slice, score all rows.

    The slices come from the key's hash, so a row is in the same one in every run. The
    calibrator learns from the exact raw scores.
    """
    split = ft.hash_split(dataset, key, parts)
    train = TrainingRows.of(split.where(F.col("part") == "train"), numeric, categorical, target)
    fitted = fit_default_model(train)
    raw = fitted.model.score(split)
    learned = raw.where(F.col("part") == "calibration").select("raw_pd", target)
    calibrator = fit_isotonic(staged(score_groups(learned, "raw_pd", target), "score-groups"))
    scored = apply_isotonic(raw, calibrator, "raw_pd", "raw_calibrated_pd")
    return FittedRun(fitted, calibrator, background_means(train, fitted.model), scored)
