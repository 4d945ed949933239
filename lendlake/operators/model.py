"""Default model: fit by distributed Newton steps, and scoring as plain column arithmetic."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.linear import LinearIndex, Term
from ..functions.scalars import column, lookup, round_half_even, threshold_band
from . import features as ft
from .training import START_SHARE, TrainingRows

# Fixed values of the score bands and the audit record.
RISK_BANDS = [(0.50, "critical"), (0.20, "high"), (0.05, "medium")]
CALIBRATED_BANDS = [(0.10, "critical"), (0.04, "high"), (0.015, "medium")]
BAND_ORDER = ["critical", "high", "medium", "low"]
MODEL_VERSION = "logit_v1"
PD_DIGITS = 6
DECISION_THRESHOLD = 0.5


@column
def risk_band(pd: str = "predicted_pd") -> str:
    return threshold_band.sql(pd, RISK_BANDS, "low")


@column
def calibrated_band(pd: str = "calibrated_pd") -> str:
    return threshold_band.sql(pd, CALIBRATED_BANDS, "low")


@column
def band_rank(band: str = "risk_band") -> str:
    """1 for critical to 4 for low, 5 for anything else."""
    return lookup.sql(band, {b: i for i, b in enumerate(BAND_ORDER, 1)}, len(BAND_ORDER) + 1)


@dataclass(frozen=True)
class LinearModel:
    """Log-odds = intercept + sum of weights over raw numeric columns and category levels.

    The weights apply to unscaled inputs: a standardised coefficient b on (x - m) / s is the
    weight b / s with centre m. ``names`` gives each term's feature name.
    """

    index: LinearIndex
    names: Mapping[str, str]

    def log_odds(self) -> Column:
        return F.expr(self.index.raw_sql())

    def probability(self) -> Column:
        return F.expr(self.index.probability_sql())

    def score(self, df: DataFrame, name: str = "raw_pd") -> DataFrame:
        """P(default) of every row; runs inside code generation, without vectors or UDFs."""
        return df.withColumn(name, self.probability())

    def to_rows(self) -> list[tuple[str, str, float, float]]:
        rows = [("(intercept)", "", float(self.index.intercept), 0.0)]
        return rows + [
            (self.names.get(t.column, t.column), t.column, t.weight, t.center)
            for t in self.index.terms
        ]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.to_rows(), "feature string, expression string, weight double, center double"
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Store the weights as a table: fitted once, read by scoring, calibration, explanation."""
        self.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def read(spark: SparkSession, path: str) -> LinearModel:
        rows = spark.read.parquet(path).collect()  # one row per model term
        intercept = next(r["weight"] for r in rows if not r["expression"])
        terms = [r for r in rows if r["expression"]]
        return LinearModel(
            LinearIndex([Term(r["expression"], r["weight"], r["center"]) for r in terms], intercept),
            {r["expression"]: r["feature"] for r in terms},
        )


#: Units in the last place of the coefficients that count as met.
LAST_DIGITS = 4
#: From so many rows on, a fit begins where one in START_SHARE of them ends.
START_ROWS = 1 << 20


def frozen_model(weights: Mapping[str, float], intercept: float) -> LinearModel:
    """Model from given weights on raw numeric columns."""
    index = LinearIndex([Term(c, w) for c, w in weights.items()], intercept)
    return LinearModel(index, {c: f"num__{c}" for c in weights})


@dataclass(frozen=True)
class FittedModel:
    """A fitted model, and its coefficients on the scaled inputs (the intercept is the last)."""

    model: LinearModel
    names: Sequence[str]
    coefficients: Sequence[float]
    steps: int
    gradient: float

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = list(zip([*self.names, "(intercept)"], self.coefficients, strict=True))
        return spark.createDataFrame(rows, "feature string, coefficient double")


@dataclass(frozen=True)
class Design:
    """How a row becomes the vector of a fit: scaled numerics, one slot a level, and the constant."""

    numeric: Sequence[tuple[str, float, float]]  # column, mean, deviation
    levels: Sequence[tuple[str, Sequence[str]]]  # column, its levels

    @property
    def slots(self) -> list[tuple[str, str]]:
        return [(c, level) for c, levels in self.levels for level in levels]

    @property
    def width(self) -> int:
        return len(self.numeric) + len(self.slots) + 1


def _sums(design: Design, class_weight: Mapping[int, float], point: np.ndarray) -> Callable:
    """What a task adds to a Newton step: loss, gradient and Gram matrix of its blocks' rows, as (place, value).

    A nested function, so that it travels with the task and needs no package there.
    """
    numeric, levels, width = list(design.numeric), list(design.levels), design.width
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + width + len(upper[0]))
        for block in (b for batch in batches for b in batch.column(0)):
            rows = pa.ipc.open_stream(block.as_buffer()).read_next_batch()
            rows = rows.filter(rows.column("label").is_valid())
            if not rows.num_rows:
                continue
            x = np.ones((rows.num_rows, width), order="F")
            for k, (_, mean, deviation) in enumerate(numeric):
                x[:, k] = (rows.column(k).to_numpy(zero_copy_only=False) - mean) / deviation
            k = len(numeric)
            for j, (_, names) in enumerate(levels):
                text = rows.column(len(numeric) + j)
                code = text.indices.fill_null(-1).to_numpy(zero_copy_only=False)
                place = {level: i for i, level in enumerate(text.dictionary.to_pylist())}
                for level in names:
                    x[:, k] = code == place.get(level, -2)
                    k += 1
            y = rows.column("label").to_numpy(zero_copy_only=False).astype(float)
            weight = np.where(y > 0.5, class_weight[1], class_weight[0])
            odds = x @ point
            chance = 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))
            total[0] += (weight * (np.logaddexp(0, odds) - y * odds)).sum()
            total[1 : 1 + width] += x.T @ (weight * (chance - y))
            total[1 + width :] += (x.T @ (x * (weight * chance * (1 - chance))[:, None]))[upper]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"])

    return run


def _newton(
    blocks: DataFrame, design: Design, class_weight: Mapping[int, float], penalty: float, max_steps: int, tol: float, start: np.ndarray | None = None
):
    """Coefficients at the least penalised loss. A step is one grouped sum over the rows; its size is the features' squared.

    The gradient of many rows can't vanish below what the last digit of a coefficient makes of it;
    steps end there, however small ``tol`` is.
    """
    width = design.width
    upper = np.triu_indices(width)
    shrink = np.full(width, penalty)
    shrink[-1] = 0.0  # the constant is free

    def at(point: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        parts = blocks.mapInArrow(_sums(design, class_weight, point), "place long, value double")
        got = parts.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
        total = np.zeros(1 + width + len(upper[0]))
        total[got.column("place").to_numpy()] = got.column("value").to_numpy()
        gram = np.zeros((width, width))
        gram[upper] = total[1 + width :]
        gram = gram + gram.T - np.diag(np.diag(gram))
        return total[0] + 0.5 * (shrink * point**2).sum(), total[1 : 1 + width] + shrink * point, gram + np.diag(shrink)

    def open_at(point: np.ndarray, gradient: np.ndarray, gram: np.ndarray) -> bool:
        digits = LAST_DIGITS * np.finfo(float).eps * (np.abs(gram) @ np.abs(point))
        return bool((np.abs(gradient) > np.maximum(tol, digits)).any())

    point = np.zeros(width) if start is None else start
    loss, gradient, gram = at(point)
    steps = 0
    while steps < max_steps and open_at(point, gradient, gram):
        move = np.linalg.lstsq(gram, gradient, rcond=None)[0]
        while True:  # halve a step that overshoots
            steps += 1
            loss_there, gradient_there, gram_there = at(point - move)
            if loss_there <= loss + 1e-12 * abs(loss) or steps >= max_steps:
                break
            move = move / 2
        point, loss, gradient, gram = point - move, loss_there, gradient_there, gram_there
    return point, steps, float(np.abs(gradient).max())


def fit_default_model(
    train: DataFrame | TrainingRows,
    numeric: Sequence[str] = tuple(ft.NUMERIC_FEATURES),
    categorical: Sequence[str] = tuple(ft.CATEGORICAL_FEATURES),
    target: str = ft.TARGET,
    inverse_regularization: float = 1.0,
    max_steps: int = 100,
    tol: float = 1e-7,
) -> FittedModel:
    """Class-balanced L2 logistic regression on standardised numerics and one-hot categories, by Newton steps.

    The least of ``sum(weight * loss) + |coefficients|^2 / (2 C)``, the constant left out of the
    penalty; ``tol`` bounds the largest entry of its gradient. Weights are n / (2 rows of the
    class), the scaling uses population deviations. A frame is read once, to pack its rows; rows that
    were packed before keep the columns they were packed with. Every step reads the blocks once;
    what comes back is a sum for each pair of features, however many the rows.
    """
    rows = train if isinstance(train, TrainingRows) else TrainingRows.of(train, numeric, categorical, target, START_SHARE)
    rows.require_complete()
    design = Design([(c, *rows.moments[c]) for c in rows.numeric], [(c, list(rows.levels[c])) for c in rows.categorical])
    n = rows.ones + rows.zeros
    class_weight = {k: n / (2.0 * of_class) if of_class else 0.0 for k, of_class in ((0, rows.zeros), (1, rows.ones))}
    penalty, start = 1.0 / inverse_regularization, None
    if n >= START_ROWS:
        few = rows.blocks.select("share")
        start, *_ = _newton(few, design, class_weight, penalty / rows.share, max_steps, tol * n)
    point, steps, gradient = _newton(rows.blocks.select("rows"), design, class_weight, penalty, max_steps, tol, start)
    terms, names = [], {}
    for (c, mean, deviation), b in zip(design.numeric, point):
        terms.append(Term(c, float(b) / deviation, mean))
        names[c] = f"num__{c}"
    for (c, level), b in zip(design.slots, point[len(design.numeric) :]):
        column = rows.indicator(c, level)
        terms.append(Term(column, float(b)))
        names[column] = f"cat__{c}_{level}"
    model = LinearModel(LinearIndex(terms, float(point[-1])), names)
    return FittedModel(model, list(names.values()), [float(b) for b in point], steps, gradient)


def audit_records(scored: DataFrame, pd: str = "raw_pd", version: str = MODEL_VERSION) -> DataFrame:
    """Audit rows of scored account-months, without their surrogate id.

    The band belongs to the unrounded probability; the stored probability is rounded after.
    Driver columns are empty until the explanation step, and the governance flags have no
    logic behind them.
    """
    keys = [c for c in ("account_month_id", "account_id", "customer_id", "month") if c in scored.columns]
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    return scored.select(
        *keys,
        F.lit(version).alias("model_version"),
        round_half_even(pd, PD_DIGITS).alias("predicted_pd"),
        risk_band(pd).alias("risk_band"),
        text.alias("top_shap_feature_1"),
        number.alias("top_shap_value_1"),
        text.alias("top_shap_feature_2"),
        number.alias("top_shap_value_2"),
        F.lit(0.0).alias("psi_score"),
        F.lit(False).alias("drift_alert_flag"),
        F.lit(False).alias("fairness_alert_flag"),
        F.lit(False).alias("override_flag"),
    )
