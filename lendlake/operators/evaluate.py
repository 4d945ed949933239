"""Model evaluation as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import column, literal, rate, round_half_up, rounded_mean
from .model import DECISION_THRESHOLD
from .ordering import quantile_buckets, rank_auc


@column
def predicted_label(score: str, threshold: float = DECISION_THRESHOLD) -> str:
    return f"if({score} > {literal(threshold)}, 1, 0)"


def _cells(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """One row with the four counts n<actual><predicted>, from one aggregation."""
    return df.selectExpr(
        *[
            f"count_if(cast({label} as int) = {a} and {predicted} = {p}) as n{a}{p}"
            for a in (0, 1)
            for p in (0, 1)
        ]
    )


def confusion_matrix(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """All four cells, also the empty ones; ``predicted`` is expression text."""
    rows = [
        f"named_struct('actual', {a}, 'predicted', {p}, 'rows', n{a}{p})" for a in (0, 1) for p in (0, 1)
    ]
    return _cells(df, label, predicted).selectExpr(f"inline(array({', '.join(rows)}))")


def _ratio(a: str, b: str) -> str:
    return f"coalesce(try_divide(cast({a} as double), {b}), 0.0D)"


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both averages."""
    rates = _cells(df, label, predicted).selectExpr(
        "*",
        f"{_ratio('n00', 'n00 + n10')} as p0",
        f"{_ratio('n11', 'n11 + n01')} as p1",
        f"{_ratio('n00', 'n00 + n01')} as r0",
        f"{_ratio('n11', 'n11 + n10')} as r1",
        "n00 + n01 as s0",
        "n10 + n11 as s1",
    )
    scores = rates.selectExpr("*", *[f"{_ratio(f'2 * p{k} * r{k}', f'p{k} + r{k}')} as f{k}" for k in (0, 1)])
    measures = ("p", "r", "f")
    accuracy = _ratio("n00 + n11", "s0 + s1")
    lines = [
        ("0", [f"{m}0" for m in measures], "s0"),
        ("1", [f"{m}1" for m in measures], "s1"),
        ("accuracy", [accuracy] * 3, "s0 + s1"),
        ("macro avg", [f"(({m}0 + {m}1) / 2)" for m in measures], "s0 + s1"),
        ("weighted avg", [_ratio(f"({m}0 * s0 + {m}1 * s1)", "s0 + s1") for m in measures], "s0 + s1"),
    ]
    rows = [
        f"named_struct('class', '{name}', "
        + ", ".join(
            f"'{k}', {round_half_up.sql(v, 4)}" for k, v in zip(("precision", "recall", "f1_score"), values)
        )
        + f", 'support', {support})"
        for name, values, support in lines
    ]
    return scores.selectExpr(f"inline(array({', '.join(rows)}))")


def decile_table(df: DataFrame, score: str, label: str, buckets: int = 10) -> DataFrame:
    """Rows, outcome rate and mean score per quantile bucket, highest bucket first."""
    return (
        quantile_buckets(df, score, buckets, "risk_decile")
        .groupBy("risk_decile")
        .agg(
            F.count(label).alias("accounts"),
            rate(label).alias("default_rate"),
            rounded_mean(score).alias("avg_predicted_pd"),
        )
        .orderBy(F.desc("risk_decile"))
    )


@column
def brier_score(score: str, label: str) -> str:
    """Mean squared error of a probability (an aggregate)."""
    gap = f"({score} - cast({label} as int))"
    return f"avg({gap} * {gap})"


def compare_scores(df: DataFrame, scores: Sequence[str], label: str) -> DataFrame:
    """AUC and Brier score of several probabilities of the same rows, side by side."""
    long = df.select(
        F.col(label),
        F.inline(
            F.array(*[F.struct(F.lit(s).alias("measure"), F.col(s).alias("pd")) for s in scores])
        ),
    )
    brier = long.groupBy("measure").agg(round_half_up(brier_score.sql("pd", label), 6).alias("brier"))
    auc = rank_auc(long, "pd", label, ["measure"]).select(
        "measure", round_half_up("auc", 6).alias("auc")
    )
    return auc.join(F.broadcast(brier), "measure")  # one row per score on both sides


def calibration_curve(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Mean score and outcome rate in equal-width score bins that have rows."""
    bin_no = F.expr(f"cast(least(floor({score} * {bins}), {bins - 1}) as int) + 1")
    return df.groupBy(bin_no.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"),
        rounded_mean(score).alias("avg_predicted_pd"),
        rate(label).alias("actual_default_rate"),
    )


def monotonic_check(groups: DataFrame, order: str, value: str) -> DataFrame:
    """Marks groups whose value is below the one of the group before (groups are few)."""
    prev = F.lag(value).over(Window.orderBy(order))
    return groups.select(
        order, value, F.coalesce(F.col(value) >= prev, F.lit(True)).alias("in_order")
    )
