"""Population Stability Index of numeric features and of category mixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import column, round_half_up, threshold_band
from ..sources.dimensions import literal_frame
from .ordering import cells_of, quantiles_in

# Fixed values of the drift rules.
EMPTY_SHARE = 0.0001
DRIFT_LEVELS = [(0.25, "significant_drift"), (0.10, "moderate_drift")]
PSI_DIGITS = 6
DRIFT_FEATURES = [
    "fico_score",
    "credit_utilization",
    "utilization_rate",
    "annual_income",
    "cashflow_stress_score",
    "behavioral_risk_score",
    "delinquencies_12m",
]
PERIODS = ("early_baseline_months", "late_baseline_months")


@column
def drift_level(psi: str = "psi_score") -> str:
    return threshold_band.sql(psi, DRIFT_LEVELS, "stable", null_label="not_available")


def midpoint_month(df: DataFrame, month: str = "month") -> DataFrame:
    """One row: the middle one of the distinct months (the later of two middle ones)."""
    months = F.sort_array(F.collect_set(month))
    return df.agg(months.alias("m")).select(
        F.element_at("m", (F.size("m") / 2).cast("int") + 1).alias("midpoint_month")
    )


def with_period(df: DataFrame, name: str = "is_reference", month: str = "month") -> DataFrame:
    """Split at the midpoint month: True before it, False from it on. The month is found once, from its column alone."""
    return df.withColumn(name, F.col(month) < F.lit(midpoint_month(df, month).first()[0]))


def _index(counts: DataFrame, by: str) -> DataFrame:
    """PSI per feature from (feature, bin, ref, cur) counts; counts are a few rows per feature."""
    of_feature = Window.partitionBy(by)
    shares = counts.select(
        by,
        *[
            F.try_divide(F.col(side), F.sum(side).over(of_feature)).alias(side)
            for side in ("ref", "cur")
        ],
    )
    filled = shares.select(
        by,
        *[F.when(F.col(s) == 0, EMPTY_SHARE).otherwise(F.col(s)).alias(s) for s in ("ref", "cur")],
    )
    index = round_half_up("sum((cur - ref) * ln(cur / ref))", PSI_DIGITS)
    return filled.groupBy(by).agg(index.alias("psi_score"))


def psi(
    df: DataFrame, features: Sequence[str], is_reference: str = "is_reference", buckets: int = 10
) -> DataFrame:
    """PSI of each numeric feature, reference rows against current rows.

    Bins come from the reference quantiles; current values outside the reference range are
    left out and shares are over the rest. A feature with fewer than two bins, or with an
    empty side, has no PSI. Both periods of all features are counted in the cells of the same
    two passes that find the quantiles, and the bins are made of those cells.
    """
    spark = df.sparkSession
    probs = [i / buckets for i in range(buckets + 1)]
    cells = cells_of(df, features, probs, is_reference)
    borders = {f: sorted({q for q in qs if q is not None}) for f, qs in quantiles_in(cells, probs).items()}
    usable = {f: b for f, b in borders.items() if len(b) >= 3}
    names = literal_frame(spark, feature_name=list(features))
    if not usable:
        return names.withColumn("psi_score", F.lit(None).cast("double"))
    upto = cells.upto(usable)
    lowest = cells.at({f: b[0] for f, b in usable.items()})
    rows = []
    for f, b in usable.items():
        for k in range(1, len(b)):
            counts = [upto[f, b[k]][s] - upto[f, b[k - 1]][s] + (lowest[f][s] if k == 1 else 0) for s in (0, 1)]
            rows.append((f, k, *counts))
    # one row per feature and bin
    full = literal_frame(spark, **dict(zip(("feature_name", "bin", "ref", "cur"), map(list, zip(*rows)), strict=True)))
    return names.join(F.broadcast(_index(full, "feature_name")), "feature_name", "left")


def mix_shift(df: DataFrame, features: Sequence[str], is_reference: str = "is_reference") -> DataFrame:
    """PSI of category mixes: one bin per level that occurs in either period."""
    counted = (
        df.select(
            F.col(is_reference).alias("_ref"),
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(f).alias("feature_name"), F.col(f).cast("string").alias("bin"))
                        for f in features
                    ]
                )
            ),
        )
        .where(F.col("bin").isNotNull())
        .groupBy("feature_name", "bin")
        .agg(F.count_if("_ref").alias("ref"), F.count_if(~F.col("_ref")).alias("cur"))
    )
    return _index(counted, "feature_name")


def drift_table(psi_scores: DataFrame, periods: tuple[str, str] = PERIODS) -> DataFrame:
    """Stored form of the drift scores, with period labels and levels."""
    return psi_scores.select(
        "feature_name",
        F.lit(periods[0]).alias("reference_period"),
        F.lit(periods[1]).alias("current_period"),
        "psi_score",
        drift_level().alias("drift_level"),
    )
