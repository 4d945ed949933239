"""Feature lists, stratified hash splits, scaling, one-hot columns and class weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import column, literal

# The model's features and target.
NUMERIC_FEATURES = [
    "current_balance",
    "available_credit",
    "utilization_rate",
    "minimum_payment_due",
    "actual_payment_amount",
    "days_past_due",
    "cashflow_stress_score",
    "behavioral_risk_score",
    "macro_stress_score",
    "credit_limit",
    "interest_rate",
    "origination_fico",
    "origination_income",
    "origination_dti",
    "age",
    "annual_income",
    "monthly_income",
    "baseline_fico",
    "baseline_dti",
    "baseline_financial_resilience",
    "employment_stability_score",
    "fico_score",
    "total_debt_balance",
    "total_credit_limit",
    "credit_utilization",
    "num_open_accounts",
    "num_recent_inquiries",
    "delinquencies_12m",
]
CATEGORICAL_FEATURES = [
    "product_type",
    "risk_tier_at_origination",
    "employment_type",
    "income_band",
    "education_level",
    "bankruptcy_flag",
]
TARGET = "default_flag"

HASH_PREFIX = 4  # hex digits
HASH_RANGE = 16**HASH_PREFIX


# --- splits -----------------------------------------------------------------


def row_hash(key: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key]))


def hash_split(
    df: DataFrame, key: Sequence[str], weights: Mapping[str, float], name: str = "part"
) -> DataFrame:
    """Assign every row to a split by its key's hash: no shuffle, and the same after a re-run.

    The hash is independent of the target, so every stratum is divided in the same shares.
    """
    prefix = F.substring(row_hash(key), 1, HASH_PREFIX)
    *inner, last = weights
    out, upto = None, 0.0
    for part in inner:
        upto += weights[part]
        cond = prefix < f"{round(upto * HASH_RANGE):0{HASH_PREFIX}x}"
        out = F.when(cond, part) if out is None else out.when(cond, part)
    return df.withColumn(name, F.lit(last) if out is None else out.otherwise(last))


def stratified_split(
    df: DataFrame,
    target: str,
    key: Sequence[str],
    weights: Mapping[str, float],
    name: str = "part",
) -> DataFrame:
    """Split with exact quotas: in every stratum the rows with the smallest key hashes go first.

    Materialise an expensive input first, because it is read three times. Ranking a whole
    stratum would put it in one task. Hash prefixes are counted instead; a
    prefix whose rows all fall on one side of every quota is decided by its count alone, and
    only the few prefixes that a quota cuts through are ranked.
    """
    hashed = df.withColumn("_hash", row_hash(key)).withColumn(
        "_prefix", F.substring("_hash", 1, HASH_PREFIX)
    )
    ordered = Window.partitionBy(target).orderBy("_prefix")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    prefixes = (
        hashed.groupBy(target, "_prefix")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy(target)))
    )
    *inner, last = weights
    quotas, upto = [], 0.0
    for part in inner:
        upto += weights[part]
        quotas.append((part, F.floor(F.col("_total") * upto + 0.5)))

    def part_at(position: Column) -> Column:
        out = None
        for part, quota in quotas:
            out = F.when(position < quota, part) if out is None else out.when(position < quota, part)
        return F.lit(last) if out is None else out.otherwise(last)

    first, final = part_at(F.col("_start")), part_at(F.col("_start") + F.col("_n") - 1)
    # strata x 65,536 prefixes at most, so this side has a fixed size bound
    decided = F.broadcast(
        prefixes.withColumn("_whole", first == final).withColumn("_first", first).drop("_n")
    )
    placed = hashed.join(decided, [target, "_prefix"])
    in_prefix = Window.partitionBy(target, "_prefix").orderBy("_hash", *key)
    cut = (
        placed.where(~F.col("_whole"))
        .withColumn("_pos", F.col("_start") + F.row_number().over(in_prefix) - 1)
        .withColumn(name, part_at(F.col("_pos")))
    )
    whole = placed.where("_whole").withColumn(name, F.col("_first"))
    return whole.select(*df.columns, name).unionByName(cut.select(*df.columns, name))


# --- scaling and encoding ---------------------------------------------------


def population_moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column: one pass, one row.

    A constant column gets deviation 1, so scaling it gives zeros instead of a division by zero.
    """
    row = df.selectExpr(
        *[f"avg({c}) as m_{c}" for c in cols], *[f"stddev_pop({c}) as s_{c}" for c in cols]
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in cols}


@column
def standardized(c: str, moments: Mapping[str, tuple[float, float]]) -> str:
    mean, std = moments[c]
    return f"(({c} - {literal(float(mean))}) / {literal(float(std))})"


def category_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Categories as text; booleans read True / False."""
    kinds = dict(df.dtypes)
    return df.withColumns(
        {
            c: F.initcap(F.col(c).cast("string")) if kinds[c] == "boolean" else F.col(c).cast("string")
            for c in cols
        }
    )


def one_hot_encoder(cols: Sequence[str]) -> Pipeline:
    """One slot per known level in alphabetical order; unknown and NULL give all zeros."""
    indexer = StringIndexer(
        inputCols=list(cols),
        outputCols=[f"{c}__level" for c in cols],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    encoder = OneHotEncoder(
        inputCols=[f"{c}__level" for c in cols],
        outputCols=[f"{c}__hot" for c in cols],
        dropLast=True,
    )
    return Pipeline(stages=[indexer, encoder])


def levels_of(encoder_model, cols: Sequence[str]) -> dict[str, list[str]]:
    return dict(zip(cols, map(list, encoder_model.stages[0].labelsArray)))


def assembler(numeric: Sequence[str], categorical: Sequence[str], out: str = "features") -> VectorAssembler:
    """Numeric columns, then the one-hot slots; a NULL input is an error."""
    return VectorAssembler(
        inputCols=[*numeric, *[f"{c}__hot" for c in categorical]], outputCol=out, handleInvalid="error"
    )


def class_weights(df: DataFrame, target: str = TARGET) -> DataFrame:
    """One row per class: rows, and the balanced weight n / (classes x rows of the class)."""
    everything = Window.partitionBy()
    return (
        df.groupBy(F.col(target).cast("int").alias("label"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            "label",
            "rows",
            (F.sum("rows").over(everything) / (F.count("label").over(everything) * F.col("rows"))).alias(
                "weight"
            ),
        )
    )


def with_class_weight(df: DataFrame, target: str = TARGET, name: str = "weight") -> DataFrame:
    """Balanced weight of every row; the two-row weight table is broadcast."""
    table = class_weights(df, target).select(
        F.col("label").alias("_label"), F.col("weight").alias(name)
    )
    return df.join(F.broadcast(table), F.col(target).cast("int") == F.col("_label")).drop("_label")
