"""Parameterised portfolio reports over tables in the contract's shape.

A filter value of ``"all"`` (or None) means no filter. Rate and mean columns are rounded as
the reports show them. Accounts are only joined when a product filter needs them: the
contract's foreign key (see the reference audit) makes the unfiltered join keep every row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    NO_FILTER,
    equals_or_all,
    feature_label,
    percent_text,
    portfolio_filter,
    rate,
    round_half_up,
    rounded_mean,
)
from ..operators.model import MODEL_VERSION, band_rank
from ..operators.ordering import top_wide_rows
from ..sources.tables import row_count

RATE_METRICS = ["default_rate", "chargeoff_rate", "avg_cashflow_stress", "avg_behavioral_risk"]
PAYMENT_METRICS = ["missed_payment_rate", "partial_payment_rate", "late_payment_rate"]
BAND_METRICS = ["avg_predicted_pd", "actual_default_rate"]
PRODUCT_METRICS = ["default_rate", "avg_utilization"]
JOIN_KEY = ("account_month_id",)

# Headings of the account spotlight and texts of the takeaways.
SPOTLIGHT_HEADINGS = {
    "account_id": "Account ID",
    "customer_id": "Customer ID",
    "product_type": "Product",
    "risk_band": "Risk Band",
    "calibrated_pd": "Calibrated PD",
    "calibrated_risk_band": "Calibrated Risk Band",
    "predicted_pd": "Predicted PD",
    "default_flag": "Actual Default",
    "utilization_rate": "Utilization Rate",
    "fico_score": "FICO Score",
    "cashflow_stress_score": "Cashflow Stress Score",
    "behavioral_risk_score": "Behavioral Risk Score",
    "top_shap_feature_1": "Top Driver 1",
    "top_shap_value_1": "Top Driver 1 SHAP Value",
    "top_shap_feature_2": "Top Driver 2",
    "top_shap_value_2": "Top Driver 2 SHAP Value",
}
SCENARIO_MESSAGES = {
    "baseline": "The selected baseline scenario represents normal portfolio behavior.",
    "severe_credit_stress": (
        "The selected stress scenario shows elevated borrower pressure compared with "
        "baseline conditions."
    ),
}
ALL_PRODUCTS_MESSAGE = "The view covers the full account portfolio."
OTHER_SCENARIO_MESSAGE = "The selected scenario is {}."
ONE_PRODUCT_MESSAGE = "The view is focused on `{}` accounts."
DEFAULT_RISK_MESSAGE = "The selected view has a default rate of {}."
CASHFLOW_MESSAGE = "The average borrower cashflow stress score is {}."
INTERPRETATION_MESSAGE = (
    "Higher stress, utilization, and lower FICO scores are associated with higher "
    "model-predicted default risk."
)
# End of the fixed values.


def _where(df: DataFrame, *predicates: Column | None) -> DataFrame:
    for p in predicates:
        if p is not None:
            df = df.where(p)
    return df


def _of_product(facts: DataFrame, accounts: DataFrame | None, product: str | None) -> DataFrame:
    """Facts of one product's accounts; unfiltered facts pass through without a join."""
    if product in NO_FILTER:
        return facts
    chosen = accounts.where(F.col("product_type") == product).select("account_id")
    return facts.join(chosen, "account_id", "left_semi")


def _rows(name: str = "rows") -> Column:
    return F.count(F.lit(1)).alias(name)


# --- sizes and options ------------------------------------------------------


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [row_count(df, name) for name, df in tables.items()])


def options(df: DataFrame, col: str, with_all: bool = False) -> DataFrame:
    """Sorted distinct values for a filter; ``all`` comes first where the filter is optional."""
    values = df.select(F.col(col).alias("option")).distinct().withColumn("_first", F.lit(1))
    if with_all:
        head = df.sparkSession.range(1).select(F.lit("all").alias("option"), F.lit(0).alias("_first"))
        values = head.unionByName(values)
    return values.orderBy("_first", F.asc_nulls_last("option")).drop("_first")


def portfolio_size(accounts: DataFrame, product: str | None = None) -> DataFrame:
    return accounts.where(portfolio_filter(product)).agg(
        F.count_distinct("customer_id").alias("customers"), _rows("accounts")
    )


def portfolio_composition(accounts: DataFrame, product: str | None = None) -> DataFrame:
    return (
        accounts.where(portfolio_filter(product))
        .groupBy("product_type")
        .agg(
            _rows("accounts"),
            F.count_distinct("customer_id").alias("customers"),
            rounded_mean("credit_limit", 2).alias("avg_credit_limit"),
            rounded_mean("interest_rate").alias("avg_interest_rate"),
        )
        .orderBy(F.desc("accounts"), "product_type")
    )


# --- scenario reports -------------------------------------------------------


def _scenario_metrics() -> list[Column]:
    return [
        rate("default_flag").alias("default_rate"),
        rate("chargeoff_flag").alias("chargeoff_rate"),
        rounded_mean("cashflow_stress_score").alias("avg_cashflow_stress"),
        rounded_mean("behavioral_risk_score").alias("avg_behavioral_risk"),
        rounded_mean("macro_stress_score").alias("avg_macro_stress"),
    ]


def scenario_risk(
    snapshots: DataFrame,
    accounts: DataFrame | None = None,
    product: str | None = None,
    scenario: str | None = None,
) -> DataFrame:
    """Risk by scenario, for all scenarios or a selected one, riskiest first."""
    facts = _where(snapshots, equals_or_all("scenario_id", scenario))
    return (
        _of_product(facts, accounts, product)
        .groupBy("scenario_id")
        .agg(_rows(), *_scenario_metrics())
        .orderBy(F.desc("default_rate"), "scenario_id")
    )


def scenario_kpis(
    snapshots: DataFrame, scenario: str, accounts: DataFrame | None = None, product: str | None = None
) -> DataFrame:
    facts = snapshots.where(F.col("scenario_id") == scenario)
    return _of_product(facts, accounts, product).agg(
        rate("default_flag").alias("selected_default_rate"),
        rate("chargeoff_flag").alias("selected_chargeoff_rate"),
        rounded_mean("cashflow_stress_score").alias("selected_cashflow_stress"),
    )


def default_trend(
    snapshots: DataFrame, accounts: DataFrame | None = None, product: str | None = None
) -> DataFrame:
    return (
        _of_product(snapshots, accounts, product)
        .groupBy("month", "scenario_id")
        .agg(
            rate("default_flag").alias("default_rate"),
            rate("chargeoff_flag").alias("chargeoff_rate"),
            rounded_mean("cashflow_stress_score").alias("avg_cashflow_stress"),
        )
        .orderBy("month", "scenario_id")
    )


def trend_pivot(trend: DataFrame, scenarios: Sequence[str], value: str = "default_rate") -> DataFrame:
    """Month by scenario; the scenario list is given, so Spark runs no job to find it."""
    return trend.groupBy("month").pivot("scenario_id", list(scenarios)).agg(F.first(value)).orderBy("month")


def chart_series(report: DataFrame, index: str, metrics: Sequence[str]) -> DataFrame:
    """Report metrics in long form (index, metric, value)."""
    return report.unpivot(index, list(metrics), "metric", "value")


def takeaways(kpis: DataFrame, scenario: str, product: str | None = None) -> DataFrame:
    """The executive summary as text rows, from the one-row scenario figures."""
    view = SCENARIO_MESSAGES.get(scenario, OTHER_SCENARIO_MESSAGE.format(scenario))
    scope = ALL_PRODUCTS_MESSAGE if product in NO_FILTER else ONE_PRODUCT_MESSAGE.format(product)

    def with_percent(message: str, column: str) -> Column:
        before, after = message.split("{}")
        return F.concat(F.lit(before), percent_text(column), F.lit(after))

    lines = [
        ("Scenario view", F.lit(view)),
        ("Product scope", F.lit(scope)),
        ("Default risk", with_percent(DEFAULT_RISK_MESSAGE, "selected_default_rate")),
        ("Cashflow stress", with_percent(CASHFLOW_MESSAGE, "selected_cashflow_stress")),
        ("Interpretation", F.lit(INTERPRETATION_MESSAGE)),
    ]
    return kpis.select(
        F.inline(
            F.array(*[F.struct(F.lit(k).alias("section"), text.alias("message")) for k, text in lines])
        )
    )


# --- payment reports --------------------------------------------------------


def payment_behavior(
    payments: DataFrame,
    accounts: DataFrame | None = None,
    product: str | None = None,
    scenario: str | None = None,
) -> DataFrame:
    facts = _where(payments, equals_or_all("scenario_id", scenario))
    return (
        _of_product(facts, accounts, product)
        .groupBy("scenario_id")
        .agg(
            _rows("payment_events"),
            rate("missed_payment_flag").alias("missed_payment_rate"),
            rate("partial_payment_flag").alias("partial_payment_rate"),
            rate("late_payment_flag").alias("late_payment_rate"),
            rounded_mean("days_late", 2).alias("avg_days_late"),
        )
        .orderBy(F.desc("late_payment_rate"), "scenario_id")
    )


# --- model reports ----------------------------------------------------------


def _audited(
    audit: DataFrame,
    dataset: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    product: str | None,
    band: str | None,
    version: str,
) -> DataFrame:
    """Audit rows of a model version with data-set columns; filters act before the join."""
    scores = _where(
        audit.where(F.col("model_version") == version), equals_or_all("risk_band", band)
    )
    facts = _where(dataset, equals_or_all("product_type", product)).select(*key, *columns)
    return scores.join(facts, list(key))


def band_validation(
    audit: DataFrame,
    dataset: DataFrame,
    key: Sequence[str] = JOIN_KEY,
    product: str | None = None,
    band: str | None = None,
    version: str = MODEL_VERSION,
) -> DataFrame:
    columns = ["default_flag", "utilization_rate", "fico_score"]
    return (
        _audited(audit, dataset, key, columns, product, band, version)
        .groupBy("risk_band")
        .agg(
            _rows("accounts"),
            rounded_mean("predicted_pd").alias("avg_predicted_pd"),
            rate("default_flag").alias("actual_default_rate"),
            rounded_mean("utilization_rate").alias("avg_utilization"),
            rounded_mean("fico_score", 1).alias("avg_fico"),
        )
        .orderBy(F.desc("avg_predicted_pd"), "risk_band")
    )


def band_distribution(audit: DataFrame, version: str = MODEL_VERSION) -> DataFrame:
    return (
        audit.where(F.col("model_version") == version)
        .groupBy("risk_band")
        .agg(_rows("accounts"), rounded_mean("predicted_pd").alias("avg_predicted_pd"))
        .orderBy(F.desc("avg_predicted_pd"), "risk_band")
    )


def ranked_band_distribution(
    audit: DataFrame,
    dataset: DataFrame,
    key: Sequence[str] = JOIN_KEY,
    product: str | None = None,
    version: str = MODEL_VERSION,
) -> DataFrame:
    """Accounts per band, from critical to low."""
    return (
        _audited(audit, dataset, key, [], product, None, version)
        .groupBy("risk_band")
        .agg(_rows("accounts"))
        .withColumn("band_rank", band_rank())
        .orderBy("band_rank", "risk_band")
    )


def calibrated_distribution(audit: DataFrame, version: str = MODEL_VERSION) -> DataFrame:
    return (
        audit.where(F.col("model_version") == version)
        .groupBy("calibrated_risk_band")
        .agg(_rows("accounts"), rounded_mean("calibrated_pd").alias("avg_calibrated_pd"))
        .orderBy(F.desc("avg_calibrated_pd"), "calibrated_risk_band")
    )


def calibrated_validation(
    audit: DataFrame, dataset: DataFrame, key: Sequence[str] = JOIN_KEY, version: str = MODEL_VERSION
) -> DataFrame:
    return (
        _audited(audit, dataset, key, ["default_flag"], None, None, version)
        .groupBy("calibrated_risk_band")
        .agg(
            _rows("accounts"),
            rounded_mean("calibrated_pd").alias("avg_calibrated_pd"),
            rate("default_flag").alias("actual_default_rate"),
        )
        .orderBy(F.desc("avg_calibrated_pd"), "calibrated_risk_band")
    )


def explained_accounts(
    audit: DataFrame, n: int = 10, tie_break: Sequence[str] = ("account_id", "month"), version: str = MODEL_VERSION
) -> DataFrame:
    """The riskiest rows that have drivers."""
    found = audit.where(
        (F.col("model_version") == version) & F.col("top_shap_feature_1").isNotNull()
    )
    return top_wide_rows(found, "predicted_pd", tie_break, n).select(
        "account_id",
        "customer_id",
        "risk_band",
        round_half_up("predicted_pd", 4).alias("predicted_pd"),
        "top_shap_feature_1",
        round_half_up("top_shap_value_1", 4).alias("top_shap_value_1"),
        "top_shap_feature_2",
        round_half_up("top_shap_value_2", 4).alias("top_shap_value_2"),
    )


def spotlight(
    audit: DataFrame,
    dataset: DataFrame,
    key: Sequence[str] = JOIN_KEY,
    product: str | None = None,
    band: str | None = None,
    n: int = 25,
    tie_break: Sequence[str] = ("account_id", "month"),
    version: str = MODEL_VERSION,
) -> DataFrame:
    """The riskiest account months with their drivers in words, under display headings."""
    columns = [
        "product_type",
        "default_flag",
        "utilization_rate",
        "fico_score",
        "cashflow_stress_score",
        "behavioral_risk_score",
    ]
    top = top_wide_rows(
        _audited(audit, dataset, key, columns, product, band, version), "predicted_pd", tie_break, n
    )
    digits = {"fico_score": 1}
    digits |= {
        c: 4
        for c in SPOTLIGHT_HEADINGS
        if c.endswith(("_pd", "_rate", "_value_1", "_value_2")) or c.endswith("_score") and c != "fico_score"
    }
    shown = []
    for c in SPOTLIGHT_HEADINGS:
        if c in digits:
            shown.append(round_half_up(c, digits[c]).alias(c))
        elif c.startswith("top_shap_feature"):
            shown.append(feature_label(c).alias(c))
        else:
            shown.append(F.col(c))
    return top.select(*shown).withColumnsRenamed(SPOTLIGHT_HEADINGS)


def product_risk(dataset: DataFrame, product: str | None = None) -> DataFrame:
    return (
        dataset.where(portfolio_filter(product))
        .groupBy("product_type")
        .agg(
            _rows(),
            rate("default_flag").alias("default_rate"),
            rounded_mean("utilization_rate").alias("avg_utilization"),
            rounded_mean("fico_score", 1).alias("avg_fico"),
        )
        .orderBy(F.desc("default_rate"), "product_type")
    )


def dataset_summary(dataset: DataFrame) -> DataFrame:
    return dataset.agg(_rows(), rate("default_flag").alias("default_rate"))


def drift_ranking(drift: DataFrame) -> DataFrame:
    return drift.select("feature_name", "psi_score", "drift_level").orderBy(
        F.desc_nulls_last("psi_score"), "feature_name"
    )
