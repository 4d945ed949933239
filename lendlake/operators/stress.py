"""Scenario tables, panel expansion and expected risk under stress."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import literal, round_half_even, round_half_up, rounded_mean
from ..sources.dimensions import repeat_for
from . import rules


@dataclass(frozen=True)
class Scenario:
    """One what-if definition at full strength."""

    scenario_id: str
    scenario_name: str
    interest_rate_shock_bps: float = 0.0
    unemployment_shock: float = 0.0
    inflation_shock: float = 0.0
    policy_stress_index: float = 0.0
    student_loan_restart_flag: bool = False
    student_loan_payment_multiplier: float = 1.0


# The standard scenario set, and the two that reach the account panel.
STANDARD_SCENARIOS = (
    Scenario("baseline", "Baseline Economy", 0.0, 0.0, 0.0, 0.10),
    Scenario("mild_rate_shock", "Mild Interest Rate Shock", 75.0, 0.003, 0.004, 0.30),
    Scenario("cost_of_living_stress", "Cost of Living Stress", 50.0, 0.005, 0.012, 0.50),
    Scenario("regional_recession", "Regional Recession", 100.0, 0.020, 0.006, 0.70),
    Scenario("severe_credit_stress", "Severe Credit Stress", 150.0, 0.030, 0.015, 0.90),
)
PANEL_SCENARIOS = ("baseline", "severe_credit_stress")
SHOCK_DIGITS = {
    "interest_rate_shock_bps": 2,
    "unemployment_shock": 4,
    "inflation_shock": 4,
    "policy_stress_index": 4,
}


def scenario_definitions(
    spark: SparkSession, scenarios: Sequence[Scenario] = STANDARD_SCENARIOS
) -> DataFrame:
    """The definitions as a literal relation (its size is known, so joins broadcast it)."""
    names = list(Scenario.__dataclass_fields__)
    columns = zip(*[astuple(s) for s in scenarios])
    return spark.createDataFrame(pa.table(dict(zip(names, map(list, columns)))))


def scenario_months(
    definitions: DataFrame,
    months: DataFrame,
    *,
    activation_month: int = 12,
    early: float = 0.35,
    rounded: bool = True,
) -> DataFrame:
    """Definitions x months; shocks act at ``early`` strength before the activation month.

    ``months`` has ``month`` and ``month_index``. User-made definitions make this a scenario
    builder. Both inputs are dimensions, so the product is one too.
    """
    strength = f"if(month_index < {activation_month}, {literal(early)}, 1.0D)"
    shocks = []
    for name, digits in SHOCK_DIGITS.items():
        value = f"{name} * {strength}"
        shocks.append(f"{round_half_even.sql(value, digits) if rounded else value} as {name}")
    return repeat_for(definitions, months).selectExpr(
        "scenario_id",
        "scenario_name",
        "month",
        "student_loan_restart_flag",
        "student_loan_payment_multiplier",
        *shocks,
    )


def join_macro(
    panel: DataFrame, macro: DataFrame, keys: Sequence[str] = ("month", "state", "zip3")
) -> DataFrame:
    """Left join of the macro conditions on the region-month key."""
    return panel.join(macro, list(keys), "left")


def fan_out_scenarios(panel: DataFrame, scenarios: DataFrame) -> DataFrame:
    """One row per scenario of the month."""
    return panel.join(scenarios, "month", "left")


def expand_panel(
    accounts: DataFrame,
    customers: DataFrame,
    months: DataFrame,
    macro: DataFrame,
    scenarios: DataFrame,
) -> DataFrame:
    """Accounts with their customers, for every month, with macro conditions and scenarios.

    Accounts are spread evenly by their key before each becomes months x scenarios rows, so a
    customer with many accounts does not fill one task. The scenario fan-out comes last. With
    macro and scenario tables that are small enough to broadcast nothing shuffles the panel.
    """
    borrowers = accounts.join(customers, "customer_id", "left").repartition("account_id")
    by_month = repeat_for(borrowers, months.select("month"))
    return fan_out_scenarios(join_macro(by_month, macro), scenarios)


def project_stress(panel: DataFrame) -> DataFrame:
    """Expected behaviour of every panel row, by rule instead of by random draw.

    The default probability is the mean over both payment outcomes: with the days past due
    that a missed payment brings, and with none.
    """
    leveled = panel.withColumn(
        "utilization_rate", rules.utilization(rules.expected_utilization.sql())
    )
    scored = rules.with_stress_scores(rules.with_balances(leveled)).withColumn(
        "missed_payment_probability", rules.missed_payment_probability()
    )
    outcomes = (
        scored.withColumn("days_past_due", rules.days_past_due("true"))
        .withColumn("_pd_missed", rules.default_probability())
        .withColumn("days_past_due", F.lit(0))
        .withColumn("_pd_paid", rules.default_probability())
    )
    return outcomes.withColumn(
        "default_probability",
        F.expr(
            "missed_payment_probability * _pd_missed + (1.0D - missed_payment_probability) * _pd_paid"
        ),
    ).drop("days_past_due", "_pd_missed", "_pd_paid")


def stress_summary(projected: DataFrame, by: Sequence[str] = ("scenario_id",)) -> DataFrame:
    """Expected rates and mean scores per scenario (and product, month)."""
    means = {
        "missed_payment_probability": "expected_missed_rate",
        "default_probability": "expected_default_rate",
        "cashflow_stress_score": "avg_cashflow_stress",
        "behavioral_risk_score": "avg_behavioral_risk",
        "macro_stress_score": "avg_macro_stress",
        "utilization_rate": "avg_utilization",
    }
    return projected.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        *[rounded_mean(c).alias(name) for c, name in means.items()],
    )


def scenario_delta(
    frame: DataFrame, by: Sequence[str], value: str, baseline: str = "baseline", digits: int = 4
) -> DataFrame:
    """Change of a per-scenario value against the baseline scenario of the same group.

    ``frame`` holds one row per group and scenario; the baseline value is taken inside the
    group, so no self-join is needed.
    """
    base = (
        f"max(if(scenario_id = {literal(baseline)}, {value}, null)) "
        f"over (partition by {', '.join(by)})"
    )
    return frame.select(
        *by,
        "scenario_id",
        value,
        round_half_up(f"({value} - {base})", digits).alias(f"{value}_change"),
    )
