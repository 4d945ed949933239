"""Portfolio rules as columns, and the column chains built from them.

Random parts of a simulated book (noise terms, drawn flags) are not made here: an observed
flag or value is an input column, and a rule gives its expectation or its check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.linear import LinearIndex, Term, weighted
from ..functions.scalars import (
    clip,
    column,
    days_after,
    first_match,
    floor_at_zero,
    literal,
    lookup,
    right_closed_bins,
    threshold_band,
    z_score,
)

# ---------------------------------------------------------------------------
# Fixed values of the rules
# ---------------------------------------------------------------------------

INCOME_EDGES = [(40_000.0, "low"), (80_000.0, "middle"), (130_000.0, "upper_middle")]
INCOME_BOUNDS = (18_000.0, 240_000.0)
RISK_TIERS = [(740, "prime"), (670, "near_prime"), (600, "subprime")]
PRODUCT_BASE_RATE = {
    "credit_card": 0.18,
    "personal_loan": 0.13,
    "auto_loan": 0.08,
    "student_refi": 0.09,
}
TIER_SPREAD = {"prime": 0.0, "near_prime": 0.025, "subprime": 0.065, "deep_subprime": 0.11}
RATE_BOUNDS = (0.04, 0.34)
CREDIT_LIMIT_BOUNDS = {
    "credit_card": (500.0, 35_000.0),
    "personal_loan": (1_000.0, 45_000.0),
    "auto_loan": (5_000.0, 60_000.0),
    "student_refi": (3_000.0, 80_000.0),
}
EMPLOYMENT_STABILITY = {
    "salaried": 0.82,
    "hourly": 0.62,
    "self_employed": 0.55,
    "student": 0.48,
    "unemployed": 0.18,
}
PRODUCT_BASE_UTILIZATION = {
    "credit_card": 0.42,
    "personal_loan": 0.72,
    "auto_loan": 0.82,
    "student_refi": 0.76,
}
TIER_UTILIZATION = {"prime": -0.08, "near_prime": 0.0, "subprime": 0.08, "deep_subprime": 0.14}
PRODUCT_PAYMENT_RATE = {
    "credit_card": 0.025,
    "personal_loan": 0.035,
    "auto_loan": 0.030,
    "student_refi": 0.025,
}
MACRO_STRESS = LinearIndex(
    [
        Term("unemployment_rate", 5.0),
        Term("inflation_rate", 4.0),
        Term("rent_index", 0.08),
        Term("unemployment_shock", 8.0),
        Term("inflation_shock", 5.0),
        Term("wage_growth_rate", -2.5),
        Term("consumer_sentiment_index", -0.004, center=90.0),
    ],
    low=0.0,
    high=1.0,
)
CASHFLOW_STRESS = weighted(
    {
        "baseline_dti": 0.55,
        "utilization_rate": 0.22,
        "macro_stress_score": 0.35,
        "policy_stress_index": 0.30,
        "baseline_financial_resilience": -0.35,
        "employment_stability_score": -0.18,
    },
    low=0.0,
    high=1.0,
)
BEHAVIORAL_RISK = LinearIndex(
    [
        Term("cashflow_stress_score", 0.55),
        Term("utilization_rate", 0.20),
        Term("employment_stability_score", -0.15, center=1.0),
        Term("policy_stress_index", 0.10),
    ],
    low=0.0,
    high=1.0,
)
MISSED_PAYMENT = weighted(
    {
        "cashflow_stress_score": 4.0,
        "utilization_rate": 1.4,
        "macro_stress_score": 1.2,
        "policy_stress_index": 0.8,
        "baseline_financial_resilience": -1.1,
    },
    intercept=-3.1,
)
DEFAULT_RISK = weighted(
    {
        "cashflow_stress_score": 3.2,
        "behavioral_risk_score": 1.4,
        "utilization_rate": 0.8,
        "macro_stress_score": 0.7,
        "policy_stress_index": 0.8,
        "days_past_due": 0.018,
        "baseline_financial_resilience": -1.3,
    },
    intercept=-7.2,
)
DELINQUENCY_STATUS = {0: "current", 30: "30_dpd", 60: "60_dpd"}
DAYS_LATE_BOUNDS = {  # inclusive bounds of days late by payment class
    "dpd_90_plus": (65, 109),
    "dpd_60": (35, 69),
    "dpd_30": (10, 39),
    "missed": (30, 74),
    "partial": (3, 29),
    "on_time": (0, 5),
}
CHANNEL_RISK = [(0.60, "high_risk"), (0.30, "medium_risk")]
CHANNELS_BY_RISK = {
    "low_risk": ["autopay", "online", "mobile"],
    "medium_risk": ["autopay", "online", "mobile", "branch"],
    "high_risk": ["online", "mobile", "branch", "failed_autopay"],
}

# ---------------------------------------------------------------------------
# Customer and account rules
# ---------------------------------------------------------------------------


@column
def income_band(income: str = "annual_income") -> str:
    return right_closed_bins.sql(income, 0.0, INCOME_EDGES, "high")


@column
def monthly_income(income: str = "annual_income") -> str:
    return f"{income} / 12.0D"


@column
def risk_tier(fico: str = "baseline_fico") -> str:
    return threshold_band.sql(fico, RISK_TIERS, "deep_subprime")


@column
def interest_rate(
    product: str = "product_type", tier: str = "risk_tier_at_origination", noise: str | None = None
) -> str:
    """Product base rate plus tier spread, limited to the price range."""
    price = f"{lookup.sql(product, PRODUCT_BASE_RATE)} + {lookup.sql(tier, TIER_SPREAD)}"
    return clip.sql(price if noise is None else f"{price} + {noise}", *RATE_BOUNDS)


@column
def bounded_credit_limit(limit: str = "credit_limit", product: str = "product_type") -> str:
    """A proposed limit forced into its product's range."""
    return first_match.sql(
        [
            (f"{product} = {literal(name)}", clip.sql(limit, lo, hi))
            for name, (lo, hi) in CREDIT_LIMIT_BOUNDS.items()
        ]
    )


@column
def debt_to_income(
    dti: str, income: str = "annual_income", loan: str = "student_loan_flag"
) -> str:
    """Debt ratio with its low-income and student-loan supplements."""
    total = f"{dti} + if({income} < 40000.0D, 0.10D, 0.0D) + if({loan}, 0.06D, 0.0D)"
    return clip.sql(total, 0.05, 0.75)


@column
def student_loan_propensity(education: str = "education_level") -> str:
    return f"if({education} in ('bachelor', 'graduate'), 0.42D, 0.18D)"


@column
def employment_stability(employment: str = "employment_type", noise: str | None = None) -> str:
    base = lookup.sql(employment, EMPLOYMENT_STABILITY, 0.50)
    return base if noise is None else clip.sql(f"{base} + {noise}", 0.0, 1.0)


def with_moments(df: DataFrame, c: str) -> DataFrame:
    """Add a column's mean and population deviation over all rows (``_mean``, ``_std``)."""
    return df.select(
        "*",
        df.agg(F.avg(c)).scalar().alias("_mean"),
        df.agg(F.stddev_pop(c)).scalar().alias("_std"),
    )


def financial_profile(customers: DataFrame) -> DataFrame:
    """Income-linked score and financial resilience, from the income's place in the population.

    Mean and standard deviation are two numbers, read by scalar subqueries.
    """
    z = with_moments(customers, "annual_income").withColumn(
        "_z", z_score("annual_income", "_mean", "_std")
    )
    resilience = "0.45D + (baseline_fico - 650.0D) / 300.0D + _z * 0.10D - baseline_dti * 0.35D"
    return z.select(
        *customers.columns,
        clip("650.0D + _z * 35.0D", 520.0, 830.0).alias("income_linked_fico"),
        clip(resilience, 0.0, 1.0).alias("financial_resilience"),
    )


# ---------------------------------------------------------------------------
# Macro and account-month rules
# ---------------------------------------------------------------------------


@column
def recession_flag() -> str:
    return "(unemployment_rate > 0.058D or inflation_rate > 0.042D or consumer_sentiment_index < 88.0D)"


@column
def expected_utilization(
    product: str = "product_type", tier: str = "risk_tier_at_origination"
) -> str:
    """Utilisation level of a product and tier before policy pressure."""
    return f"{lookup.sql(product, PRODUCT_BASE_UTILIZATION)} + {lookup.sql(tier, TIER_UTILIZATION)}"


@column
def utilization(level: str, policy: str = "policy_stress_index") -> str:
    """Utilisation from a level (expected or observed) and the policy pressure on it."""
    return clip.sql(f"{level} + {policy} * 0.08D", 0.02, 1.20)


@column
def current_balance() -> str:
    return "credit_limit * utilization_rate"


@column
def available_credit() -> str:
    return floor_at_zero.sql(f"credit_limit - {current_balance.sql()}")


@column
def minimum_payment_due() -> str:
    """Share of the balance by product plus one month of (shocked) interest."""
    monthly = "(interest_rate + interest_rate_shock_bps / 10000.0D) / 12.0D"
    share = lookup.sql("product_type", PRODUCT_PAYMENT_RATE)
    return f"{current_balance.sql()} * ({share} + {monthly})"


@column
def macro_stress() -> str:
    return MACRO_STRESS.score_sql()


@column
def cashflow_stress() -> str:
    return CASHFLOW_STRESS.score_sql()


@column
def behavioral_risk() -> str:
    return BEHAVIORAL_RISK.score_sql()


@column
def missed_payment_probability() -> str:
    return MISSED_PAYMENT.probability_sql()


@column
def default_probability() -> str:
    return DEFAULT_RISK.probability_sql()


@column
def days_past_due(
    missed: str = "missed_payment_flag", risk: str = "behavioral_risk_score"
) -> str:
    return first_match.sql(
        [
            (f"{missed} and {risk} < 0.45D", "30"),
            (f"{missed} and {risk} < 0.70D", "60"),
            (f"{missed} and {risk} >= 0.70D", "90"),
        ],
        "0",
    )


@column
def delinquency_status(dpd: str = "days_past_due") -> str:
    cases = [(f"{dpd} = {k}", literal(v)) for k, v in DELINQUENCY_STATUS.items()]
    return first_match.sql([*cases, (f"{dpd} >= 90", "'90_plus_dpd'")], "'current'")


@column
def chargeoff_flag(default: str = "default_flag", dpd: str = "days_past_due") -> str:
    return f"({default} and {dpd} >= 90)"


def with_balances(panel: DataFrame) -> DataFrame:
    return panel.selectExpr(
        "*",
        f"{current_balance.sql()} as current_balance",
        f"{available_credit.sql()} as available_credit",
        f"{minimum_payment_due.sql()} as minimum_payment_due",
    )


def with_stress_scores(panel: DataFrame) -> DataFrame:
    """Macro, cash-flow and behavioural scores; each needs the one before it."""
    return (
        panel.withColumn("macro_stress_score", macro_stress())
        .withColumn("cashflow_stress_score", cashflow_stress())
        .withColumn("behavioral_risk_score", behavioral_risk())
    )


# ---------------------------------------------------------------------------
# Payment rules
# ---------------------------------------------------------------------------


@column
def missed_payment(paid: str = "actual_payment_amount", due: str = "minimum_payment_due") -> str:
    return f"({paid} <= {due} * 0.10D)"


@column
def partial_payment(paid: str = "actual_payment_amount", due: str = "minimum_payment_due") -> str:
    """Some, but less than 95 % of the amount due; may overlap with a missed payment."""
    return f"({paid} > 0.0D and {paid} < {due} * 0.95D)"


@column
def late_payment(days_late: str = "days_late") -> str:
    return f"({days_late} >= 3)"


@column
def payment_class(
    dpd: str = "days_past_due",
    missed: str = "missed_payment_flag",
    partial: str = "partial_payment_flag",
) -> str:
    """Class that decides the range of days late: days past due override the payment flags."""
    return first_match.sql(
        [
            (f"{dpd} = 30", "'dpd_30'"),
            (f"{dpd} = 60", "'dpd_60'"),
            (f"{dpd} >= 90", "'dpd_90_plus'"),
            (missed, "'missed'"),
            (partial, "'partial'"),
        ],
        "'on_time'",
    )


@column
def days_late_in_range(cls: str, days_late: str = "days_late") -> str:
    return first_match.sql(
        [
            (f"{cls} = {literal(k)}", f"{days_late} between {lo} and {hi}")
            for k, (lo, hi) in DAYS_LATE_BOUNDS.items()
        ]
    )


@column
def payment_date(due: str = "due_date", days_late: str = "days_late") -> str:
    return days_after.sql(due, days_late)


@column
def channel_risk_class(risk: str = "behavioral_risk_score") -> str:
    return threshold_band.sql(risk, CHANNEL_RISK, "low_risk")


@column
def channel_allowed(cls: str, channel: str = "payment_channel") -> str:
    return first_match.sql(
        [
            (f"{cls} = {literal(k)}", f"{channel} in ({', '.join(map(literal, v))})")
            for k, v in CHANNELS_BY_RISK.items()
        ]
    )
