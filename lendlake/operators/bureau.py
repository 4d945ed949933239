"""Customer-month roll-up and bureau-style profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.linear import weighted
from ..functions.scalars import clipped_ratio, column

# Fixed values of the bureau rules.
UTILIZATION_BOUNDS = (0.0, 1.5)
SCORE_BOUNDS = (300.0, 850.0)
BUREAU_SCORE = weighted(
    {
        "baseline_fico": 1.0,
        "credit_utilization": -75.0,
        "delinquencies_12m": -7.0,
        "if(max_days_past_due >= 90, 1.0D, 0.0D)": -55.0,
        "default_count": -35.0,
        "chargeoff_count": -65.0,
        "baseline_financial_resilience": 25.0,
        "employment_stability_score": 15.0,
    },
    low=SCORE_BOUNDS[0],
    high=SCORE_BOUNDS[1],
)
INQUIRY = weighted(
    {"credit_utilization": 0.05, "if(delinquent_accounts > 0, 1.0D, 0.0D)": 0.04},
    intercept=0.04,
    low=0.0,
    high=0.25,
)
INQUIRY_TRIALS = 3
ROLLED_COLUMNS = ["current_balance", "days_past_due", "default_flag", "chargeoff_flag"]
BANKRUPTCY = weighted(
    {
        "if(max_days_past_due >= 90, 1.0D, 0.0D)": 0.002,
        "if(chargeoff_count > 0, 1.0D, 0.0D)": 0.006,
        "if(fico_score < 500, 1.0D, 0.0D)": 0.003,
    },
    intercept=0.0002,
    low=0.0,
    high=0.03,
)


@column
def money_sum(c: str) -> str:
    """Sum of whole cents: integer sums do not depend on the order of the rows."""
    return f"sum(cast(floor({c} * 100.0D + 0.5D) as bigint)) / 100.0D"


def customer_month(snapshots: DataFrame) -> DataFrame:
    """Balances, delinquency and losses per customer and month (one scenario's snapshots)."""
    return snapshots.groupBy("customer_id", "month").agg(
        money_sum("current_balance").alias("total_debt_balance"),
        F.max("days_past_due").alias("max_days_past_due"),
        F.expr("count_if(days_past_due > 0)").alias("delinquent_accounts"),
        F.expr("count_if(default_flag)").alias("default_count"),
        F.expr("count_if(chargeoff_flag)").alias("chargeoff_count"),
    )


def credit_lines(accounts: DataFrame) -> DataFrame:
    """Limit total and number of accounts per customer."""
    return accounts.groupBy("customer_id").agg(
        money_sum("credit_limit").alias("total_credit_limit"),
        F.count("account_id").alias("num_open_accounts"),
    )


@column
def rolling_count(value: str, key: str = "customer_id", order: str = "month", rows: int = 12) -> str:
    """Sum over the last ``rows`` observed rows of the key: rows, not calendar months."""
    frame = f"rows between {rows - 1} preceding and current row"
    return f"sum({value}) over (partition by {key} order by {order} {frame})"


def bureau_base(snapshots: DataFrame, accounts: DataFrame) -> DataFrame:
    """Roll-up with limits, utilisation and the 12-month delinquency count."""
    return with_limits(customer_month(snapshots), credit_lines(accounts))


def with_limits(rolled: DataFrame, lines: DataFrame) -> DataFrame:
    """The customer months with limits, utilisation and the 12-month delinquency count."""
    limited = rolled.join(lines, "customer_id", "left")
    return limited.withColumn("credit_utilization", credit_utilization()).withColumn("delinquencies_12m", rolling_count("delinquent_accounts"))


@column
def credit_utilization() -> str:
    return clipped_ratio.sql("total_debt_balance", "total_credit_limit", *UTILIZATION_BOUNDS)


@column
def bureau_score() -> str:
    return f"cast(rint({BUREAU_SCORE.score_sql()}) as int)"


@column
def inquiry_probability() -> str:
    return INQUIRY.score_sql()


@column
def expected_inquiries() -> str:
    return f"{INQUIRY.score_sql()} * {float(INQUIRY_TRIALS)}D"


@column
def bankruptcy_probability() -> str:
    return BANKRUPTCY.score_sql()


def bureau_profile(base: DataFrame, customers: DataFrame) -> DataFrame:
    """Bureau score on top of the roll-up; customers without a profile keep a NULL score."""
    profile = customers.select(
        "customer_id",
        "baseline_fico",
        "baseline_financial_resilience",
        "employment_stability_score",
    )
    scored = base.join(profile, "customer_id", "left").withColumn("fico_score", bureau_score())
    return scored.select(*base.columns, "fico_score")


