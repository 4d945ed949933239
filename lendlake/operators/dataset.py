"""The modelling data set: one scenario's account months with account, customer, bureau data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of the data set by the table they come from.
SNAPSHOT_COLUMNS = [
    "account_month_id",
    "account_id",
    "customer_id",
    "month",
    "scenario_id",
    "default_flag",
    "current_balance",
    "available_credit",
    "utilization_rate",
    "minimum_payment_due",
    "actual_payment_amount",
    "days_past_due",
    "cashflow_stress_score",
    "behavioral_risk_score",
    "macro_stress_score",
]
ACCOUNT_COLUMNS = [
    "product_type",
    "credit_limit",
    "interest_rate",
    "term_months",
    "origination_fico",
    "origination_income",
    "origination_dti",
    "risk_tier_at_origination",
]
CUSTOMER_COLUMNS = [
    "age",
    "state",
    "employment_type",
    "annual_income",
    "monthly_income",
    "income_band",
    "education_level",
    "baseline_fico",
    "baseline_dti",
    "baseline_financial_resilience",
    "employment_stability_score",
]
BUREAU_COLUMNS = [
    "fico_score",
    "total_debt_balance",
    "total_credit_limit",
    "credit_utilization",
    "num_open_accounts",
    "num_recent_inquiries",
    "delinquencies_12m",
    "bankruptcy_flag",
]
JOINED_COLUMNS = ACCOUNT_COLUMNS + CUSTOMER_COLUMNS + BUREAU_COLUMNS
COLUMNS = SNAPSHOT_COLUMNS + JOINED_COLUMNS


def modeling_dataset(
    snapshots: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    bureau: DataFrame,
    scenario: str = "baseline",
    columns: Sequence[str] = SNAPSHOT_COLUMNS,
    bureau_columns: Sequence[str] = BUREAU_COLUMNS,
    buckets: int | None = None,
) -> DataFrame:
    """Snapshots of one scenario (``columns`` of them) with their attributes; months without a bureau row stay.

    Accounts and customers meet first, at account size. For the customer's columns and the bureau's
    only the keys of accounts and snapshots travel to the customers, and the columns come back with
    them, so wide rows stay where their account is (snapshots that lie by account do not move at all).
    ``buckets``: how many the bureau lies in by customer; the keys are laid alike, so it stays there.
    """
    owners = accounts.select("account_id", "customer_id").distinct().join(customers.select("customer_id", *CUSTOMER_COLUMNS), "customer_id")
    borrowers = accounts.select("account_id", "customer_id", *ACCOUNT_COLUMNS).join(owners, ["account_id", "customer_id"])
    facts = snapshots.where(F.col("scenario_id") == scenario).select(*columns)
    key = ["account_id", "customer_id", "month"]
    # packed files hide how many keys there are: without the hint middling tables would be broadcast
    keys = facts.select(*key).distinct()
    laid = keys.repartition(buckets, "customer_id") if buckets else keys
    scored = laid.hint("merge").join(bureau.select("customer_id", "month", *bureau_columns), ["customer_id", "month"])
    joined = facts.join(borrowers.drop("customer_id"), "account_id").join(scored, key, "left")
    return joined.select(*columns, *ACCOUNT_COLUMNS, *CUSTOMER_COLUMNS, *bureau_columns)
