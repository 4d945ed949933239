"""Schema contract of the portfolio tables: types, primary and foreign keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

LOAD_TIME = "created_at"

# Table and column names and their types, which stored tables must have.
_DDL = {
    "customers": """customer_id string, birth_year int, age int, state string, zip3 string,
        employment_type string, annual_income double, monthly_income double, income_band string,
        education_level string, student_loan_flag boolean, baseline_fico int,
        baseline_dti double, baseline_financial_resilience double,
        employment_stability_score double, created_at timestamp""",
    "accounts": """account_id string, customer_id string, product_type string, open_date date,
        credit_limit double, interest_rate double, term_months int, origination_fico int,
        origination_income double, origination_dti double, risk_tier_at_origination string,
        created_at timestamp""",
    "student_loan_exposure": """student_loan_id string, customer_id string,
        student_loan_balance double, monthly_student_payment double, repayment_plan string,
        forbearance_flag boolean, restart_month date, payment_to_income_ratio double,
        student_loan_stress_score double, created_at timestamp""",
    "macro_monthly": """macro_id string, month date, state string, zip3 string,
        unemployment_rate double, inflation_rate double, interest_rate_index double,
        rent_index double, wage_growth_rate double, consumer_sentiment_index double,
        recession_flag boolean, created_at timestamp""",
    "policy_scenarios": """scenario_month_id string, scenario_id string, scenario_name string,
        month date, student_loan_restart_flag boolean, student_loan_payment_multiplier double,
        interest_rate_shock_bps double, unemployment_shock double, inflation_shock double,
        policy_stress_index double, created_at timestamp""",
    "bureau_monthly": """bureau_snapshot_id string, customer_id string, month date,
        fico_score int, total_debt_balance double, total_credit_limit double,
        credit_utilization double, num_open_accounts int, num_recent_inquiries int,
        delinquencies_12m int, bankruptcy_flag boolean, created_at timestamp""",
    "account_monthly_snapshots": """account_month_id string, account_id string,
        customer_id string, scenario_id string, month date, current_balance double,
        available_credit double, utilization_rate double, minimum_payment_due double,
        actual_payment_amount double, days_past_due int, delinquency_status string,
        chargeoff_flag boolean, default_flag boolean, cashflow_stress_score double,
        behavioral_risk_score double, macro_stress_score double, created_at timestamp""",
    "payment_events": """payment_id string, account_id string, account_month_id string,
        customer_id string, scenario_id string, payment_date date, due_date date,
        scheduled_payment_amount double, actual_payment_amount double, payment_channel string,
        missed_payment_flag boolean, partial_payment_flag boolean, late_payment_flag boolean,
        days_late int, created_at timestamp""",
    "model_scoring_audit": """score_id string, account_month_id string, account_id string,
        customer_id string, month date, model_version string, predicted_pd double,
        risk_band string, top_shap_feature_1 string, top_shap_value_1 double,
        top_shap_feature_2 string, top_shap_value_2 double, psi_score double,
        drift_alert_flag boolean, fairness_alert_flag boolean, override_flag boolean,
        calibrated_pd double, calibrated_risk_band string, created_at timestamp""",
    "model_feature_psi": """feature_name string, reference_period string,
        current_period string, psi_score double, drift_level string, calculated_at timestamp""",
}

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampType(),
}


def _struct(columns: str) -> StructType:
    """Struct of "name type, ..." text; needs no session, unlike Spark's own DDL reader."""
    pairs = [c.split() for c in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, StructType] = {name: _struct(ddl) for name, ddl in _DDL.items()}

PRIMARY_KEYS = {
    "customers": "customer_id",
    "accounts": "account_id",
    "student_loan_exposure": "student_loan_id",
    "macro_monthly": "macro_id",
    "policy_scenarios": "scenario_month_id",
    "bureau_monthly": "bureau_snapshot_id",
    "account_monthly_snapshots": "account_month_id",
    "payment_events": "payment_id",
    "model_scoring_audit": "score_id",
}

FOREIGN_KEYS = [  # child table, parent table, key
    ("accounts", "customers", "customer_id"),
    ("student_loan_exposure", "customers", "customer_id"),
    ("bureau_monthly", "customers", "customer_id"),
    ("account_monthly_snapshots", "accounts", "account_id"),
    ("account_monthly_snapshots", "customers", "customer_id"),
    ("payment_events", "accounts", "account_id"),
    ("payment_events", "customers", "customer_id"),
    ("model_scoring_audit", "account_monthly_snapshots", "account_month_id"),
    ("model_scoring_audit", "accounts", "account_id"),
    ("model_scoring_audit", "customers", "customer_id"),
]

_TIME_DEFAULTS = {LOAD_TIME, "calculated_at"}


def conform(df: DataFrame, table: str, *, missing: str = "null") -> DataFrame:
    """The table's columns, in order and with the contract's types.

    A column the frame does not have is NULL (load times: now), or an error when
    ``missing="error"``. Columns outside the contract are dropped.
    """
    have = set(df.columns)
    absent = [f.name for f in SCHEMAS[table] if f.name not in have | _TIME_DEFAULTS]
    if absent and missing == "error":
        raise ValueError(f"{table}: columns missing from the input: {', '.join(absent)}")

    def source(name: str) -> Column:
        if name in have:
            return F.col(name)
        return F.current_timestamp() if name in _TIME_DEFAULTS else F.lit(None)

    return df.select(*[source(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[table]])


def contract(spark: SparkSession) -> DataFrame:
    """The contract itself as rows (table_name, position, column_name, data_type)."""
    rows = [
        (table, i, f.name, f.dataType.simpleString())
        for table, schema in SCHEMAS.items()
        for i, f in enumerate(schema)
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string"
    )
