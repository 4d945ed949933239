"""Queries on the portfolio rules: customers, accounts, stress, payments, bureau, data set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import lookup, round_half_up
from ..operators import bureau, rules, stress
from ..operators.dataset import COLUMNS as DATASET_COLUMNS
from ..sources.dimensions import repeat_for
from ..sources.portfolio import ACTIVATION_MONTH, ROW_KEY, Portfolio
from .registry import query
from .views import case_of, clip, mean, r, sigmoid

SNAPSHOT_KEY = [*ROW_KEY, "scenario_id"]
_KEY = "account_id, month, scenario_id"

# --- customers and accounts -------------------------------------------------


@query("d01_income_band", "select customer_id, annual_income, monthly_income, income_band from customers")
def income_band(p: Portfolio) -> DataFrame:
    return p.customers.select(
        "customer_id",
        "annual_income",
        rules.monthly_income().alias("monthly_income"),
        rules.income_band().alias("income_band"),
    )


@query(
    "d02_risk_tier",
    """select customer_id, case when baseline_fico >= 740 then 'prime' when baseline_fico >= 670 then 'near_prime'
    when baseline_fico >= 600 then 'subprime' else 'deep_subprime' end as risk_tier from customers""",
)
def risk_tier(p: Portfolio) -> DataFrame:
    return p.customers.select("customer_id", rules.risk_tier().alias("risk_tier"))


@query(
    "d03_pricing",
    f"select account_id, {clip('interest_rate', 0.04, 0.34)} as interest_rate from accounts",
)
def pricing(p: Portfolio) -> DataFrame:
    return p.accounts.select("account_id", rules.interest_rate().alias("interest_rate"))


@query(
    "d04_limit_bounds",
    f"""select account_id, case product_type
    {' '.join(f"when '{k}' then {clip('credit_limit', lo, hi)}" for k, (lo, hi) in rules.CREDIT_LIMIT_BOUNDS.items())}
    end as bounded_limit from accounts""",
)
def limit_bounds(p: Portfolio) -> DataFrame:
    return p.accounts.select("account_id", rules.bounded_credit_limit().alias("bounded_limit"))


@query(
    "d05_affordability",
    f"""select customer_id, {clip('''baseline_dti + case when annual_income < 40000e0 then 0.10e0 else 0e0 end
      + case when student_loan_flag then 0.06e0 else 0e0 end''', 0.05, 0.75)} as dti from customers""",
)
def affordability(p: Portfolio) -> DataFrame:
    return p.customers.select("customer_id", rules.debt_to_income("baseline_dti").alias("dti"))


@query(
    "d06_resilience",
    f"""with z as (select c.*, (annual_income - m) / s as z from customers c
      cross join (select avg(annual_income) m, stddev_pop(annual_income) s from customers))
    select customer_id, {r(clip('650e0 + z * 35e0', 520.0, 830.0), 6)} as income_linked_fico,
      {r(clip('0.45e0 + (baseline_fico - 650e0) / 300e0 + z * 0.10e0 - baseline_dti * 0.35e0', 0.0, 1.0), 6)} as financial_resilience
    from z""",
)
def resilience(p: Portfolio) -> DataFrame:
    profile = rules.financial_profile(
        p.customers.select("customer_id", "annual_income", "baseline_fico", "baseline_dti")
    )
    return profile.select(
        "customer_id",
        round_half_up("income_linked_fico", 6).alias("income_linked_fico"),
        round_half_up("financial_resilience", 6).alias("financial_resilience"),
    )


@query(
    "d07_employment_stability",
    f"""select c_custkey, {case_of('c_mktsegment', {'AUTOMOBILE': 0.82, 'BUILDING': 0.62, 'FURNITURE': 0.55, 'HOUSEHOLD': 0.48}, '0.18e0')} as stability
    from customer""",
)
def employment_stability(p: Portfolio) -> DataFrame:
    return p.customers.select(
        F.col("customer_id").alias("c_custkey"), rules.employment_stability().alias("stability")
    )


@query(
    "d08_student_loan_propensity",
    """select customer_id, case when education_level in ('bachelor', 'graduate') then 0.42e0 else 0.18e0 end as propensity
    from customers""",
)
def student_loan_propensity(p: Portfolio) -> DataFrame:
    return p.customers.select("customer_id", rules.student_loan_propensity().alias("propensity"))


# --- macro conditions and scenarios -----------------------------------------


@query(
    "d09_recession_flag",
    """select month, state, zip3, unemployment_rate > 0.058e0 or inflation_rate > 0.042e0
      or consumer_sentiment_index < 88e0 as recession_flag from macro_monthly""",
)
def recession_flag(p: Portfolio) -> DataFrame:
    return p.macro_monthly.select("month", "state", "zip3", "recession_flag")


_SHOCKS = {"interest_rate_shock_bps": 2, "unemployment_shock": 4, "inflation_shock": 4, "policy_stress_index": 4}


@query(
    "d10_scenario_months",
    f"""select scenario_id, scenario_name, month, student_loan_restart_flag, student_loan_payment_multiplier,
    {', '.join(_SHOCKS)} from policy_scenarios""",
)
def scenario_months(p: Portfolio) -> DataFrame:
    return stress.scenario_months(p.scenario_defs, p.months, activation_month=ACTIVATION_MONTH)


def _expanded(p: Portfolio) -> DataFrame:
    accounts = p.accounts.select(
        "account_id", "customer_id", "product_type", "credit_limit", "interest_rate", "risk_tier_at_origination"
    )
    customers = p.customers.select(
        "customer_id",
        "state",
        "zip3",
        "baseline_dti",
        "baseline_financial_resilience",
        "employment_stability_score",
    )
    return stress.expand_panel(accounts, customers, p.months, p.macro_dimension, p.scenario_dimension)


_EXPANDED = """(select a.*, c.state, c.baseline_dti, c.baseline_financial_resilience, c.employment_stability_score,
      k.* exclude (state, zip3), s.* exclude (month)
    from accounts a left join customers c on a.customer_id = c.customer_id cross join (select month from months) m
    left join macro_monthly k on m.month = k.month and c.state = k.state and c.zip3 = k.zip3
    left join (select * from policy_scenarios where scenario_id in ('baseline', 'severe_credit_stress')) s on m.month = s.month)"""


@query(
    "d11_panel_expansion",
    f"""select month, scenario_id, count(*) as rows, count(distinct account_id) as accounts,
    {mean('unemployment_rate', 6)} as avg_unemployment, max(policy_stress_index) as policy_stress_index
    from {_EXPANDED} group by month, scenario_id""",
)
def panel_expansion(p: Portfolio) -> DataFrame:
    # Accounts are counted by region first: only regions are repeated for months and scenarios.
    places = p.customers.select("customer_id", "state", "zip3")
    each = p.accounts.groupBy("account_id", "customer_id").agg(F.count(F.lit(1)).alias("n"))
    regions = (
        each.join(places, "customer_id", "left")
        .groupBy("state", "zip3")
        .agg(F.sum("n").alias("n"), F.count("account_id").alias("accounts"))
    )
    expanded = stress.fan_out_scenarios(
        stress.join_macro(repeat_for(regions, p.months.select("month")), p.macro_dimension), p.scenario_dimension
    )
    return expanded.groupBy("month", "scenario_id").agg(
        F.sum("n").alias("rows"),
        F.sum("accounts").alias("accounts"),
        round_half_up("(sum(unemployment_rate * n) / sum(if(unemployment_rate is null, 0, n)))", 6).alias("avg_unemployment"),
        F.max("policy_stress_index").alias("policy_stress_index"),
    )


_UTILIZATION = clip(
    f"{case_of('product_type', rules.PRODUCT_BASE_UTILIZATION)} + "
    f"{case_of('risk_tier_at_origination', rules.TIER_UTILIZATION)} + policy_stress_index * 0.08e0",
    0.02,
    1.20,
)


@query(
    "d12_expected_utilization",
    f"""select p.account_id, p.month, p.scenario_id, {_UTILIZATION.replace('product_type', 'p.product_type')} as utilization_rate
    from panel p join (select account_id, risk_tier_at_origination from accounts) a on p.account_id = a.account_id""",
)
def expected_utilization(p: Portfolio) -> DataFrame:
    level = rules.utilization(rules.expected_utilization.sql())
    return p.panel.select(*SNAPSHOT_KEY, level.alias("utilization_rate"))


@query("d13_balances", f"select {_KEY}, current_balance, available_credit from account_monthly_snapshots")
def balances(p: Portfolio) -> DataFrame:
    return p.panel.select(
        *SNAPSHOT_KEY,
        rules.current_balance().alias("current_balance"),
        rules.available_credit().alias("available_credit"),
    )


@query("d14_minimum_payment", f"select {_KEY}, minimum_payment_due from account_monthly_snapshots")
def minimum_payment(p: Portfolio) -> DataFrame:
    return p.panel.select(*SNAPSHOT_KEY, rules.minimum_payment_due().alias("minimum_payment_due"))


@query("d15_macro_stress", f"select {_KEY}, macro_stress_score from panel")
def macro_stress(p: Portfolio) -> DataFrame:
    return p.panel.select(*SNAPSHOT_KEY, rules.macro_stress().alias("macro_stress_score"))


@query("d16_cashflow_stress", f"select {_KEY}, cashflow_stress_score from stressed")
def cashflow_stress(p: Portfolio) -> DataFrame:
    macro = p.panel.withColumn("macro_stress_score", rules.macro_stress())
    return macro.select(*SNAPSHOT_KEY, rules.cashflow_stress().alias("cashflow_stress_score"))


@query("d17_behavioral_risk", f"select {_KEY}, behavioral_risk_score from account_monthly_snapshots")
def behavioral_risk(p: Portfolio) -> DataFrame:
    return rules.with_stress_scores(p.panel).select(*SNAPSHOT_KEY, "behavioral_risk_score")


_MISSED_ODDS = """-3.1e0 + cashflow_stress_score * 4e0 + utilization_rate * 1.4e0 + macro_stress_score * 1.2e0
    + policy_stress_index * 0.8e0 - baseline_financial_resilience * 1.1e0"""


@query(
    "d18_missed_probability",
    f"select {_KEY}, {r(sigmoid(_MISSED_ODDS), 6)} as missed_probability from account_monthly_snapshots",
)
def missed_probability(p: Portfolio) -> DataFrame:
    pm = round_half_up(rules.missed_payment_probability.sql(), 6)
    return p.account_monthly_snapshots.select(*SNAPSHOT_KEY, pm.alias("missed_probability"))


@query(
    "d19_days_past_due",
    f"""select {_KEY}, cast(case when not missed_payment_flag then 0 when behavioral_risk_score < 0.45e0 then 30
    when behavioral_risk_score < 0.70e0 then 60 else 90 end as int) as implied_dpd from payment_events""",
)
def days_past_due(p: Portfolio) -> DataFrame:
    return p.payment_events.select(*SNAPSHOT_KEY, rules.days_past_due().alias("implied_dpd"))


@query("d20_delinquency_status", f"select {_KEY}, days_past_due, delinquency_status from account_monthly_snapshots")
def delinquency_status(p: Portfolio) -> DataFrame:
    return p.panel.select(
        *SNAPSHOT_KEY, "days_past_due", rules.delinquency_status().alias("delinquency_status")
    )


@query("d21_default_probability", f"select {_KEY}, predicted_pd from scored")
def default_probability(p: Portfolio) -> DataFrame:
    pd = F.expr(f"floor({rules.default_probability.sql()} * 1e6D + 0.5D) / 1e6D")
    return p.account_monthly_snapshots.select(*SNAPSHOT_KEY, pd.alias("predicted_pd"))


@query(
    "d22_chargeoff",
    f"select {_KEY}, default_flag and days_past_due >= 90 as chargeoff_flag from account_monthly_snapshots",
)
def chargeoff(p: Portfolio) -> DataFrame:
    return p.account_monthly_snapshots.select(*SNAPSHOT_KEY, rules.chargeoff_flag().alias("chargeoff_flag"))


_PROJECTED_ODDS = """-7.2e0 + cashflow_stress_score * 3.2e0 + behavioral_risk_score * 1.4e0 + utilization_rate * 0.8e0
    + macro_stress_score * 0.7e0 + policy_stress_index * 0.8e0 + {0} * 0.018e0 - baseline_financial_resilience * 1.3e0"""
_MISSED_DPD = "case when behavioral_risk_score < 0.45e0 then 30 when behavioral_risk_score < 0.70e0 then 60 else 90 end"


def _projection_sql(by: str) -> str:
    macro = clip(
        """unemployment_rate * 5e0 + inflation_rate * 4e0 + rent_index * 0.08e0 + unemployment_shock * 8e0
        + inflation_shock * 5e0 - wage_growth_rate * 2.5e0 - (consumer_sentiment_index - 90e0) * 0.004e0""",
        0.0,
        1.0,
    )
    cash = clip(
        """baseline_dti * 0.55e0 + utilization_rate * 0.22e0 + macro_stress_score * 0.35e0 + policy_stress_index * 0.30e0
        - baseline_financial_resilience * 0.35e0 - employment_stability_score * 0.18e0""",
        0.0,
        1.0,
    )
    behavior = clip(
        """cashflow_stress_score * 0.55e0 + utilization_rate * 0.20e0 + (1e0 - employment_stability_score) * 0.15e0
        + policy_stress_index * 0.10e0""",
        0.0,
        1.0,
    )
    return f"""with e1 as (select *, {_UTILIZATION} as utilization_rate, {macro} as macro_stress_score from {_EXPANDED}),
    e2 as (select *, {cash} as cashflow_stress_score from e1),
    e3 as (select *, {behavior} as behavioral_risk_score from e2),
    e4 as (select *, {sigmoid(_MISSED_ODDS)} as pm, {sigmoid(_PROJECTED_ODDS.format(_MISSED_DPD))} as pd_missed,
      {sigmoid(_PROJECTED_ODDS.format('0'))} as pd_paid from e3)
    select {by}, count(*) as rows, {mean('pm')} as expected_missed_rate,
      {mean('pm * pd_missed + (1e0 - pm) * pd_paid')} as expected_default_rate,
      {mean('cashflow_stress_score')} as avg_cashflow_stress, {mean('behavioral_risk_score')} as avg_behavioral_risk,
      {mean('macro_stress_score')} as avg_macro_stress, {mean('utilization_rate')} as avg_utilization
    from e4 group by {by}"""


@query("d23_stress_projection", _projection_sql("scenario_id"))
def stress_projection(p: Portfolio) -> DataFrame:
    return stress.stress_summary(stress.project_stress(_expanded(p)))


@query("d23_stress_projection_by_product", _projection_sql("scenario_id, product_type, month"))
def stress_projection_by_product(p: Portfolio) -> DataFrame:
    by = ["scenario_id", "product_type", "month"]
    return stress.stress_summary(stress.project_stress(_expanded(p)), by)


# --- payments ---------------------------------------------------------------


@query(
    "d24_payment_flags",
    f"select {_KEY}, missed_payment_flag, partial_payment_flag, late_payment_flag from payment_events",
)
def payment_flags(p: Portfolio) -> DataFrame:
    return p.payment_events.select(
        *SNAPSHOT_KEY, "missed_payment_flag", "partial_payment_flag", "late_payment_flag"
    )


_CLASS = """case when days_past_due = 30 then 'dpd_30' when days_past_due = 60 then 'dpd_60' when days_past_due >= 90 then 'dpd_90_plus'
    when missed_payment_flag then 'missed' when partial_payment_flag then 'partial' else 'on_time' end"""
_IN_RANGE = (
    "case payment_class "
    + " ".join(
        f"when '{k}' then days_late between {lo} and {hi}" for k, (lo, hi) in rules.DAYS_LATE_BOUNDS.items()
    )
    + " end"
)


@query(
    "d25_days_late_range",
    f"""select payment_class, scenario_id, count(*) as rows, count(case when not ({_IN_RANGE}) then 1 end) as breaks
    from (select *, {_CLASS} as payment_class from payment_events) group by payment_class, scenario_id""",
)
def days_late_range(p: Portfolio) -> DataFrame:
    from ..operators.quality import rule_breaks

    classed = p.payment_events.withColumn("payment_class", rules.payment_class())
    return rule_breaks(classed, rules.days_late_in_range("payment_class"), ["payment_class", "scenario_id"])


_CHANNEL_CLASS = """case when behavioral_risk_score >= 0.60e0 then 'high_risk' when behavioral_risk_score >= 0.30e0
    then 'medium_risk' else 'low_risk' end"""


@query(
    "d26_channel_validity",
    f"""select channel_class, payment_channel, count(*) as rows,
    count(case when not (case channel_class when 'low_risk' then payment_channel in ('autopay', 'online', 'mobile')
      when 'medium_risk' then payment_channel in ('autopay', 'online', 'mobile', 'branch')
      else payment_channel in ('online', 'mobile', 'branch', 'failed_autopay') end) then 1 end) as breaks
    from (select behavioral_risk_score, case account_id % 6 when 0 then 'autopay' when 1 then 'online' when 2 then 'mobile'
        when 3 then 'branch' when 4 then 'failed_autopay' end as payment_channel, {_CHANNEL_CLASS} as channel_class
      from account_monthly_snapshots) group by 1, 2
    union all select channel_class, 'as derived', count(*), count(case when not (case channel_class
        when 'low_risk' then payment_channel in ('autopay', 'online', 'mobile')
        when 'medium_risk' then payment_channel in ('autopay', 'online', 'mobile', 'branch')
        else payment_channel in ('online', 'mobile', 'branch', 'failed_autopay') end) then 1 end)
      from (select *, {_CHANNEL_CLASS} as channel_class from payment_events) group by 1""",
)
def channel_validity(p: Portfolio) -> DataFrame:
    from ..operators.quality import rule_breaks

    # Channels that know nothing of the class, none among them, break the rule; derived ones must not.
    names = {0: "autopay", 1: "online", 2: "mobile", 3: "branch", 4: "failed_autopay"}
    reported = p.account_monthly_snapshots.withColumns(
        {"channel_class": rules.channel_risk_class(), "payment_channel": F.expr(lookup.sql("account_id % 6", names))}
    )
    derived = p.payment_events.withColumn("channel_class", rules.channel_risk_class())
    allowed = rules.channel_allowed("channel_class")
    found = rule_breaks(reported, allowed, ["channel_class", "payment_channel"])
    own = rule_breaks(derived, allowed, ["channel_class"])
    return found.unionByName(own.withColumn("payment_channel", F.lit("as derived")))


# --- bureau and data set ----------------------------------------------------


@query(
    "d27_customer_month",
    """select customer_id, month, total_debt_balance, max_days_past_due, delinquent_accounts, default_count,
    chargeoff_count, total_credit_limit, num_open_accounts, credit_utilization from bureau_base""",
)
def customer_month(p: Portfolio) -> DataFrame:
    return p.bureau_base.drop("delinquencies_12m")


@query("d28_delinquencies_12m", "select customer_id, month, delinquencies_12m from bureau_base")
def delinquencies_12m(p: Portfolio) -> DataFrame:
    rolled = bureau.customer_month(p.baseline)
    return rolled.select(
        "customer_id", "month", bureau.rolling_count("delinquent_accounts").alias("delinquencies_12m")
    )


@query("d29_bureau_score", "select customer_id, month, fico_score from bureau_scored")
def bureau_score(p: Portfolio) -> DataFrame:
    return p.bureau_monthly.select("customer_id", "month", "fico_score")


@query(
    "d30_event_probabilities",
    f"""select customer_id, month,
    {clip('0.04e0 + credit_utilization * 0.05e0 + case when delinquent_accounts > 0 then 0.04e0 else 0e0 end', 0.0, 0.25)} * 3e0 as expected_inquiries,
    {clip('''0.0002e0 + case when max_days_past_due >= 90 then 0.002e0 else 0e0 end
      + case when chargeoff_count > 0 then 0.006e0 else 0e0 end + case when fico_score < 500 then 0.003e0 else 0e0 end''', 0.0, 0.03)} as bankruptcy_probability
    from bureau_scored""",
)
def event_probabilities(p: Portfolio) -> DataFrame:
    return p.bureau_monthly.select(
        "customer_id",
        "month",
        bureau.expected_inquiries().alias("expected_inquiries"),
        bureau.bankruptcy_probability().alias("bankruptcy_probability"),
    )


@query("d31_modeling_dataset", f"select {', '.join(DATASET_COLUMNS)} from modeling_dataset")
def modeling_dataset(p: Portfolio) -> DataFrame:
    return p.modeling_dataset
