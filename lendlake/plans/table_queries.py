"""Queries on tables as such: scans, contracts, life-cycle, projections, joins, reshapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fx
from ..operators import bureau, ordering, profile, quality, rules, stress
from ..operators.model import audit_records, band_rank, risk_band
from ..session import fresh_path
from ..sources import schemas, tables
from ..sources.dimensions import repeat_for
from ..sources.portfolio import ROW_KEY, Portfolio
from ..sources.slices import SlicedTable
from . import reports
from .registry import query
from .views import RISK_BAND, clip, mean, r, rate, re_, sigmoid

# ---------------------------------------------------------------------------
# Scans, contracts, life-cycle
# ---------------------------------------------------------------------------


@query(
    "s01_pruned_scan",
    "select o_orderkey, o_custkey, o_totalprice from orders",
)
def pruned_scan(p: Portfolio) -> DataFrame:
    return p.table("orders", "o_orderkey", "o_custkey", "o_totalprice")


@query(
    "s02_conform_accounts",
    """select cast(account_id as varchar) as account_id, cast(customer_id as varchar) as customer_id,
    product_type, open_date, credit_limit, interest_rate, term_months, origination_fico,
    origination_income, origination_dti, risk_tier_at_origination from accounts""",
)
def conform_accounts(p: Portfolio) -> DataFrame:
    return schemas.conform(p.accounts, "accounts", missing="error").drop(schemas.LOAD_TIME)


@query(
    "s03_integrity_audit",
    """select * from (
    select 'customer key' as "check", count(*) as keys, cast(coalesce(sum(n), 0) as bigint) as rows
      from (select customer_id, count(*) n from customers group by 1 having count(*) > 1)
    union all select 'order line key', count(*), cast(coalesce(sum(n), 0) as bigint)
      from (select l_orderkey, l_linenumber, count(*) n from lineitem group by 1, 2 having count(*) > 1)
    union all select 'account to customer', count(*), cast(coalesce(sum(n), 0) as bigint)
      from (select customer_id, count(*) n from accounts where customer_id not in (select customer_id from customers) group by 1)
    union all select 'event to customer', count(*), cast(coalesce(sum(n), 0) as bigint)
      from (select user_id, count(*) n from events where user_id not in (select c_custkey from customer) group by 1)
    union all select 'document label', count(*), cast(coalesce(sum(n), 0) as bigint)
      from (select doc_id, count(*) n from documents where doc_id not in (select doc_id from labels) group by 1))""",
)
def integrity_audit(p: Portfolio) -> DataFrame:
    lines = p.table("lineitem", "l_orderkey", "l_linenumber")
    found = {
        "customer key": quality.check_keys(p.customers, ["customer_id"]),
        "order line key": quality.check_keys(lines, ["l_orderkey", "l_linenumber"]),
        "account to customer": quality.check_fk(p.accounts, p.customers, "customer_id"),
        "event to customer": quality.check_fk(
            p.table("events", "user_id"), p.table("customer", "c_custkey"), "user_id", "c_custkey"
        ),
        "document label": quality.check_fk(
            p.table("documents", "doc_id"), p.table("labels", "doc_id"), "doc_id"
        ),
    }
    parts = [quality.violations(df, name) for name, df in found.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "s04_register_relation",
    "select product_type, count(*) as rows from accounts group by product_type",
)
def register_relation(p: Portfolio) -> DataFrame:
    tables.register(p.accounts, "registered_accounts")
    return p.spark.sql(
        "select product_type, count(*) as rows from registered_accounts group by product_type"
    )


@query(
    "s05_materialize",
    "select customer_id, state, income_band from customers",
)
def materialize(p: Portfolio) -> DataFrame:
    path = fresh_path(p.spark, "customers")
    return tables.materialize(p.customers.select("customer_id", "state", "income_band"), path)


@query(
    "s06_full_refresh",
    """select cast(customer_id as varchar) as customer_id, age, state, zip3, annual_income,
    student_loan_flag, baseline_fico, true as has_load_time from customers""",
)
def full_refresh(p: Portfolio) -> DataFrame:
    stored = tables.full_refresh(p.customers, fresh_path(p.spark, "customers"), "customers")
    return stored.select(
        "customer_id",
        "age",
        "state",
        "zip3",
        "annual_income",
        "student_loan_flag",
        "baseline_fico",
        F.col(schemas.LOAD_TIME).isNotNull().alias("has_load_time"),
    )


@query(
    "s07_replace_slice",
    """select account_id, customer_id, 'v1' as model_version, baseline_score as score from (
      select a.account_id, a.customer_id, cast(origination_fico as double) as baseline_score from accounts a)
    union all select account_id, customer_id, 'v2', interest_rate * 2e0 from accounts""",
)
def replace_slice(p: Portfolio) -> DataFrame:
    keep = ["account_id", "customer_id"]
    a = p.accounts

    def version(name, score):
        return a.select(*keep, F.lit(name).alias("model_version"), score.alias("score"))

    first = version("v1", F.col("origination_fico").cast("double"))
    table = SlicedTable.of(first.unionByName(version("v2", F.col("interest_rate"))), "model_version", "audit")
    stored = table.replace(version("v2", F.col("interest_rate") * 2.0))
    return stored.select(*keep, "model_version", "score")


@query(
    "s08_merge_update",
    """select a.account_id, a.product_type, case when a.product_type = 'auto_loan' and c.region = 'ASIA'
      then a.credit_limit * 0.5e0 else a.credit_limit end as credit_limit
    from accounts a join customers c on a.customer_id = c.customer_id""",
)
def merge_update(p: Portfolio) -> DataFrame:
    target = p.accounts.select("account_id", "product_type", "credit_limit")
    cut = p.borrowers.where(F.col("region") == "ASIA").select(
        "account_id", (F.col("credit_limit") * 0.5).alias("credit_limit")
    )
    only = F.col("product_type") == "auto_loan"
    return tables.merge_update(target, cut, "account_id", ["credit_limit"], only)


@query(
    "s09_ensure_column",
    """select account_id, product_type, cast(null as double) as calibrated_pd,
    cast(null as varchar) as calibrated_risk_band from accounts""",
)
def ensure_column(p: Portfolio) -> DataFrame:
    df = p.accounts.select("account_id", "product_type")
    for name, kind in {
        "product_type": "string",
        "calibrated_pd": "double",
        "calibrated_risk_band": "string",
    }.items():
        df = tables.ensure_column(df, name, kind)
    return df


@query(
    "s10_create_and_insert",
    """select product_type as feature_name, cast(null as varchar) as reference_period,
    avg(origination_fico) as psi_score, true as has_time from accounts group by product_type""",
)
def create_and_insert(p: Portfolio) -> DataFrame:
    rows = p.accounts.groupBy(F.col("product_type").alias("feature_name")).agg(
        F.avg("origination_fico").alias("psi_score")
    )
    path = fresh_path(p.spark, "psi")
    stored = tables.create_and_insert(rows, path, "model_feature_psi", ["feature_name", "psi_score"])
    return stored.select(
        "feature_name", "reference_period", "psi_score", F.col("calculated_at").isNotNull().alias("has_time")
    )


@query(
    "s11_load_time",
    "select customer_id, true as stamped from customers",
)
def load_time(p: Portfolio) -> DataFrame:
    stamped = tables.with_load_time(p.customers.select("customer_id"))
    return stored_flag(stamped)


def stored_flag(df: DataFrame) -> DataFrame:
    return df.select("customer_id", F.col(schemas.LOAD_TIME).isNotNull().alias("stamped"))


@query(
    "s12_surrogate_key",
    """select 'ACCTMO_' || lpad(cast(row_number() over (order by account_id, month) as varchar), 10, '0')
      as account_month_id, account_id, month from observed""",
)
def surrogate_key(p: Portfolio) -> DataFrame:
    rows = p.observed.select(*ROW_KEY)
    keyed = tables.with_surrogate_key(rows, "account_month_id", "ACCTMO", 10, ROW_KEY)
    return keyed.select("account_month_id", *ROW_KEY)


@query("s13_row_count", "select 'lineitem' as table_name, count(*) as rows from lineitem")
def count_rows(p: Portfolio) -> DataFrame:
    return tables.row_count(p.table("lineitem"), "lineitem")


# ---------------------------------------------------------------------------
# Projections and filters
# ---------------------------------------------------------------------------


@query(
    "p01_projection",
    """select s.account_id, s.month, s.default_flag, a.product_type, c.income_band
    from account_monthly_snapshots s join accounts a on s.account_id = a.account_id
    join customers c on s.customer_id = c.customer_id""",
)
def projection(p: Portfolio) -> DataFrame:
    borrower = p.borrowers.select("account_id", "product_type", "income_band")
    return p.account_monthly_snapshots.join(borrower, "account_id").select(
        *ROW_KEY, "default_flag", "product_type", "income_band"
    )


@query(
    "p02_equality_filter",
    """select account_id, month, cashflow_stress_score from account_monthly_snapshots
    where scenario_id = 'severe_credit_stress'""",
)
def equality_filter(p: Portfolio) -> DataFrame:
    return p.account_monthly_snapshots.where(F.col("scenario_id") == "severe_credit_stress").select(
        *ROW_KEY, "cashflow_stress_score"
    )


@query(
    "p03_in_list",
    """select scenario_id, month, policy_stress_index from policy_scenarios
    where scenario_id in ('baseline', 'severe_credit_stress')""",
)
def in_list(p: Portfolio) -> DataFrame:
    return p.panel_scenarios.select("scenario_id", "month", "policy_stress_index")


@query(
    "p04_not_null",
    "select account_id, term_months from accounts where term_months is not null",
)
def not_null(p: Portfolio) -> DataFrame:
    return p.accounts.where(F.col("term_months").isNotNull()).select("account_id", "term_months")


_SELECTIONS = [(None, None, None), ("auto_loan", "all", "baseline"), ("all", "high", "severe_credit_stress"),
               ("credit_card", "medium", "all")]


def _selection_sql() -> str:
    parts = []
    for product, band, scenario in _SELECTIONS:
        cond = ["1 = 1"]
        if product not in fx.NO_FILTER:
            cond.append(f"product_type = '{product}'")
        if band not in fx.NO_FILTER:
            cond.append(f"risk_band = '{band}'")
        if scenario not in fx.NO_FILTER:
            cond.append(f"scenario_id = '{scenario}'")
        parts.append(f"count(case when {' and '.join(cond)} then 1 end)")
    cols = ", ".join(f"{x} as selection_{i}" for i, x in enumerate(parts))
    return f"""select {cols} from (select s.*, a.product_type, {RISK_BAND} as risk_band
      from scored s join accounts a on s.account_id = a.account_id)"""


@query("p05_optional_filters", _selection_sql())
def optional_filters(p: Portfolio) -> DataFrame:
    rows = p.scored.join(p.accounts.select("account_id", "product_type"), "account_id").select(
        "product_type", "scenario_id", risk_band().alias("risk_band")
    )
    return rows.agg(
        *[
            F.count_if(fx.portfolio_filter(*chosen)).alias(f"selection_{i}")
            for i, chosen in enumerate(_SELECTIONS)
        ]
    )


@query(
    "p06_drop_missing",
    """select event_id, value from events where value is not null and not isnan(value)""",
)
def drop_missing(p: Portfolio) -> DataFrame:
    return p.table("events", "event_id", "value").where(~fx.is_missing("value"))


@query(
    "p07_period_split",
    """select account_id, month, case when month < date '1998-01-01' then 'early' else 'late' end as period
    from observed""",
)
def period_split(p: Portfolio) -> DataFrame:
    early = F.col("month") < F.lit("1998-01-01").cast("date")
    return p.observed.select(*ROW_KEY, F.when(early, "early").otherwise("late").alias("period"))


@query(
    "p08_flag_columns",
    """select account_id, month, scenario_id, actual_payment_amount <= minimum_payment_due * 0.10e0 as tenth_or_less,
    actual_payment_amount >= minimum_payment_due as paid_in_full, days_past_due > 0 as past_due
    from account_monthly_snapshots""",
)
def flag_columns(p: Portfolio) -> DataFrame:
    paid, due = F.col("actual_payment_amount"), F.col("minimum_payment_due")
    return p.account_monthly_snapshots.select(
        *ROW_KEY,
        "scenario_id",
        rules.missed_payment().alias("tenth_or_less"),
        (paid >= due).alias("paid_in_full"),
        (F.col("days_past_due") > 0).alias("past_due"),
    )


@query(
    "p09_constant_columns",
    """select account_id, month, 'logit_v1' as model_version, cast(null as varchar) as top_shap_feature_1,
    cast(null as double) as top_shap_value_1, 0e0 as psi_score, false as drift_alert_flag,
    false as fairness_alert_flag, false as override_flag from scored where scenario_id = 'baseline'""",
)
def constant_columns(p: Portfolio) -> DataFrame:
    return audit_records(p.baseline_scored).select(
        *ROW_KEY,
        "model_version",
        "top_shap_feature_1",
        "top_shap_value_1",
        "psi_score",
        "drift_alert_flag",
        "fairness_alert_flag",
        "override_flag",
    )


@query(
    "p10_rename",
    """select account_id as "Account ID", product_type as "Product", interest_rate as "Interest Rate" from accounts""",
)
def rename(p: Portfolio) -> DataFrame:
    headings = {"account_id": "Account ID", "product_type": "Product", "interest_rate": "Interest Rate"}
    return p.accounts.select(*headings).withColumnsRenamed(headings)


@query(
    "p11_fixed_sample",
    """select account_id, month, utilization_rate from baseline_snapshots
    order by md5(concat_ws('|', cast(account_id as varchar), cast(month as varchar), '42')), account_id, month limit 1000""",
)
def fixed_sample(p: Portfolio) -> DataFrame:
    return ordering.sample_rows(p.baseline.select(*ROW_KEY, "utilization_rate"), ROW_KEY, 1000)


# ---------------------------------------------------------------------------
# Joins
# ---------------------------------------------------------------------------


@query(
    "j01_fact_account",
    """select s.account_id, s.month, s.scenario_id, a.product_type, a.interest_rate
    from account_monthly_snapshots s join accounts a on s.account_id = a.account_id""",
)
def fact_account(p: Portfolio) -> DataFrame:
    accounts = p.accounts.select("account_id", "product_type", "interest_rate")
    return p.account_monthly_snapshots.join(accounts, "account_id").select(
        *ROW_KEY, "scenario_id", "product_type", "interest_rate"
    )


@query(
    "j02_fact_customer",
    """select s.account_id, s.month, s.scenario_id, c.state, c.age
    from account_monthly_snapshots s join customers c on s.customer_id = c.customer_id""",
)
def fact_customer(p: Portfolio) -> DataFrame:
    customers = p.customers.select("customer_id", "state", "age")
    return p.account_monthly_snapshots.join(customers, "customer_id").select(
        *ROW_KEY, "scenario_id", "state", "age"
    )


@query(
    "j03_left_two_keys",
    """select s.account_id, s.month, b.delinquencies_12m, b.credit_utilization
    from baseline_snapshots s left join bureau_base b on s.customer_id = b.customer_id and s.month = b.month""",
)
def left_two_keys(p: Portfolio) -> DataFrame:
    b = p.bureau_base.select("customer_id", "month", "delinquencies_12m", "credit_utilization")
    return p.baseline.join(b, ["customer_id", "month"], "left").select(
        *ROW_KEY, "delinquencies_12m", "credit_utilization"
    )


@query(
    "j04_scores_dataset",
    """select a.account_id, a.month, a.predicted_pd, m.fico_score, m.default_flag
    from plain_audit a join modeling_dataset m on a.account_id = m.account_id and a.month = m.month""",
)
def scores_dataset(p: Portfolio) -> DataFrame:
    m = p.modeling_dataset.select(*ROW_KEY, "fico_score", "default_flag")
    return p.plain_audit.join(m, ROW_KEY).select(*ROW_KEY, "predicted_pd", "fico_score", "default_flag")


@query(
    "j05_left_single_key",
    """select a.account_id, a.customer_id, c.annual_income, c.state
    from accounts a left join customers c on a.customer_id = c.customer_id""",
)
def left_single_key(p: Portfolio) -> DataFrame:
    c = p.customers.select("customer_id", "annual_income", "state")
    return p.accounts.select("account_id", "customer_id").join(c, "customer_id", "left")


@query(
    "j06_left_three_keys",
    """select o.account_id, o.month, k.unemployment_rate, k.interest_rate_index
    from observed o join accounts a on o.account_id = a.account_id join customers c on a.customer_id = c.customer_id
    left join macro_monthly k on o.month = k.month and c.state = k.state and c.zip3 = k.zip3""",
)
def left_three_keys(p: Portfolio) -> DataFrame:
    located = p.observed.join(p.borrowers.select("account_id", "state", "zip3"), "account_id")
    return stress.join_macro(located, p.macro_dimension).select(
        *ROW_KEY, "unemployment_rate", "interest_rate_index"
    )


@query(
    "j07_scenario_fan_out",
    """select o.account_id, o.month, s.scenario_id, s.policy_stress_index
    from observed o left join policy_scenarios s on o.month = s.month""",
)
def scenario_fan_out(p: Portfolio) -> DataFrame:
    return stress.fan_out_scenarios(p.observed, p.policy_scenarios).select(
        *ROW_KEY, "scenario_id", "policy_stress_index"
    )


@query(
    "j08_account_months",
    """select m.month, count(*) as rows, count(distinct a.account_id) as accounts, min(a.account_id) as first_account
    from accounts a cross join months m group by m.month""",
)
def account_months(p: Portfolio) -> DataFrame:
    # Rows of an account are counted where they lie, before they are repeated: no distinct later.
    each = p.accounts.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        repeat_for(each, p.months.select("month"))
        .groupBy("month")
        .agg(
            F.sum("n").alias("rows"),
            F.count("account_id").alias("accounts"),
            F.min("account_id").alias("first_account"),
        )
    )


@query(
    "j09_keyed_update",
    """select s.account_id, s.month, case when b.fico_score < 500 then 'review' else s.delinquency_status end as delinquency_status
    from baseline_snapshots s left join bureau_monthly b on s.customer_id = b.customer_id and s.month = b.month""",
)
def keyed_update(p: Portfolio) -> DataFrame:
    target = p.baseline.select(*ROW_KEY, "customer_id", "delinquency_status")
    source = p.bureau_monthly.where(F.col("fico_score") < 500).select(
        "customer_id", "month", F.lit("review").alias("delinquency_status")
    )
    return tables.merge_update(target, source, ["customer_id", "month"], ["delinquency_status"]).drop(
        "customer_id"
    )


# ---------------------------------------------------------------------------
# Aggregations
# ---------------------------------------------------------------------------


@query("a01_count_per_group", "select scenario_id, count(*) as rows from account_monthly_snapshots group by 1")
def count_per_group(p: Portfolio) -> DataFrame:
    return p.account_monthly_snapshots.groupBy("scenario_id").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "a02_count_distinct",
    """select 'all' as product_type, count(distinct customer_id) as customers from accounts
    union all select product_type, count(distinct customer_id) from accounts group by product_type""",
)
def count_distinct(p: Portfolio) -> DataFrame:
    customers = F.count_distinct("customer_id").alias("customers")
    total = p.accounts.agg(customers).select(F.lit("all").alias("product_type"), "customers")
    return total.unionByName(p.accounts.groupBy("product_type").agg(customers))


@query(
    "a03_flag_rate",
    f"""select scenario_id, {rate('default_flag')} as default_rate, {rate('chargeoff_flag')} as chargeoff_rate
    from account_monthly_snapshots group by scenario_id""",
)
def flag_rate(p: Portfolio) -> DataFrame:
    return p.account_monthly_snapshots.groupBy("scenario_id").agg(
        fx.rate("default_flag").alias("default_rate"), fx.rate("chargeoff_flag").alias("chargeoff_rate")
    )


@query(
    "a04_rounded_mean",
    f"""select product_type, {mean('credit_limit', 2)} as avg_credit_limit, {mean('interest_rate')} as avg_interest_rate
    from accounts group by product_type""",
)
def rounded_mean(p: Portfolio) -> DataFrame:
    return p.accounts.groupBy("product_type").agg(
        fx.rounded_mean("credit_limit", 2).alias("avg_credit_limit"),
        fx.rounded_mean("interest_rate").alias("avg_interest_rate"),
    )


@query(
    "a05_grand_total",
    f"""select count(*) as rows, {rate('default_flag')} as default_rate, {mean('macro_stress_score')} as avg_macro_stress
    from account_monthly_snapshots""",
)
def grand_total(p: Portfolio) -> DataFrame:
    return p.account_monthly_snapshots.agg(
        F.count(F.lit(1)).alias("rows"),
        fx.rate("default_flag").alias("default_rate"),
        fx.rounded_mean("macro_stress_score").alias("avg_macro_stress"),
    )


@query(
    "a06_sum_per_group",
    "select customer_id, total_credit_limit from credit_lines",
)
def sum_per_group(p: Portfolio) -> DataFrame:
    return bureau.credit_lines(p.accounts).select("customer_id", "total_credit_limit")


@query(
    "a07_max_per_group",
    "select customer_id, max(days_past_due) as max_days_past_due from baseline_snapshots group by customer_id",
)
def max_per_group(p: Portfolio) -> DataFrame:
    return p.baseline.groupBy("customer_id").agg(F.max("days_past_due").alias("max_days_past_due"))


@query(
    "a08_conditional_count",
    """select customer_id, count(case when days_past_due > 0 then 1 end) as delinquent from baseline_snapshots
    group by customer_id""",
)
def conditional_count(p: Portfolio) -> DataFrame:
    return p.baseline.groupBy("customer_id").agg(F.count_if(F.col("days_past_due") > 0).alias("delinquent"))


@query(
    "a09_group_size",
    "select customer_id, count(*) as accounts, count(term_months) as term_loans from accounts group by customer_id",
)
def group_size(p: Portfolio) -> DataFrame:
    return p.accounts.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("accounts"), F.count("term_months").alias("term_loans")
    )


@query(
    "a10_two_keys",
    """select customer_id, month, count(*) as accounts, max(days_past_due) as max_days_past_due
    from baseline_snapshots group by customer_id, month""",
)
def two_keys(p: Portfolio) -> DataFrame:
    return p.baseline.groupBy("customer_id", "month").agg(
        F.count(F.lit(1)).alias("accounts"), F.max("days_past_due").alias("max_days_past_due")
    )


@query(
    "a11_frequencies",
    f"""select payment_channel, count(*) as rows, {r('count(*) * 1e0 / (select count(*) from payment_events)', 6)} as share
    from payment_events group by payment_channel""",
)
def frequencies(p: Portfolio) -> DataFrame:
    return profile.frequencies(p.payment_events, "payment_channel")


def profile_sql(table: str, cols: list[str], digits: int = 4) -> str:
    return " union all ".join(
        f"""select '{c}' as column_name, count({c}) as count, {mean(c, digits)} as mean,
        {r(f'stddev_samp({c})', digits)} as std, {r(f'min({c})', digits)} as min,
        {r(f'quantile_cont({c}, 0.25)', digits)} as q25, {r(f'quantile_cont({c}, 0.5)', digits)} as q50,
        {r(f'quantile_cont({c}, 0.75)', digits)} as q75, {r(f'max({c})', digits)} as max from {table}"""
        for c in cols
    )


@query("a12_numeric_profile", profile_sql("accounts", ["credit_limit", "interest_rate", "origination_fico"]))
def numeric_profile(p: Portfolio) -> DataFrame:
    return profile.numeric_profile(p.accounts, ["credit_limit", "interest_rate", "origination_fico"])


@query(
    "a13_many_means",
    f"""select scenario_id, {mean('cashflow_stress_score')} as avg_cashflow_stress_score,
    {mean('behavioral_risk_score')} as avg_behavioral_risk_score, {rate('default_flag')} as avg_default_flag
    from account_monthly_snapshots group by scenario_id""",
)
def many_means(p: Portfolio) -> DataFrame:
    cols = ["cashflow_stress_score", "behavioral_risk_score", "default_flag"]
    return profile.group_means(p.account_monthly_snapshots, ["scenario_id"], cols)


@query(
    "a14_exact_quantiles",
    f"""select i as decile, {r('quantile_cont(l_extendedprice, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0])[i + 1]', 6)} as price,
    {r('quantile_cont(l_quantity, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0])[i + 1]', 6)} as quantity
    from lineitem, range(0, 11) t(i) group by i""",
)
def exact_quantiles(p: Portfolio) -> DataFrame:
    cols = ["l_extendedprice", "l_quantity"]
    q = ordering.exact_quantiles(p.table("lineitem", *cols), cols, [i / 10 for i in range(11)])
    rows = p.spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(zip(q["l_extendedprice"], q["l_quantity"]))],
        "decile bigint, price double, quantity double",
    )
    return rows.select(
        "decile", fx.round_half_up("price", 6).alias("price"), fx.round_half_up("quantity", 6).alias("quantity")
    )


@query(
    "a15_population_z_score",
    f"""select customer_id, {r('(annual_income - m) / s', 6)} as income_z
    from customers cross join (select avg(annual_income) m, stddev_pop(annual_income) s from customers)""",
)
def population_z_score(p: Portfolio) -> DataFrame:
    z = rules.with_moments(p.customers.select("customer_id", "annual_income"), "annual_income")
    score = fx.round_half_up(fx.z_score.sql("annual_income", "_mean", "_std"), 6)
    return z.select("customer_id", score.alias("income_z"))


@query(
    "a16_predicted_and_actual",
    f"""select scenario_id, count(default_flag) as accounts, {rate('default_flag')} as default_rate,
    {mean('predicted_pd')} as avg_predicted_pd from scored group by scenario_id""",
)
def predicted_and_actual(p: Portfolio) -> DataFrame:
    return p.scored.groupBy("scenario_id").agg(
        F.count("default_flag").alias("accounts"),
        fx.rate("default_flag").alias("default_rate"),
        fx.rounded_mean("predicted_pd").alias("avg_predicted_pd"),
    )


# ---------------------------------------------------------------------------
# Windows
# ---------------------------------------------------------------------------


@query(
    "w01_rolling_twelve_rows",
    "select customer_id, month, delinquent_accounts, delinquencies_12m from bureau_base",
)
def rolling_twelve_rows(p: Portfolio) -> DataFrame:
    return p.bureau_base.select("customer_id", "month", "delinquent_accounts", "delinquencies_12m")


_DECILES = "list_sort(list_distinct(quantile_cont({0}, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0])))"


@query(
    "w02_quantile_bucket",
    f"""with b as (select {_DECILES.format('predicted_pd')} as b from scored)
    select account_id, month, scenario_id,
      cast(greatest(1, len(list_filter(b.b, lambda q: q < predicted_pd))) as int) as risk_decile
    from scored cross join b""",
)
def quantile_bucket(p: Portfolio) -> DataFrame:
    scores = tables.staged(p.scored.select(*ROW_KEY, "scenario_id", "predicted_pd"), "scores")
    return ordering.quantile_buckets(scores, "predicted_pd", 10, "risk_decile").drop("predicted_pd")


@query(
    "w03_row_numbers",
    "select account_id, month, row_number() over (order by account_id, month) as row_no from observed",
)
def row_numbers(p: Portfolio) -> DataFrame:
    return tables.number_rows(p.observed.select(*ROW_KEY), ROW_KEY)


@query(
    "w04_scenario_delta",
    f"""with t as (select month, scenario_id, {rate('default_flag')} as default_rate
      from account_monthly_snapshots group by month, scenario_id)
    select t.month, t.scenario_id, t.default_rate, {r('t.default_rate - b.default_rate')} as default_rate_change
    from t left join t b on t.month = b.month and b.scenario_id = 'baseline'""",
)
def scenario_delta(p: Portfolio) -> DataFrame:
    trend = reports.default_trend(p.account_monthly_snapshots)
    return stress.scenario_delta(trend, ["month"], "default_rate")


# ---------------------------------------------------------------------------
# Sort, limit, top-k
# ---------------------------------------------------------------------------


@query(
    "t01_order_by_aggregate",
    f"""select state, count(*) as accounts, {mean('credit_limit', 2)} as avg_credit_limit
    from accounts a join customers c on a.customer_id = c.customer_id group by state order by accounts desc""",
)
def order_by_aggregate(p: Portfolio) -> DataFrame:
    return (
        p.borrowers.groupBy("state")
        .agg(F.count(F.lit(1)).alias("accounts"), fx.rounded_mean("credit_limit", 2).alias("avg_credit_limit"))
        .orderBy(F.desc("accounts"), "state")
    )


@query(
    "t02_order_by_two_keys",
    "select month, scenario_id, count(*) as rows from account_monthly_snapshots group by 1, 2 order by 1, 2",
)
def order_by_two_keys(p: Portfolio) -> DataFrame:
    grouped = p.account_monthly_snapshots.groupBy("month", "scenario_id").agg(F.count(F.lit(1)).alias("rows"))
    return grouped.orderBy("month", "scenario_id")


@query(
    "t03_category_order",
    f"""select {RISK_BAND} as risk_band, count(*) as accounts,
    cast(case {RISK_BAND} when 'critical' then 1 when 'high' then 2 when 'medium' then 3 when 'low' then 4 else 5 end as int) as band_rank
    from scored group by 1, 3""",
)
def category_order(p: Portfolio) -> DataFrame:
    return (
        p.scored.groupBy(risk_band().alias("risk_band"))
        .agg(F.count(F.lit(1)).alias("accounts"))
        .withColumn("band_rank", band_rank())
        .orderBy("band_rank")
    )


@query(
    "t04_top_rows",
    """select account_id, month, scenario_id, predicted_pd from scored
    order by predicted_pd desc, account_id, month, scenario_id limit 500""",
)
def top_rows(p: Portfolio) -> DataFrame:
    rows = p.scored.select(*ROW_KEY, "scenario_id", "predicted_pd")
    return ordering.top_rows(rows, "predicted_pd", [*ROW_KEY, "scenario_id"], 500)


@query(
    "t05_top_two_of_row",
    """with e as (select vec_id, unnest(embedding) as v, generate_subscripts(embedding, 1) as pos from embeddings),
    k as (select *, row_number() over (partition by vec_id order by abs(v) desc, pos desc) as place from e)
    select a.vec_id, a.pos as position_1, cast(a.v as double) as value_1, b.pos as position_2, cast(b.v as double) as value_2
    from k a join k b on a.vec_id = b.vec_id and a.place = 1 and b.place = 2""",
)
def top_two_of_row(p: Portfolio) -> DataFrame:
    from ..operators.explain import top_by_size

    entries = F.transform(
        "embedding",
        lambda v, i: F.struct(
            F.abs(v).alias("size"), (i + 1).cast("bigint").alias("name"), v.cast("double").alias("value")
        ),
    )
    first, second = top_by_size(entries, 1), top_by_size(entries, 2)
    return p.table("embeddings", "vec_id", "embedding").select(
        "vec_id",
        first["name"].alias("position_1"),
        first["value"].alias("value_1"),
        second["name"].alias("position_2"),
        second["value"].alias("value_2"),
    )


@query(
    "t06_midpoint_month",
    "select list_sort(list(distinct month))[count(distinct month) // 2 + 1] as midpoint_month from observed",
)
def midpoint_month(p: Portfolio) -> DataFrame:
    from ..operators.drift import midpoint_month as middle

    return middle(p.observed)


@query("t07_preview", "select account_id, month, min_qty, max_qty from observed order by account_id, month limit 5")
def preview(p: Portfolio) -> DataFrame:
    return p.observed.select(*ROW_KEY, "min_qty", "max_qty").orderBy(*ROW_KEY).limit(5)


# ---------------------------------------------------------------------------
# Set operations and reshape
# ---------------------------------------------------------------------------


@query(
    "u01_union_counts",
    "select 'customers' as table_name, count(*) as rows from customers union all select 'accounts', count(*) from accounts",
)
def union_counts(p: Portfolio) -> DataFrame:
    return reports.table_counts({"customers": p.customers, "accounts": p.accounts})


@query(
    "u02_options",
    "select 'all' as option union all select distinct product_type from accounts",
)
def options(p: Portfolio) -> DataFrame:
    return reports.options(p.accounts, "product_type", with_all=True)


@query(
    "u03_pivot",
    f"""with t as (select state, scenario_id, {rate('default_flag')} as v from account_monthly_snapshots s
      join customers c on s.customer_id = c.customer_id group by 1, 2)
    select state, max(case when scenario_id = 'baseline' then v end) as baseline,
      max(case when scenario_id = 'severe_credit_stress' then v end) as severe_credit_stress from t group by state""",
)
def pivot(p: Portfolio) -> DataFrame:
    located = p.account_monthly_snapshots.join(p.customers.select("customer_id", "state"), "customer_id")
    return (
        located.groupBy("state").pivot("scenario_id", list(stress.PANEL_SCENARIOS)).agg(fx.rate("default_flag"))
    )


@query(
    "u04_long_form",
    """select customer_id, month, metric, value from (
    select customer_id, month, unnest(['total_debt_balance', 'credit_utilization']) as metric,
      unnest([total_debt_balance, credit_utilization]) as value from bureau_base)""",
)
def long_form(p: Portfolio) -> DataFrame:
    return p.bureau_base.unpivot(
        ["customer_id", "month"], ["total_debt_balance", "credit_utilization"], "metric", "value"
    )


# ---------------------------------------------------------------------------
# Scalar functions
# ---------------------------------------------------------------------------


@query("f01_round_half_up", f"select event_id, {r('value', 2)} as two, {r('value', 4)} as four from events")
def round_half_up(p: Portfolio) -> DataFrame:
    return p.table("events", "event_id", "value").select(
        "event_id", fx.round_half_up("value", 2).alias("two"), fx.round_half_up("value", 4).alias("four")
    )


@query(
    "f02_round_half_even",
    f"select customer_id, {re_('monthly_income', 2)} as monthly_income, {re_('baseline_dti', 1)} as dti from customers",
)
def round_half_even(p: Portfolio) -> DataFrame:
    return p.customers.select(
        "customer_id",
        fx.round_half_even("monthly_income", 2).alias("monthly_income"),
        fx.round_half_even("baseline_dti", 1).alias("dti"),
    )


@query(
    "f03_casts",
    """select customer_id, cast(student_loan_flag as int) as flag, cast(baseline_fico as double) as fico,
    cast(age as varchar) as age_text from customers""",
)
def casts(p: Portfolio) -> DataFrame:
    return p.customers.select(
        "customer_id",
        F.col("student_loan_flag").cast("int").alias("flag"),
        F.col("baseline_fico").cast("double").alias("fico"),
        F.col("age").cast("string").alias("age_text"),
    )


@query("f04_clip", f"select event_id, case when value is not null then {clip('value', 10.0, 90.0)} end as clipped from events")
def clip_values(p: Portfolio) -> DataFrame:
    return p.table("events", "event_id", "value").select("event_id", fx.clip("value", 10.0, 90.0).alias("clipped"))


@query("f05_floor_at_zero", "select c_custkey, greatest(c_acctbal, 0e0) as positive_balance from customer")
def floor_at_zero(p: Portfolio) -> DataFrame:
    return p.table("customer", "c_custkey", "c_acctbal").select(
        "c_custkey", fx.floor_at_zero("c_acctbal").alias("positive_balance")
    )


@query("f06_sigmoid", f"select c_custkey, {r(sigmoid('c_acctbal / 100e0'), 6)} as p from customer")
def sigmoid_values(p: Portfolio) -> DataFrame:
    return p.table("customer", "c_custkey", "c_acctbal").select(
        "c_custkey", fx.round_half_up(fx.sigmoid.sql("c_acctbal / 100.0D"), 6).alias("p")
    )


@query(
    "f07_log_and_abs",
    f"select c_custkey, {r('ln(abs(c_acctbal) + 1e0)', 6)} as log_size, abs(c_acctbal) as size from customer",
)
def log_and_abs(p: Portfolio) -> DataFrame:
    return p.table("customer", "c_custkey", "c_acctbal").select(
        "c_custkey",
        fx.round_half_up("ln(abs(c_acctbal) + 1.0D)", 6).alias("log_size"),
        F.abs("c_acctbal").alias("size"),
    )


@query(
    "f08_lookup",
    """select o_orderkey, case o_orderpriority when '3-MEDIUM' then 'personal_loan'
    when '4-NOT SPECIFIED' then 'auto_loan' when '5-LOW' then 'student_refi' end as product_type from orders""",
)
def lookup(p: Portfolio) -> DataFrame:
    from ..sources.portfolio import PRODUCTS

    return p.table("orders", "o_orderkey", "o_orderpriority").select(
        "o_orderkey", fx.lookup("o_orderpriority", PRODUCTS).alias("product_type")
    )


@query(
    "f09_first_match",
    """select o_orderkey, case when o_totalprice > 200000e0 then 'large' when o_orderstatus = 'F' then 'closed'
    else 'other' end as kind from orders""",
)
def first_match(p: Portfolio) -> DataFrame:
    cases = [("o_totalprice > 200000.0D", "'large'"), ("o_orderstatus = 'F'", "'closed'")]
    return p.table("orders", "o_orderkey", "o_totalprice", "o_orderstatus").select(
        "o_orderkey", fx.first_match(cases, "'other'").alias("kind")
    )


@query(
    "f10_right_closed_bins",
    """select c_custkey, case when c_acctbal <= 0e0 then null when c_acctbal <= 1000e0 then 'a'
    when c_acctbal <= 5000e0 then 'b' else 'c' end as bin from customer""",
)
def right_closed_bins(p: Portfolio) -> DataFrame:
    bins = fx.right_closed_bins("c_acctbal", 0.0, [(1000.0, "a"), (5000.0, "b")], "c")
    return p.table("customer", "c_custkey", "c_acctbal").select("c_custkey", bins.alias("bin"))


@query(
    "f11_threshold_bands",
    """select c_custkey, case when c_acctbal >= 5000e0 then 'top' when c_acctbal >= 0e0 then 'mid' else 'debt' end as band
    from customer""",
)
def threshold_bands(p: Portfolio) -> DataFrame:
    band = fx.threshold_band("c_acctbal", [(5000.0, "top"), (0.0, "mid")], "debt")
    return p.table("customer", "c_custkey", "c_acctbal").select("c_custkey", band.alias("band"))


@query(
    "f12_date_arithmetic",
    """select account_id, month, scenario_id, payment_date, cast(payment_date - due_date as int) as days_late from payment_events""",
)
def date_arithmetic(p: Portfolio) -> DataFrame:
    return p.payment_events.select(
        *ROW_KEY, "scenario_id", "payment_date", F.date_diff("payment_date", "due_date").alias("days_late")
    )


@query(
    "f13_months",
    """select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as month,
    cast(date_trunc('month', o_orderdate) - interval 7 month as date) as earlier, cast(month(o_orderdate) as int) as month_number,
    cast(date_trunc('month', o_orderdate) + interval 23 month as date) as last_of_span from orders""",
)
def months(p: Portfolio) -> DataFrame:
    return p.table("orders", "o_orderkey", "o_orderdate").select(
        "o_orderkey",
        fx.month_start("o_orderdate").alias("month"),
        fx.months_before(fx.month_start.sql("o_orderdate"), 7).alias("earlier"),
        F.month("o_orderdate").alias("month_number"),
        F.element_at(fx.month_span("o_orderdate", 24), -1).alias("last_of_span"),
    )


@query(
    "f14_clipped_ratio",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
    least(greatest(l_tax / nullif(l_discount, 0e0), 0e0), 1.5e0) as ratio from lineitem where l_discount <> 0e0
    union all select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, null from lineitem where l_discount = 0e0""",
)
def clipped_ratio(p: Portfolio) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    ratio = fx.clipped_ratio("l_tax", "l_discount", 0.0, 1.5) + 0.0
    return p.table("lineitem", *keys, "l_tax", "l_discount").select(*keys, ratio.alias("ratio"))


@query("f15_padded_id", "select 'CUST_' || lpad(cast(c_custkey as varchar), 7, '0') as customer_id, c_custkey from customer")
def padded_id(p: Portfolio) -> DataFrame:
    return p.table("customer", "c_custkey").select(
        fx.padded_id("CUST", "c_custkey", 7).alias("customer_id"), "c_custkey"
    )


_NAMES = ["num__utilization_rate", "cat__income_band_low", "cat__employment_type_self_employed", "num__age"]


def _label_sql() -> str:
    known = " ".join(f"when '{k}' then '{v}'" for k, v in fx.FEATURE_LABELS.items())
    bare = "string_split(lower(replace(replace(replace(name, 'num__', ''), 'cat__', ''), '_', ' ')), '')"
    title = (
        f"array_to_string(list_transform({bare}, lambda ch, i: case when i > 1 and "
        f"regexp_matches({bare}[i - 1], '^[a-z]$') then ch else upper(ch) end), '')"
    )
    return f"""with n as (select event_id, event_type, case event_id % 6 {' '.join(
        f"when {i} then '{n}'" for i, n in enumerate(_NAMES))} when 4 then 'cat__' || event_type || '_' || cast(user_id as varchar) || 'm'
      end as name from events)
    select event_id, case when name is null then 'Not explained yet' else coalesce(case name {known} end, {title}) end as label from n"""


@query("f16_feature_label", _label_sql())
def feature_label(p: Portfolio) -> DataFrame:
    name = fx.lookup("event_id % 6", dict(enumerate(_NAMES)))
    made = F.concat(
        F.lit("cat__"), "event_type", F.lit("_"), F.col("user_id").cast("string"), F.lit("m")
    )
    named = p.table("events", "event_id", "event_type", "user_id").select(
        "event_id", F.when(F.col("event_id") % 6 == 4, made).otherwise(name).alias("name")
    )
    return named.select("event_id", fx.feature_label("name").alias("label"))


@query(
    "f17_number_text",
    """select account_id, printf('%.2f%%', interest_rate * 100e0) as rate_text,
    format('{:,d}', cast(floor(credit_limit) as bigint)) as limit_text from accounts""",
)
def number_text(p: Portfolio) -> DataFrame:
    return p.accounts.select(
        "account_id",
        fx.percent_text("interest_rate").alias("rate_text"),
        fx.thousands_text("floor(credit_limit)").alias("limit_text"),
    )


@query(
    "f18_missing_test",
    "select account_id, term_months is null as no_term, (case when credit_limit > 1e5 then null else credit_limit end) is null as large from accounts",
)
def missing_test(p: Portfolio) -> DataFrame:
    capped = "if(credit_limit > 100000.0D, double('NaN'), credit_limit)"
    return p.accounts.select(
        "account_id", F.col("term_months").isNull().alias("no_term"), fx.is_missing(capped).alias("large")
    )


@query(
    "f19_scaled_z_score",
    f"""select c_custkey, {r('(c_acctbal - m) / s * 35e0', 4)} as score
    from customer cross join (select avg(c_acctbal) m, stddev_pop(c_acctbal) s from customer)""",
)
def scaled_z_score(p: Portfolio) -> DataFrame:
    c = rules.with_moments(p.table("customer", "c_custkey", "c_acctbal"), "c_acctbal")
    return c.select(
        "c_custkey", fx.round_half_up(fx.z_score.sql("c_acctbal", "_mean", "_std", 35.0), 4).alias("score")
    )
