"""The portfolio reports as named queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import FEATURE_LABELS
from ..operators import profile, quality, stress
from ..operators.drift import DRIFT_FEATURES
from ..sources.portfolio import ROW_KEY, Portfolio
from . import reports
from .model_queries import _DATASET_SOURCE, _LEVEL, _psi_check, drift_rows
from .registry import query
from .table_queries import profile_sql
from .views import mean, r, rate

_STRESS = "severe_credit_stress"
_AUTO = "auto_loan"
_SCENARIO_METRICS = f"""count(*) as rows, {rate('default_flag')} as default_rate, {rate('chargeoff_flag')} as chargeoff_rate,
    {mean('cashflow_stress_score')} as avg_cashflow_stress, {mean('behavioral_risk_score')} as avg_behavioral_risk,
    {mean('macro_stress_score')} as avg_macro_stress"""
_PAYMENT_METRICS = f"""count(*) as payment_events, {rate('missed_payment_flag')} as missed_payment_rate,
    {rate('partial_payment_flag')} as partial_payment_rate, {rate('late_payment_flag')} as late_payment_rate,
    {mean('days_late', 2)} as avg_days_late"""
_BAND_METRICS = f"""count(*) as accounts, {mean('predicted_pd')} as avg_predicted_pd, {rate('default_flag')} as actual_default_rate,
    {mean('utilization_rate')} as avg_utilization, {mean('fico_score', 1)} as avg_fico"""
_PRODUCT_METRICS = f"""count(*) as rows, {rate('default_flag')} as default_rate, {mean('utilization_rate')} as avg_utilization,
    {mean('fico_score', 1)} as avg_fico"""
_AUDITED = """(select a.*, m.product_type, m.default_flag, m.utilization_rate, m.fico_score, m.cashflow_stress_score,
    m.behavioral_risk_score from {0} a join modeling_dataset m on a.account_id = m.account_id and a.month = m.month
    where a.model_version = 'logit_v1')"""


def _of_product(facts: str, product: str) -> str:
    return f"(select f.* from {facts} f join accounts a on f.account_id = a.account_id where a.product_type = '{product}')"


def _series(report: str, index: str, metrics: list[str]) -> str:
    parts = [f"select {index}, '{m}' as metric, {m} as value from report" for m in metrics]
    return f"with report as ({report}) {' union all '.join(parts)}"


# --- portfolio summary ------------------------------------------------------

_COUNTED = ["customers", "accounts", "macro_monthly", "policy_scenarios", "account_monthly_snapshots",
            "payment_events", "bureau_monthly", "modeling_dataset", "model_scoring_audit"]


@query(
    "q01_table_counts",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as rows from {'plain_audit' if t == 'model_scoring_audit' else t}"
        for t in _COUNTED
    ),
)
def table_counts(p: Portfolio) -> DataFrame:
    counted = {t: getattr(p, t) for t in _COUNTED if t != "model_scoring_audit"}
    return reports.table_counts({**counted, "model_scoring_audit": p.plain_audit})


_SCENARIO_RISK = f"select scenario_id, {_SCENARIO_METRICS} from account_monthly_snapshots group by scenario_id"


@query("q02_scenario_risk", _SCENARIO_RISK)
def scenario_risk(p: Portfolio) -> DataFrame:
    return reports.scenario_risk(p.account_monthly_snapshots)


@query("q03_payment_behavior", f"select scenario_id, {_PAYMENT_METRICS} from payment_events group by scenario_id")
def payment_behavior(p: Portfolio) -> DataFrame:
    return reports.payment_behavior(p.payment_events)


@query("q04_band_validation", f"select risk_band, {_BAND_METRICS} from {_AUDITED.format('plain_audit')} group by risk_band")
def band_validation(p: Portfolio) -> DataFrame:
    return reports.band_validation(p.plain_audit, p.modeling_dataset, ROW_KEY)


_PRODUCT_RISK = f"select product_type, {_PRODUCT_METRICS} from modeling_dataset group by product_type"


@query("q05_product_risk", _PRODUCT_RISK)
def product_risk(p: Portfolio) -> DataFrame:
    return reports.product_risk(p.modeling_dataset)


@query("q06_dataset_summary", f"select count(*) as rows, {rate('default_flag')} as default_rate from modeling_dataset")
def dataset_summary(p: Portfolio) -> DataFrame:
    return reports.dataset_summary(p.modeling_dataset)


@query(
    "q07_band_distribution",
    f"select risk_band, count(*) as accounts, {mean('predicted_pd')} as avg_predicted_pd from plain_audit group by risk_band",
)
def band_distribution(p: Portfolio) -> DataFrame:
    return reports.band_distribution(p.plain_audit)


@query(
    "q08_calibrated_distribution",
    f"""select calibrated_risk_band, count(*) as accounts, {mean('calibrated_pd')} as avg_calibrated_pd
    from audit group by calibrated_risk_band""",
)
def calibrated_distribution(p: Portfolio) -> DataFrame:
    return reports.calibrated_distribution(p.audit)


@query(
    "q09_calibrated_validation",
    f"""select calibrated_risk_band, count(*) as accounts, {mean('calibrated_pd')} as avg_calibrated_pd,
    {rate('default_flag')} as actual_default_rate from {_AUDITED.format('audit')} group by calibrated_risk_band""",
)
def calibrated_validation(p: Portfolio) -> DataFrame:
    return reports.calibrated_validation(p.audit, p.modeling_dataset, ROW_KEY)


@query(
    "q10_drift_ranking",
    _psi_check(
        _DATASET_SOURCE,
        DRIFT_FEATURES,
        f"select feature_name, psi_score, {_LEVEL} as drift_level from psi",
    ),
)
def drift_ranking(p: Portfolio) -> DataFrame:
    return reports.drift_ranking(drift_rows(p))


_TOP = """account_id, customer_id, risk_band, predicted_pd, top_shap_feature_1, top_shap_value_1, top_shap_feature_2, top_shap_value_2"""


@query(
    "q11_explained_accounts",
    f"""select account_id, customer_id, risk_band, {r('predicted_pd')} as predicted_pd, top_shap_feature_1,
      {r('top_shap_value_1')} as top_shap_value_1, top_shap_feature_2, {r('top_shap_value_2')} as top_shap_value_2
    from (select {_TOP} from audit where top_shap_feature_1 is not null order by predicted_pd desc, account_id, month limit 10)""",
)
def explained_accounts(p: Portfolio) -> DataFrame:
    return reports.explained_accounts(p.audit)


# --- filtered reports -------------------------------------------------------


@query(
    "q12_filter_options",
    """select 'scenario' as filter, scenario_id as option from account_monthly_snapshots group by 2
    union all select 'band', 'all' union all select 'band', risk_band from plain_audit group by 2
    union all select 'product', 'all' union all select 'product', product_type from accounts group by 2""",
)
def filter_options(p: Portfolio) -> DataFrame:
    lists = {
        "scenario": reports.options(p.account_monthly_snapshots, "scenario_id"),
        "band": reports.options(p.plain_audit, "risk_band", with_all=True),
        "product": reports.options(p.accounts, "product_type", with_all=True),
    }
    parts = [df.select(F.lit(name).alias("filter"), "option") for name, df in lists.items()]
    return reduce(DataFrame.unionByName, parts)


@query(
    "q13_portfolio_size",
    f"""select 'all' as product, count(distinct customer_id) as customers, count(*) as accounts from accounts
    union all select '{_AUTO}', count(distinct customer_id), count(*) from accounts where product_type = '{_AUTO}'""",
)
def portfolio_size(p: Portfolio) -> DataFrame:
    parts = [
        reports.portfolio_size(p.accounts, product).select(F.lit(product).alias("product"), "*")
        for product in ("all", _AUTO)
    ]
    return parts[0].unionByName(parts[1])


_KPIS = f"""{rate('default_flag')} as selected_default_rate, {rate('chargeoff_flag')} as selected_chargeoff_rate,
    {mean('cashflow_stress_score')} as selected_cashflow_stress"""


@query(
    "q14_scenario_kpis",
    f"""select 'all' as product, {_KPIS} from account_monthly_snapshots where scenario_id = '{_STRESS}'
    union all select '{_AUTO}', {_KPIS} from {_of_product('account_monthly_snapshots', _AUTO)} where scenario_id = '{_STRESS}'""",
)
def scenario_kpis(p: Portfolio) -> DataFrame:
    parts = [
        reports.scenario_kpis(p.account_monthly_snapshots, _STRESS, p.accounts, product).select(
            F.lit(product).alias("product"), "*"
        )
        for product in ("all", _AUTO)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "q15_portfolio_composition",
    f"""select product_type, count(*) as accounts, count(distinct customer_id) as customers,
    {mean('credit_limit', 2)} as avg_credit_limit, {mean('interest_rate')} as avg_interest_rate from accounts group by product_type""",
)
def portfolio_composition(p: Portfolio) -> DataFrame:
    return reports.portfolio_composition(p.accounts)


@query(
    "q16_selected_scenario",
    f"""select scenario_id, {_SCENARIO_METRICS} from {_of_product('account_monthly_snapshots', _AUTO)}
    where scenario_id = '{_STRESS}' group by scenario_id""",
)
def selected_scenario(p: Portfolio) -> DataFrame:
    return reports.scenario_risk(p.account_monthly_snapshots, p.accounts, _AUTO, _STRESS)


_PRODUCT_SCENARIOS = f"select scenario_id, {_SCENARIO_METRICS} from {_of_product('account_monthly_snapshots', _AUTO)} group by scenario_id"


@query("q17_scenario_comparison", _PRODUCT_SCENARIOS)
def scenario_comparison(p: Portfolio) -> DataFrame:
    return reports.scenario_risk(p.account_monthly_snapshots, p.accounts, _AUTO)


@query("q17_scenario_series", _series(_SCENARIO_RISK, "scenario_id", reports.RATE_METRICS))
def scenario_series(p: Portfolio) -> DataFrame:
    report = reports.scenario_risk(p.account_monthly_snapshots)
    return reports.chart_series(report, "scenario_id", reports.RATE_METRICS)


def _trend(facts: str) -> str:
    return f"""select month, scenario_id, {rate('default_flag')} as default_rate, {rate('chargeoff_flag')} as chargeoff_rate,
    {mean('cashflow_stress_score')} as avg_cashflow_stress from {facts} group by month, scenario_id"""


@query("q18_default_trend", _trend("account_monthly_snapshots"))
def default_trend(p: Portfolio) -> DataFrame:
    return reports.default_trend(p.account_monthly_snapshots)


@query("q18_default_trend_product", _trend(_of_product("account_monthly_snapshots", _AUTO)))
def default_trend_product(p: Portfolio) -> DataFrame:
    return reports.default_trend(p.account_monthly_snapshots, p.accounts, _AUTO)


@query(
    "q19_trend_pivot",
    f"""select month, max(case when scenario_id = 'baseline' then default_rate end) as baseline,
    max(case when scenario_id = '{_STRESS}' then default_rate end) as {_STRESS}
    from ({_trend('account_monthly_snapshots')}) group by month""",
)
def trend_pivot(p: Portfolio) -> DataFrame:
    return reports.trend_pivot(reports.default_trend(p.account_monthly_snapshots), stress.PANEL_SCENARIOS)


@query(
    "q20_payment_selected",
    f"""select scenario_id, {_PAYMENT_METRICS} from {_of_product('payment_events', _AUTO)}
    where scenario_id = '{_STRESS}' group by scenario_id""",
)
def payment_selected(p: Portfolio) -> DataFrame:
    return reports.payment_behavior(p.payment_events, p.accounts, _AUTO, _STRESS)


_PRODUCT_PAYMENTS = f"select scenario_id, {_PAYMENT_METRICS} from {_of_product('payment_events', _AUTO)} group by scenario_id"


@query("q21_payment_comparison", _PRODUCT_PAYMENTS)
def payment_comparison(p: Portfolio) -> DataFrame:
    return reports.payment_behavior(p.payment_events, p.accounts, _AUTO)


@query("q21_payment_series", _series(_PRODUCT_PAYMENTS, "scenario_id", reports.PAYMENT_METRICS))
def payment_series(p: Portfolio) -> DataFrame:
    report = reports.payment_behavior(p.payment_events, p.accounts, _AUTO)
    return reports.chart_series(report, "scenario_id", reports.PAYMENT_METRICS)


_FILTERED_BANDS = f"""select risk_band, {_BAND_METRICS} from {_AUDITED.format('plain_audit')}
    where product_type = '{_AUTO}' and risk_band = 'medium' group by risk_band"""


@query("q22_band_validation_filtered", _FILTERED_BANDS)
def band_validation_filtered(p: Portfolio) -> DataFrame:
    return reports.band_validation(p.plain_audit, p.modeling_dataset, ROW_KEY, _AUTO, "medium")


@query(
    "q22_band_series",
    _series(
        f"select risk_band, {_BAND_METRICS} from {_AUDITED.format('plain_audit')} group by risk_band",
        "risk_band",
        reports.BAND_METRICS,
    ),
)
def band_series(p: Portfolio) -> DataFrame:
    report = reports.band_validation(p.plain_audit, p.modeling_dataset, ROW_KEY)
    return reports.chart_series(report, "risk_band", reports.BAND_METRICS)


_RANK = "cast(case risk_band when 'critical' then 1 when 'high' then 2 when 'medium' then 3 when 'low' then 4 else 5 end as int)"


@query(
    "q23_ranked_bands",
    f"""select risk_band, count(*) as accounts, {_RANK} as band_rank from {_AUDITED.format('plain_audit')}
    where product_type = 'credit_card' group by risk_band""",
)
def ranked_bands(p: Portfolio) -> DataFrame:
    return reports.ranked_band_distribution(p.plain_audit, p.modeling_dataset, ROW_KEY, "credit_card")


def _label(c: str) -> str:
    known = " ".join(f"when '{k}' then '{v}'" for k, v in FEATURE_LABELS.items())
    return f"case {c} {known} when 'num__policy_stress_index' then 'Policy Stress Index' else {c} end"


def _spotlight_sql(where: str = "") -> str:
    return f"""select account_id as "Account ID", customer_id as "Customer ID", product_type as "Product", risk_band as "Risk Band",
      {r('calibrated_pd')} as "Calibrated PD", calibrated_risk_band as "Calibrated Risk Band", {r('predicted_pd')} as "Predicted PD",
      default_flag as "Actual Default", {r('utilization_rate')} as "Utilization Rate", {r('fico_score', 1)} as "FICO Score",
      {r('cashflow_stress_score')} as "Cashflow Stress Score", {r('behavioral_risk_score')} as "Behavioral Risk Score",
      {_label('top_shap_feature_1')} as "Top Driver 1", {r('top_shap_value_1')} as "Top Driver 1 SHAP Value",
      {_label('top_shap_feature_2')} as "Top Driver 2", {r('top_shap_value_2')} as "Top Driver 2 SHAP Value"
    from (select * from {_AUDITED.format('audit')} {where} order by predicted_pd desc, account_id, month limit 25)"""


@query("q24_spotlight", _spotlight_sql())
def spotlight(p: Portfolio) -> DataFrame:
    return reports.spotlight(p.audit, p.modeling_dataset, ROW_KEY)


@query("q24_spotlight_filtered", _spotlight_sql(f"where product_type = '{_AUTO}' and risk_band = 'medium'"))
def spotlight_filtered(p: Portfolio) -> DataFrame:
    return reports.spotlight(p.audit, p.modeling_dataset, ROW_KEY, _AUTO, "medium")


@query(
    "q25_product_risk_filtered",
    f"select product_type, {_PRODUCT_METRICS} from modeling_dataset where product_type = '{_AUTO}' group by product_type",
)
def product_risk_filtered(p: Portfolio) -> DataFrame:
    return reports.product_risk(p.modeling_dataset, _AUTO)


@query("q25_product_series", _series(_PRODUCT_RISK, "product_type", reports.PRODUCT_METRICS))
def product_series(p: Portfolio) -> DataFrame:
    return reports.chart_series(reports.product_risk(p.modeling_dataset), "product_type", reports.PRODUCT_METRICS)


@query(
    "q26_takeaways",
    f"""with k as (select {_KPIS} from {_of_product('account_monthly_snapshots', _AUTO)} where scenario_id = '{_STRESS}')
    select 'Scenario view' as section,
      'The selected stress scenario shows elevated borrower pressure compared with baseline conditions.' as message from k
    union all select 'Product scope', 'The view is focused on `{_AUTO}` accounts.' from k
    union all select 'Default risk', printf('The selected view has a default rate of %.2f%%.', selected_default_rate * 100e0) from k
    union all select 'Cashflow stress', printf('The average borrower cashflow stress score is %.2f%%.', selected_cashflow_stress * 100e0) from k
    union all select 'Interpretation', 'Higher stress, utilization, and lower FICO scores are associated with higher model-predicted default risk.' from k""",
)
def takeaways(p: Portfolio) -> DataFrame:
    kpis = reports.scenario_kpis(p.account_monthly_snapshots, _STRESS, p.accounts, _AUTO)
    return reports.takeaways(kpis, _STRESS, _AUTO)


# --- profiles, means, frequencies, validation -------------------------------

_BUREAU_PROFILE = ["fico_score", "total_debt_balance", "credit_utilization", "num_open_accounts",
                   "num_recent_inquiries", "delinquencies_12m"]
_MACRO_PROFILE = ["unemployment_rate", "inflation_rate", "interest_rate_index", "rent_index", "wage_growth_rate",
                  "consumer_sentiment_index"]


@query("q27_bureau_profile", profile_sql("bureau_monthly", _BUREAU_PROFILE))
def bureau_profile(p: Portfolio) -> DataFrame:
    return profile.numeric_profile(p.bureau_monthly.select(*_BUREAU_PROFILE), _BUREAU_PROFILE)


@query("q27_macro_profile", profile_sql("macro_monthly", _MACRO_PROFILE))
def macro_profile(p: Portfolio) -> DataFrame:
    return profile.numeric_profile(p.macro_monthly.select(*_MACRO_PROFILE), _MACRO_PROFILE)


_MEANS = ["cashflow_stress_score", "behavioral_risk_score", "macro_stress_score"]
_FLAGS = ["default_flag", "chargeoff_flag"]


@query(
    "q28_scenario_means",
    f"""select scenario_id, {', '.join(f'{mean(c)} as avg_{c}' for c in _MEANS)}, {', '.join(f'{rate(c)} as avg_{c}' for c in _FLAGS)}
    from account_monthly_snapshots group by scenario_id""",
)
def scenario_means(p: Portfolio) -> DataFrame:
    return profile.group_means(p.account_monthly_snapshots, ["scenario_id"], _MEANS + _FLAGS)


_SHOCK_COLUMNS = ["interest_rate_shock_bps", "unemployment_shock", "inflation_shock", "policy_stress_index"]


@query(
    "q28_scenario_maxima",
    f"select scenario_id, {', '.join(f'{r(f'max({c})')} as max_{c}' for c in _SHOCK_COLUMNS)} from policy_scenarios group by scenario_id",
)
def scenario_maxima(p: Portfolio) -> DataFrame:
    return profile.group_maxima(p.policy_scenarios, ["scenario_id"], _SHOCK_COLUMNS)


_PAYMENT_FLAGS = ["missed_payment_flag", "partial_payment_flag", "late_payment_flag"]


@query(
    "q28_payment_flag_means",
    f"select {', '.join(f'{rate(c)} as avg_{c}' for c in _PAYMENT_FLAGS)} from payment_events",
)
def payment_flag_means(p: Portfolio) -> DataFrame:
    return profile.group_means(p.payment_events, [], _PAYMENT_FLAGS)


def _frequency_sql(col: str, table: str) -> str:
    return f"""select '{col}' as column_name, {col} as value, count(*) as rows,
    {r(f'count(*) * 1e0 / (select count(*) from {table})', 6)} as share from {table} group by {col}"""


@query(
    "q29_frequencies",
    _frequency_sql("product_type", "accounts") + " union all " + _frequency_sql("payment_channel", "payment_events"),
)
def frequencies(p: Portfolio) -> DataFrame:
    parts = [
        profile.frequencies(df, c).select(F.lit(c).alias("column_name"), F.col(c).alias("value"), "rows", "share")
        for c, df in (("product_type", p.accounts), ("payment_channel", p.payment_events))
    ]
    return parts[0].unionByName(parts[1])


def _check_sql(name: str, by: str, value: str, table: str) -> str:
    return f"select '{name}' as check_name, {by} as group_name, count(*) as rows, {value} as value from {table} group by {by}"


@query(
    "q30_validation_checks",
    " union all ".join(
        [
            _check_sql("fico_by_income_band", "income_band", mean("baseline_fico"), "customers"),
            _check_sql("rate_by_tier", "risk_tier_at_origination", mean("interest_rate"), "accounts"),
            _check_sql("late_rate_by_scenario", "scenario_id", rate("late_payment_flag"), "payment_events"),
            _check_sql("chargeoff_rate_by_scenario", "scenario_id", rate("chargeoff_flag"), "account_monthly_snapshots"),
            _check_sql(
                "failed_autopay_by_scenario", "scenario_id", rate("(payment_channel = 'failed_autopay')"), "payment_events"
            ),
            _check_sql("default_rate_by_product", "product_type", rate("default_flag"), "modeling_dataset"),
            _check_sql("default_rate_by_band", "risk_band", rate("default_flag"), _AUDITED.format("plain_audit")),
        ]
    ),
)
def validation_checks(p: Portfolio) -> DataFrame:
    failed = p.payment_events.withColumn("failed_autopay", F.col("payment_channel") == "failed_autopay")
    banded = p.plain_audit.join(p.modeling_dataset.select(*ROW_KEY, "default_flag"), ROW_KEY)
    found = {
        "fico_by_income_band": quality.mean_by(p.customers, "income_band", "baseline_fico", "value"),
        "rate_by_tier": quality.mean_by(p.accounts, "risk_tier_at_origination", "interest_rate", "value"),
        "late_rate_by_scenario": quality.rate_by(p.payment_events, "scenario_id", "late_payment_flag", "value"),
        "chargeoff_rate_by_scenario": quality.rate_by(
            p.account_monthly_snapshots, "scenario_id", "chargeoff_flag", "value"
        ),
        "failed_autopay_by_scenario": quality.rate_by(failed, "scenario_id", "failed_autopay", "value"),
        "default_rate_by_product": quality.rate_by(p.modeling_dataset, "product_type", "default_flag", "value"),
        "default_rate_by_band": quality.rate_by(banded, "risk_band", "default_flag", "value"),
    }
    parts = [
        df.select(
            F.lit(name).alias("check_name"), F.col(df.columns[0]).alias("group_name"), "rows", "value"
        )
        for name, df in found.items()
    ]
    return reduce(DataFrame.unionByName, parts)
