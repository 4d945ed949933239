"""SQL text of the portfolio tables, for checking the DataFrame results in another engine.

Each query's check names the views it needs in its own text; ``with_views`` puts their
definitions in front, in dependency order.
"""

from __future__ import annotations

import re

# The constants of the checks are written out here, apart from those that the library uses.
RISK_BANDS = [(0.50, "critical"), (0.20, "high"), (0.05, "medium")]
CALIBRATED_BANDS = [(0.10, "critical"), (0.04, "high"), (0.015, "medium")]
CURVE_KNOTS = [(0.0, 0.0), (0.02, 0.02), (0.05, 0.04), (0.1, 0.08), (0.25, 0.16), (0.5, 0.24), (1.0, 0.5)]
MODEL_INTERCEPT = -7.2
MODEL_WEIGHTS = {
    "cashflow_stress_score": 3.2,
    "behavioral_risk_score": 1.4,
    "utilization_rate": 0.8,
    "macro_stress_score": 0.7,
    "policy_stress_index": 0.8,
    "days_past_due": 0.018,
    "baseline_financial_resilience": -1.3,
}
SNAPSHOT_COLUMNS = """account_month_id account_id customer_id month scenario_id default_flag current_balance available_credit
    utilization_rate minimum_payment_due actual_payment_amount days_past_due cashflow_stress_score behavioral_risk_score
    macro_stress_score""".split()
ACCOUNT_COLUMNS = """product_type credit_limit interest_rate term_months origination_fico origination_income origination_dti
    risk_tier_at_origination""".split()
CUSTOMER_COLUMNS = """age state employment_type annual_income monthly_income income_band education_level baseline_fico baseline_dti
    baseline_financial_resilience employment_stability_score""".split()
BUREAU_COLUMNS = """fico_score total_debt_balance total_credit_limit credit_utilization num_open_accounts num_recent_inquiries
    delinquencies_12m bankruptcy_flag""".split()


def r(x: str, digits: int = 4) -> str:
    """Half-up rounding on the scaled double."""
    return f"(sign({x}) * floor(abs({x}) * 1e{digits} + 0.5e0) / 1e{digits} + 0e0)"


def re_(x: str, digits: int = 6) -> str:
    """Half-to-even rounding on the scaled double."""
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits} + 0e0)"


def rate(flag: str, digits: int = 4) -> str:
    return r(f"avg(cast({flag} as int))", digits)


def mean(x: str, digits: int = 4) -> str:
    return r(f"avg({x})", digits)


def clip(x: str, low: float, high: float) -> str:
    return f"least(greatest({x}, {low!r}e0), {high!r}e0)"


def sigmoid(x: str) -> str:
    return f"(1e0 / (1e0 + exp(-({clip(x, -30.0, 30.0)}))))"


def case_of(x: str, mapping: dict, default: str = "null") -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else f"{v!r}e0" if isinstance(v, float) else str(v)

    body = " ".join(f"when {lit(k)} then {lit(v)}" for k, v in mapping.items())
    return f"case {x} {body} else {default} end"


def bands(x: str, levels: list, default: str) -> str:
    body = " ".join(f"when {x} >= {t!r}e0 then '{label}'" for t, label in levels)
    return f"case {body} else '{default}' end"


RISK_BAND = bands("predicted_pd", RISK_BANDS, "low")
CALIBRATED_BAND = bands("raw_calibrated_pd", CALIBRATED_BANDS, "low")
LOG_ODDS = f"{MODEL_INTERCEPT!r}e0 + " + " + ".join(f"{c} * {w!r}e0" for c, w in MODEL_WEIGHTS.items())


def interpolated(x: str) -> str:
    knots = CURVE_KNOTS
    parts = [f"when {x} <= {knots[0][0]!r}e0 then {knots[0][1]!r}e0"]
    for (xa, ya), (xb, yb) in zip(knots, knots[1:]):
        slope = (yb - ya) / (xb - xa)
        parts.append(f"when {x} <= {xb!r}e0 then {ya!r}e0 + ({x} - {xa!r}e0) * {slope!r}e0")
    parts.append(f"when {x} > {knots[-1][0]!r}e0 then {knots[-1][1]!r}e0")
    return f"case {' '.join(parts)} end"


_PAYMENT_RATE = "case product_type when 'personal_loan' then 0.035e0 when 'auto_loan' then 0.030e0 else 0.025e0 end"
_DUE = f"credit_limit * utilization_rate * ({_PAYMENT_RATE} + (interest_rate + interest_rate_shock_bps / 10000e0) / 12e0)"
_CENTS = "cast(sum(cast(floor({0} * 100e0 + 0.5e0) as bigint)) as bigint) / 100e0"

VIEWS: dict[str, str] = {
    "customers": """
select c.c_custkey as customer_id, n.n_name as state, r.r_name as region,
  lpad(cast(c.c_nationkey * 4 + c.c_custkey % 3 as varchar), 3, '0') as zip3,
  cast(2005 - c.c_custkey % 50 as int) as birth_year, cast(21 + c.c_custkey % 50 as int) as age,
  case c.c_mktsegment when 'AUTOMOBILE' then 'salaried' when 'BUILDING' then 'hourly'
    when 'FURNITURE' then 'self_employed' when 'HOUSEHOLD' then 'student' else 'unemployed' end as employment_type,
  case c.c_mktsegment when 'AUTOMOBILE' then 0.82e0 when 'BUILDING' then 0.62e0
    when 'FURNITURE' then 0.55e0 when 'HOUSEHOLD' then 0.48e0 else 0.18e0 end as employment_stability_score,
  case c.c_custkey % 4 when 0 then 'high_school' when 1 then 'associate' when 2 then 'bachelor'
    else 'graduate' end as education_level,
  c.c_custkey % 5 = 0 as student_loan_flag,
  18000e0 + (c.c_acctbal + 1000e0) * 20e0 as annual_income,
  (18000e0 + (c.c_acctbal + 1000e0) * 20e0) / 12e0 as monthly_income,
  case when c.c_acctbal <= 100e0 then 'low' when c.c_acctbal <= 2100e0 then 'middle'
    when c.c_acctbal <= 4600e0 then 'upper_middle' else 'high' end as income_band,
  cast(520 + (c.c_custkey * 7919) % 311 as int) as baseline_fico,
  0.05e0 + cast((c.c_custkey * 37) % 71 as double) / 100e0 as baseline_dti,
  least(greatest(0.45e0 + (cast(520 + (c.c_custkey * 7919) % 311 as double) - 650e0) / 300e0
    - (0.05e0 + cast((c.c_custkey * 37) % 71 as double) / 100e0) * 0.35e0, 0e0), 1e0) as baseline_financial_resilience
from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey""",
    "accounts": """
select o.o_orderkey as account_id, o.o_custkey as customer_id,
  case o.o_orderpriority when '3-MEDIUM' then 'personal_loan' when '4-NOT SPECIFIED' then 'auto_loan'
    when '5-LOW' then 'student_refi' else 'credit_card' end as product_type,
  cast(o.o_orderdate as date) as open_date, o.o_totalprice as credit_limit,
  case o.o_orderpriority when '3-MEDIUM' then 0.13e0 when '4-NOT SPECIFIED' then 0.08e0
    when '5-LOW' then 0.09e0 else 0.18e0 end
   + case when cu.baseline_fico >= 740 then 0e0 when cu.baseline_fico >= 670 then 0.025e0
    when cu.baseline_fico >= 600 then 0.065e0 else 0.11e0 end as interest_rate,
  case when o.o_orderpriority in ('1-URGENT', '2-HIGH') then cast(null as int) else 36 end as term_months,
  cu.baseline_fico as origination_fico, cu.annual_income as origination_income, cu.baseline_dti as origination_dti,
  case when cu.baseline_fico >= 740 then 'prime' when cu.baseline_fico >= 670 then 'near_prime'
    when cu.baseline_fico >= 600 then 'subprime' else 'deep_subprime' end as risk_tier_at_origination
from orders o join customers cu on o.o_custkey = cu.customer_id""",
    "observed": """
select l_orderkey as account_id, cast(date_trunc('month', l_shipdate) as date) as month,
  min(l_quantity) as min_qty, max(l_quantity) as max_qty,
  max(case when l_returnflag = 'R' then l_quantity else 0e0 end) as returned_qty,
  max(cast(round(l_discount * 100e0) as int)) as max_disc
from lineitem group by l_orderkey, cast(date_trunc('month', l_shipdate) as date)""",
    "months": """
select distinct month, (year(month) - 1995) * 12 + month(month) - 1 as month_index from observed""",
    "macro_monthly": """
select m.month, n.n_name as state,
  lpad(cast(n.n_nationkey * 4 + z.zone as varchar), 3, '0') as zip3,
  0.036e0 + (n.n_nationkey % 5) * 0.002e0 + case when m.month_index >= 42 then 0.012e0 else 0e0 end as unemployment_rate,
  0.028e0 + (n.n_nationkey % 3) * 0.002e0 + case when m.month_index >= 42 then 0.007e0 else 0e0 end as inflation_rate,
  1e0 + z.zone * 0.05e0 + case when m.month_index >= 42 then 0.1e0 else 0e0 end as interest_rate_index,
  0.94e0 + (n.n_nationkey % 7) * 0.05e0 as rent_index,
  0.032e0 - case when m.month_index >= 42 then 0.008e0 else 0e0 end as wage_growth_rate,
  93e0 + (n.n_nationkey % 9) - case when m.month_index >= 42 then 8e0 else 0e0 end as consumer_sentiment_index
from months m cross join nation n cross join (values (0), (1), (2)) z(zone)""",
    "scenario_defs": """
select * from (values ('baseline', 'Baseline Economy', 0e0, 0e0, 0e0, 0.10e0),
  ('mild_rate_shock', 'Mild Interest Rate Shock', 75e0, 0.003e0, 0.004e0, 0.30e0),
  ('cost_of_living_stress', 'Cost of Living Stress', 50e0, 0.005e0, 0.012e0, 0.50e0),
  ('regional_recession', 'Regional Recession', 100e0, 0.020e0, 0.006e0, 0.70e0),
  ('severe_credit_stress', 'Severe Credit Stress', 150e0, 0.030e0, 0.015e0, 0.90e0))
 t(scenario_id, scenario_name, bps, unemp, infl, stress)""",
    "policy_scenarios": """
select d.scenario_id, d.scenario_name, m.month,
  false as student_loan_restart_flag, 1e0 as student_loan_payment_multiplier,
  round_even(d.bps * case when m.month_index < 42 then 0.35e0 else 1e0 end * 1e2, 0) / 1e2 as interest_rate_shock_bps,
  round_even(d.unemp * case when m.month_index < 42 then 0.35e0 else 1e0 end * 1e4, 0) / 1e4 as unemployment_shock,
  round_even(d.infl * case when m.month_index < 42 then 0.35e0 else 1e0 end * 1e4, 0) / 1e4 as inflation_shock,
  round_even(d.stress * case when m.month_index < 42 then 0.35e0 else 1e0 end * 1e4, 0) / 1e4 as policy_stress_index
from scenario_defs d cross join months m""",
    "panel": """
select o.account_id, a.customer_id, o.month, s.scenario_id, a.product_type, a.credit_limit, a.interest_rate,
  o.min_qty, o.returned_qty, s.interest_rate_shock_bps, s.policy_stress_index, cu.baseline_dti,
  cu.baseline_financial_resilience, cu.employment_stability_score,
  case when o.max_disc >= 10 then 90 when o.max_disc = 9 then 60 when o.max_disc = 8 then 30 else 0 end as days_past_due,
  least(greatest(o.max_qty / 50e0 + s.policy_stress_index * 0.08e0, 0.02e0), 1.20e0) as utilization_rate,
  least(greatest(k.unemployment_rate * 5e0 + k.inflation_rate * 4e0 + k.rent_index * 0.08e0 + s.unemployment_shock * 8e0
    + s.inflation_shock * 5e0 - k.wage_growth_rate * 2.5e0 - (k.consumer_sentiment_index - 90e0) * 0.004e0, 0e0), 1e0) as macro_stress_score
from observed o join accounts a on o.account_id = a.account_id join customers cu on a.customer_id = cu.customer_id
left join macro_monthly k on o.month = k.month and cu.state = k.state and cu.zip3 = k.zip3
left join policy_scenarios s on o.month = s.month
where s.scenario_id in ('baseline', 'severe_credit_stress')""",
    "stressed": """
select p.*, least(greatest(p.baseline_dti * 0.55e0 + p.utilization_rate * 0.22e0 + p.macro_stress_score * 0.35e0
  + p.policy_stress_index * 0.30e0 - p.baseline_financial_resilience * 0.35e0
  - p.employment_stability_score * 0.18e0, 0e0), 1e0) as cashflow_stress_score
from panel p""",
    "account_monthly_snapshots": f"""
select concat_ws('|', cast(account_id as varchar), cast(month as varchar), scenario_id) as account_month_id,
  account_id, customer_id, scenario_id, month, utilization_rate, days_past_due,
  credit_limit * utilization_rate as current_balance,
  greatest(credit_limit - credit_limit * utilization_rate, 0e0) as available_credit,
  {_DUE} as minimum_payment_due,
  {_DUE} * case when days_past_due > 0 then (min_qty - 1e0) / 100e0 else 0.85e0 + min_qty / 100e0 end as actual_payment_amount,
  case when days_past_due = 0 then 'current' when days_past_due = 30 then '30_dpd'
    when days_past_due = 60 then '60_dpd' else '90_plus_dpd' end as delinquency_status,
  returned_qty >= 46e0 - policy_stress_index * 10e0 as default_flag,
  returned_qty >= 46e0 - policy_stress_index * 10e0 and days_past_due >= 90 as chargeoff_flag,
  policy_stress_index, baseline_financial_resilience, macro_stress_score, cashflow_stress_score,
  least(greatest(cashflow_stress_score * 0.55e0 + utilization_rate * 0.20e0
    + (1e0 - employment_stability_score) * 0.15e0 + policy_stress_index * 0.10e0, 0e0), 1e0) as behavioral_risk_score
from stressed""",
    "payment_base": """
select s.account_month_id, s.account_id, s.customer_id, s.scenario_id, s.month, s.days_past_due, s.behavioral_risk_score,
  s.minimum_payment_due as scheduled_payment_amount, s.actual_payment_amount,
  s.actual_payment_amount <= s.minimum_payment_due * 0.10e0 as missed_payment_flag,
  s.actual_payment_amount > 0e0 and s.actual_payment_amount < s.minimum_payment_due * 0.95e0 as partial_payment_flag,
  cast(case when s.days_past_due = 30 then 10 + s.account_id % 30 when s.days_past_due = 60 then 35 + s.account_id % 35
    when s.days_past_due >= 90 then 65 + s.account_id % 45 else s.account_id % 6 end as int) as days_late,
  case when s.behavioral_risk_score < 0.30e0 then case s.account_id % 3 when 0 then 'autopay' when 1 then 'online' else 'mobile' end
    when s.behavioral_risk_score < 0.60e0 then case s.account_id % 4 when 0 then 'autopay' when 1 then 'online'
      when 2 then 'mobile' else 'branch' end
    else case s.account_id % 4 when 0 then 'online' when 1 then 'mobile' when 2 then 'branch' else 'failed_autopay' end end as payment_channel
from account_monthly_snapshots s""",
    "payment_events": """
select p.*, p.days_late >= 3 as late_payment_flag, p.month + cast(15 + p.account_id % 11 as int) as due_date,
  p.month + cast(15 + p.account_id % 11 + p.days_late as int) as payment_date
from payment_base p""",
    "baseline_snapshots": """
select * from account_monthly_snapshots where scenario_id = 'baseline'""",
    "customer_month": f"""
select customer_id, month, {_CENTS.format('current_balance')} as total_debt_balance, max(days_past_due) as max_days_past_due,
  count(case when days_past_due > 0 then 1 end) as delinquent_accounts,
  count(case when default_flag then 1 end) as default_count, count(case when chargeoff_flag then 1 end) as chargeoff_count
from baseline_snapshots group by customer_id, month""",
    "credit_lines": f"""
select customer_id, {_CENTS.format('credit_limit')} as total_credit_limit, count(*) as num_open_accounts
from accounts group by customer_id""",
    "bureau_base": """
select m.customer_id, m.month, m.total_debt_balance, m.max_days_past_due, m.delinquent_accounts, m.default_count,
  m.chargeoff_count, l.total_credit_limit, l.num_open_accounts,
  least(greatest(m.total_debt_balance / nullif(l.total_credit_limit, 0e0), 0e0), 1.5e0) as credit_utilization,
  cast(sum(m.delinquent_accounts) over (partition by m.customer_id order by m.month
    rows between 11 preceding and current row) as bigint) as delinquencies_12m
from customer_month m left join credit_lines l on m.customer_id = l.customer_id""",
    "bureau_scored": """
select b.*, cast(round_even(least(greatest(c.baseline_fico - b.credit_utilization * 75e0 - b.delinquencies_12m * 7e0
  - case when b.max_days_past_due >= 90 then 55e0 else 0e0 end - b.default_count * 35e0 - b.chargeoff_count * 65e0
  + c.baseline_financial_resilience * 25e0 + c.employment_stability_score * 15e0, 300e0), 850e0), 0) as int) as fico_score
from bureau_base b left join customers c on b.customer_id = c.customer_id""",
    "bureau_monthly": """
select b.*, cast((b.customer_id * 13 + month(b.month)) % 4 as int) as num_recent_inquiries,
  least(greatest(0.0002e0 + case when max_days_past_due >= 90 then 1e0 else 0e0 end * 0.002e0
   + case when chargeoff_count > 0 then 1e0 else 0e0 end * 0.006e0
   + case when fico_score < 500 then 1e0 else 0e0 end * 0.003e0, 0e0), 0.03e0) >= 0.005e0 as bankruptcy_flag
from bureau_scored b""",
    "modeling_dataset": "\nselect "
    + ", ".join(
        [f"s.{c}" for c in SNAPSHOT_COLUMNS]
        + [f"a.{c}" for c in ACCOUNT_COLUMNS]
        + [f"c.{c}" for c in CUSTOMER_COLUMNS]
        + [f"b.{c}" for c in BUREAU_COLUMNS]
    )
    + """
from account_monthly_snapshots s join accounts a on s.account_id = a.account_id
join customers c on s.customer_id = c.customer_id
left join bureau_monthly b on s.customer_id = b.customer_id and s.month = b.month
where s.scenario_id = 'baseline'""",
    "scored": f"""
select s.*, floor({sigmoid(LOG_ODDS)} * 1e6 + 0.5e0) / 1e6 as predicted_pd from account_monthly_snapshots s""",
    "driver_means": "\nselect " + ", ".join(f"avg({c}) as mean_{c}" for c in MODEL_WEIGHTS) + " from train_rows",
    "driver_parts": "\nselect account_id, month, unnest(["
    + ", ".join(f"{{'name': 'num__{c}', 'value': {w!r}e0 * ({c} - mean_{c})}}" for c, w in MODEL_WEIGHTS.items())
    + "]) as d from scored cross join driver_means where scenario_id = 'baseline'",
    "train_rows": """
select * from baseline_snapshots
where substr(md5(concat_ws('|', cast(account_id as varchar), cast(month as varchar))), 1, 4) < 'c000'""",
    "drivers": """
select account_id, month, arg_max(d, {'size': abs(d['value']), 'name': d['name']}, 2) as top
from driver_parts group by account_id, month""",
    "audit": f"""
select s.account_id, s.customer_id, s.month, 'logit_v1' as model_version, s.predicted_pd,
  {RISK_BAND} as risk_band, top[1]['name'] as top_shap_feature_1, {re_("top[1]['value']")} as top_shap_value_1,
  top[2]['name'] as top_shap_feature_2, {re_("top[2]['value']")} as top_shap_value_2,
  {re_("raw_calibrated_pd")} as calibrated_pd, {CALIBRATED_BAND} as calibrated_risk_band
from (select *, {interpolated("predicted_pd")} as raw_calibrated_pd from scored where scenario_id = 'baseline') s
join drivers d on s.account_id = d.account_id and s.month = d.month""",
    "plain_audit": f"""
select account_id, customer_id, month, 'logit_v1' as model_version, {re_("predicted_pd")} as predicted_pd,
  {RISK_BAND} as risk_band, {interpolated("predicted_pd")} as raw_calibrated_pd
from scored where scenario_id = 'baseline'""",
}


#: Relations that a check may use more than once: computed once.
MATERIALIZED = {"account_monthly_snapshots", "modeling_dataset", "driver_means", "drivers"}


def _needed(text: str, seen: list[str]) -> None:
    """Collect the views a text uses, each one after the views it uses itself."""
    for name, body in VIEWS.items():
        if name not in seen and re.search(rf"\b{name}\b", text):
            _needed(body, seen)
            if name not in seen:
                seen.append(name)


def with_views(sql: str) -> str:
    """The check with the definitions of the views it uses; local ``with`` parts are kept."""
    names: list[str] = []
    _needed(sql, names)
    if not names:
        return sql.strip()
    head = ",\n".join(f"{n} as {'materialized ' * (n in MATERIALIZED)}({VIEWS[n].strip()})" for n in names)
    body = sql.strip()
    if body.lower().startswith("with recursive "):
        return f"with recursive {head},\n{body[15:]}"
    if body.lower().startswith("with "):
        return f"with {head},\n{body[5:]}"
    return f"with {head}\n{body}"
