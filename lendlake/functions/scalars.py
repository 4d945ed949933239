"""Scalar functions shared by the rules, the model life-cycle and the reports.

A function takes SQL expression text (a column name is one) and gives a native column.
``fn.sql`` gives the text instead, so that functions nest as text and a whole rule reaches
Spark as one parsed expression rather than as hundreds of calls from Python.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce, wraps
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Values of a filter widget that mean "no filter".
NO_FILTER = (None, "all")

# Display names of model features. Names that are missing here are
# derived from the feature name itself (see ``feature_label``).
FEATURE_LABELS = {
    "num__fico_score": "FICO Score",
    "num__credit_utilization": "Credit Utilization",
    "num__delinquencies_12m": "Delinquencies in Last 12 Months",
    "num__utilization_rate": "Account Utilization Rate",
    "num__cashflow_stress_score": "Cashflow Stress Score",
    "num__behavioral_risk_score": "Behavioral Risk Score",
    "num__days_past_due": "Days Past Due",
    "num__baseline_fico": "Baseline FICO",
    "num__baseline_dti": "Baseline DTI",
    "num__interest_rate": "Interest Rate",
    "num__total_debt_balance": "Total Debt Balance",
    "num__employment_stability_score": "Employment Stability Score",
    "num__current_balance": "Current Balance",
    "num__available_credit": "Available Credit",
    "num__minimum_payment_due": "Minimum Payment Due",
    "num__actual_payment_amount": "Actual Payment Amount",
    "num__macro_stress_score": "Macro Stress Score",
    "num__credit_limit": "Credit Limit",
    "num__origination_fico": "Origination FICO",
    "num__origination_income": "Origination Income",
    "num__origination_dti": "Origination DTI",
    "num__annual_income": "Annual Income",
    "num__monthly_income": "Monthly Income",
    "num__baseline_financial_resilience": "Financial Resilience Score",
    "num__total_credit_limit": "Total Credit Limit",
    "num__num_open_accounts": "Number of Open Accounts",
    "num__num_recent_inquiries": "Recent Credit Inquiries",
    "cat__product_type_credit_card": "Product: Credit Card",
    "cat__product_type_personal_loan": "Product: Personal Loan",
    "cat__product_type_auto_loan": "Product: Auto Loan",
    "cat__product_type_student_refi": "Product: Student Refinance",
    "cat__risk_tier_at_origination_prime": "Risk Tier: Prime",
    "cat__risk_tier_at_origination_near_prime": "Risk Tier: Near Prime",
    "cat__risk_tier_at_origination_subprime": "Risk Tier: Subprime",
    "cat__risk_tier_at_origination_deep_subprime": "Risk Tier: Deep Subprime",
    "cat__income_band_low": "Income Band: Low",
    "cat__income_band_middle": "Income Band: Middle",
    "cat__income_band_upper_middle": "Income Band: Upper Middle",
    "cat__income_band_high": "Income Band: High",
}


def column(fn: Callable[..., str]) -> Callable[..., Column]:
    """Column version of a function that writes expression text; the text stays at ``.sql``."""

    @wraps(fn)
    def build(*args, **kwargs) -> Column:
        return F.expr(fn(*args, **kwargs))

    build.sql = fn
    return build


def literal(v) -> str:
    """SQL text of a Python value; floats are doubles, never decimals."""
    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float):
        return f"{v!r}D"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(v)


# --- rounding ---------------------------------------------------------------


@column
def round_half_up(x: str, digits: int) -> str:
    """Half-up rounding on the scaled double, the result SQL ``ROUND`` gives on doubles.

    Spark's own ``round`` works on the decimal text of the double and differs from that in
    about one value in a hundred. Adding 0.0 turns a negative zero into zero.
    """
    scale = literal(float(10**digits))
    return f"(signum({x}) * floor(abs({x}) * {scale} + 0.5D) / {scale} + 0.0D)"


@column
def round_half_even(x: str, digits: int) -> str:
    """Half-to-even rounding on the scaled double, the rounding of stored columns."""
    scale = literal(float(10**digits))
    return f"(rint(({x}) * {scale}) / {scale} + 0.0D)"


@column
def rate(flag: str, digits: int = 4) -> str:
    """Rounded share of true values of a boolean column (an aggregate)."""
    return round_half_up.sql(f"avg(cast({flag} as int))", digits)


@column
def rounded_mean(x: str, digits: int = 4) -> str:
    """Rounded mean of a numeric column (an aggregate)."""
    return round_half_up.sql(f"avg({x})", digits)


# --- bounds, curves and ratios ----------------------------------------------


@column
def clip(x: str, low: float | None, high: float | None) -> str:
    """Limit to [low, high]; NULL stays NULL (``greatest``/``least`` alone would skip it)."""
    bounded = x
    if low is not None:
        bounded = f"greatest({bounded}, {literal(low)})"
    if high is not None:
        bounded = f"least({bounded}, {literal(high)})"
    return f"if(({x}) is null, null, {bounded})"


@column
def floor_at_zero(x: str) -> str:
    return clip.sql(x, 0.0, None)


@column
def sigmoid(x: str) -> str:
    """Logistic function with the exponent limited to +-30."""
    return f"(1.0D / (1.0D + exp(-({clip.sql(x, -30.0, 30.0)}))))"


@column
def clipped_ratio(num: str, den: str, low: float, high: float) -> str:
    """num / den limited to [low, high]; a zero denominator gives NULL."""
    return clip.sql(f"try_divide({num}, {den})", low, high)


@column
def z_score(x: str, mean: str, std: str, scale: float = 1.0) -> str:
    return f"(try_divide({x} - {mean}, {std}) * {literal(scale)})"


@column
def is_missing(x: str) -> str:
    """NULL or NaN (double columns)."""
    return f"(({x}) is null or isnan({x}))"


# --- lookups, cases and bands -----------------------------------------------


@column
def first_match(cases: Sequence[tuple[str, str]], default: str | None = None) -> str:
    """Value of the first true condition; conditions and values are expression text."""
    body = " ".join(f"when {cond} then {value}" for cond, value in cases)
    return f"(case {body}{'' if default is None else f' else {default}'} end)"


@column
def lookup(x: str, mapping: Mapping, default=None) -> str:
    """Category to value; an unknown category gives ``default`` (NULL if not set)."""
    body = " ".join(f"when {literal(k)} then {literal(v)}" for k, v in mapping.items())
    return f"(case {x} {body} else {literal(default)} end)"


@column
def right_closed_bins(x: str, low: float, edges: Sequence[tuple[float, str]], last: str) -> str:
    """Labelled bins (low, e1], (e1, e2], ..., above the last edge; outside gives NULL."""
    cases = [(f"{x} <= {literal(low)}", "null")]
    cases += [(f"{x} <= {literal(edge)}", literal(label)) for edge, label in edges]
    return first_match.sql([*cases, (f"{x} is not null", literal(last))])


@column
def threshold_band(
    x: str, levels: Sequence[tuple[float, str]], default: str, null_label: str | None = None
) -> str:
    """Label of the first level with value >= threshold (levels in descending order).

    A missing value gets ``null_label``; without one it gets ``default``, since every
    comparison with a missing value is false.
    """
    cases = [] if null_label is None else [(f"{x} is null", literal(null_label))]
    cases += [(f"{x} >= {literal(t)}", literal(label)) for t, label in levels]
    return first_match.sql(cases, literal(default))


# --- dates ------------------------------------------------------------------


@column
def month_start(x: str) -> str:
    return f"trunc(cast({x} as date), 'MM')"


@column
def month_span(start: str, periods: int) -> str:
    """Array of ``periods`` month starts from ``start``."""
    first = month_start.sql(start)
    return f"sequence({first}, add_months({first}, {periods - 1}), interval 1 month)"


@column
def months_before(x: str, months: int | str) -> str:
    return f"add_months({x}, -({months}))"


@column
def days_after(x: str, days: int | str) -> str:
    return f"date_add({x}, {days})"


# --- text -------------------------------------------------------------------


@column
def padded_id(prefix: str, number: str, width: int) -> str:
    """Identifier text such as ``SCORE_0000000042``."""
    return f"format_string('{prefix}_%0{width}d', {number})"


@column
def percent_text(x: str, digits: int = 2) -> str:
    return f"format_string('%.{digits}f%%', ({x}) * 100.0D)"


@column
def thousands_text(x: str) -> str:
    return f"format_number({x}, 0)"


@column
def title_case(x: str) -> str:
    """Upper-case every letter that does not follow a letter, lower-case the others."""
    chars = f"split(lower({x}), '')"
    before = f"element_at(concat(array(' '), {chars}), i + 1)"
    return f"array_join(transform({chars}, (ch, i) -> if({before} rlike '^[a-z]$', ch, upper(ch))), '')"


@column
def feature_label(x: str, missing: str = "Not explained yet") -> str:
    """Readable label of a model feature name."""
    bare = f"replace(replace(replace({x}, 'num__', ''), 'cat__', ''), '_', ' ')"
    known = lookup.sql(x, FEATURE_LABELS)
    return f"(case when {x} is null then {literal(missing)} else coalesce({known}, {title_case.sql(bare)}) end)"


# --- predicates -------------------------------------------------------------


def equals_or_all(name: str, value) -> Column | None:
    """Equality predicate, or None when the value means "no filter"."""
    return None if value in NO_FILTER else F.col(name) == F.lit(value)


def portfolio_filter(
    product: str | None = None,
    band: str | None = None,
    scenario: str | None = None,
    *,
    product_col: str = "product_type",
    band_col: str = "risk_band",
    scenario_col: str = "scenario_id",
) -> Column:
    """Conjunction of the filters that are set; true when none is."""
    parts = [
        equals_or_all(product_col, product),
        equals_or_all(band_col, band),
        equals_or_all(scenario_col, scenario),
    ]
    return reduce(and_, [p for p in parts if p is not None], F.lit(True))
