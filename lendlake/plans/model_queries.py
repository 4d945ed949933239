"""Queries on the model life-cycle: splits, features, scores, evaluation, explanation, drift."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fx
from ..functions.scalars import round_half_up
from ..operators import calibrate, drift, evaluate, explain, lifecycle, model, ordering
from ..operators import features as ft
from ..operators.training import TrainingRows
from ..sources import tables
from ..sources.portfolio import CURVE, ROW_KEY, TRAIN_SHARES, Portfolio
from ..sources.slices import SlicedTable
from .fit_sql import isotonic_sql, newton_sql
from .registry import query
from .views import CALIBRATED_BAND, LOG_ODDS, RISK_BAND, interpolated, mean, r, rate, re_, sigmoid

SNAPSHOT_KEY = [*ROW_KEY, "scenario_id"]
THREE_WAY = lifecycle.PARTS
_HASH = "md5(concat_ws('|', cast(account_id as varchar), cast(month as varchar)))"


def _hash_part(bounds: dict[str, str], last: str) -> str:
    body = " ".join(f"when substr({_HASH}, 1, 4) < '{b}' then '{name}'" for name, b in bounds.items())
    return f"case {body} else '{last}' end"


_TWO_WAY_SQL = _hash_part({"train": "c000"}, "test")
_THREE_WAY_SQL = _hash_part({"train": "999a", "calibration": "cccd"}, "test")


# --- splits and features ----------------------------------------------------


@query(
    "m01_stratified_split",
    f"""with n as (select account_id, month, default_flag, row_number() over (partition by default_flag
      order by {_HASH}, account_id, month) as place, count(*) over (partition by default_flag) as total from baseline_snapshots)
    select account_id, month, default_flag, case when place <= floor(total * 0.75e0 + 0.5e0) then 'train' else 'test' end as part from n""",
)
def stratified_split(p: Portfolio) -> DataFrame:
    rows = tables.staged(p.baseline.select(*ROW_KEY, "default_flag"), "strata")
    return ft.stratified_split(rows, "default_flag", ROW_KEY, TRAIN_SHARES)


@query("m01_hash_split", f"select account_id, month, {_TWO_WAY_SQL} as part from baseline_snapshots")
def hash_split(p: Portfolio) -> DataFrame:
    return ft.hash_split(p.baseline.select(*ROW_KEY), ROW_KEY, TRAIN_SHARES)


@query(
    "m02_three_way_split",
    f"""select part, default_flag, count(*) as rows, min(account_id) as first_account from
    (select *, {_THREE_WAY_SQL} as part from baseline_snapshots) group by part, default_flag""",
)
def three_way_split(p: Portfolio) -> DataFrame:
    return (
        ft.hash_split(p.baseline, ROW_KEY, THREE_WAY)
        .groupBy("part", "default_flag")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("account_id").alias("first_account"))
    )


_SCALED = ["credit_limit", "interest_rate", "origination_fico"]


@query(
    "m03_standardized",
    "select account_id, "
    + ", ".join(
        r(f"({c} - (select avg({c}) from accounts)) / (select stddev_pop({c}) from accounts)", 6) + f" as {c}"
        for c in _SCALED
    )
    + " from accounts",
)
def standardized(p: Portfolio) -> DataFrame:
    moments = ft.population_moments(p.accounts, _SCALED)
    return p.accounts.select(
        "account_id", *[round_half_up(ft.standardized.sql(c, moments), 6).alias(c) for c in _SCALED]
    )


_HOT = {
    "product_type": ["auto_loan", "credit_card", "personal_loan", "student_refi"],
    "risk_tier_at_origination": ["deep_subprime", "near_prime", "prime", "subprime"],
}


@query(
    "m04_one_hot",
    "select account_id, "
    + ", ".join(
        f"case when {c} = '{v}' then 1 else 0 end as cat__{c}_{v}" for c, levels in _HOT.items() for v in levels
    )
    + " from accounts",
)
def one_hot(p: Portfolio) -> DataFrame:
    cols = list(_HOT)
    rows = p.accounts.select("account_id", *cols)
    encoder = ft.one_hot_encoder(cols).fit(rows)
    hot = encoder.transform(rows)
    return hot.select(
        "account_id",
        *[
            F.get(vector_to_array(f"{c}__hot"), i).cast("int").alias(f"cat__{c}_{level}")
            for c, levels in ft.levels_of(encoder, cols).items()
            for i, level in enumerate(levels)
        ],
    )


_ASSEMBLED = ["utilization_rate", "days_past_due", "cashflow_stress_score"]


_PRODUCT_SLOTS = ["auto_loan", "credit_card", "personal_loan", "student_refi"]


@query(
    "m05_assembled",
    "select account_id, month, 7 as n_features, utilization_rate as slot_0, cast(days_past_due as double) as slot_1, cashflow_stress_score as slot_2, "
    + ", ".join(f"case when product_type = '{v}' then 1e0 else 0e0 end as slot_{i}" for i, v in enumerate(_PRODUCT_SLOTS, 3))
    + " from modeling_dataset",
)
def assembled(p: Portfolio) -> DataFrame:
    rows = p.modeling_dataset.select(*ROW_KEY, *_ASSEMBLED, "product_type")
    encoder = ft.one_hot_encoder(["product_type"]).fit(rows)
    vectors = ft.assembler(_ASSEMBLED, ["product_type"]).transform(encoder.transform(rows))
    v = vector_to_array("features")
    return vectors.select(*ROW_KEY, F.size(v).alias("n_features"), *[F.get(v, i).alias(f"slot_{i}") for i in range(7)])


_LEVELS = {
    "product_type": ["auto_loan", "credit_card", "personal_loan", "student_refi"],
    "risk_tier_at_origination": ["deep_subprime", "near_prime", "prime", "subprime"],
    "employment_type": ["hourly", "salaried", "self_employed", "student", "unemployed"],
    "income_band": ["high", "low", "middle", "upper_middle"],
    "education_level": ["associate", "bachelor", "graduate", "high_school"],
    "bankruptcy_flag": ["False", "True"],
}
_NEWTON, _FITTED_NAMES, _VECTOR = newton_sql(
    "modeling_dataset", ft.NUMERIC_FEATURES, _LEVELS, "default_flag", f"{_HASH} < 'c000'"
)


def _train_rows(p: Portfolio, weights: dict[str, float]) -> TrainingRows:
    """The columns of the fit on the training rows, packed: every step of the fit reads them."""
    train = ft.hash_split(p.modeling_dataset, ROW_KEY, weights).where(F.col("part") == "train")
    return TrainingRows.of(train, ft.NUMERIC_FEATURES, ft.CATEGORICAL_FEATURES, ft.TARGET)


@query(
    "m06_logistic_fit",
    f"""with recursive {_NEWTON}
    select feature, {r('coefficient', 5)} as coefficient from (
      select unnest([{', '.join(f"'{n}'" for n in _FITTED_NAMES)}]) as feature, unnest(b) as coefficient,
        unnest(range(1, {len(_FITTED_NAMES) + 1})) as i from fitted)
    where i in (select i from fit_rows cross join fit_places group by i having sum(abs(x[i])) > 0)""",
)
def logistic_fit(p: Portfolio) -> DataFrame:
    """Fitted coefficients of the full feature set on the training rows (levels that occur)."""
    fitted = model.fit_default_model(_train_rows(p, TRAIN_SHARES))
    return fitted.to_frame(p.spark).select("feature", round_half_up("coefficient", 5).alias("coefficient"))


@query(
    "m07_class_weights",
    """select cast(default_flag as int) as label, count(*) as rows,
    (select count(*) from baseline_snapshots) / (2e0 * count(*)) as weight from baseline_snapshots group by 1""",
)
def class_weights(p: Portfolio) -> DataFrame:
    return ft.class_weights(p.baseline)


@query(
    "m08_score",
    f"""select account_id, month, scenario_id, {r(sigmoid(LOG_ODDS), 6)} as pd,
    case when {sigmoid(LOG_ODDS)} > 0.5e0 then 1 else 0 end as predicted from account_monthly_snapshots""",
)
def score(p: Portfolio) -> DataFrame:
    scored = p.model.score(p.account_monthly_snapshots)
    return scored.select(
        *SNAPSHOT_KEY,
        round_half_up("raw_pd", 6).alias("pd"),
        evaluate.predicted_label("raw_pd").alias("predicted"),
    )


@query("m09_risk_band", f"select account_id, month, scenario_id, {RISK_BAND} as risk_band from scored")
def risk_band(p: Portfolio) -> DataFrame:
    return p.scored.select(*SNAPSHOT_KEY, model.risk_band().alias("risk_band"))


@query(
    "m10_audit_records",
    """select concat_ws('|', cast(account_id as varchar), cast(month as varchar), 'baseline') as account_month_id,
    account_id, customer_id, month, model_version, predicted_pd, risk_band, cast(null as varchar) as top_shap_feature_1,
    cast(null as double) as top_shap_value_1, cast(null as varchar) as top_shap_feature_2, cast(null as double) as top_shap_value_2,
    0e0 as psi_score, false as drift_alert_flag, false as fairness_alert_flag, false as override_flag,
    'SCORE_' || lpad(cast(row_number() over (order by account_id, month) as varchar), 10, '0') as score_id from plain_audit""",
)
def audit_records(p: Portfolio) -> DataFrame:
    """Audit rows with their surrogate id, written as one slice of the audit table."""
    keyed = tables.with_surrogate_key(p.plain_audit, "score_id", "SCORE", 10, ROW_KEY)
    return SlicedTable.of(keyed, "model_version", "audit").read()


# --- evaluation -------------------------------------------------------------


def _auc_sql(table: str, score: str, label: str, by: str = "") -> str:
    group = f"{by}, " if by else ""
    part = f"partition by {by}" if by else ""
    return f"""select {group}sum(pos) as positives, sum(neg) as negatives,
      {r("sum(pos * (cneg - neg) + 0.5e0 * pos * neg) / (cast(sum(pos) as double) * sum(neg))", 6)} as auc
    from (select *, sum(neg) over ({part} order by s) as cneg from (
      select {group}{score} as s, count(case when {label} then 1 end) as pos, count(case when not ({label}) then 1 end) as neg
      from {table} group by {group}{score})) {'group by ' + by if by else ''}"""


def _auc_columns(sql: str) -> str:
    return f"select * replace (cast(positives as bigint) as positives, cast(negatives as bigint) as negatives) from ({sql})"


@query("m11_auc", _auc_columns(_auc_sql("scored", "predicted_pd", "default_flag", "scenario_id")))
def auc(p: Portfolio) -> DataFrame:
    out = ordering.rank_auc(p.scored, "predicted_pd", "default_flag", ["scenario_id"])
    return out.withColumn("auc", round_half_up("auc", 6))


@query(
    "m11_auc_text_length",
    _auc_columns(
        _auc_sql("(select n_chars, quality from documents d join labels l on d.doc_id = l.doc_id)", "n_chars", "quality = 1")
    ),
)
def auc_text_length(p: Portfolio) -> DataFrame:
    joined = p.table("documents", "doc_id", "n_chars").join(p.table("labels", "doc_id", "quality"), "doc_id")
    return ordering.rank_auc(joined, "n_chars", "quality").withColumn("auc", round_half_up("auc", 6))


_LABELLED = "(select cast(default_flag as int) as y, cast(predicted_pd > 0.2e0 as int) as p from scored)"


@query(
    "m12_confusion_matrix",
    f"""select a as actual, q as predicted, count(s.y) as rows from (values (0), (1)) t(a) cross join (values (0), (1)) u(q)
    left join {_LABELLED} s on s.y = a and s.p = q group by a, q""",
)
def confusion_matrix(p: Portfolio) -> DataFrame:
    return evaluate.confusion_matrix(p.scored, "default_flag", evaluate.predicted_label.sql("predicted_pd", 0.2))


@query(
    "m13_classification_report",
    f"""with c as (select count(case when y = 0 and p = 0 then 1 end) * 1e0 as n00, count(case when y = 0 and p = 1 then 1 end) * 1e0 as n01,
      count(case when y = 1 and p = 0 then 1 end) * 1e0 as n10, count(case when y = 1 and p = 1 then 1 end) * 1e0 as n11 from {_LABELLED}),
    m as (select *, n00 + n01 as s0, n10 + n11 as s1, n00 / (n00 + n10) as p0, n11 / (n11 + n01) as p1,
      n00 / (n00 + n01) as r0, n11 / (n11 + n10) as r1, (n00 + n11) / (n00 + n01 + n10 + n11) as acc from c),
    f as (select *, 2e0 * p0 * r0 / (p0 + r0) as f0, 2e0 * p1 * r1 / (p1 + r1) as f1 from m)
    select "class", {r('pr')} as precision, {r('re')} as recall, {r('f')} as f1_score, cast(s as bigint) as support from (
      select '0' as "class", p0 as pr, r0 as re, f0 as f, s0 as s from f
      union all select '1', p1, r1, f1, s1 from f
      union all select 'accuracy', acc, acc, acc, s0 + s1 from f
      union all select 'macro avg', (p0 + p1) / 2e0, (r0 + r1) / 2e0, (f0 + f1) / 2e0, s0 + s1 from f
      union all select 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
        (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 from f)""",
)
def classification_report(p: Portfolio) -> DataFrame:
    return evaluate.classification_report(
        p.scored, "default_flag", evaluate.predicted_label.sql("predicted_pd", 0.2)
    )


_TENTHS = "[0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]"


@query(
    "m14_decile_table",
    f"""with b as (select list_sort(list_distinct(quantile_cont(predicted_pd, {_TENTHS}))) as b from scored)
    select cast(greatest(1, len(list_filter(b.b, lambda q: q < predicted_pd))) as int) as risk_decile, count(*) as accounts,
      {rate('default_flag')} as default_rate, {mean('predicted_pd')} as avg_predicted_pd
    from scored cross join b group by 1""",
)
def decile_table(p: Portfolio) -> DataFrame:
    return evaluate.decile_table(p.scored, "predicted_pd", "default_flag")


@query(
    "m15_brier",
    f"""select scenario_id, {r('avg((predicted_pd - cast(default_flag as int)) * (predicted_pd - cast(default_flag as int)))', 6)} as brier
    from scored group by scenario_id""",
)
def brier(p: Portfolio) -> DataFrame:
    return p.scored.groupBy("scenario_id").agg(
        round_half_up(evaluate.brier_score.sql("predicted_pd", "default_flag"), 6).alias("brier")
    )


# --- calibration ------------------------------------------------------------

_CALIBRATION_GROUPS = f"""select predicted_pd as score, count(*) * 1e0 as w, count(case when default_flag then 1 end) * 1e0 as y
      from scored where {_THREE_WAY_SQL} = 'calibration' group by 1"""


@query(
    "m16_isotonic_fit",
    f"""with recursive {isotonic_sql(_CALIBRATION_GROUPS)}
    select score, cast(w as bigint) as rows, {r('calibrated', 9)} as calibrated from iso_fit""",
)
def isotonic_fit(p: Portfolio) -> DataFrame:
    """The fit on the exact scores of the calibration slice."""
    slice_ = ft.hash_split(p.scored, ROW_KEY, THREE_WAY).where(F.col("part") == "calibration")
    groups = tables.staged(calibrate.score_groups(slice_, "predicted_pd", "default_flag"), "score-groups")
    fitted = calibrate.fit_isotonic(groups)
    return calibrate.apply_isotonic(groups, fitted, "score", "calibrated").select(
        "score", F.col("weight").cast("bigint").alias("rows"), round_half_up("calibrated", 9).alias("calibrated")
    )


@query(
    "m17_apply_calibration",
    f"select account_id, month, scenario_id, {r(interpolated('predicted_pd'), 9)} as calibrated_pd from scored",
)
def apply_calibration(p: Portfolio) -> DataFrame:
    value = round_half_up(CURVE.value_sql("predicted_pd"), 9)
    return p.scored.select(*SNAPSHOT_KEY, value.alias("calibrated_pd"))


@query(
    "m18_calibrated_band",
    f"""select account_id, month, scenario_id, {CALIBRATED_BAND} as calibrated_risk_band
    from (select *, {interpolated('predicted_pd')} as raw_calibrated_pd from scored)""",
)
def calibrated_band(p: Portfolio) -> DataFrame:
    return p.scored.select(
        *SNAPSHOT_KEY, model.calibrated_band(CURVE.value_sql("predicted_pd")).alias("calibrated_risk_band")
    )


def _two_versions(p: Portfolio) -> SlicedTable:
    """A stored audit table with two model versions; only ``logit_v1`` gets write-backs."""
    versions = F.explode(F.lit(["logit_v0", "logit_v1"])).alias("model_version")
    rows = p.plain_audit.select(*ROW_KEY, "customer_id", "predicted_pd", "risk_band", versions)
    return SlicedTable.of(rows, "model_version", "audit")


@query(
    "m19_calibration_write_back",
    f"""select account_id, month, 'logit_v1' as model_version, predicted_pd, {re_('raw_calibrated_pd')} as calibrated_pd,
      {CALIBRATED_BAND} as calibrated_risk_band from plain_audit
    union all select account_id, month, 'logit_v0', predicted_pd, null, null from plain_audit""",
)
def calibration_write_back(p: Portfolio) -> DataFrame:
    table = _two_versions(p)
    stored = table.read().where(F.col("model_version") == "logit_v1")
    values = calibrate.with_calibration(
        stored.select(*ROW_KEY, CURVE.value("predicted_pd").alias("raw_calibrated_pd"))
    )
    return calibrate.write_calibration(table, values, ROW_KEY, "logit_v1").select(
        *ROW_KEY, "model_version", "predicted_pd", "calibrated_pd", "calibrated_risk_band"
    )


_COMPARED = f"""(select default_flag, unnest(['predicted_pd', 'calibrated_pd']) as measure,
    unnest([predicted_pd, {interpolated('predicted_pd')}]) as pd from scored)"""


@query(
    "m20_raw_vs_calibrated",
    f"""select a.measure, a.auc, b.brier from ({_auc_sql(_COMPARED, 'pd', 'default_flag', 'measure')}) a
    join (select measure, {r('avg((pd - cast(default_flag as int)) * (pd - cast(default_flag as int)))', 6)} as brier
      from {_COMPARED} group by measure) b on a.measure = b.measure""",
)
def raw_vs_calibrated(p: Portfolio) -> DataFrame:
    both = p.scored.select(
        "default_flag", "predicted_pd", CURVE.value("predicted_pd").alias("calibrated_pd")
    )
    return evaluate.compare_scores(both, ["predicted_pd", "calibrated_pd"], "default_flag")


# --- the fitted path --------------------------------------------------------

_NEWTON_60, _, _ = newton_sql("modeling_dataset", ft.NUMERIC_FEATURES, _LEVELS, "default_flag", f"{_HASH} < '999a'")
_RAW_GROUPS = "select raw_pd as score, count(*) * 1e0 as w, sum(y) * 1e0 as y from run_raw where part = 'calibration' group by 1"
_RUN = f"""with recursive {_NEWTON_60},
    run_raw as materialized (select account_id, month, default_flag, cast(default_flag as int) as y, {_THREE_WAY_SQL} as part,
      1e0 / (1e0 + exp(-least(greatest(list_dot_product(x, b), -30e0), 30e0))) as raw_pd
      from (select account_id, month, default_flag, {_VECTOR} as x from modeling_dataset cross join fit_stat) cross join fitted),
    {isotonic_sql(_RAW_GROUPS)},
    run_near as (select account_id, month, default_flag, part, raw_pd, l.score as xa, l.calibrated as ya, h.score as xb, h.calibrated as yb from run_raw a
      asof left join iso_fit l on a.raw_pd >= l.score asof left join iso_fit h on a.raw_pd <= h.score),
    run as materialized (select account_id, month, default_flag, part, raw_pd, case when xa is null then yb when xb is null then ya
        when xa = xb then ya else ya + (raw_pd - xa) * (yb - ya) / (xb - xa) end as raw_calibrated_pd from run_near)"""

_TERMS = range(1, len(_FITTED_NAMES))  # without the constant


@query(
    "m29_fitted_path",
    f"""{_RUN},
    run_means as materialized (select [{', '.join(f'avg(x[{i}])' for i in _TERMS)}] as m from fit_rows),
    run_parts as (select account_id, month, [{', '.join(f'abs(b[{i}] * (x[{i}] - m[{i}]))' for i in _TERMS)}] as sizes
      from (select account_id, month, {_VECTOR} as x from modeling_dataset cross join fit_stat) cross join fitted cross join run_means),
    run_top as materialized (select account_id, month, [{', '.join(f"'{n}'" for n in _FITTED_NAMES)}][list_position(sizes, list_max(sizes))] as top_shap_feature_1
      from run_parts)
    select {CALIBRATED_BAND} as calibrated_risk_band, top_shap_feature_1, count(*) as rows, {mean('raw_pd')} as avg_raw_pd,
      {mean('raw_calibrated_pd')} as avg_calibrated_pd, {rate('default_flag')} as actual_default_rate
    from run r join run_top t on r.account_id = t.account_id and r.month = t.month group by 1, 2""",
)
def fitted_path(p: Portfolio) -> DataFrame:
    """Fit, score, calibrate, band and explain every row of the data set; rows by band and strongest driver."""
    audit = lifecycle.run_lifecycle(p.modeling_dataset, ROW_KEY).audit()
    return audit.groupBy("calibrated_risk_band", "top_shap_feature_1").agg(
        F.count(F.lit(1)).alias("rows"),
        fx.rounded_mean("raw_pd").alias("avg_raw_pd"),
        fx.rounded_mean("raw_calibrated_pd").alias("avg_calibrated_pd"),
        fx.rate("default_flag").alias("actual_default_rate"),
    )


_HELD_OUT = """(select default_flag, unnest(['raw_pd', 'calibrated_pd']) as measure, unnest([raw_pd, raw_calibrated_pd]) as pd
    from run where part = 'test')"""


@query(
    "m30_held_out_comparison",
    f"""{_RUN}
    select a.measure, a.auc, b.brier from ({_auc_sql(_HELD_OUT, 'pd', 'default_flag', 'measure')}) a
    join (select measure, {r('avg((pd - cast(default_flag as int)) * (pd - cast(default_flag as int)))', 6)} as brier
      from {_HELD_OUT} group by measure) b on a.measure = b.measure""",
)
def held_out_comparison(p: Portfolio) -> DataFrame:
    """Raw against calibrated probabilities of a fresh fit, on rows that neither the fit nor the calibrator saw."""
    return lifecycle.run_lifecycle(p.modeling_dataset, ROW_KEY).held_out()


# --- explanation ------------------------------------------------------------


@query(
    "m21_linear_attribution",
    f"""select account_id, month, d['name'] as name, {r("d['value']", 6)} as value from driver_parts""",
)
def linear_attribution(p: Portfolio) -> DataFrame:
    parts = explain.contributions(p.model, p.driver_background)
    return p.baseline.select(*ROW_KEY, F.inline(parts)).select(
        *ROW_KEY, "name", round_half_up("value", 6).alias("value")
    )


@query(
    "m22_top_drivers",
    """select account_id, month, predicted_pd, top_shap_feature_1, top_shap_value_1, top_shap_feature_2, top_shap_value_2
    from audit""",
)
def top_drivers(p: Portfolio) -> DataFrame:
    return explain.with_top_drivers(p.baseline_scored, p.model, p.driver_background).select(
        *ROW_KEY, "predicted_pd", *explain.DRIVER_COLUMNS
    )


@query(
    "m23_driver_write_back",
    """with top as (select account_id, month, top_shap_feature_1, top_shap_value_1, top_shap_feature_2, top_shap_value_2
      from audit)
    select a.account_id, a.month, 'logit_v1' as model_version, t.top_shap_feature_1, t.top_shap_value_1,
      t.top_shap_feature_2, t.top_shap_value_2
    from plain_audit a left join top t on a.account_id = t.account_id and a.month = t.month
    union all select account_id, month, 'logit_v0', null, null, null, null from plain_audit""",
)
def driver_write_back(p: Portfolio) -> DataFrame:
    table = _two_versions(p)
    explained = top_drivers(p)
    return explain.write_drivers(table, explained, ROW_KEY, "logit_v1").select(
        *ROW_KEY, "model_version", *explain.DRIVER_COLUMNS
    )


# --- drift ------------------------------------------------------------------


_MIDPOINT = "(select list_sort(list(distinct month))[count(distinct month) // 2 + 1] from {0})"
_SNAPSHOT_SOURCE = f"""select utilization_rate, cashflow_stress_score, predicted_pd, month < {_MIDPOINT.format('scored')} as is_reference
    from scored where scenario_id = 'baseline'"""


def _psi_check(source: str, features: list[str], out: str) -> str:
    """Numeric PSI with flat steps: borders, bins, counts, shares."""
    long = " union all ".join(f"select '{f}' as feature_name, cast({f} as double) as x, is_reference from psi_source" for f in features)
    return f"""with psi_source as ({source}),
    long as (select * from ({long}) where x is not null),
    borders as (select feature_name, list_sort(list_distinct(quantile_cont(x, {_TENTHS}))) as b from long where is_reference group by 1),
    counted as (select l.feature_name, greatest(1, len(list_filter(b, lambda q: q < x))) as bin,
        count(case when is_reference then 1 end) as rc, count(case when not is_reference then 1 end) as cc
      from long l join borders o on l.feature_name = o.feature_name where x between b[1] and b[len(b)] group by 1, 2),
    bins as (select feature_name, unnest(range(1, len(b))) as bin from borders where len(b) >= 3),
    shares as (select s.feature_name, coalesce(rc, 0) / (sum(rc) over (partition by s.feature_name) * 1e0) as ref,
        coalesce(cc, 0) / (sum(cc) over (partition by s.feature_name) * 1e0) as cur
      from bins s left join counted n on s.feature_name = n.feature_name and s.bin = n.bin),
    filled as (select feature_name, case when ref = 0 then 0.0001e0 else ref end as ref, case when cur = 0 then 0.0001e0 else cur end as cur from shares),
    psi as (select feature_name, {r('sum((cur - ref) * ln(cur / ref))', 6)} as psi_score from filled group by 1)
    {out}"""


@query(
    "m24_psi",
    _psi_check(
        _SNAPSHOT_SOURCE,
        ["utilization_rate", "cashflow_stress_score", "predicted_pd"],
        "select feature_name, psi_score from psi",
    ),
)
def psi(p: Portfolio) -> DataFrame:
    features = ["utilization_rate", "cashflow_stress_score", "predicted_pd"]
    return drift.psi(drift.with_period(p.baseline_scored.select("month", *features)), features)


_LEVEL = """case when psi_score is null then 'not_available' when psi_score >= 0.25e0 then 'significant_drift'
    when psi_score >= 0.10e0 then 'moderate_drift' else 'stable' end"""


@query(
    "m24_psi_events",
    _psi_check(
        "select value, user_id * 1e0 as user_no, ts < timestamp '2024-01-16' as is_reference from events",
        ["value", "user_no"],
        "select feature_name, psi_score from psi",
    ),
)
def psi_events(p: Portfolio) -> DataFrame:
    rows = p.table("events", "ts", "value", "user_id").select(
        "value",
        F.col("user_id").cast("double").alias("user_no"),
        (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).alias("is_reference"),
    )
    return drift.psi(rows, ["value", "user_no"])


@query(
    "m25_drift_level",
    f"""select feature_name, {_LEVEL} as drift_level from (select name as feature_name,
      case when value >= 1e0 then null else value end as psi_score from
      (select account_id || '-' || cast(month as varchar) as name, utilization_rate as value from baseline_snapshots))""",
)
def drift_level(p: Portfolio) -> DataFrame:
    value = F.when(F.col("utilization_rate") < 1.0, F.col("utilization_rate"))
    name = F.concat_ws("-", F.col("account_id").cast("string"), F.col("month").cast("string"))
    return p.baseline.select(name.alias("feature_name"), value.alias("psi_score")).select(
        "feature_name", drift.drift_level().alias("drift_level")
    )


_DATASET_SOURCE = f"""select {', '.join(drift.DRIFT_FEATURES)}, month < {_MIDPOINT.format('modeling_dataset')} as is_reference
    from modeling_dataset"""
_DRIFT_ROWS = f"""select feature_name, 'early_baseline_months' as reference_period, 'late_baseline_months' as current_period,
    psi_score, {_LEVEL} as drift_level from psi"""


def drift_rows(p: Portfolio) -> DataFrame:
    """Drift of the stored data set's features."""
    rows = p.modeling_dataset.select("month", *drift.DRIFT_FEATURES)
    return drift.drift_table(drift.psi(drift.with_period(rows), drift.DRIFT_FEATURES))


@query("m26_feature_drift", _psi_check(_DATASET_SOURCE, drift.DRIFT_FEATURES, _DRIFT_ROWS))
def feature_drift(p: Portfolio) -> DataFrame:
    return drift_rows(p)


_MIX = ["income_band", "product_type", "risk_tier_at_origination"]


@query(
    "m27_mix_shift",
    f"""with src as (select {', '.join(_MIX)}, month < {_MIDPOINT.format('modeling_dataset')} as is_reference from modeling_dataset),
    long as ({' union all '.join(f"select '{f}' as feature_name, {f} as bin, is_reference from src" for f in _MIX)}),
    n as (select feature_name, bin, count(case when is_reference then 1 end) * 1e0 as rc,
      count(case when not is_reference then 1 end) * 1e0 as cc from long group by 1, 2),
    s as (select feature_name, rc / sum(rc) over (partition by feature_name) as ref, cc / sum(cc) over (partition by feature_name) as cur from n),
    g as (select feature_name, case when ref = 0 then 0.0001e0 else ref end as ref, case when cur = 0 then 0.0001e0 else cur end as cur from s)
    select feature_name, {r('sum((cur - ref) * ln(cur / ref))', 6)} as psi_score from g group by 1""",
)
def mix_shift(p: Portfolio) -> DataFrame:
    return drift.mix_shift(drift.with_period(p.modeling_dataset.select("month", *_MIX)), _MIX)


@query(
    "m28_calibration_curve",
    f"""select cast(least(floor(predicted_pd * 10e0), 9) as int) + 1 as bin, count(*) as rows, {mean('predicted_pd')} as avg_predicted_pd,
    {rate('default_flag')} as actual_default_rate from scored group by 1""",
)
def calibration_curve(p: Portfolio) -> DataFrame:
    return evaluate.calibration_curve(p.scored, "predicted_pd", "default_flag")


@query(
    "m28_monotonic_check",
    f"""with d as (select cast(least(floor(predicted_pd * 10e0), 9) as int) + 1 as bin, {rate('default_flag')} as actual_default_rate
      from scored group by 1)
    select bin, actual_default_rate, coalesce(actual_default_rate >= lag(actual_default_rate) over (order by bin), true) as in_order from d""",
)
def monotonic_check(p: Portfolio) -> DataFrame:
    curve = evaluate.calibration_curve(p.scored, "predicted_pd", "default_flag")
    return evaluate.monotonic_check(curve, "bin", "actual_default_rate")
