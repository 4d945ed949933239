"""Boundary values of scalar functions and rules on hand-made frames."""

import math

import pytest
from pyspark.sql import functions as F

from lendlake.functions import scalars as fx
from lendlake.operators import bureau, model, rules, stress


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


def doubles(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "x double")


def test_half_up_follows_the_scaled_double(spark):
    df = doubles(spark, [1.005, 2.5, -2.5, 0.12345, -0.00001, None])
    assert values(df, fx.round_half_up("x", 2)) == [1.0, 2.5, -2.5, 0.12, 0.0, None]
    assert math.copysign(1, values(df, fx.round_half_up("x", 2))[4]) == 1.0


def test_half_even_matches_numpy(spark):
    np = pytest.importorskip("numpy")
    xs = [0.575, 0.125, 0.135, 2.675, -0.125, 1.005]
    assert values(doubles(spark, xs), fx.round_half_even("x", 2)) == [float(v) for v in np.round(xs, 2)]


def test_clip_and_sigmoid_keep_null(spark):
    df = doubles(spark, [-100.0, 0.0, 100.0, None])
    assert values(df, fx.clip("x", -1.0, 1.0)) == [-1.0, 0.0, 1.0, None]
    p = values(df, fx.sigmoid("x"))
    assert p[0] == pytest.approx(1 / (1 + math.exp(30))) and p[1] == 0.5 and p[3] is None


def test_ratio_with_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 1.0), (1.0, 4.0)], "a double, b double")
    assert values(df, fx.clipped_ratio("a", "b", 0.0, 1.5)) == [None, 1.5, 0.25]


def test_income_band_edges(spark):
    df = doubles(spark, [-1.0, 0.0, 40000.0, 40000.01, 80000.0, 130000.0, 130000.01, None])
    want = [None, None, "low", "middle", "middle", "upper_middle", "high", None]
    assert values(df, rules.income_band("x")) == want


def test_risk_tier_edges(spark):
    df = spark.createDataFrame([(f,) for f in (599, 600, 669, 670, 739, 740)], "f int")
    want = ["deep_subprime", "subprime", "subprime", "near_prime", "near_prime", "prime"]
    assert values(df, rules.risk_tier("f")) == want


def test_risk_and_calibrated_bands(spark):
    df = doubles(spark, [0.0, 0.015, 0.0399999, 0.04, 0.05, 0.1, 0.2, 0.4999999, 0.5, 1.0, None])
    assert values(df, model.risk_band("x")) == (
        ["low"] * 4 + ["medium"] * 2 + ["high"] * 2 + ["critical"] * 2 + ["low"]
    )
    assert values(df, model.calibrated_band("x")) == (
        ["low", "medium", "medium", "high", "high"] + ["critical"] * 5 + ["low"]
    )


def test_band_belongs_to_the_unrounded_probability(spark):
    df = spark.createDataFrame([("a", "m", 0.4999996)], "account_id string, month string, raw_pd double")
    row = model.audit_records(df).first()
    assert (row["predicted_pd"], row["risk_band"]) == (0.5, "high")


def test_days_past_due_and_status(spark):
    df = spark.createDataFrame(
        [(False, 0.9), (True, 0.44), (True, 0.45), (True, 0.69), (True, 0.70)],
        "missed_payment_flag boolean, behavioral_risk_score double",
    ).withColumn("days_past_due", rules.days_past_due())
    assert values(df, "days_past_due") == [0, 30, 60, 60, 90]
    assert values(df, rules.delinquency_status()) == ["current", "30_dpd", "60_dpd", "60_dpd", "90_plus_dpd"]


def test_payment_flags_may_overlap(spark):
    df = spark.createDataFrame([(r * 100.0, 100.0) for r in (0, 0.05, 0.10, 0.5, 0.95, 1)], "p double, d double")
    assert values(df, rules.missed_payment("p", "d")) == [True, True, True, False, False, False]
    assert values(df, rules.partial_payment("p", "d")) == [False, True, True, True, False, False]


def test_lower_score_pays_more(spark):
    df = spark.createDataFrame(
        [("auto_loan", t) for t in ("prime", "near_prime", "subprime", "deep_subprime")],
        "product_type string, risk_tier_at_origination string",
    )
    rates = values(df, rules.interest_rate())
    assert rates == sorted(rates) and rates[0] == 0.08


def test_unknown_category_has_no_price(spark):
    df = spark.createDataFrame([("boat_loan", "prime")], "product_type string, risk_tier_at_origination string")
    assert values(df, rules.interest_rate()) == [None]


def test_macro_join_uses_all_three_keys(spark):
    panel = spark.createDataFrame([(1, "m", "NY", "100"), (2, "m", "NY", "101")], "id int, month string, state string, zip3 string")
    macro = spark.createDataFrame([("m", "NY", "100", 0.04)], "month string, state string, zip3 string, unemployment_rate double")
    out = {r["id"]: r["unemployment_rate"] for r in stress.join_macro(panel, macro).collect()}
    assert out == {1: 0.04, 2: None}


def test_scenario_builder_with_own_definitions(spark):
    own = [stress.Scenario("mine", "Mine", 200.0, 0.02, 0.01, 0.5)]
    months = spark.createDataFrame([("2025-01-01", 0), ("2026-01-01", 12)], "month string, month_index int")
    out = stress.scenario_months(stress.scenario_definitions(spark, own), months).orderBy("month").collect()
    assert [r["interest_rate_shock_bps"] for r in out] == [70.0, 200.0]
    assert [r["policy_stress_index"] for r in out] == [0.175, 0.5]


def test_rolling_count_uses_rows_not_months(spark):
    df = spark.createDataFrame([("c", m, 1) for m in (1, 2, 15, 16)], "customer_id string, month int, n int")
    rolled = df.withColumn("n12", bureau.rolling_count("n")).orderBy("month")
    assert [r["n12"] for r in rolled.collect()] == [1, 2, 3, 4]


def test_feature_labels(spark):
    names = ["num__fico_score", "cat__bankruptcy_flag_True", "num__age", "cat__x_12m_late", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert values(df, fx.feature_label("n")) == [
        "FICO Score", "Bankruptcy Flag True", "Age", "X 12M Late", "Not explained yet",
    ]


def test_filters(spark):
    df = spark.createDataFrame([("a", "low", "s"), ("b", "high", "s")], "product_type string, risk_band string, scenario_id string")
    assert df.where(fx.portfolio_filter()).count() == 2
    assert df.where(fx.portfolio_filter("all", None, "s")).count() == 2
    assert df.where(fx.portfolio_filter("a", "high")).count() == 0


def test_literals():
    assert fx.literal(0.00001) == "1e-05D"
    assert fx.literal("it's") == "'it\\'s'"
    assert fx.literal(True) == "true" and fx.literal(None) == "null"


def test_quoted_literal_round_trip(spark):
    text = "a'b\\c"
    assert spark.range(1).select(F.expr(fx.literal(text))).first()[0] == text
