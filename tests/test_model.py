"""Model life-cycle against small numpy/pandas computations."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendlake.operators import calibrate, drift, evaluate, explain, features, model, ordering
from lendlake.session import fresh_path


@pytest.fixture(scope="module")
def logit_data():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 3)) * [1.0, 5.0, 0.2] + [0.0, 10.0, 1.0]
    odds = 0.8 * x[:, 0] - 0.3 * (x[:, 1] - 10) + 2.0 * (x[:, 2] - 1) - 1.0
    y = rng.random(400) < 1 / (1 + np.exp(-odds))
    return pd.DataFrame({"id": range(400), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y})


def newton(x, y, weight):
    """Minimise weighted log-loss + |w|^2 / 2 with a free intercept."""
    design = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([0.0] + [1.0] * x.shape[1])
    w = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        grad = design.T @ (weight * (p - y)) + penalty @ w
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + penalty
        w -= np.linalg.solve(hess, grad)
    return w


def test_fit_equals_newton(spark, logit_data):
    df = spark.createDataFrame(logit_data)
    fitted = model.fit_default_model(df, ["a", "b", "c"], [], "y", tol=1e-9).model
    x = logit_data[["a", "b", "c"]].to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    y = logit_data["y"].to_numpy().astype(float)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    w = newton(z, y, weight)
    assert fitted.index.intercept == pytest.approx(w[0], abs=1e-8)
    assert [t.weight for t in fitted.index.terms] == pytest.approx(list(w[1:] / x.std(0)), abs=1e-8)
    p = [r["raw_pd"] for r in fitted.score(df).orderBy("id").collect()]
    assert p == pytest.approx(list(1 / (1 + np.exp(-(w[0] + z @ w[1:])))), abs=1e-8)


def test_model_with_categories_survives_storage(spark, logit_data):
    df = spark.createDataFrame(logit_data).withColumn("kind", F.when(F.col("id") % 3 == 0, "it's").otherwise("k2"))
    df = df.withColumn("flag", F.col("id") % 2 == 0)
    fitted = model.fit_default_model(df, ["a"], ["kind", "flag"], "y").model
    names = [r[0] for r in fitted.to_rows()]
    assert names == ["(intercept)", "num__a", "cat__kind_it's", "cat__kind_k2", "cat__flag_False", "cat__flag_True"]
    path = fresh_path(spark, "model")
    fitted.save(spark, path)
    read = model.LinearModel.read(spark, path)
    assert sorted(read.to_rows()) == sorted(fitted.to_rows())
    unseen = spark.createDataFrame([(0.0, "zzz", None), (0.0, None, None)], "a double, kind string, flag boolean")
    p = {r["raw_pd"] for r in read.score(unseen).collect()}
    assert len(p) == 1 and None not in p


def test_fit_ends_at_the_least_loss(spark):
    """Scaled badly and all but separable: steps are halved where they overshoot, and the gradient vanishes."""
    rows = [(float(i) ** 3, float(i % 7), i > 30 or i == 5) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, y boolean").repartition(5)
    fitted = model.fit_default_model(df, ["a", "b"], [], "y", inverse_regularization=1e4)
    assert fitted.gradient <= 1e-7 and fitted.steps < 100
    one = model.fit_default_model(df.where("y"), ["a", "b"], [], "y")  # one class only
    assert one.gradient <= 1e-6 and one.steps <= 100


def test_missing_feature_is_an_error(spark):
    df = spark.createDataFrame([(1.0, True), (None, False)], "a double, y boolean")
    with pytest.raises(ValueError, match=r"'a': 1"):
        model.fit_default_model(df, ["a"], [], "y")


def test_attribution_adds_up_to_the_log_odds(spark, logit_data):
    df = spark.createDataFrame(logit_data)
    fitted = model.fit_default_model(df, ["a", "b", "c"], [], "y").model
    means = explain.background_means(df, fitted)
    base = fitted.index.intercept + sum(t.weight * (means[t.column] - t.center) for t in fitted.index.terms)
    total = F.aggregate("parts", F.lit(0.0), lambda acc, e: acc + e["value"])
    rows = df.withColumn("parts", explain.contributions(fitted, means)).select(
        total.alias("sum"), fitted.log_odds().alias("odds")
    )
    for r in rows.collect():
        assert r["sum"] + base == pytest.approx(r["odds"], abs=1e-9)
    top = explain.with_top_drivers(df, fitted, means).first()
    assert abs(top["top_shap_value_1"]) >= abs(top["top_shap_value_2"])
    assert top["top_shap_feature_1"].startswith("num__")


def pav(x, y, w):
    blocks = []
    for v, n in zip(y, w):
        blocks.append([v * n, n, 1])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n2, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n2, blocks[-1][2] + k]
    return [s / n for s, n, k in blocks for _ in range(k)]


def test_isotonic_equals_pool_adjacent_violators(spark):
    rng = np.random.default_rng(3)
    score = np.round(rng.random(600), 2)
    label = rng.random(600) < score**2
    df = spark.createDataFrame(pd.DataFrame({"s": score, "y": label}))
    groups = calibrate.score_groups(df, "s", "y")
    fitted = calibrate.fit_isotonic(groups)
    got = calibrate.apply_isotonic(groups, fitted, "score", "v").orderBy("score").toPandas()
    want = pav(got["score"], got["outcome"], got["weight"])
    assert list(got["v"]) == pytest.approx(want, abs=1e-9)
    outside = spark.createDataFrame([(-1.0,), (2.0,)], "score double")
    edge = [r["v"] for r in calibrate.apply_isotonic(outside, fitted, "score", "v").collect()]
    assert edge == pytest.approx([want[0], want[-1]])


def test_curve_interpolates_and_clips(spark):
    curve = calibrate.Curve([(0.1, 0.0), (0.5, 0.4), (0.9, 0.4)])
    df = spark.createDataFrame([(0.0,), (0.3,), (0.7,), (1.0,), (None,)], "s double")
    got = [r[0] for r in df.select(curve.value("s")).collect()]
    assert got[:4] == pytest.approx([0.0, 0.2, 0.4, 0.4]) and got[4] is None


def test_exact_quantiles_equal_pandas(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame(
        {
            "u": rng.random(3000),
            "hot": np.where(rng.random(3000) < 0.4, 5.0, rng.integers(0, 50, 3000)).astype(float),
            "tail": np.exp(rng.normal(size=3000) * 6),
        }
    )
    frame.loc[::17, "u"] = np.nan
    probs = [0, 0.1, 0.25, 0.5, 0.9, 0.999, 1]
    got = ordering.exact_quantiles(spark.createDataFrame(frame).repartition(5), list(frame), probs)
    for c in frame:
        assert got[c] == pytest.approx(list(frame[c].quantile(probs)), rel=1e-12), c


def test_quantiles_of_nothing_and_of_one_value(spark):
    df = spark.createDataFrame([(None, 3.0), (None, 3.0)], "e double, k double")
    assert ordering.exact_quantiles(df, ["e", "k"], [0.1, 0.5]) == {"e": [None, None], "k": [3.0, 3.0]}


def test_ties_share_a_bucket(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 0, 0, 0, 1, 2, 3, 4)], "x double")
    out = ordering.quantile_buckets(df, "x", 4).orderBy("x").collect()
    assert [r["bucket"] for r in out] == [1, 1, 1, 1, 2, 2, 3, 3]


def test_bucket_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 5, 9, 0)], "x double")
    assert [r[0] for r in df.select(ordering.bucket_of("x", [1, 3, 5])).collect()] == [1, 1, 1, 2, 2, None, None]


def test_auc_with_ties_equals_pair_counting(spark):
    rng = np.random.default_rng(5)
    s = np.round(rng.random(500), 2)
    y = rng.random(500) < s
    pos, neg = s[y], s[~y]
    want = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    df = spark.createDataFrame(pd.DataFrame({"s": s, "y": y}))
    row = ordering.rank_auc(df, "s", "y", parts=16).first()
    assert (row["positives"], row["negatives"]) == (len(pos), len(neg))
    assert row["auc"] == pytest.approx(want, abs=1e-12)


def test_classification_report_and_matrix(spark):
    df = spark.createDataFrame([(0, 0.1)] * 5 + [(0, 0.9)] * 2 + [(1, 0.8)] * 3, "y int, p double")
    predicted = evaluate.predicted_label.sql("p")
    cells = {(r["actual"], r["predicted"]): r["rows"] for r in evaluate.confusion_matrix(df, "y", predicted).collect()}
    assert cells == {(0, 0): 5, (0, 1): 2, (1, 0): 0, (1, 1): 3}
    report = {r["class"]: r for r in evaluate.classification_report(df, "y", predicted).collect()}
    assert (report["1"]["precision"], report["1"]["recall"], report["1"]["f1_score"]) == (0.6, 1.0, 0.75)
    assert report["accuracy"]["f1_score"] == 0.8 and report["weighted avg"]["support"] == 10


def reference_psi(ref, cur, buckets=10):
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, buckets + 1)))
    if len(edges) < 3:
        return None
    shares = []
    for side in (ref, cur):
        counts = pd.cut(pd.Series(side), edges, include_lowest=True).value_counts(sort=False)
        share = (counts / counts.sum()).to_numpy()
        shares.append(np.where(share == 0, 1e-4, share))
    r, c = shares
    return float(np.sum((c - r) * np.log(c / r)))


def test_psi_equals_pandas(spark):
    rng = np.random.default_rng(11)
    n = 2000
    frame = pd.DataFrame(
        {
            "smooth": rng.normal(size=n),
            "tied": rng.integers(0, 6, n).astype(float),
            "constant": 1.0,
            "shifted": rng.normal(size=n),
            "is_reference": np.arange(n) < 900,
        }
    )
    current = ~frame["is_reference"]
    frame.loc[current, "shifted"] += 1.5
    frame.loc[current & (frame["tied"] == 2), "tied"] = 3
    features_ = ["smooth", "tied", "constant", "shifted"]
    got = {r[0]: r[1] for r in drift.psi(spark.createDataFrame(frame), features_).collect()}
    for f in features_:
        want = reference_psi(frame.loc[~current, f], frame.loc[current, f])
        assert got[f] == (None if want is None else pytest.approx(want, abs=2e-6)), f


def test_psi_of_an_empty_side_is_missing(spark):
    df = spark.createDataFrame([(float(i), True) for i in range(20)], "x double, is_reference boolean")
    assert drift.psi(df, ["x"]).first()["psi_score"] is None
    flipped = df.withColumn("is_reference", ~F.col("is_reference"))
    assert drift.psi(flipped, ["x"]).first()["psi_score"] is None
    level = drift.drift_table(drift.psi(df, ["x"])).first()["drift_level"]
    assert level == "not_available"


def test_drift_levels(spark):
    df = spark.createDataFrame([(0.0999,), (0.10,), (0.2499,), (0.25,), (None,)], "psi_score double")
    assert [r[0] for r in df.select(drift.drift_level()).collect()] == [
        "stable", "moderate_drift", "moderate_drift", "significant_drift", "not_available",
    ]


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_stratified_split_meets_its_quotas(spark, n):
    df = spark.range(n).select("id", (F.col("id") % 5 == 0).alias("y"))
    out = features.stratified_split(df, "y", ["id"], {"train": 0.6, "cal": 0.2, "test": 0.2}).toPandas()
    assert len(out) == n and out["id"].is_unique
    for _, part in out.groupby("y"):
        total = len(part)
        assert (part["part"] == "train").sum() == int(np.floor(total * 0.6 + 0.5))
        assert (part["part"] == "test").sum() == total - int(np.floor(total * 0.8 + 0.5))


def test_unseen_category_is_all_zero(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    encoder = features.one_hot_encoder(["k"]).fit(train)
    hot = encoder.transform(spark.createDataFrame([("a",), ("zzz",), (None,)], "k string"))
    assert [list(r["k__hot"].toArray()) for r in hot.select("k__hot").collect()] == [[1, 0, 0], [0, 0, 0], [0, 0, 0]]


def test_sample_is_fixed_and_without_repeats(spark):
    df = spark.range(500)
    first = {r["id"] for r in ordering.sample_rows(df, ["id"], 50).collect()}
    assert len(first) == 50
    assert first == {r["id"] for r in ordering.sample_rows(df.repartition(9), ["id"], 50).collect()}
    assert first != {r["id"] for r in ordering.sample_rows(df, ["id"], 50, seed=1).collect()}


@pytest.mark.parametrize(("accuracy", "few", "most"), [(10_000, 30_000, 1 << 20), (50, 60, 1 << 20), (50, 60, 20), (20, 0, 7)])
def test_cells_give_exact_quantiles_at_any_size(spark, monkeypatch, accuracy, few, most):
    """Rough sketches, missed intervals and divided cells change the passes, not the results."""
    for name, value in (("SKETCH_ACCURACY", accuracy), ("MARGIN", 1 / (2 * accuracy)), ("FEW_ROWS", few), ("CELL_VALUES", most), ("DIVISIONS", 8)):
        monkeypatch.setattr(ordering, name, value)
    rng = np.random.default_rng(7)
    n = 4000
    frame = pd.DataFrame({"u": rng.random(n), "hot": np.where(rng.random(n) < 0.4, 5.0, rng.integers(0, 50, n)).astype(float)})
    frame.loc[::17, "u"] = np.nan
    probs = [0, 0.1, 0.25, 0.5, 0.9, 0.999, 1]
    got = ordering.exact_quantiles(spark.createDataFrame(frame).repartition(7), list(frame), probs)
    for c in frame:
        assert got[c] == pytest.approx(list(frame[c].quantile(probs)), rel=1e-12), c


def test_drift_reads_the_rows_twice(spark, monkeypatch):
    reads = []
    monkeypatch.setattr(ordering, "_count", lambda vals, cells, run=ordering._count: (reads.append(1), run(vals, cells)))
    df = spark.range(50_000).select((F.col("id") % 9_973).cast("double").alias("x"), (F.col("id") % 3 == 0).alias("is_reference"))
    assert drift.psi(df, ["x"]).first()["psi_score"] < 0.01
    assert len(reads) == 1  # after the sketch, one counting pass
