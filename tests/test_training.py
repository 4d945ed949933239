"""Packed training rows: read once, and counted as plain aggregates count them."""

import pytest
from pyspark.sql import functions as F

from lendlake.operators import explain, features, lifecycle, model
from lendlake.operators.training import TrainingRows

NUMERIC, CATEGORICAL = ["a", "b", "k"], ["kind", "flag"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).selectExpr(
        "id",
        "cast(id % 97 as double) as a",
        "cast(hash(id) % 1000 as int) as b",
        "0.1D as k",
        "case id % 4 when 0 then \"it's\" when 1 then 'y' when 2 then 'z' end as kind",
        "id % 2 = 0 as flag",
        "if(id % 50 = 7, null, (id % 97) / 97.0D + (hash(id) % 1000) / 2000.0D > 0.4D) as y",
    ).repartition(5)


def test_packed_rows_are_counted_as_the_frame(rows):
    packed = TrainingRows.of(rows, NUMERIC, CATEGORICAL, "y")
    assert packed.blocks.count() == 5
    assert (packed.rows, packed.ones, packed.zeros) == (3000, rows.where("y").count(), rows.where("not y").count())
    want = features.population_moments(rows, NUMERIC)
    for c in ("a", "b"):
        assert packed.moments[c] == pytest.approx(want[c], rel=1e-12), c
    assert packed.moments["k"] == (0.1, 1.0)  # a constant has no deviation
    assert packed.levels == {"kind": {"it's": 750, "y": 750, "z": 750}, "flag": {"False": 1500, "True": 1500}}


def test_a_fit_of_packed_rows_is_that_of_the_frame(rows, monkeypatch):
    monkeypatch.setattr(model, "START_ROWS", 1)
    packed = TrainingRows.of(rows, NUMERIC, CATEGORICAL, "y", 4)
    fitted, plain = model.fit_default_model(packed), model.fit_default_model(rows, NUMERIC, CATEGORICAL, "y")
    assert fitted.coefficients == pytest.approx(plain.coefficients, abs=1e-7)
    means, want = explain.background_means(packed, fitted.model), explain.background_means(rows, fitted.model)
    assert means == pytest.approx(want, rel=1e-12)


def test_missing_values_and_no_rows_are_errors(rows):
    holes = rows.withColumn("a", F.when(F.col("id") % 10 > 0, F.col("a")))
    with pytest.raises(ValueError, match=r"\{'a': 300\}"):
        model.fit_default_model(holes, NUMERIC, CATEGORICAL, "y")
    with pytest.raises(ValueError, match="no training rows"):
        model.fit_default_model(rows.limit(0), NUMERIC, CATEGORICAL, "y")


def test_a_life_cycle_reads_its_training_rows_once(spark, rows):
    """Steps, sums, levels and means come from the packed rows, not from the data set again."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    dataset = rows.where("y is not null").mapInArrow(counted, rows.schema)
    run = lifecycle.run_lifecycle(dataset, ["id"], NUMERIC, CATEGORICAL, "y")
    n = rows.where("y is not null").count()
    assert read.value == 2 * n  # once to fit, once to calibrate
    assert run.audit().count() == n


@pytest.mark.parametrize("ties", [False, True])
def test_strongest_drivers_are_the_first_of_the_sorted_entries(spark, ties):
    weights = {"a": 1.0, "b": -1.0 if ties else 0.5, "c": 1.0}
    frozen = model.frozen_model(weights, 0.0)
    values = [(1.0, 1.0, 1.0), (2.0, -2.0, 0.5), (None, 1.0, 3.0), (None, None, None), (0.0, -0.0, 0.0), (float("nan"), 5.0, 1.0)]
    df = spark.createDataFrame(values, "a double, b double, c double")
    means = dict.fromkeys(weights, 0.0)
    entries = F.sort_array(explain.contributions(frozen, means), asc=False)
    got = explain.with_top_drivers(df, frozen, means).withColumn("entries", entries).collect()
    for r in got:
        for k in (1, 2):
            assert r[f"top_shap_feature_{k}"] == r["entries"][k - 1]["name"]
            want = r["entries"][k - 1]["value"]
            assert r[f"top_shap_value_{k}"] == (None if want is None else pytest.approx(want, nan_ok=True))
