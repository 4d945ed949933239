"""Rows move once to their buckets, and what can be computed on reading is neither moved nor written."""

import re

import pytest
from pyspark.sql import functions as F

from lendlake.operators import dataset
from lendlake.plans import contract
from lendlake.sources import schemas, tables
from lendlake.sources.portfolio import READ_COLUMNS, Portfolio
from lendlake.sources.store import StoredPortfolio


@pytest.fixture(scope="module")
def stored(spark, folder):
    return StoredPortfolio(spark, folder)


def moves(spark, p, name, key):
    """Exchanges in the plan that makes a stored table, as on large tables."""
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = spark.conf.get(limits[0])
    for c in limits:
        spark.conf.set(c, "-1")
    try:
        made = Portfolio.__dict__[name].func(p).repartition(p.store.buckets, key)
        plan = made._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limits[0], before)
        spark.conf.unset(limits[1])
    return re.findall(r"Exchange hashpartitioning\((\w+)#", plan)


def test_lines_move_once(spark, stored):
    assert moves(spark, stored, "snapshot_inputs", "account_id").count("account_id") == 1


def test_customer_months_move_once(spark, stored):
    found = moves(spark, stored, "bureau_monthly", "customer_id")
    assert found.count("customer_id") == 2, found  # account months, accounts


def test_data_set_stores_no_column_that_is_read_from_others(spark, stored):
    assert set(READ_COLUMNS) <= set(stored.modeling_dataset.columns)
    assert not set(READ_COLUMNS) & set(spark.table(stored.store.built["modeling_dataset"]).columns)


def test_months_without_bureau_rows_stay_empty(spark, stored):
    inputs = stored.dataset_inputs.limit(5)
    none = inputs.withColumns({c: F.lit(None).cast(inputs.schema[c].dataType) for c in dataset.BUREAU_COLUMNS if c in inputs.columns})
    got = Portfolio.dataset_of(none).select(*dataset.BUREAU_COLUMNS).collect()
    assert len(got) == 5 and all(x is None for row in got for x in row)


def test_large_contract_tables_store_their_numbers_only(spark, stored):
    names = ("bureau_monthly", "account_monthly_snapshots", "payment_events", "model_scoring_audit")
    for name in names:
        found = contract.contract_table(stored, name)
        assert found.columns == [f.name for f in schemas.SCHEMAS[name]]
        assert f"contract_{name}" not in stored.store.built
        if schemas.LOAD_TIME in found.columns:
            first = found.select(schemas.LOAD_TIME).distinct().collect()
            assert first == contract.contract_table(stored, name).select(schemas.LOAD_TIME).distinct().collect()


def test_numbers_by_the_first_key_equal_the_sorted_ones(spark):
    rows = spark.range(400).selectExpr("if(id % 57 = 5, null, id * 37 % 57) as a", "id * 11 % 400 as b", "'x' as other")
    got = tables.number_rows_by(rows.repartition(5, "a"), ["a", "b"], "n")
    keys = sorted(((r.a, r.b) for r in rows.collect()), key=lambda k: (k[0] is not None, k))
    want = {k: i + 1 for i, k in enumerate(keys) if k[0] is not None}
    assert {(r.a, r.b): r.n for r in got.collect()} == want and got.count() == len(want)


def test_repeated_keys_get_a_number_each(spark):
    rows = spark.createDataFrame([(1, 2), (1, 2), (2, 1), (2, None)], "a int, b int")
    got = tables.number_rows_by(rows, ["a", "b"], "n").collect()
    assert sorted((r.a, r.n) for r in got) == [(1, 1), (1, 2), (2, 3), (2, 4)]
