"""The stored chain writes what rows are computed from, and wide rows stay with their account."""

import re

import pytest

from lendlake.operators import dataset
from lendlake.sources import store
from lendlake.sources.portfolio import SNAPSHOT_INPUTS
from lendlake.sources.store import StoredPortfolio


@pytest.fixture(scope="module")
def stored(spark, folder):
    return StoredPortfolio(spark, folder)


def test_computed_columns_are_not_written(spark, stored):
    assert stored.modeling_dataset.columns == dataset.COLUMNS
    made = {"account_month_id", "current_balance", "available_credit", "behavioral_risk_score"}
    for name in ("account_monthly_snapshots", "modeling_dataset"):
        assert made <= set(getattr(stored, name).columns)
        assert not made & set(spark.table(stored.store.built[name]).columns)
    assert set(spark.table(stored.store.built["account_monthly_snapshots"]).columns) == set(SNAPSHOT_INPUTS)


def test_payments_are_read_through_the_account_months(stored):
    assert stored.payment_events.count() == stored.account_monthly_snapshots.count()
    assert "payment_events" not in stored.store.built


def test_buckets_follow_the_rows(spark):
    """A bucket of wide rows is sorted by one task in memory: 1 GB of packed input needs over a hundred."""
    assert store.Store(spark, 1 << 30).buckets >= 100


def test_wide_rows_stay_with_their_account(spark, stored):
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = spark.conf.get(limits[0])
    for c in limits:
        spark.conf.set(c, "-1")
    try:
        own = dataset.modeling_dataset(stored.account_monthly_snapshots, stored.accounts, stored.customers, stored.bureau_monthly)
        plan = own._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limits[0], before)
        spark.conf.unset(limits[1])
    wide = [x for x in re.findall(r"Exchange.*\n.*", plan) if "current_balance" in x]
    assert "Exchange" in plan and not wide, wide


def test_repeated_keys_give_the_rows_of_the_plain_joins(spark):
    """The same account of two customers, an account month twice, a bureau month twice, months unknown."""
    months = "timestamp '2020-01-01', timestamp '2020-02-01', null"
    keys = {"account_month_id": "'x'", "account_id": "a", "customer_id": "a % 2 + c", "month": "cast(m as date)", "scenario_id": "'baseline'"}
    facts = [f"{keys.get(c, 'cast(n as double)')} as {c}" for c in dataset.SNAPSHOT_COLUMNS]
    rows = (
        spark.sql("select explode(array(1, 2, 3)) as a")
        .selectExpr("*", f"explode(array({months})) as m")
        .selectExpr("*", "explode(array(0, 1)) as c")
        .selectExpr("*", "explode(array(7, 7)) as n")
        .selectExpr(*facts)
    )
    accounts = spark.sql("select explode(array(1, 2, 2)) as account_id").selectExpr(
        "account_id", "1 as customer_id", *[f"account_id * 10 as {c}" for c in dataset.ACCOUNT_COLUMNS]
    )
    customers = spark.sql("select explode(array(0, 1, 2)) as customer_id").selectExpr("customer_id", *[f"customer_id as {c}" for c in dataset.CUSTOMER_COLUMNS])
    bureau = (
        spark.sql("select explode(array(0, 1, 1)) as customer_id")
        .selectExpr("customer_id", f"explode(array({months})) as m")
        .selectExpr("customer_id", "cast(m as date) as month", *[f"customer_id + 100 as {c}" for c in dataset.BUREAU_COLUMNS])
    )
    got = dataset.modeling_dataset(rows, accounts, customers, bureau)
    borrowers = accounts.join(customers, "customer_id").drop("customer_id")
    want = rows.join(borrowers, "account_id").join(bureau, ["customer_id", "month"], "left").select(*dataset.COLUMNS)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 20
