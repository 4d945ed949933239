"""The stored chain: the same rows as the lazy tables, one scan a table, joins that move nothing."""

import re

import pytest

from lendlake.plans import contract, reports
from lendlake.plans.catalog import queries
from lendlake.operators import ordering
from lendlake.session import fresh_path
from lendlake.sources.portfolio import ROW_KEY, Portfolio
from lendlake.sources.store import LAYOUTS, StoredPortfolio, store_of


def rows(df):
    return sorted(map(str, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, folder):
    return StoredPortfolio(spark, folder)


@pytest.fixture()
def no_broadcast(spark):
    """As on large tables: no side of a join is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_stored_table_equals_the_lazy_one(spark, folder, stored, name):
    want = getattr(Portfolio(spark, folder), name)
    assert rows(getattr(stored, name).select(want.columns)) == rows(want)


def test_scenario_filter_prunes_partitions(stored):
    plan = plan_of(reports.scenario_kpis(stored.account_monthly_snapshots, "severe_credit_stress"))
    assert "PartitionFilters: [isnotnull(scenario_id" in plan and "lineitem" not in plan


@pytest.mark.parametrize(
    ("name", "scans"),
    [("q04_band_validation", 2), ("q22_band_series", 2), ("q23_ranked_bands", 2), ("q09_calibrated_validation", 2), ("q17_scenario_comparison", 2)],
)
def test_joins_of_stored_tables_move_no_rows(spark, folder, no_broadcast, name, scans):
    plan = plan_of(queries()[name](spark, folder))
    assert len(re.findall("FileScan", plan)) == scans
    below = plan[plan.index("SortMergeJoin") :]
    assert "Exchange" not in below, below


def test_fact_to_account_join_moves_no_rows(stored, no_broadcast):
    facts, accounts = stored.account_monthly_snapshots, stored.accounts
    plan = plan_of(facts.join(accounts.select("account_id", "product_type"), "account_id"))
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan


def test_store_follows_its_files(spark, folder, tmp_path):
    for name in ("customer", "nation", "region", "orders", "lineitem"):
        spark.read.parquet(f"{folder}/{name}.parquet").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    first = store_of(spark, str(tmp_path))
    assert store_of(spark, str(tmp_path)) is first
    spark.read.parquet(f"{folder}/customer.parquet").limit(3).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/customer.parquet")
    assert store_of(spark, str(tmp_path)) is not first
    assert StoredPortfolio(spark, str(tmp_path)).customers.count() == 3


def test_a_failed_build_can_be_made_again(spark, folder, tmp_path):
    p = StoredPortfolio(spark, folder)
    bad = p.customers.selectExpr("customer_id", "if(customer_id > 10, raise_error('lost'), 1) as x")
    with pytest.raises(Exception, match="lost"):
        p.store.table("trial", lambda: bad, LAYOUTS["customers"])
    assert p.store.table("trial", lambda: p.customers, LAYOUTS["customers"]).count() == p.customers.count()


def test_top_wide_rows_equals_a_full_sort(spark):
    df = spark.range(1000).selectExpr("id % 37 as a", "id as b", "cast(id * 7919 % 50 as double) as v", "repeat('w', 50) as w")
    want = ordering.top_rows(df, "v", ["a", "b"], 25).collect()
    assert ordering.top_wide_rows(df, "v", ["a", "b"], 25).collect() == want
    assert ordering.top_wide_rows(df.limit(0), "v", ["a", "b"], 25).count() == 0
    assert len(ordering.top_wide_rows(df.limit(4), "v", ["a", "b"], 25).collect()) == 4


def test_spotlight_writes_nothing_and_explains_few_rows(spark, folder, stored):
    before = set(stored.store.built)
    top = reports.spotlight(stored.audit, stored.modeling_dataset, ROW_KEY)
    assert top.count() == 25
    assert set(stored.store.built) - before <= {"modeling_dataset", "bureau_monthly", "account_monthly_snapshots", "borrowers", "customers", "calendar", "macro_monthly", "policy_scenarios"}
    assert "account_id#" in plan_of(top) and re.search(r"account_id#\d+L? IN|INSET", plan_of(top))


def test_reports_on_the_contract_tables(spark, folder, stored):
    """The reports' default key is the contract's account_month_id."""
    audit = contract.contract_table(stored, "model_scoring_audit")
    own = reports.band_validation(audit, stored.modeling_dataset)
    assert rows(own) == rows(reports.band_validation(stored.audit, stored.modeling_dataset, ROW_KEY))
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


@pytest.mark.parametrize(("given", "kept"), [("65535", "8000"), ("4000", "4000")])
def test_reading_a_stored_table_keeps_generated_methods_small_enough_to_be_compiled(spark, folder, given, kept):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, given)
        reports.spotlight(StoredPortfolio(spark, folder).audit, StoredPortfolio(spark, folder).modeling_dataset, ROW_KEY, "auto_loan", "medium").collect()
        assert spark.conf.get(name) == kept
    finally:
        spark.conf.set(name, before)
