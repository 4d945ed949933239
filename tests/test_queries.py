"""Every named query against its SQL check, on the smallest tables."""

import check
import pytest

from lendlake.plans import catalog

QUERIES, CHECKS = catalog.queries(), catalog.checks()


@pytest.fixture(scope="module")
def duck(folder):
    return check.connect(folder)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_sql(spark, folder, duck, name):
    assert check.compare(QUERIES[name](spark, folder), duck, CHECKS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_query_without_sql_has_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_entry(spark):
    import __spark_entry__ as contract

    assert {r["scenario_id"] for r in contract.entry(spark).collect()} == {
        "baseline",
        "severe_credit_stress",
    }
    assert set(contract.oracle_sql()) <= set(contract.queries())
