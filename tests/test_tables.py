"""Table life-cycle, keys and audits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lendlake.operators import quality
from lendlake.sources import dimensions, schemas, tables
from lendlake.sources.slices import SlicedTable


def test_merge_update_changes_matching_rows_only(spark):
    target = spark.createDataFrame(
        [(k, v, 0.0) for k in (1, 2, 3) for v in ("v1", "v2")], "k int, version string, pd double"
    )
    source = spark.createDataFrame([(2, 0.2), (3, None), (9, 0.9)], "k int, pd double")
    out = tables.merge_update(target, source, "k", ["pd"], F.col("version") == "v1")
    got = {(r["k"], r["version"]): r["pd"] for r in out.collect()}
    assert got == {(1, "v1"): 0.0, (1, "v2"): 0.0, (2, "v1"): 0.2, (2, "v2"): 0.0, (3, "v1"): None, (3, "v2"): 0.0}


def test_merge_update_with_repeated_source_key_keeps_the_row_count(spark):
    target = spark.createDataFrame([(1, 0.0)], "k int, pd double")
    source = spark.createDataFrame([(1, 0.1), (1, 0.3)], "k int, pd double")
    assert [tuple(r) for r in tables.merge_update(target, source, ["k"], ["pd"]).collect()] == [(1, 0.3)]


def test_slice_replacement_leaves_other_slices(spark):
    table = SlicedTable.of(spark.createDataFrame([(1, "a"), (2, "b"), (3, "it's 50%/x=y")], "x int, version string"), "version")
    out = table.replace(spark.createDataFrame([(7, "b"), (8, "b")], "x int, version string"))
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (3, "it's 50%/x=y"), (7, "b"), (8, "b")]
    out = table.replace(spark.createDataFrame([(9, "it's 50%/x=y")], "x int, version string"))
    assert sorted(map(tuple, out.where("version like 'it%'").collect())) == [(9, "it's 50%/x=y")]


def test_a_write_that_fails_leaves_the_slice(spark):
    table = SlicedTable.of(spark.createDataFrame([(1, "a"), (2, "b")], "x int, version string"), "version")
    files = table.read().where("version = 'b'").inputFiles()
    rows = spark.range(100).repartition(4).select(
        F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).cast("int").alias("x"), F.lit("b").alias("version")
    )
    with pytest.raises(Exception, match="lost"):
        table.replace(rows)
    with pytest.raises(Exception, match="lost"):
        table.update(rows.select("x", F.col("x").cast("double").alias("pd")), "b", "x", {"pd": "double"})
    assert sorted((r["x"], r["version"]) for r in table.read().collect()) == [(1, "a"), (2, "b")]
    table.replace(spark.createDataFrame([(5, "b")], "x int, version string"))
    assert [r["x"] for r in table.read().where("version = 'b'").collect()] == [5]
    assert [r["x"] for r in spark.read.parquet(*files).collect()] == [2]  # what runs on the old files can end


def test_update_slice_adds_columns_to_one_slice(spark):
    table = SlicedTable.of(spark.createDataFrame([(1, "a"), (2, "a"), (1, "b")], "k int, version string"), "version")
    out = table.update(spark.createDataFrame([(1, 0.5)], "k int, pd double"), "a", "k", {"pd": "double"})
    assert sorted((r["version"], r["k"], r["pd"]) for r in out.collect()) == [
        ("a", 1, 0.5), ("a", 2, None), ("b", 1, None),
    ]
    again = table.update(spark.createDataFrame([(2, 0.7)], "k int, pd double"), "a", "k", {"pd": "double"})
    assert {(r["version"], r["k"]): r["pd"] for r in again.collect()}[("a", 1)] == 0.5


def test_numbering_stores_keys_only(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(tables, "staged", lambda df, name, run=tables.staged: (stored.append(df.columns), run(df, name))[1])
    df = spark.range(500).select(F.col("id").alias("k"), F.lit("wide").alias("w"))
    assert sorted((r["k"], r["row_no"]) for r in tables.number_rows(df, ["k"]).collect()) == [(i, i + 1) for i in range(500)]
    assert stored == [["k"], ["k", "_id"]]


def test_surrogate_keys_follow_the_natural_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(7)
    keyed = tables.with_surrogate_key(df, "sid", "ROW", 6, ["k"]).orderBy("k").collect()
    assert [r["sid"] for r in keyed] == [f"ROW_{i:06d}" for i in range(1, 5001)]


def test_row_numbers_with_a_hot_leading_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("a"), F.col("id").alias("b"))
    out = tables.number_rows(df, ["a", "b"]).orderBy("a", "b").collect()
    assert [r["row_no"] for r in out] == list(range(1, 3001))


def test_conform_orders_casts_and_fills(spark):
    df = spark.createDataFrame([(1, "x", 3)], "customer_id int, state string, extra int")
    out = schemas.conform(df, "customers")
    assert out.columns == schemas.SCHEMAS["customers"].names
    row = out.first()
    assert (row["customer_id"], row["age"]) == ("1", None) and row["created_at"] is not None
    with pytest.raises(ValueError, match="columns missing"):
        schemas.conform(df, "customers", missing="error")


def test_contract_lists_every_table(spark):
    found = {r["table_name"] for r in schemas.contract(spark).collect()}
    assert found == set(schemas.SCHEMAS)
    for child, parent, key in schemas.FOREIGN_KEYS:
        assert key in schemas.SCHEMAS[child].names and key in schemas.SCHEMAS[parent].names


def test_key_and_reference_audits(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "zz"), (4, "zz")], "id int, ref string")
    parent = spark.createDataFrame([("a",), ("b",)], "ref string")
    assert [tuple(r) for r in quality.check_keys(child, ["id"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in quality.check_fk(child, parent, "ref").collect()] == [("zz", 2)]
    total = quality.violations(quality.check_fk(child, parent, "ref"), "ref").first()
    assert tuple(total) == ("ref", 1, 2)


def test_all_keys_in_one_audit(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "zz"), (4, "zz"), (None, "a")], "id int, ref string")
    parent = spark.createDataFrame([("a",), ("b",), (None,), (None,)], "ref string")
    found = quality.audit_keys({"child": child, "parent": parent}, {"child": "id", "parent": "ref"}, [("child", "parent", "ref")])
    assert {tuple(r) for r in found.collect()} == {
        ("child key id", 2, 3), ("parent key ref", 1, 2), ("child to parent by ref", 1, 2),
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_large_dimension_stays_distributed(spark):
    big = spark.range(50)
    kept = dimensions.bounded_dimension(big, max_rows=10)
    assert kept is big
    small = dimensions.bounded_dimension(big, max_rows=50)
    assert small is not big and sorted(r[0] for r in small.collect()) == list(range(50))
    assert dimensions.checked_broadcast(big, max_rows=10) is big


def test_repeat_for_calendar(spark):
    months = spark.createDataFrame([(dt.date(2025, m, 1),) for m in (1, 2, 3)], "month date")
    out = dimensions.repeat_for(spark.range(4), months)
    assert out.columns == ["id", "month"] and out.distinct().count() == 12


def test_reloaded_table_is_read_anew(spark, folder, tmp_path):
    """A folder's lineitem is replaced in one session: months and scenarios follow it."""
    import os

    from lendlake.plans import catalog

    own = str(tmp_path)
    for name in os.listdir(folder):
        if name != "lineitem.parquet":
            os.symlink(f"{folder}/{name}", f"{own}/{name}")
    whole = spark.read.parquet(f"{folder}/lineitem.parquet")
    query = catalog.queries()["q02_scenario_risk"]
    whole.where("l_shipdate < '2000-01-01'").coalesce(1).write.parquet(f"{own}/lineitem.parquet")
    query(spark, own).collect()
    whole.coalesce(1).write.mode("overwrite").parquet(f"{own}/lineitem.parquet")
    key = lambda r: str(r)
    assert sorted(query(spark, own).collect(), key=key) == sorted(query(spark, folder).collect(), key=key)
