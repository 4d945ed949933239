"""Integrity audits and data-validation reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import rate, rounded_mean


def check_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that are NULL or occur more than once, with their number of rows."""
    any_null = F.lit(False)
    for k in key:
        any_null = any_null | F.col(k).isNull()
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where((F.col("rows") > 1) | any_null)
    )


def check_fk(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child keys without a parent row, with their number of child rows.

    Child rows are counted per key first, so a hot key is one row in the anti join.
    """
    parent_key = parent_key or key
    return (
        child.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")
    )


def violations(found: DataFrame, check: str) -> DataFrame:
    """One row (check, keys, rows) for a key or reference audit."""
    return found.agg(
        F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    ).select(F.lit(check).alias("check"), "keys", "rows")


def rule_breaks(df: DataFrame, ok: Column, by: Sequence[str]) -> DataFrame:
    """Rows and rows that break a rule, per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~ok).alias("breaks")
    )


def rate_by(df: DataFrame, by: str, flag: str, name: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), rate(flag).alias(name))


def mean_by(df: DataFrame, by: str, value: str, name: str, digits: int = 4) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), rounded_mean(value, digits).alias(name))


def audit_keys(
    stored: Mapping[str, DataFrame], primary: Mapping[str, str], foreign: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """(check, keys, rows): broken keys of every primary key and of every reference (child, parent, key).

    A table is read once: each row gives its keys, tagged with the checks they belong to and the
    side they stand on. All tags are grouped together, combined map-side, so a hot key is one row.
    """
    tags: dict[str, list[tuple[str, str, str]]] = {t: [] for t in stored}  # table: (check, column, side)
    for table, key in primary.items():
        tags[table].append((f"{table} key {key}", key, "own"))
    for child, parent, key in foreign:
        check = f"{child} to {parent} by {key}"
        tags[child].append((check, key, "child"))
        tags[parent].append((check, key, "parent"))
    sides = ("own", "child", "parent")
    parts = []
    for table, own in tags.items():
        entries = [
            F.struct(
                F.lit(check).alias("check"),
                F.col(key).cast("string").alias("key"),
                *[F.lit(int(side == s)).cast("long").alias(s) for s in sides],
            )
            for check, key, side in own
        ]
        if entries:
            parts.append(stored[table].select(F.inline(F.array(*entries))))
    counted = reduce(DataFrame.unionByName, parts).groupBy("check", "key").agg(*[F.sum(s).alias(s) for s in sides])
    doubled = (F.col("own") > 1) | (F.col("key").isNull() & (F.col("own") > 0))
    orphan = F.col("key").isNotNull() & (F.col("child") > 0) & (F.col("parent") == 0)
    broken = doubled | orphan
    return counted.groupBy("check").agg(
        F.count_if(broken).alias("keys"), F.sum(F.when(broken, F.col("own") + F.col("child")).otherwise(0)).alias("rows")
    )
