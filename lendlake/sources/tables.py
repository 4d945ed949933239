"""Table life-cycle: pruned reads, loads, slice replacement, keyed updates, surrogate keys.

Tables live as Parquet folders. Nothing here moves rows through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import padded_id
from ..session import fresh_path
from .schemas import LOAD_TIME, conform


# --- reading ----------------------------------------------------------------


def load(
    spark: SparkSession, path: str, cols: Sequence[str] | None = None, schema: str | None = None
) -> DataFrame:
    """A table, with only the named columns read from its files."""
    df = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    return df if cols is None else df.select(*cols)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make the frame usable as a relation in SQL, and return that relation."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def row_count(df: DataFrame, name: str) -> DataFrame:
    """One row (table_name, rows); an aggregate, so reports can union many of them."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")


# --- writing ----------------------------------------------------------------


def with_load_time(df: DataFrame, name: str = LOAD_TIME) -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def materialize(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Drop-and-recreate a table from a query and return the stored table."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame as a new table in the shared folder, for operators that read it several times.

    It survives lost executors, and later passes read only the columns they need.
    """
    return materialize(df, fresh_path(df.sparkSession, name))


def full_refresh(df: DataFrame, path: str, table: str) -> DataFrame:
    """Replace the whole table by rows that follow its contract."""
    return materialize(conform(df, table, missing="error"), path)


def create_and_insert(df: DataFrame, path: str, table: str, cols: Sequence[str]) -> DataFrame:
    """Create if absent, empty, and insert the named columns; the rest take their defaults."""
    return materialize(conform(df.select(*cols), table), path)


def ensure_column(df: DataFrame, name: str, data_type: str) -> DataFrame:
    """Add a NULL column unless the frame has it."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(data_type))


def merge_update(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str] | str,
    cols: Sequence[str],
    where: Column | None = None,
) -> DataFrame:
    """Keyed update: matched target rows take the source's values, the others keep theirs.

    Source rows without a target are not inserted. A key that occurs twice in the source
    would multiply target rows, so the source is reduced to one row per key first (the
    greatest of its value tuples, which does not depend on row order).
    """
    keys = [key] if isinstance(key, str) else list(key)
    packed = source.groupBy(*keys).agg(F.max(F.struct(*cols)).alias("_new"))
    joined = target.join(packed, keys, "left")
    hit = F.col("_new").isNotNull() if where is None else F.col("_new").isNotNull() & where
    return joined.select(
        *[
            F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
            for c in target.columns
        ]
    )


# --- surrogate keys ---------------------------------------------------------


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_no") -> DataFrame:
    """1-based row number in the global order of ``order`` (unique per row, not NULL), without a global window.

    Only the keys are stored, range-partitioned and sorted: a row's number is its position inside
    the partition plus the size of the partitions before it. Other columns meet their number by
    key and are read once. Only one count per partition meets in a single task.
    """
    keys = staged(df.select(*order), "row-keys")
    in_partition = (1 << 33) - 1  # layout of monotonically_increasing_id
    placed = staged(
        keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "row-places"
    )
    part = F.shiftright("_id", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    # one row per partition of the key's sort
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").select(
        *order, (F.col("_offset") + F.col("_id").bitwiseAND(F.lit(in_partition)) + 1).alias(name)
    )
    if set(df.columns) == set(order):
        return numbered.select(*df.columns, name)
    return df.join(numbered, list(order))


def number_rows_by(df: DataFrame, order: Sequence[str], name: str = "row_no") -> DataFrame:
    """The keys with the numbers of ``number_rows``, for rows that lie by the first of ``order``.

    Rows are numbered where they lie, inside each value of the first key; only the number of rows of
    each value is sorted by range. All rows of one value pass through one task, so it must not be
    a key of few values. Rows without a first key count, but get no number.
    """
    lead = order[0]
    sizes = df.groupBy(lead).agg(F.count(F.lit(1)).alias("_size"))
    sorted_sizes = sizes.repartitionByRange(lead).sortWithinPartitions(lead)
    placed = staged(sorted_sizes.withColumn("_part", F.spark_partition_id()), "key-sizes")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.sum("_size").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    earlier = F.sum("_size").over(Window.partitionBy("_part").orderBy(lead).rowsBetween(Window.unboundedPreceding, -1))
    # one row per partition of the sizes' sort
    starts = placed.withColumn("_earlier", F.coalesce(earlier, F.lit(0))).join(F.broadcast(offsets), "_part")
    inside = F.row_number().over(Window.partitionBy(lead).orderBy(*(order[1:] or order)))
    return (
        df.select(*order)
        .withColumn("_inside", inside)
        .join(starts.select(lead, (F.col("_offset") + F.col("_earlier")).alias("_start")), lead)
        .select(*order, (F.col("_start") + F.col("_inside")).alias(name))
    )


def with_surrogate_key(
    df: DataFrame, name: str, prefix: str, width: int, order: Sequence[str]
) -> DataFrame:
    """Identifier ``PREFIX_000..n`` numbered in the order of a natural key."""
    numbered = number_rows(df, order, "_row_no")
    return numbered.withColumn(name, padded_id(prefix, "_row_no", width)).drop("_row_no")
