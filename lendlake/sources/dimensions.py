"""Small dimensions whose size is checked before they are treated as small."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIMENSION_LIMIT = 20_000
BROADCAST_LIMIT = 500_000


def bounded_dimension(df: DataFrame, max_rows: int = DIMENSION_LIMIT) -> DataFrame:
    """The frame as a literal relation if it has at most ``max_rows`` rows, else unchanged.

    Catalyst knows a literal relation's exact size, so joins with it (and with small things
    derived from it) broadcast by the normal threshold; no hint is needed. A larger frame
    stays distributed and joins by shuffle. At most ``max_rows + 1`` rows reach the driver.
    Nothing is remembered: a table that was loaded anew is read anew.
    """
    rows = df.limit(max_rows + 1).toArrow()
    return df if rows.num_rows > max_rows else df.sparkSession.createDataFrame(rows, df.schema)


def literal_frame(spark: SparkSession, **columns: list) -> DataFrame:
    """A few known rows as a literal relation: exact size for the planner, no Python workers."""
    return spark.createDataFrame(pa.table(columns))


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_LIMIT) -> DataFrame:
    """The frame with a broadcast hint if it has at most ``max_rows`` rows, else unchanged.

    For derived dimensions, whose size Catalyst cannot tell before it runs them. Without the
    hint Spark joins by shuffle, and adaptive execution still sees the real sizes. The
    count stops at the limit and is made for every query.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def repeat_for(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """Every row of ``df`` once per row of a dimension (a calendar, a scenario list).

    The dimension becomes one array value, read by a scalar subquery and exploded, so the
    rows of ``df`` stay where they are and no join is planned.
    """
    rows = dimension.agg(F.collect_list(F.struct(*dimension.columns)).alias("rows")).scalar()
    exploded = df.select("*", F.explode(rows).alias("_dim"))
    return exploded.select(*df.columns, "_dim.*")
