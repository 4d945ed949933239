"""Tables of slices, each slice replaced by pointing Spark's catalogue to its new folder.

A slice is the rows of one value of a column (a model version, a period). New rows are written
to a folder that nobody reads yet; only when they are complete is the partition's location changed. A write
that fails, or a job that dies, leaves the table as it was, and queries that run on the old files
can end.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from .tables import merge_update


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


@dataclass(frozen=True)
class SlicedTable:
    """A catalogue table partitioned by one text column."""

    spark: SparkSession
    name: str
    slice_col: str

    @staticmethod
    def create(spark: SparkSession, name: str, schema: str, slice_col: str, folder: str | None = None) -> SlicedTable:
        """An empty table; ``schema`` names all columns, ``slice_col`` among them."""
        place = folder or fresh_path(spark, name)
        spark.sql(
            f"create table {_quoted(name)} ({schema}) using parquet partitioned by ({_quoted(slice_col)}) location '{place}'"
        )
        return SlicedTable(spark, name, slice_col)

    @staticmethod
    def of(df: DataFrame, slice_col: str, prefix: str = "sliced") -> SlicedTable:
        """A new table with the columns and slices of ``df``."""
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema)
        table = SlicedTable.create(df.sparkSession, f"{prefix}_{uuid.uuid4().hex}", columns, slice_col)
        table.replace(df)
        return table

    def read(self) -> DataFrame:
        return self.spark.table(_quoted(self.name))

    def _escaped(self, value: str) -> str:
        return value.replace("\\", "\\\\").replace("'", "\\'")

    def replace(self, df: DataFrame) -> DataFrame:
        """Replace the slices that occur in ``df``, and return the table. Other slices stay."""
        place = fresh_path(self.spark, f"{self.name}-slices")
        order = [c for c in self.read().columns if c in df.columns]
        df.select(*order).write.partitionBy(self.slice_col).parquet(place)
        self._point(place)
        return self.read()

    def _point(self, place: str) -> None:
        """Let each slice's partition lie where its new files are."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(place)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        for status in fs.listStatus(path):  # one folder a slice
            folder = status.getPath().getName()
            if "=" not in folder:
                continue
            value = escape.unescapePathName(folder.split("=", 1)[1])
            key = f"{_quoted(self.slice_col)} = '{self._escaped(value)}'"
            self.spark.sql(f"alter table {_quoted(self.name)} add if not exists partition ({key})")
            self.spark.sql(
                f"alter table {_quoted(self.name)} partition ({key}) set location '{self._escaped(status.getPath().toString())}'"
            )

    def ensure_columns(self, new_columns: Mapping[str, str]) -> None:
        """Add the columns that the table lacks; they are NULL in the slices that were written without them."""
        have = set(self.read().columns)
        add = [f"{_quoted(c)} {t}" for c, t in new_columns.items() if c not in have]
        if add:
            self.spark.sql(f"alter table {_quoted(self.name)} add columns ({', '.join(add)})")

    def update(self, source: DataFrame, value: str, key: Sequence[str] | str, new_columns: Mapping[str, str]) -> DataFrame:
        """Write ``new_columns`` of ``source`` back to one slice, and return the table.

        Only that slice is read and written anew. Rows without a match keep what they have.
        """
        self.ensure_columns(new_columns)
        part = self.read().where(F.col(self.slice_col) == value)
        return self.replace(merge_update(part, source, key, list(new_columns)))
