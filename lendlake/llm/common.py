"""Helpers of the corpus operators: reading, staging in the shared folder, and text rules."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import os
import tempfile
import weakref
import zipfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import fresh_path

#: White space of every word rule: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"

_paths: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
_shipped: weakref.WeakSet = weakref.WeakSet()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once for a session: tasks import it there."""
    context = spark.sparkContext
    if context in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="code-"), "lendlake_code.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    out.write(file, os.path.relpath(file, os.path.dirname(top)))
    context.addPyFile(path)
    _shipped.add(context)


def release_memory() -> None:
    """Give back what this process has freed: a Python worker stays for later tasks, beside those of other stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with a function of this package."""
    ship(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return df.mapInArrow(task, schema)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame | Iterator[DataFrame], name: str, by: str | None = None, compression: str | None = None) -> DataFrame:
    """The frame as a table in the shared folder: read several times, safe from lost executors.

    With ``by``, each value of that column has a folder of its own. The folder is removed when the application ends, or earlier by ``free`` or ``drop_staged``.
    Of several frames, each is made and written once the one before is done and its shuffle files are let go.
    """
    rest = iter(()) if isinstance(df, DataFrame) else df
    df = df if isinstance(df, DataFrame) else next(rest)
    spark, schema = df.sparkSession, df.schema
    path = fresh_path(spark, name)
    if spark not in _paths:
        _paths[spark] = []
        atexit.register(drop_staged, spark)
    _paths[spark].append(path)
    while df is not None:
        (df.write.partitionBy(by) if by else df.write).parquet(path, mode="append", compression=compression)
        df = None
        if (df := next(rest, None)) is not None:
            free()
    stored = spark.read.schema(schema).parquet(path)
    stored._staged_at = path
    return stored


def free(*frames: DataFrame) -> None:
    """Remove staged frames that nothing reads any more, and let Spark drop the shuffle files of finished steps.

    Spark removes a shuffle's files once the driver has collected the plan that made them, so both
    garbage collectors are asked for.
    """
    for df in frames:
        spark, path = df.sparkSession, df._staged_at
        _paths.get(spark, []).remove(path)
        _delete(spark, path)
    gc.collect()
    SparkSession.active()._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def drop_staged(spark: SparkSession) -> None:
    """Remove the staged tables of this session; frames built on them can't be read afterwards."""
    for path in _paths.pop(spark, []):
        with contextlib.suppress(Exception):  # the session may be gone
            _delete(spark, path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def named(column: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col("`" + column.replace("`", "``") + "`")


def row_of(docs: DataFrame, keep: list[str] | None = None) -> Column:
    """The columns ``keep`` (by default all) as one struct, so that no name clashes."""
    return F.struct(*[named(c).alias(c) for c in keep or docs.columns])


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def crc_mod(doc_id, mod: int) -> int:
    """The same in Python."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod


def raw_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and the offsets of its values (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[off[0] : off[-1]], off - off[0]


def parts_of(batch: pa.RecordBatch, column: int, most: int = 6_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each, so that a task's memory is bounded."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most
    edge = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
    for a, b in zip(edge, [*edge[1:], batch.num_rows], strict=True):
        yield batch.slice(int(a), int(b - a))


def sums_by(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each run of values, for runs of given lengths (which may be 0)."""
    ends = np.cumsum(lengths)
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[ends - lengths]


def word_codes(words: list) -> tuple[np.ndarray, pa.Array]:
    """A code per word, and the distinct words by code."""
    coded = pa.array(words, pa.binary()).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
