"""The portfolio as stored tables: each built once, bucketed for its joins, and read by all queries.

The stored tables are the chain that the reports stand on: customers and accounts, months and
macro conditions, account months, payments, bureau rows, the modelling data set. A table is built when it
is first asked for, each from stored ones before it. Tables that meet on an account are bucketed
and sorted by ``account_id`` into the same number of buckets, those on a customer by
``customer_id``, so their joins move no rows.

A store belongs to one session and to the state of its input files (paths, lengths and times
are compared for each query), so a table that was loaded anew is built anew.
"""

from __future__ import annotations

import atexit
import contextlib
import hashlib
import threading
import uuid
import weakref
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..session import fresh_path
from .portfolio import INPUTS, Portfolio

#: Input bytes of a bucket. A packed input byte becomes some 25 bytes of wide rows, and a task sorts a bucket in memory.
BYTES_PER_BUCKET = 8 << 20
MIN_BUCKETS = 8
#: Bytes of a method that the JVM still compiles (HotSpot's HugeMethodLimit).
COMPILED_BYTES = 8000


@dataclass(frozen=True)
class Layout:
    """How a table lies: buckets by a key, in the order of ``sort``, in a folder per ``partition`` value.

    With ``inputs`` the table holds those rows of the portfolio, and ``read`` makes the table's rows
    from them one by one: computed columns are many times the size of what they come from. A table
    that is ``projected`` from another stored one is read through it, and nothing is written.
    """

    bucket: str | None = None
    sort: tuple[str, ...] = ()
    partition: tuple[str, ...] = ()
    inputs: str | None = None
    read: Callable[[DataFrame], DataFrame] | None = None
    projected: bool = False


_BY_ACCOUNT_MONTH = ("account_id", "month")
LAYOUTS = {
    "customers": Layout("customer_id", ("customer_id",)),
    "borrowers": Layout("account_id", ("account_id",)),
    "calendar": Layout(),
    "macro_monthly": Layout(),
    "policy_scenarios": Layout(),
    "account_monthly_snapshots": Layout(
        "account_id", _BY_ACCOUNT_MONTH, ("scenario_id",), inputs="snapshot_inputs", read=Portfolio.snapshots_of
    ),
    "payment_events": Layout(projected=True),
    "bureau_monthly": Layout("customer_id", ("customer_id", "month")),
    "modeling_dataset": Layout("account_id", _BY_ACCOUNT_MONTH, inputs="dataset_inputs", read=Portfolio.dataset_of),
}

_stores: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
_folders: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _files(spark: SparkSession, folder: str) -> tuple[str, int]:
    """Digest of the input files (path, length, time), and their bytes. Reads folder lists only."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for name in INPUTS:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            continue
        for status in fs.listStatus(path):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest(), sum(x[1] for x in found)


def compile_wide_rows(spark: SparkSession) -> None:
    """Lower the session's limit on generated methods to what the JVM compiles.

    Columns that are computed on reading make generated stages of more bytes than that. A whole
    stage over the limit is run operator by operator instead, whose code Spark splits.
    """
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > COMPILED_BYTES:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(COMPILED_BYTES))


def drop_stores(spark: SparkSession) -> None:
    """Remove the stored tables of this session; frames built on them can't be read afterwards."""
    _stores.pop(spark, None)
    for path in _folders.pop(spark, []):
        with contextlib.suppress(Exception):  # the session may be gone
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


class Store:
    """Where one state of the inputs has its tables, and which of them are built."""

    def __init__(self, spark: SparkSession, size: int):
        self.spark = spark
        self.folder = fresh_path(spark, "store")
        self.buckets = max(MIN_BUCKETS, -(-size // BYTES_PER_BUCKET))
        self.built: dict[str, str] = {}
        self.asked: dict[str, datetime] = {}  # tables that are read through others: when first asked for
        self._lock = threading.RLock()
        if spark not in _folders:
            _folders[spark] = []
            atexit.register(drop_stores, spark)
        _folders[spark].append(self.folder)

    def table(self, name: str, make: Callable[[], DataFrame], layout: Layout) -> DataFrame:
        compile_wide_rows(self.spark)
        with self._lock:
            if name not in self.built:
                self.built[name] = self._build(name, make(), layout)
        # Tables that share the bucket key are joined on it and on more (the month): with the
        # default the planner would move rows that lie together already.
        self.spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        return self.spark.table(self.built[name])

    def _build(self, name: str, df: DataFrame, layout: Layout) -> str:
        stored = f"{name}_{uuid.uuid4().hex}"  # a fresh place: a build that failed leaves nothing in the way
        if layout.bucket:
            # One file for each bucket (and partition value): rows are dealt as buckets are.
            df = df.repartition(self.buckets, layout.bucket)
        writer = df.write.format("parquet").option("compression", "zstd").option("path", f"{self.folder}/{stored}")
        if layout.partition:
            writer = writer.partitionBy(*layout.partition)
        if layout.bucket:
            writer = writer.bucketBy(self.buckets, layout.bucket).sortBy(*layout.sort)
        writer.saveAsTable(f"lendlake_{stored}")
        return f"lendlake_{stored}"


def store_of(spark: SparkSession, folder: str) -> Store:
    """The store of the folder's files as they are now."""
    state, size = _files(spark, folder)
    of_session = _stores.setdefault(spark, {})
    if (folder, state) not in of_session:
        of_session[folder, state] = Store(spark, size)
    return of_session[folder, state]


class StoredPortfolio(Portfolio):
    """The same tables, each read from the store; those that are none are built on stored ones."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder)
        self.store = store_of(spark, folder)
        self.buckets = self.store.buckets

    # Rows are laid into the buckets before they are grouped, joined or widened, and stay there: a
    # grouping by (account, month) would else move them by both keys, and once more to the account.

    @cached_property
    def borrower_inputs(self) -> DataFrame:
        return super().borrower_inputs.repartition(self.buckets, "account_id")

    @cached_property
    def lines(self) -> DataFrame:
        return super().lines.repartition(self.buckets, "account_id")

    @cached_property
    def customer_rows(self) -> DataFrame:
        return super().customer_rows.repartition(self.buckets, "customer_id")

    @cached_property
    def customer_lines(self) -> DataFrame:
        return super().customer_lines.repartition(self.buckets, "customer_id")


def _stored(name: str, rows: str, layout: Layout) -> cached_property:
    lazy = Portfolio.__dict__[rows].func
    return cached_property(lambda self: self.store.table(name, lambda: lazy(self), layout))


def _read(inputs: str, layout: Layout) -> cached_property:
    return cached_property(lambda self: layout.read(getattr(self, inputs)))


def _set(name: str, prop: cached_property) -> None:
    prop.__set_name__(StoredPortfolio, name)
    setattr(StoredPortfolio, name, prop)


for _name, _layout in LAYOUTS.items():
    if _layout.inputs:
        _set(_layout.inputs, _stored(_name, _layout.inputs, _layout))
        _set(_name, _read(_layout.inputs, _layout))
    elif not _layout.projected:
        _set(_name, _stored(_name, _name, _layout))
