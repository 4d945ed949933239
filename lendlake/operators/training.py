"""Training rows of a fit as stored blocks: packed once, and read by every step."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import staged
from . import features as ft

#: A fit of many rows begins where one in so many of them ends.
START_SHARE = 64
_BLOCK = """rows binary, share binary, n long, ones long, zeros long, missing array<long>, mean array<double>,
    squares array<double>, levels array<struct<place: int, level: string, n: long>>"""


def level_indicator(column: str, level: str) -> str:
    """SQL text that is 1 for one category level and 0 for every other value, NULL included."""
    quoted = level.replace("\\", "\\\\").replace("'", "\\'")
    return f"if(cast({column} as string) <=> '{quoted}', 1.0D, 0.0D)"


def _blocks(numbers: int, texts: int) -> Callable:
    """A task's rows as blocks: the columns packed, those of the starting share, and what the block adds to the sums.

    A nested function, so that it travels with the task and needs no package there.
    """
    names = [*[f"x{k}" for k in range(numbers)], *[f"c{k}" for k in range(texts)], "label"]

    def packed(rows: pa.RecordBatch) -> bytes:
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(rows)
        return out.getvalue().to_pybytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, label = [batch.column(k) for k in range(numbers)], batch.column("label")
            coded = [batch.column(numbers + k).dictionary_encode() for k in range(texts)]
            rows = pa.RecordBatch.from_arrays([*x, *coded, label], names)
            mean, squares = [], []
            for column in x:
                v = column.drop_null().to_numpy(zero_copy_only=False)
                first = v[0] if len(v) else 0.0  # sums from the first value on: a constant keeps no deviation
                rest = v - first
                gap = rest.sum() / max(len(v), 1)
                mean.append(float(first + gap))
                squares.append(float(((rest - gap) ** 2).sum()))
            levels = []
            for k, column in enumerate(coded):
                counts = np.bincount(column.indices.drop_null().to_numpy(zero_copy_only=False), minlength=len(column.dictionary))
                levels += [{"place": k, "level": level, "n": int(n)} for level, n in zip(column.dictionary.to_pylist(), counts) if n]
            y = label.drop_null().to_numpy(zero_copy_only=False)
            block = {
                "rows": packed(rows),
                "share": packed(rows.filter(batch.column("in_share"))),
                "n": batch.num_rows,
                "ones": int((y == 1).sum()),
                "zeros": int((y == 0).sum()),
                "missing": [c.null_count for c in x],
                "mean": mean,
                "squares": squares,
                "levels": levels,
            }
            level_type = pa.list_(pa.struct([("place", pa.int32()), ("level", pa.string()), ("n", pa.int64())]))
            whole, real = pa.list_(pa.int64()), pa.list_(pa.float64())
            types = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), whole, real, real, level_type]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(block.values(), types, strict=True)], list(block))

    return run


@dataclass(frozen=True)
class TrainingRows:
    """Stored blocks of rows (``blocks``), and what was counted while they were packed, over all rows.

    A block holds some thousands of rows in columns; ``share`` in it has those of a hashed share.
    """

    blocks: DataFrame
    numeric: Sequence[str]
    categorical: Sequence[str]
    kinds: Mapping[str, str]
    rows: int
    ones: int
    zeros: int
    missing: Mapping[str, int]
    moments: Mapping[str, tuple[float, float]]  # mean and population deviation, 1 for a constant
    levels: Mapping[str, Mapping[str, int]]  # rows of each level, in alphabetical order
    share: int  # one in how many rows is in ``share``

    @staticmethod
    def of(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, share: int = START_SHARE) -> TrainingRows:
        """The rows of a frame, which is read once."""
        texts = ft.category_text(train, categorical)
        hashed = F.pmod(F.xxhash64(*numeric), F.lit(share)) == 0 if numeric else F.lit(True)
        rows = texts.select(
            *[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(numeric)],
            *[F.col(c).alias(f"c{k}") for k, c in enumerate(categorical)],
            F.col(target).cast("int").alias("label"),
            hashed.alias("in_share"),
        )
        blocks = staged(rows.mapInArrow(_blocks(len(numeric), len(categorical)), _BLOCK), "train")
        total = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "ones", "zeros")]).first()
        if not total["n"]:
            raise ValueError("no training rows")
        # Means are summed from the least one of a block on, so a constant column has no deviation here either.
        each = blocks.select("n", F.posexplode(F.arrays_zip("missing", "mean", "squares")).alias("place", "of"))
        least = each.groupBy("place").agg(F.sum("of.missing").alias("missing"), F.min("of.mean").alias("mean"))
        missing, from_ = {}, [0.0] * len(numeric)
        for r in least.collect():  # one row a column, here and below
            from_[r["place"]] = r["mean"]
            if r["missing"]:
                missing[numeric[r["place"]]] = r["missing"]
        gap = F.expr("of.mean") - F.get(F.array(*map(F.lit, from_)), F.col("place")) if numeric else F.lit(0.0)
        sums = each.withColumn("gap", gap).groupBy("place").agg(
            F.sum(F.col("n") * F.col("gap")).alias("gap"), F.sum(F.expr("of.squares + n * gap * gap")).alias("squares")
        )
        moments = {}
        for r in sums.collect():
            mean = r["gap"] / total["n"]
            variance = max(r["squares"] / total["n"] - mean * mean, 0.0) if r["squares"] == r["squares"] else float("nan")
            moments[numeric[r["place"]]] = (from_[r["place"]] + mean, variance**0.5 or 1.0)
        levels = {c: {} for c in categorical}
        counted = blocks.select(F.inline("levels")).groupBy("place", "level").agg(F.sum("n").alias("n")).collect()
        for r in sorted(counted):
            levels[categorical[r["place"]]][r["level"]] = r["n"]
        return TrainingRows(
            blocks, list(numeric), list(categorical), dict(train.dtypes), total["n"], total["ones"], total["zeros"], missing, moments, levels, share
        )

    def require_complete(self) -> None:
        """Fail with the number of missing values per feature, before a model meets them."""
        missing = {c: self.missing[c] for c in self.numeric if c in self.missing}
        if missing:
            raise ValueError(f"missing feature values: {missing}")

    def indicator(self, c: str, level: str) -> str:
        """SQL text of a level's input column, on rows as they were before they were packed."""
        return level_indicator(f"initcap(cast({c} as string))" if self.kinds[c] == "boolean" else c, level)

    def means(self) -> dict[str, float]:
        """Mean of every input column, by its SQL text."""
        shares = {self.indicator(c, level): n / self.rows for c, levels in self.levels.items() for level, n in levels.items()}
        return {c: mean for c, (mean, _) in self.moments.items()} | shares
