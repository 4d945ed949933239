"""Exact order statistics without a global sort or a single-task window.

A mergeable sketch guides them: one pass gives, for each wanted rank, a narrow interval that
should hold it. A second pass counts the rows of all cells that the intervals' ends make, and
keeps the distinct values of the wanted cells alone. The results are exact whatever the sketch's
error: a rank that its interval missed makes its cell a wanted one, and the pass is made again.
"""

from __future__ import annotations

import itertools
import math
from bisect import bisect_left
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.dimensions import literal_frame
from ..sources.tables import staged

SKETCH_ACCURACY = 10_000
#: Distance of an interval's ends from the wanted share: three times the sketch's error.
MARGIN = 3 / SKETCH_ACCURACY
#: A column with at most so many rows keeps all its values.
FEW_ROWS = 3 * SKETCH_ACCURACY
#: Distinct values that are ordered together; larger cells are divided first.
CELL_VALUES = 1 << 20
DIVISIONS = 1_024
MIN_PARTS, MAX_PARTS = 64, 4096
PART_ACCURACY = 20_000


def default_parts(df: DataFrame) -> int:
    """As many value parts as the session has shuffle partitions, within fixed limits."""
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(configured, MIN_PARTS), MAX_PARTS)


def _present(c: str) -> Column:
    """The column as double with NaN turned into NULL."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _bucketize(df: DataFrame, borders: dict[str, list[float]]) -> DataFrame:
    """Add ``part_<col>``: number of the part that holds the value (binary search, JVM side)."""
    cols = list(borders)
    return Bucketizer(
        inputCols=cols,
        outputCols=[f"part_{c}" for c in cols],
        splitsArray=[borders[c] for c in cols],
        handleInvalid="keep",
    ).transform(df)


@dataclass
class Cells:
    """Counts of values by cell, for some columns, and the values of the wanted cells.

    The borders b0 < b1 < ... of a column make the cells: 2k is the open interval below border k
    (the last one is above all borders), 2k + 1 is border k itself. ``counts`` has the rows of each cell as
    (reference, other). ``values`` is a stored table (feature, cell, value, ref, cur) of the
    wanted intervals' distinct values.
    """

    borders: dict[str, list[float]]
    wanted: dict[str, set[int]]
    counts: dict[str, dict[int, tuple[int, int]]] = field(default_factory=dict)
    values: DataFrame | None = None

    def cell_of(self, c: str, value: float) -> int:
        k = bisect_left(self.borders[c], value)
        return 2 * k + (k < len(self.borders[c]) and self.borders[c][k] == value)

    def rows(self, c: str) -> int:
        """Reference rows that have a value."""
        return sum(ref for ref, _ in self.counts[c].values())

    def holding(self, c: str, rank: int) -> tuple[int, int]:
        """The cell that holds a rank (from 0) of the reference rows, and the rank inside it."""
        for cell in sorted(self.counts[c]):
            size = self.counts[c][cell][0]
            if rank < size:
                return cell, rank
            rank -= size
        raise IndexError(rank)

    def known(self, c: str, cell: int) -> bool:
        return cell % 2 == 1 or cell in self.wanted[c]

    def values_at(self, ranks: dict[str, Iterable[int]]) -> dict[tuple[str, int], float]:
        """The reference value at each rank; every rank lies in a border or a wanted cell."""
        out, picks = {}, []
        for c, some in ranks.items():
            for rank in some:
                cell, inside = self.holding(c, rank)
                if cell % 2:
                    out[c, rank] = self.borders[c][cell // 2]
                else:
                    picks.append((c, cell, inside, rank))
        small = []
        for (c, cell), group in itertools.groupby(sorted(picks), key=lambda x: x[:2]):
            if self.counts[c][cell][0] <= CELL_VALUES:
                small += group
            else:
                out |= {(c, rank): self._divided(c, cell, inside) for *_, inside, rank in group}
        if small:
            names = ("feature", "cell", "inside", "rank")
            # as many rows as there are wanted ranks
            picked = F.broadcast(literal_frame(self.values.sparkSession, **dict(zip(names, map(list, zip(*small)), strict=True))))
            upto = Window.partitionBy("feature", "cell").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            found = (
                self.values.where("ref > 0")
                .join(picked.select("feature", "cell").distinct(), ["feature", "cell"], "left_semi")
                .withColumn("upto", F.sum("ref").over(upto))
                .join(picked, ["feature", "cell"])
                .where((F.col("inside") < F.col("upto")) & (F.col("inside") >= F.col("upto") - F.col("ref")))
            )
            out |= {(r["feature"], r["rank"]): r["value"] for r in found.select("feature", "rank", "value").collect()}
        return out

    def _divided(self, c: str, cell: int, rank: int) -> float:
        """One value of a cell that is too large to order: it is divided evenly until it is not."""
        some = self.values.where((F.col("feature") == c) & (F.col("cell") == cell) & (F.col("ref") > 0)).select("value", "ref")
        while True:
            probs = [i / DIVISIONS for i in range(1, DIVISIONS)]
            row = some.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("value", probs, SKETCH_ACCURACY).alias("q")).first()
            if row["n"] <= CELL_VALUES:
                upto = Window.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
                return some.withColumn("upto", F.sum("ref").over(upto)).where(F.col("upto") > rank).agg(F.min("value")).first()[0]
            ends = [-math.inf, *sorted(set(row["q"])), math.inf]
            parts = _bucketize(some, {"value": ends}).groupBy("part_value").agg(F.sum("ref").alias("ref"))
            for part, ref in sorted((int(r[0]), r[1]) for r in parts.collect()):  # DIVISIONS rows
                if rank < ref:
                    some = some.where((F.col("value") >= ends[part]) & (F.col("value") < ends[part + 1]))
                    break
                rank -= ref

    def upto(self, points: dict[str, Sequence[float]]) -> dict[tuple[str, float], tuple[int, int]]:
        """(reference, other) rows with a value of at most each point; points lie in borders or wanted cells."""
        inside = [(c, self.cell_of(c, x), float(x)) for c, xs in points.items() for x in xs if self.cell_of(c, x) % 2 == 0]
        part = {}
        if inside:
            names = ("feature", "cell", "point")
            literal = F.broadcast(literal_frame(self.values.sparkSession, **dict(zip(names, map(list, zip(*inside)), strict=True))))
            sums = (
                self.values.join(literal, ["feature", "cell"])
                .where(F.col("value") <= F.col("point"))
                .groupBy("feature", "point")
                .agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
            )
            part = {(r["feature"], r["point"]): (r["ref"], r["cur"]) for r in sums.collect()}
        out = {}
        for c, xs in points.items():
            for x in xs:
                cell = self.cell_of(c, x)
                whole = [n for k, n in self.counts[c].items() if k < cell or (k == cell and cell % 2)]
                more = part.get((c, float(x)), (0, 0))
                out[c, x] = tuple(sum(n[side] for n in whole) + more[side] for side in (0, 1))
        return out

    def at(self, points: dict[str, float]) -> dict[str, tuple[int, int]]:
        """(reference, other) rows whose value is exactly a column's point."""
        out, inside = {}, []
        for c, x in points.items():
            cell = self.cell_of(c, x)
            if cell % 2:
                out[c] = self.counts[c].get(cell, (0, 0))
            else:
                inside.append((F.col("feature") == c) & (F.col("cell") == cell) & (F.col("value") == float(x)))
                out[c] = (0, 0)
        if inside:
            found = self.values.where(reduce(Column.__or__, inside))
            out |= {r["feature"]: (r["ref"], r["cur"]) for r in found.collect()}  # one row a column
        return out


def _ranks(n: int, probs: Sequence[float]) -> list[int]:
    return sorted({r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}) if n else []


def cells_of(df: DataFrame, cols: Sequence[str], probs: Sequence[float], is_reference: str | None = None) -> Cells:
    """The cells that hold the wanted quantiles of the reference rows (all rows without ``is_reference``).

    Two passes over the rows: the sketch, and the counts by cell. What comes back is bounded by
    columns x quantiles; values of wanted cells stay distributed.
    """
    flag = F.lit(True) if is_reference is None else F.coalesce(F.col(is_reference), F.lit(False))
    vals = df.select(flag.alias("_ref"), *[_present(c).alias(c) for c in cols])
    ends = sorted({min(1.0, max(0.0, p + side)) for p in probs for side in (-MARGIN, MARGIN)})
    ref = {c: F.when(F.col("_ref"), F.col(c)) for c in cols}
    row = vals.agg(
        *[F.count(ref[c]).alias(f"n_{c}") for c in cols],
        *[F.percentile_approx(ref[c], ends, SKETCH_ACCURACY).alias(f"q_{c}") for c in cols],
    ).first()
    cells = Cells({c: sorted(set(row[f"q_{c}"] or [0.0])) for c in cols}, {c: set() for c in cols})
    for c in cols:
        if row[f"n_{c}"] <= FEW_ROWS:
            cells.wanted[c] = set(range(0, 2 * len(cells.borders[c]) + 1, 2))
            continue
        at = dict(zip(ends, row[f"q_{c}"], strict=True))
        for p in probs:
            low, high = (cells.cell_of(c, at[min(1.0, max(0.0, p + side))]) for side in (-MARGIN, MARGIN))
            cells.wanted[c] |= set(range(low + 1, high, 2))
    while True:
        _count(vals, cells)
        missed = {(c, cell) for c in cols for r in _ranks(cells.rows(c), probs) for cell in [cells.holding(c, r)[0]] if not cells.known(c, cell)}
        if not missed:
            return cells
        for c, cell in missed:
            cells.wanted[c].add(cell)


def _count(vals: DataFrame, cells: Cells) -> None:
    """The counting pass: all columns in one grouping, combined map-side."""
    cols = list(cells.borders)
    placed = _bucketize(vals, {c: [-math.inf, *cells.borders[c], math.inf] for c in cols})
    entries = []
    for c in cols:
        part = F.col(f"part_{c}").cast("int")  # borders that the value reaches
        on_border = (part > 0) & (F.get(F.lit(cells.borders[c]), part - 1) == F.col(c))
        cell = F.when(on_border, 2 * part - 1).otherwise(2 * part)
        wanted = cell.isin(sorted(cells.wanted[c])) if cells.wanted[c] else F.lit(False)
        value = F.when(wanted, F.col(c))
        entries.append(F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("feature"), cell.alias("cell"), value.alias("value"))))
    long = placed.select("_ref", F.explode(F.array_compact(F.array(*entries))).alias("e")).select("_ref", "e.*")
    grouped = long.groupBy("feature", "cell", "value").agg(F.count_if("_ref").alias("ref"), F.count_if(~F.col("_ref")).alias("cur"))
    cells.values = staged(grouped, "cells")
    cells.counts = {c: {} for c in cols}
    sums = cells.values.groupBy("feature", "cell").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    for r in sums.collect():  # columns x cells
        cells.counts[r["feature"]][r["cell"]] = (r["ref"], r["cur"])


def quantiles_in(cells: Cells, probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column's reference rows."""
    found = cells.values_at({c: _ranks(cells.rows(c), probs) for c in cells.borders})

    def at(c: str, position: float) -> float:
        low, high = found[c, math.floor(position)], found[c, math.ceil(position)]
        return low + (high - low) * (position - math.floor(position))

    return {c: [at(c, p * (n - 1)) for p in probs] if (n := cells.rows(c)) else [None] * len(probs) for c in cells.borders}


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column; NULL and NaN are left out."""
    return quantiles_in(cells_of(df, cols, probs), probs)


def breakpoints(df: DataFrame, cols: Sequence[str], buckets: int) -> dict[str, list[float]]:
    """Distinct quantile borders of each column (empty for a column without values)."""
    quantiles = exact_quantiles(df, cols, [i / buckets for i in range(buckets + 1)])
    return {c: sorted({q for q in qs if q is not None}) for c, qs in quantiles.items()}


def bucket_of(c: str, borders: Sequence[float]) -> Column:
    """1-based right-closed bucket between borders; the lowest border belongs to bucket 1.

    Values outside the borders, and missing ones, have no bucket.
    """
    if len(borders) < 2:
        return F.lit(None).cast("int")
    x = _present(c)
    below = F.size(F.filter(F.lit([float(b) for b in borders]), lambda b: b < x))
    return F.when(
        (x >= float(borders[0])) & (x <= float(borders[-1])), F.greatest(F.lit(1), below)
    )


def quantile_buckets(df: DataFrame, c: str, buckets: int = 10, name: str = "bucket") -> DataFrame:
    """Add the quantile bucket of a column: ties share a bucket, equal borders merge."""
    return df.withColumn(name, bucket_of(c, breakpoints(df, [c], buckets)[c]))


def class_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score (``label`` is 0/1 or boolean).

    Rows without a score are dropped after the grouping: a filter before it would be pushed
    down through the projections and repeat the whole score expression there.
    """
    rows = df.select(*by, F.col(score).cast("double").alias("score"), F.col(label).cast("int").alias("y"))
    return (
        rows.groupBy(*by, "score")
        .agg(
            F.sum("y").alias("pos"), F.expr("sum(1 - y)").alias("neg"), F.count("score").alias("scored")
        )
        .where(F.col("scored") > 0)
        .drop("scored")
    )


def rank_auc(
    df: DataFrame, score: str, label: str, by: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    """Tie-aware area under the ROC curve per group (groups are few).

    The rows are read once, into counts per distinct score. Those are ordered inside value parts
    whose borders come from the stored counts. A part only needs the number of negatives in the
    parts before it, and those totals are one row per part.
    """
    distinct = staged(class_counts(df, score, label, by), "score-counts")
    parts = parts or default_parts(df)
    probs = [i / parts for i in range(1, parts)]
    ends = distinct.agg(F.percentile_approx("score", probs, PART_ACCURACY)).first()[0] or [0.0]
    counts = _bucketize(distinct, {"score": [-math.inf, *sorted(set(ends)), math.inf]})
    below = (
        Window.partitionBy(*by, "part_score")
        .orderBy("score")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    prior = F.coalesce(F.sum("neg").over(below), F.lit(0)).cast("double")
    wins = F.col("pos") * prior + F.col("pos") * F.col("neg").cast("double") / 2.0
    in_part = (
        counts.withColumn("wins", wins)
        .groupBy(*by, "part_score")
        .agg(F.sum("wins").alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    parts_before = (
        Window.partitionBy(*by).orderBy("part_score").rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = F.coalesce(F.sum("neg").over(parts_before), F.lit(0))
    return (
        in_part.withColumn("wins", F.col("wins") + F.col("pos").cast("double") * earlier)
        .groupBy(*by)
        .agg(F.sum("wins").alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .select(
            *by,
            F.col("pos").alias("positives"),
            F.col("neg").alias("negatives"),
            F.try_divide("wins", F.col("pos").cast("double") * F.col("neg")).alias("auc"),
        )
    )


def top_rows(df: DataFrame, by: str, tie_break: Sequence[str], n: int) -> DataFrame:
    """The n rows with the highest value; ties are ordered by the key."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.asc_nulls_last(k) for k in tie_break]).limit(n)


def top_wide_rows(df: DataFrame, by: str, key: Sequence[str], n: int) -> DataFrame:
    """``top_rows`` of a wide or expensive frame: the n best from (key, value) alone, then their rows.

    The first pass reads the key and the value and keeps n rows a task. Its n keys come back as
    literals, so the second pass prunes files and row groups by them, and only n rows are joined
    and computed in full. ``key`` orders ties; a row without a key can't be among them.
    """
    best = top_rows(df.select(*dict.fromkeys([*key, by])), by, key, n).select(*key).toArrow()  # n rows
    if not best.num_rows:
        return df.limit(0)
    found = df.sparkSession.createDataFrame(best)
    first = sorted({v for v in best.column(key[0]).to_pylist() if v is not None})
    near = df.where(F.col(key[0]).isin(first))
    return top_rows(near.join(F.broadcast(found.distinct()), list(key), "left_semi"), by, key, n)


def sample_rows(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Fixed-size random sample without replacement: the n smallest seeded key hashes."""
    h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    return df.orderBy(h, *key).limit(n)
