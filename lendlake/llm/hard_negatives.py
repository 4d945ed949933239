"""Hard negatives for pairs of an anchor and a positive: slot-decomposed selection.

A pair's window of scores reaches from a share of the positive's score up to that score. The
windows of an anchor overlap, but their upper limits, in descending order, split the scores into
disjoint slots: window j is made of the slots j, j+1 and so on, cut off below. So each negative
belongs to one slot, combiners keep the k best of a slot wherever it is met, and one merge of
the slots from the last to the first answers every window of the anchor.

Anchors meet rows in blocks: a block of anchors and a block of rows share a key of their own, so
a task's memory is bounded by the two block sizes, and nothing passes through the driver but
counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, ship, staged
from .topk import _matrix, _product

POSITIVES = 5
NEGATIVES = 5
LOWEST_PERCENT = 80
SCALE = 256
ANCHOR_MOD = 100
RELABEL_MOD = 7
LABELS = 10
ANCHORS_PER_BLOCK = 2_048
ROWS_PER_BLOCK = 16_384


def labelled_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and whole components floor(scale * x); rows lacking an id, a label or a finite part are left out."""
    parts = F.col("embedding").cast("array<double>")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(finite & F.col("vec_id").isNotNull() & F.col("label").isNotNull()).select(
        "vec_id", "label", F.transform(parts, lambda x: F.floor(x * scale).cast("double")).alias("parts")
    )


def _blocks(df: DataFrame, size: int, seed: int) -> tuple[Column, int]:
    """Number of a row's block, and how many blocks there are: about ``size`` rows in each."""
    n = -(-df.count() // size) or 1
    return F.pmod(F.xxhash64(F.lit(seed), "vec_id", "parts"), F.lit(n)).cast("int"), n


def _every(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def met(anchors: DataFrame, rows: DataFrame, run: Callable, schema: str, by: Sequence[str] = ()) -> DataFrame:
    """``run`` on each block of anchors with each block of rows (and each value of ``by``, which both have)."""
    ship(anchors.sparkSession)
    own_block, anchor_blocks = _blocks(anchors, ANCHORS_PER_BLOCK, 1)
    row_block, row_blocks = _blocks(rows, ROWS_PER_BLOCK, 2)
    key = [*by, "_block", "_rows"]
    left = anchors.select("*", own_block.alias("_block"), _every(row_blocks).alias("_rows"))
    right = rows.select("*", row_block.alias("_rows"), _every(anchor_blocks).alias("_block"))
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, schema)


def _scores(anchors: pa.Table, rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of both sides, exact scores, and where the ids and the labels are the same."""
    a, q = _matrix(anchors.column("vec_id"), anchors.column("parts"))
    r, x = _matrix(rows.column("vec_id"), rows.column("parts"), q.shape[1])
    if x.shape[1] > q.shape[1]:
        q = np.pad(q, ((0, 0), (0, x.shape[1] - q.shape[1])))
    mine, other = (t.column("label").to_numpy().astype(np.int64) for t in (anchors, rows))
    return a, r, _product(q, x), a[:, None] == r[None, :], mine[:, None] == other[None, :]


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    if len(score) > k:  # all that reach the k-th score stay, so that ties are decided by id
        some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        some = np.arange(len(score))
    return some[np.lexsort((ids[some], -score[some]))[:k]]


def _positives(k: int) -> Callable:
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and rows.num_rows:
            _, ids, score, same, alike = _scores(anchors, rows)
            for i, key in enumerate(anchors.column("anchor").to_pylist()):
                may = np.flatnonzero(alike[i] & ~same[i])
                out += [(key, int(ids[j]), int(score[i, j])) for j in may[_first(score[i, may], ids[may], k)]]
        return _table(out, ("anchor", "positive_id", "positive_score"))

    return run


def _negatives(k: int, lowest: int) -> Callable:
    """The combiner: the k best of every slot that this block of rows has."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and rows.num_rows:
            _, ids, score, _, alike = _scores(anchors, rows)
            for i, (key, limits) in enumerate(zip(anchors.column("anchor").to_pylist(), anchors.column("limits").to_pylist(), strict=True)):
                top = np.asarray(limits, np.int64)  # descending
                place = len(top) - np.searchsorted(top[::-1], score[i], "left")  # limits that reach the score
                # A score under the share of its slot's own limit is too low for every window above as well.
                may = np.flatnonzero(~alike[i] & (place > 0) & (100 * score[i] >= lowest * top[np.maximum(place, 1) - 1]))
                for s in np.unique(place[may]):
                    own = may[place[may] == s]
                    out += [(key, int(ids[j]), int(score[i, j]), int(s)) for j in own[_first(score[i, own], ids[own], k)]]
        return _table(out, ("anchor", "negative_id", "negative_score", "slot"))

    return run


def _table(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def _best(df: DataFrame, by: Sequence[str], score: str, tie: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), tie)
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")


def mine_hard_negatives(
    anchors: DataFrame, rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST_PERCENT
) -> DataFrame:
    """Anchor, positive, rank, negative and both scores: the hard negatives of each anchor's positives.

    Both frames have (vec_id, label, parts), as ``labelled_vectors`` makes them. An anchor's
    positives are its ``positives`` best rows of the same label, its own id left out; a pair's
    negatives are the ``negatives`` best rows of other labels whose score is at most the
    positive's and at least ``lowest`` percent of it (none for a positive below 0). Higher scores
    come first, ties by smaller vec_id. Fewer rows than asked for give fewer; an empty frame
    gives none. Vectors of other lengths are compared as if filled with zeros. A row that
    repeats counts as often as it does; an anchor that repeats in id, label and vector asks once.
    """
    # xxhash64 names an anchor, so that repeated ids with other vectors are anchors of their own.
    own = anchors.dropDuplicates(["vec_id", "label", "parts"]).withColumn("anchor", F.xxhash64("vec_id", "label", "parts"))
    asked, table = staged(own, "anchors"), staged(rows, "vectors")
    # The label is part of the key, so that only rows of the anchor's label meet it.
    pairs = met(asked, table, _positives(positives), "anchor long, positive_id long, positive_score long", ["label"])
    best = staged(_best(pairs, ["anchor"], "positive_score", "positive_id", positives), "positives")
    limits = best.groupBy("anchor").agg(F.sort_array(F.collect_list("positive_score"), asc=False).alias("limits"))
    found = met(
        asked.join(limits, "anchor"), table, _negatives(negatives, lowest), "anchor long, negative_id long, negative_score long, slot long"
    )
    by_slot = (
        _best(found, ["anchor", "slot"], "negative_score", "negative_id", negatives)
        .groupBy("anchor")
        .agg(F.collect_list(F.struct((-F.col("negative_score")).alias("down"), "negative_id", "slot")).alias("slots"))
    )
    # From the last slot to the first: what is best so far meets the k of the next slot.
    merged = F.aggregate(
        F.sequence(F.lit(positives), F.lit(1), F.lit(-1)),
        F.expr("cast(array() as array<array<struct<down: bigint, negative_id: bigint>>>)"),
        lambda all_, j: F.concat(
            F.array(
                F.slice(
                    F.array_sort(
                        F.concat(
                            F.coalesce(F.get(all_, 0), F.expr("cast(array() as array<struct<down: bigint, negative_id: bigint>>)")),
                            F.transform(
                                F.filter("slots", lambda x: x["slot"] == j),
                                lambda x: F.struct(x["down"].alias("down"), x["negative_id"].alias("negative_id")),
                            ),
                        )
                    ),
                    1,
                    negatives,
                )
            ),
            all_,
        ),
    )
    windows = by_slot.select("anchor", merged.alias("windows"))
    # A positive's window begins at the last slot whose limit reaches its score.
    place = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    ordered = best.withColumn("_j", F.row_number().over(place))
    return (
        ordered.join(asked.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
        .join(windows, "anchor")
        .select("anchor_id", "positive_id", "positive_score", F.posexplode(F.get("windows", F.col("_j") - 1)).alias("_at", "n"))
        .select(
            F.col("anchor_id").cast("long").alias("anchor_id"),
            "positive_id",
            (F.col("_at") + 1).cast("int").alias("rank"),
            F.col("n.negative_id").alias("negative_id"),
            "positive_score",
            (-F.col("n.down")).alias("negative_score"),
        )
        .where(F.col("negative_score") * 100 >= F.col("positive_score") * lowest)
    )


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """The hard negatives of every hundredth vector's five positives."""
    vectors = read(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % RELABEL_MOD == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = labelled_vectors(vectors.withColumn("label", moved))
    return mine_hard_negatives(rows.where(F.col("vec_id") % ANCHOR_MOD == 0), rows)


ORACLE_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as p
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as anchor_id, c.vec_id as vec_id, q.label = c.label as alike,
    cast(list_sum(list_transform(range(1, len(q.p) + 1), lambda i: q.p[i] * c.p[i])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id
  where q.vec_id % 100 = 0
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from (
    select *, row_number() over (partition by anchor_id order by score desc, vec_id) as place from s where alike)
  where place <= 5
), negatives as (
  select p.anchor_id, p.positive_id, p.positive_score, s.vec_id as negative_id, s.score as negative_score,
    cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as integer) as rank
  from positives p join s on p.anchor_id = s.anchor_id
  where not s.alike and 80 * p.positive_score <= 100 * s.score and s.score <= p.positive_score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 5
"""
