"""Exact top-k search by inner product with block-at-a-time pruning.

Candidates lie in blocks of consecutive ids. For a query, a block's bound is the sum over the
terms (dimensions) of the largest product that any of its rows can give. Blocks are visited in
the order of their bounds and scored through their forward rows, until the next bound is below
the query's k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_arrow, read, staged

TOP = 10
SCALE = 1024
QUERY_MOD = 100
#: Queries that one pass over the candidates carries: the size bound of what is broadcast.
QUERIES_PER_PASS = 8_192
BLOCK_ROWS = 256
EXACT = 2.0**53


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and components floor(scale * x); vectors with a null or non-finite part are left out."""
    parts = F.col("embedding").cast("array<double>")
    good = parts.isNotNull() & F.forall(
        parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vectors.where(good & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(parts, lambda x: F.floor(x * scale).cast("double")).alias("parts"),
    )


def _matrix(ids: pa.Array, parts: pa.Array, width: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Rows as a matrix; shorter vectors are filled with zeros."""
    lists = [np.asarray(x, float) for x in parts.to_pylist()]
    out = np.zeros((len(lists), max([width, 1, *map(len, lists)])))
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return ids.to_numpy(zero_copy_only=False).astype(np.int64), out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of whole rows: in doubles where those are exact, else in longs."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    return np.einsum("ik,jk->ij", a.astype(np.int64), b.astype(np.int64))


def best_of(
    ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, block_rows: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query place, candidate id and score of each query's k best among the rows, and how many
    (query, block) pairs were scored. A query's own id is no candidate."""
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    cuts = np.arange(0, len(ids), block_rows)
    top = np.maximum.reduceat(rows, cuts, axis=0)
    low = np.minimum.reduceat(rows, cuts, axis=0)
    # The largest product per dimension comes from the block's maximum or minimum, by sign.
    bounds = np.maximum(queries, 0) @ top.T + np.minimum(queries, 0) @ low.T
    bounds += np.abs(bounds) * 1e-9 + 1e-6  # rounding never makes a bound too small
    visit = np.argsort(-bounds, axis=1, kind="stable")
    worst = np.full(len(queries), -np.inf)
    held = np.zeros(len(queries), np.int64)
    best_score = np.full((len(queries), k), np.iinfo(np.int64).min)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    scored = 0
    for step in range(len(cuts)):
        # A block whose bound equals the k-th score can still hold a tie with a smaller id.
        live = np.flatnonzero((held < k) | (bounds[np.arange(len(queries)), visit[:, step]] >= worst))
        if not len(live):
            break
        for block in np.unique(visit[live, step]):
            some = live[visit[live, step] == block]
            a, b = cuts[block], min(cuts[block] + block_rows, len(ids))
            score = _product(queries[some], rows[a:b])
            own = ids[a:b][None, :] == query_ids[some][:, None]
            scored += len(some)
            all_score = np.concatenate([best_score[some], np.where(own, np.iinfo(np.int64).min, score)], axis=1)
            all_id = np.concatenate(
                [best_id[some], np.where(own, np.iinfo(np.int64).max, np.broadcast_to(ids[a:b], score.shape))], axis=1
            )
            pick = np.lexsort((all_id, ~all_score), axis=1)[:, :k]
            best_score[some] = np.take_along_axis(all_score, pick, 1)
            best_id[some] = np.take_along_axis(all_id, pick, 1)
            held[some] = (best_id[some] != np.iinfo(np.int64).max).sum(axis=1)
            worst[some] = np.where(held[some] == k, best_score[some][:, -1].astype(float), -np.inf)
    place, column = np.nonzero(best_id != np.iinfo(np.int64).max)
    return place, best_id[place, column], best_score[place, column], scored


def top_k(
    candidates: DataFrame, queries: DataFrame, k: int = TOP, block_rows: int = BLOCK_ROWS,
    per_pass: int = QUERIES_PER_PASS,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best candidates, ties to the smaller id.

    Both frames have (vec_id, parts), as ``whole_vectors`` makes them. Vectors of other lengths
    are compared as if filled with zeros. A vec_id that repeats is a candidate for each row
    (a query's own id never), and queries with the same id are one query for each row. Without
    queries or candidates the result is empty. Products are 64-bit integers. Queries come in
    blocks of at most ``per_pass`` rows; every block is one pass over the candidates, of which
    each task returns its k best, so that the last choice sees k rows a task and query.
    """
    spark = candidates.sparkSession
    rows = staged(candidates, "vectors")
    asked = staged(queries.withColumn("_key", F.xxhash64("vec_id", "parts")), "queries")
    passes = asked.count() // per_pass * 2 + 1
    found = None
    for p in range(passes):
        block = asked if passes == 1 else asked.where(F.pmod("_key", F.lit(passes)) == p)
        table = block.select("vec_id", "parts").toArrow().combine_chunks()
        ids, parts = table.column("vec_id"), table.column("parts")
        query_ids, matrix = _matrix(ids, parts)
        shared = spark.sparkContext.broadcast((query_ids, matrix))
        one = map_arrow(rows, _searcher(shared, k, block_rows), "query_no int, query_id long, vec_id long, score long")
        one = one.withColumn("query_no", F.col("query_no") * passes + p)
        found = one if found is None else found.unionByName(one)
    order = Window.partitionBy("query_no").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _searcher(shared, k: int, block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = shared.value
        for batch in batches:
            if not len(query_ids) or not batch.num_rows:
                continue
            ids, rows = _matrix(batch.column(0), batch.column(1), queries.shape[1])
            q = queries
            if rows.shape[1] > q.shape[1]:
                q = np.pad(q, ((0, 0), (0, rows.shape[1] - q.shape[1])))
            place, vec, score, _ = best_of(ids, rows, query_ids, q, k, block_rows)
            arrays = [pa.array(place.astype(np.int32)), pa.array(query_ids[place]), pa.array(vec), pa.array(score)]
            yield pa.RecordBatch.from_arrays(arrays, ["query_no", "query_id", "vec_id", "score"])

    return run


def op10_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best other vectors for every hundredth vector."""
    vectors = whole_vectors(read(spark, folder, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERY_MOD == 0))


ORACLE_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as p
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id as vec_id,
    cast(list_sum(list_transform(range(1, len(q.p) + 1), lambda i: q.p[i] * c.p[i])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id
  where q.vec_id % 100 = 0
), r as (
  select query_id, vec_id, score,
    cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
  from s
)
select query_id, rank, vec_id, score from r where rank <= 10
"""
