"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models over hashed words and word
beginnings. Each later model also reads the probabilities of the earlier ones; in training
those come from out-of-fold predictions, so that it learns to read what it will get.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, parts_of, read, remainder, sums_by, text_or_empty, word_codes

BITS = 18
FOLDS = 5
SAMPLE_ROWS = 10_000
FEATURES = 1_024
STEMS = (4, 5, 6)
STEPS = 120
RATE = 0.5
L2 = 2e-5
THRESHOLD = 0.5

#: Words of this operator: runs of a-z, 0-9 and bytes from 0x80 on, after lower-casing A-Z.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def features_of(word: bytes) -> tuple[int, ...]:
    """Hashed features of a word: itself and its beginnings."""
    own = [b"w" + word] + [b"%d" % n + word[:n] for n in STEMS if len(word) > n]
    return tuple(xxhash.xxh32_intdigest(x) & ((1 << BITS) - 1) for x in own)


@dataclass
class Rows:
    """Texts as features: for each text the distinct features it has."""

    slots: np.ndarray
    lengths: np.ndarray

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return sums_by(weights[self.slots], self.lengths)

    def take(self, chosen: np.ndarray) -> Rows:
        text = np.repeat(np.arange(len(self.lengths)), self.lengths)
        return Rows(self.slots[chosen[text]], self.lengths[chosen])


def rows_of(texts: Sequence[str], known: dict[bytes, tuple[int, ...]]) -> Rows:
    lists = [t.encode("utf-8", "surrogatepass").translate(_FOLD).split() for t in texts]
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    codes, distinct = word_codes([w for x in lists for w in x])
    if len(known) > 1_000_000:
        known.clear()
    slots = []
    for w in distinct.to_pylist():
        got = known.get(w)
        if got is None:
            got = known[w] = features_of(w)
        slots.append(got)
    width = np.fromiter(map(len, slots), np.int64, len(slots))
    flat = np.fromiter((s for x in slots for s in x), np.int64, int(width.sum()))
    start = np.cumsum(width) - width
    # A word counts once for a text: first its distinct words, then their features.
    text = np.repeat(np.arange(len(lists)), lengths)
    pairs = np.unique(text * max(1, len(slots)) + codes) if len(codes) else np.zeros(0, np.int64)
    text, code = pairs // max(1, len(slots)), pairs % max(1, len(slots))
    many = width[code]
    at = np.repeat(start[code] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    every = np.unique(np.repeat(text, many) << BITS | flat[at])
    return Rows(every & ((1 << BITS) - 1), np.bincount(every >> BITS, minlength=len(lists)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Linear:
    """Logistic model: a weight per hashed feature, one per earlier category, and a constant."""

    weights: np.ndarray
    earlier: np.ndarray
    constant: float

    def probability(self, rows: Rows, earlier: np.ndarray) -> np.ndarray:
        return sigmoid(rows.sums(self.weights) + earlier @ self.earlier + self.constant)


def telling(rows: Rows, labels: np.ndarray, most: int = FEATURES) -> np.ndarray:
    """The features whose share of texts differs most between the classes, in standard errors."""
    text = np.repeat(labels == 1, rows.lengths)
    n1 = int((labels == 1).sum())
    pos = np.bincount(rows.slots[text], minlength=1 << BITS)
    neg = np.bincount(rows.slots[~text], minlength=1 << BITS)
    odds = np.log((pos + 0.5) / (n1 + 1)) - np.log((neg + 0.5) / (len(labels) - n1 + 1))
    z = np.where(pos + neg >= 3, np.abs(odds) / np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5)), 0)
    best = np.argsort(-z, kind="stable")[:most]
    return best[z[best] > 4]


def fit_linear(rows: Rows, earlier: np.ndarray, labels: np.ndarray) -> Linear:
    """Adagrad on all rows and the telling features; classes weigh the same."""
    n = len(labels)
    share = np.clip(labels.mean() if n else 0, 1e-3, 1 - 1e-3)
    w = np.zeros(1 << BITS)
    if n == 0 or labels.min() == labels.max():
        return Linear(w, np.zeros(earlier.shape[1]), float(np.log(share / (1 - share))))
    chosen = telling(rows, labels)
    number = np.full(1 << BITS, -1)
    number[chosen] = np.arange(len(chosen))
    own = number[rows.slots]
    text = np.repeat(np.arange(n), rows.lengths)[own >= 0]
    own = own[own >= 0]
    each = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / n
    k = len(chosen)
    x, gain = np.zeros(k + earlier.shape[1] + 1), np.full(k + earlier.shape[1] + 1, 1e-8)
    for _ in range(STEPS):
        raw = np.bincount(text, x[own], n) + earlier @ x[k:-1] + x[-1]
        error = (sigmoid(raw) - labels) * each
        step = np.concatenate([np.bincount(own, error[text], k), error @ earlier, [error.sum()]])
        step[:k] += L2 * x[:k]
        gain += step * step
        x -= RATE * step / np.sqrt(gain)
    w[chosen] = x[:k]
    return Linear(w, x[k:-1], float(x[-1]))


@dataclass
class Chain:
    """Models in the order of their categories."""

    categories: list[str]
    models: list[Linear] = field(default_factory=list)

    def probabilities(self, rows: Rows) -> np.ndarray:
        out = np.zeros((len(rows.lengths), 0))
        for model in self.models:
            out = np.column_stack([out, model.probability(rows, out)])
        return out


def fit_chain(rows: Rows, labels: np.ndarray, categories: Sequence[str], fold: np.ndarray) -> Chain:
    """``labels``: a 0/1 column per category; ``fold``: fold number per row."""
    chain, earlier = Chain(list(categories)), np.zeros((len(labels), 0))
    for k in range(len(categories)):
        chain.models.append(fit_linear(rows, earlier, labels[:, k]))
        if k + 1 == len(categories):
            break
        unseen = np.zeros(len(labels))
        for f in np.unique(fold):
            rest, own = fold != f, fold == f
            model = fit_linear(rows.take(rest), earlier[rest], labels[rest, k])
            unseen[own] = model.probability(rows.take(own), earlier[own])
        earlier = np.column_stack([earlier, unseen])
    return chain


def train_chain(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str], sample_rows: int = SAMPLE_ROWS
) -> Chain:
    """A chain for label columns, from the ``sample_rows`` labelled documents of the least hash.

    Rows whose crc32(doc_id as text) mod 5 is 0 are held out of training.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 5) != 0))
        .groupBy("doc_id")
        .agg(*[F.max(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(f"_c{i}") for i, c in enumerate(categories)])
    )
    names = [f"_c{i}" for i in range(len(categories))]
    chosen = (
        known.withColumn("_order", F.xxhash64("doc_id"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
        .orderBy("_order", "doc_id")
        .limit(sample_rows)
    )
    sample = (
        docs.select("doc_id", text_or_empty().alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .dropDuplicates(["doc_id"])
        .select("_order", "text", *names)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in (part for whole in batches for part in parts_of(whole, 1)):
            rows = rows_of(batch.column(1).to_pylist(), known)
            packed = [x.astype(np.int32).tobytes() for x in np.split(rows.slots, np.cumsum(rows.lengths)[:-1])]
            arrays = [batch.column(0), pa.array(packed[: batch.num_rows], pa.binary()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(arrays, ["_order", "slots", *batch.schema.names[2:]])

    kinds = "".join(f", {c} double" for c in names)
    table = map_arrow(sample, run, f"_order bigint, slots binary{kinds}").toArrow().sort_by("_order")
    lists = [np.frombuffer(x, np.int32) for x in table.column("slots").to_pylist()]
    rows = Rows(
        np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64),
        np.fromiter(map(len, lists), np.int64, len(lists)),
    )
    marks = np.column_stack([table.column(c).to_numpy() for c in names]) if len(lists) else np.zeros((0, len(names)))
    fold = table.column("_order").to_numpy() % FOLDS
    return fit_chain(rows, marks, categories, fold)


def predict_toxicity(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, a probability per category (p_<category>), score (the last one's) and predicted.

    Null, empty and wordless texts have no features and get probability 0 in every category;
    repeated rows are predicted alike; other columns are ignored. The chain is bounded: 2 to the
    power of BITS weights a category.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in (part for whole in batches for part in parts_of(whole, 1)):
            rows = rows_of(batch.column(1).to_pylist(), known)
            p = shared.value.probabilities(rows) * (rows.lengths > 0)[:, None]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, p.T.copy())], ["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = map_arrow(
        docs.select("doc_id", text_or_empty().alias("text")), run, f"doc_id {kind}, " + ", ".join(f"{c} double" for c in names)
    )
    last = F.col(names[-1])
    return found.select("*", last.alias("score"), (last >= threshold).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document: first of each common language's texts, then of any text.

    The labels hold one category; the chain's earlier links are its parts by language (the four
    most frequent labelled ones), which serve as targets only.
    """
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    by_lang = docs.select("doc_id", "lang").dropDuplicates(["doc_id"]).join(labels.select("doc_id", "toxic"), "doc_id")
    common = by_lang.where("lang is not null").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(4)
    langs = sorted(r.lang for r in common.collect())
    toxic = F.coalesce(F.col("toxic").cast("int"), F.lit(0))
    marked = by_lang.select(
        "doc_id", *[(F.col("lang").eqNullSafe(x)).cast("int").__mul__(toxic).alias(f"toxic_{i}") for i, x in enumerate(langs)], "toxic"
    )
    chain = train_chain(docs, marked, [f"toxic_{i}" for i in range(len(langs))] + ["toxic"])
    return predict_toxicity(docs, chain).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted"
    )
