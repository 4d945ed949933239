"""Quality classifier: votes of the nearest labelled documents in a latent space.

Documents become term counts over words, over word shapes (letters, capitals, digits and marks,
runs shortened) and over how words repeat. Weighted counts of a bounded sample of labelled documents
are factored; their latent vectors are broadcast. Every document is projected, compared with
all of them by blocked cosine products, and takes the labels of the nearest, by similarity.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import map_arrow, parts_of, raw_bytes, read, remainder, row_of, text_or_empty, word_codes

#: Columns of the term matrix: 32 for repeats, hashed shapes up to SHAPES, hashed words behind them.
SHAPES, TERMS = 2_048, 3_072
#: Weight of a word's column beside a shape's.
WORD_WEIGHT = 0.25
RANK = 24
NEIGHBOURS = 15
POWER = 4.0
THRESHOLD = 0.3
#: Labelled documents that the vectors come from, by the least hash.
SAMPLE_ROWS = 6_000
#: Bytes of text whose terms are counted at once.
PART_BYTES = 2_000_000
BLOCK = 512

_SHAPE = bytes(
    0x20 if c == 0x20 or 9 <= c <= 13
    else ord("0") if 0x30 <= c <= 0x39
    else ord("A") if 0x41 <= c <= 0x5A
    else ord("a") if 0x61 <= c <= 0x7A or c >= 0x80
    else c
    for c in range(256)
)


def _slots(terms: list[bytes], first: int = 32, last: int = SHAPES) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t) % (last - first) + first for t in terms], np.int64)


def term_counts(texts: pa.Array) -> np.ndarray:
    """Counts of terms per text (rows), as a dense matrix of TERMS columns.

    Columns 0-31 hold how words repeat; then come hashed word shapes and pairs of neighbouring
    shapes, and from SHAPES on hashed words (A-Z lower-cased). Null and empty texts have a row of zeros.
    """
    body, offsets = raw_bytes(texts)
    n = len(offsets) - 1
    raw = body.tobytes()
    # Words with their documents: the texts lie one after the other, so mark where each begins.
    out = np.zeros((n, TERMS), np.float32)
    shaped, words, lengths = [], [], np.zeros(n, np.int64)
    for i in range(n):
        own = raw[offsets[i] : offsets[i + 1]]
        some = own.lower().split()
        lengths[i] = len(some)
        words += some
        shaped.append(own.translate(_SHAPE))
    if not words:
        return out
    # Shorten runs of one class to one character; the separator keeps texts apart.
    line = np.frombuffer(b" ".join(shaped), np.uint8)
    keep = np.ones(len(line), bool)
    keep[1:] = line[1:] != line[:-1]
    shape, shapes = word_codes(line[keep].tobytes().split())
    word, distinct_words = word_codes(words)
    doc = np.repeat(np.arange(n), lengths)
    np.add.at(out, (doc, _slots(distinct_words.to_pylist(), SHAPES, TERMS)[word]), 1)

    slot = _slots(shapes.to_pylist())[shape]
    np.add.at(out, (doc, slot), 1)
    same_doc = doc[1:] == doc[:-1]
    pair = np.unique(shape[:-1][same_doc] * len(shapes) + shape[1:][same_doc], return_inverse=True)
    names = shapes.to_pylist()
    slots = _slots([names[p // len(names)] + b" " + names[p % len(names)] for p in pair[0].tolist()])
    np.add.at(out, (doc[1:][same_doc], slots[pair[1]]), 1)

    # Words equal to the one before, to that two before; and words seen before in the document.
    for lag, column in ((1, 0), (2, 1)):
        if len(word) > lag:
            again = (word[lag:] == word[:-lag]) & (doc[lag:] == doc[:-lag])
            np.add.at(out, (doc[lag:][again], column), 1)
    key = np.unique(doc * (word.max() + 1) + word)
    distinct = np.bincount((key // (word.max() + 1)).astype(np.int64), minlength=n)
    share = np.floor(8 * (1 - distinct / np.maximum(lengths, 1))).astype(np.int64)
    long = np.minimum(np.log2(np.maximum(lengths, 1)).astype(np.int64), 15)
    some = lengths > 0
    out[np.flatnonzero(some), 2 + np.minimum(share[some], 7)] = lengths[some] * 0.2
    out[np.flatnonzero(some), 16 + long[some]] = lengths[some] * 0.05
    return out


def scaled(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted square roots of the terms' shares."""
    total = counts[:, 32:SHAPES].sum(axis=1, keepdims=True)
    return np.sqrt(counts / np.maximum(total, 1)) * weights


@dataclass
class Voters:
    """Labelled latent vectors: ``weights`` per term, ``basis`` (terms x rank), unit vectors, labels."""

    weights: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        latent = scaled(counts, self.weights) @ self.basis
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def vote(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Share of label 1 among the nearest, weighted by a power of the cosine."""
        if not len(self.vectors):
            return np.where(counts[:, 32:].sum(axis=1) > 0, self.prior, 0.0)
        vectors, k = self.project(counts), min(neighbours, len(self.vectors))
        out = np.empty(len(counts))
        for a in range(0, len(counts), BLOCK):
            cosine = vectors[a : a + BLOCK] @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(float) ** POWER + 1e-9
            out[a : a + BLOCK] = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
        # A text without words says nothing: it is poor.
        return np.where(counts[:, 32:].sum(axis=1) > 0, out, 0.0)


class PackedCounts:
    """Rows of term counts held by their cells that are not zero; a slice gives them as a dense matrix."""

    def __init__(self, rows: list[bytes]):
        self.rows = rows

    @staticmethod
    def pack(counts: np.ndarray) -> list[bytes]:
        at = [np.flatnonzero(row) for row in counts]
        return [np.concatenate([a.astype(np.float32), row[a]]).tobytes() for a, row in zip(at, counts, strict=True)]

    def __getitem__(self, part: slice) -> np.ndarray:
        rows = self.rows[part]
        counts = np.zeros((len(rows), TERMS), np.float32)
        for i, packed in enumerate(rows):
            both = np.frombuffer(packed, np.float32)
            counts[i, both[: len(both) // 2].astype(np.int64)] = both[len(both) // 2 :]
        return counts


def fit_voters(counts: np.ndarray | PackedCounts, labels: np.ndarray, rank: int = RANK) -> Voters:
    """Latent vectors of labelled documents; ``counts`` as ``term_counts`` makes them, dense a block at a time."""
    n = len(labels)
    prior = float(labels.mean()) if n else 0.5
    seen = np.zeros(TERMS, np.int64)
    for a in range(0, n, BLOCK):
        seen += (counts[a : a + BLOCK] > 0).sum(axis=0)
    weights = np.log((1 + n) / (1 + seen)).astype(np.float32) + 0.1
    weights[SHAPES:] *= WORD_WEIGHT
    none = np.zeros((0, TERMS), np.float32)
    voters = Voters(weights, none.T if n else np.eye(TERMS, dtype=np.float32), none, labels, prior)
    if n == 0:
        return voters
    gram = np.zeros((TERMS, TERMS))
    for a in range(0, n, BLOCK):
        rows = scaled(counts[a : a + BLOCK], weights).astype(float)
        gram += rows.T @ rows
    _, vectors = np.linalg.eigh(gram)
    voters.basis = vectors[:, ::-1][:, :rank].astype(np.float32)
    voters.vectors = np.concatenate([voters.project(counts[a : a + BLOCK]) for a in range(0, n, BLOCK)]).astype(np.float32)
    voters.labels = labels.astype(float)
    return voters


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents, those of the least hash of their id.

    Rows whose crc32(doc_id as text) mod 5 is 0 are held out. Of an id that repeats in the labels
    the least label counts. The sample is chosen among ids alone; then its texts are looked up.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 5) != 0))
        .groupBy("doc_id")
        .agg(F.min(label).cast("double").alias("label"))
        .withColumn("_order", F.xxhash64("doc_id"))
    )
    chosen = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy("_order", "doc_id").limit(rows)
    return (
        docs.select("doc_id", text_or_empty().alias("text"))
        .join(F.broadcast(chosen), "doc_id")  # at most ``rows`` rows
        .dropDuplicates(["doc_id"])
        .orderBy("_order", "doc_id")
        .select("text", "label")
    )


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Voters:
    """Voters of the sample: counted in many tasks, factored in one (``rows`` x TERMS at most), so not on the driver."""
    sample = labelled_sample(docs, labels, label, rows).select("text", "label", F.monotonically_increasing_id().alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = pa.array(PackedCounts.pack(term_counts(batch.column(0))), pa.binary())
            yield pa.RecordBatch.from_arrays([terms, batch.column(1), batch.column(2)], ["terms", "label", "at"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, marks = [], []
        for batch in batches:
            terms += batch.column(0).to_pylist()
            marks += batch.column(1).to_pylist()
        if terms:
            voters = pickle.dumps(fit_voters(PackedCounts(terms), np.array(marks, float)))
            yield pa.RecordBatch.from_arrays([pa.array([voters], pa.binary())], ["voters"])

    counted = map_arrow(sample, run, "terms binary, label double, at long").repartition(1).sortWithinPartitions("at")
    fitted = map_arrow(counted.select("terms", "label"), fit, "voters binary").toArrow().column(0).to_pylist()
    return pickle.loads(fitted[0]) if fitted else fit_voters(PackedCounts([]), np.zeros(0))


def score_quality(docs: DataFrame, voters: Voters, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (by default all) of each document in ``row``, and its score."""
    shared = docs.sparkSession.sparkContext.broadcast(voters)  # SAMPLE_ROWS x RANK at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = shared.value
        for batch in batches:
            rows = batch.column(0)
            # Texts that come back are taken from their rows, so that a batch holds them once.
            texts = batch.column(1) if batch.num_columns > 1 else pc.struct_field(rows, [place])
            texts = pa.RecordBatch.from_arrays([texts.cast(pa.string()).fill_null("")], ["text"])
            parts = [p.slice(a, BLOCK) for p in parts_of(texts, 0, PART_BYTES) for a in range(0, p.num_rows, BLOCK)]
            scores = [voters.vote(term_counts(p.column(0))) for p in parts]
            score = np.clip(np.concatenate(scores), 0, 1) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([rows, pa.array(score)], ["row", "score"])

    place = -1 if keep else docs.columns.index("text")
    own = row_of(docs, keep).alias("row")
    both = docs.select(own, text_or_empty().alias("text")) if keep else docs.select(own)
    return map_arrow(both, run, StructType([both.schema["row"]]).add("score", "double"))


def classify_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of whole texts.

    Scores see texts only. Null, empty and blank texts score 0; without labelled rows every
    other text scores 0.5; repeated rows score alike; other columns are ignored.
    """
    scored = score_quality(docs, train(docs, labels), ["doc_id"])
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        (remainder(F.col("row.doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier doesn't reject, unchanged."""
    scored = score_quality(docs, train(docs, labels)).where(F.col("score") >= threshold)
    return scored.select("row.*")


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from labels of the training folds."""
    return classify_quality(read(spark, folder, "documents"), read(spark, folder, "labels"))
