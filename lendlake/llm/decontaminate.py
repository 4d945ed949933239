"""Benchmark decontamination by an FM-index per shard of documents.

A shard is a slice of an Arrow batch of documents. Its words that occur in test items are numbered, runs
of such words are concatenated, and a suffix array gives the Burrows-Wheeler transform, held
as a wavelet matrix. All test windows are searched backward at once; occurrences are located
by walking to sampled suffix positions, and covered words merge to removal spans.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, parts_of, read, row_of, text_or_empty

WINDOW = 10
#: Test texts are searched in blocks of about that many bytes: a block is what a task holds.
ITEM_BYTES = 4_000_000
SAMPLED = 8
#: Bytes of text of a shard.
SHARD_BYTES = 8_000_000

#: Words: runs of a-z, 0-9 and bytes from 0x80 on, after lower-casing A-Z; other bytes are blanks.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def item_words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass
class Windows:
    """Distinct test windows of one block of items."""

    words: pa.Array  # by word number - 1
    by_length: list[tuple[np.ndarray, np.ndarray]]  # word numbers (a row a window), first window number
    items: list[np.ndarray]  # of a window: item numbers
    names: list[str]  # item ids as strings, by item number
    shortest: int


def windows_of(items: list[tuple[object, str | None]], window: int = WINDOW) -> Windows | None:
    """Windows of items (id, text): ``window`` consecutive words, or all words of a shorter item."""
    number: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[int]] = {}
    names = []
    for item_id, text in items:
        ids = [number.setdefault(w, len(number) + 1) for w in item_words(text)]
        if not ids:
            continue
        names.append("" if item_id is None else str(item_id))
        for i in range(max(1, len(ids) - window + 1)):
            found.setdefault(tuple(ids[i : i + window]), set()).add(len(names) - 1)
    if not found:
        return None
    by_length, members = [], []
    for n in sorted({len(k) for k in found}):
        some = [k for k in found if len(k) == n]
        by_length.append((np.array(some, np.int64), np.int64(len(members))))
        members += [np.array(sorted(found[k]), np.int64) for k in some]
    return Windows(pa.array(list(number), pa.binary()), by_length, members, names, by_length[0][0].shape[1])


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes (the last symbol is unique and least), by prefix doubling."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, step = len(text), 1
    order = np.argsort(rank, kind="stable")
    while True:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class FmIndex:
    """Backward search and location over symbols 0 .. sigma-1; the text ends with a unique 0."""

    def __init__(self, text: np.ndarray, sampled: int = SAMPLED):
        order = suffix_array(text)
        bwt = text[order - 1]
        sigma = int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(bwt, minlength=sigma))])
        self.levels, self.zeros = [], []
        column = bwt
        for bit in reversed(range(max(1, (sigma - 1).bit_length()))):
            ones = (column >> bit) & 1
            self.levels.append((bit, ones.astype(np.uint8), np.concatenate([[0], np.cumsum(ones, dtype=np.int32)])))
            self.zeros.append(len(column) - int(ones.sum()))
            column = np.concatenate([column[ones == 0], column[ones == 1]])
        self.is_sampled = order % sampled == 0
        self.place = order[self.is_sampled]
        self.sampled_before = np.cumsum(self.is_sampled) - 1

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place of the transform."""
        start = np.zeros_like(at)
        for (bit, _, ones), zeros in zip(self.levels, self.zeros, strict=True):
            one = (symbol >> bit) & 1 == 1
            start_ones, at_ones = ones[start], ones[at]
            start = np.where(one, zeros + start_ones, start - start_ones)
            at = np.where(one, zeros + at_ones, at - at_ones)
        return at - start

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for (bit, bits, ones), zeros in zip(self.levels, self.zeros, strict=True):
            one = bits[at] == 1
            out |= one.astype(np.int64) << bit
            at = np.where(one, zeros + ones[at], at - ones[at])
        return out

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each pattern."""
        n, length = patterns.shape
        low, high = np.zeros(n, np.int64), np.full(n, self.first[-1], np.int64)
        live = np.arange(n)
        for i in reversed(range(length)):
            c = patterns[live, i]
            low[live] = self.first[c] + self.rank(c, low[live])
            high[live] = self.first[c] + self.rank(c, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes."""
        out, live, at, steps = np.zeros(len(rows), np.int64), np.arange(len(rows)), rows.copy(), 0
        while len(live):
            done = self.is_sampled[at]
            out[live[done]] = self.place[self.sampled_before[at[done]]] + steps
            live, at = live[~done], at[~done]
            c = self.symbol(at)
            at = self.first[c] + self.rank(c, at)
            steps += 1
        return out


def hits(codes: np.ndarray, lengths: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Marks of hit words, and the distinct (document, item) pairs, for one shard.

    ``codes``: word numbers of all documents, 0 for words of no item; ``lengths``: words of each.
    """
    mark, doc = np.zeros(len(codes), bool), np.repeat(np.arange(len(lengths)), lengths)
    # Only runs of item words of one document that a window fits into can hold an occurrence.
    edge = np.ones(len(codes), bool)
    edge[1:] = (doc[1:] != doc[:-1]) | ((codes[1:] == 0) != (codes[:-1] == 0))
    starts = np.flatnonzero(edge)
    sizes = np.diff(np.append(starts, len(codes)))
    fit = (codes[starts] > 0) & (sizes >= windows.shortest) if len(starts) else np.zeros(0, bool)
    starts, sizes = starts[fit], sizes[fit]  # separators are 1, words from 2 on, the end is 0
    if not len(starts):
        return mark, np.zeros((0, 2), np.int64)
    ends = np.cumsum(sizes + 1)
    begin = ends - sizes - 1
    source = np.repeat(starts - begin, sizes + 1) + np.arange(ends[-1])
    last = ends - 1
    source[last] = 0
    text = codes[source] + 1
    text[last] = 1
    text = np.append(text, 0)
    index = FmIndex(text)
    pairs = []
    for patterns, first in windows.by_length:
        here = np.flatnonzero((patterns + 1 < len(index.first) - 1).all(axis=1))  # words that this shard has
        low, high = np.zeros((2, len(patterns)), np.int64)
        low[here], high[here] = index.search(patterns[here] + 1)
        count = high - low
        found = np.flatnonzero(count)
        if not len(found):
            continue
        count = count[found]
        rows = np.repeat(low[found] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        place = index.locate(rows)
        at = source[place]
        for k in range(patterns.shape[1]):
            mark[at + k] = True
        both = np.unique(np.stack([doc[at], np.repeat(found, count) + first], axis=1), axis=0)
        members = [windows.items[w] for w in both[:, 1]]
        many = np.fromiter(map(len, members), np.int64, len(members))
        pairs.append(np.stack([np.repeat(both[:, 0], many), np.concatenate(members)], axis=1))
    return mark, np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)


def runs_of(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    step = np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[object, str | None]]]:
    """The test items in blocks of bounded expected size, dealt by a hash."""
    rows = items.select(F.col("item_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = size // block_bytes + 1
    for b in range(blocks):
        some = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield [(r.item_id, r.text) for r in some.collect()]


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    block_bytes: int = ITEM_BYTES,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """row (the columns ``keep``, by default all), n_words, spans and item_ids of ``docs``.

    ``spans``: (start, end) word numbers of the merged hit words; ``item_ids``: items with an
    occurring window, as strings. Null, empty and wordless texts and items have no words and no
    hits; repeated rows are judged each; item texts that repeat count for each of their ids.
    Test items are a query set: they come in bounded blocks, each searched in one pass over the
    documents without a shuffle.
    """
    own = row_of(docs, keep).alias("row")
    state = docs.select(
        own,
        text_or_empty().alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<bigint>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for block in item_blocks(items, block_bytes):
        state = map_arrow(state, _searcher(docs.sparkSession, windows_of(block, window)), state.schema)
    pair = F.expr(
        "transform(sequence(0, size(spans) div 2 - 1), i -> struct(spans[2 * i] as start, spans[2 * i + 1] as end))"
    )
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return state.select(
        F.col("row"),
        "n_words",
        F.when(F.size("spans") > 0, pair).otherwise(none).alias("spans"),
        F.array_sort(F.array_distinct("items")).alias("item_ids"),
    )


def _searcher(spark: SparkSession, windows: Windows | None):
    shared = spark.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        for batch in (part for whole in batches for part in parts_of(whole, 1, SHARD_BYTES)):
            lists = [t.encode("utf-8", "surrogatepass").translate(_FOLD).split() for t in batch.column(1).to_pylist()]
            lengths = np.fromiter(map(len, lists), np.int64, len(lists))
            spans, items = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            if windows is not None and lengths.sum():
                words = pa.array([w for x in lists for w in x], pa.binary())
                codes = pc.index_in(words, windows.words)
                codes = codes.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
                mark, pairs = hits(codes, lengths, windows)
                ends = np.cumsum(lengths)
                for d in np.unique(pairs[:, 0]):
                    own = mark[ends[d] - lengths[d] : ends[d]].copy()
                    for a, b in zip(spans[d][::2], spans[d][1::2], strict=True):  # of earlier blocks
                        own[a:b] = True
                    spans[d] = np.stack(runs_of(own), axis=1).ravel().tolist()
                for d, i in pairs:
                    items[d].append(windows.names[i])
            found = [pa.array(lengths), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found], names=batch.schema.names)

    return run


def leak_report(leaks: DataFrame) -> DataFrame:
    """Digest per document of ``find_leaks``."""
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    return leaks.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@F.pandas_udf(T.StringType())
def _cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without the words of their spans and what stands between those words."""
    import re

    word = re.compile(rb"[^ ]+")
    out = []
    for t, own in zip(text, spans, strict=True):
        raw = t.encode("utf-8", "surrogatepass")
        ends = [m.span() for m in word.finditer(raw.translate(_FOLD))]
        kept, at = [], 0
        for s in own:
            kept.append(raw[at : ends[s["start"]][0]])
            at = ends[s["end"] - 1][1]
        kept.append(raw[at:])
        out.append(b"".join(kept).decode("utf-8", "replace"))
    return pd.Series(out, dtype=object)


def remove_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the leaked words cut out of ``text`` and n_chars set anew; no row goes."""
    cut = F.when(F.size("spans") > 0, _cut(F.coalesce("row.text", F.lit("")), "spans"))
    both = find_leaks(docs, items, window).select("row", "spans", cut.alias("new"))
    text = F.when(F.size("spans") > 0, F.col("new")).otherwise(F.col("row.text"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(text.alias(c))
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            columns.append(
                F.when(F.size("spans") > 0, F.length("new").cast(kind)).otherwise(F.col("row.n_chars")).alias(c)
            )
        else:
            columns.append(F.col("row").getField(c).alias(c))
    return both.select(*columns)


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Ten-word windows of benchmark items in all documents."""
    docs = read(spark, folder, "documents")
    return leak_report(find_leaks(docs, read(spark, folder, "benchmark"), keep=["doc_id"]))
