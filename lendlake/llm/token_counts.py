"""Token counts by rank-synchronous merging of pre-tokens held as numpy arrays.

A text is cut before every word mark; no piece of the vocabulary crosses such a cut, so the
distinct pre-tokens of a batch are merged on their own. Pre-tokens of equal length form one
array; in each step every row merges its pair of lowest rank (the leftmost of equals), all
rows at once, until no row has a pair left. What survives is counted.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, parts_of, read, sums_by, text_or_empty

MODEL = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
MARK = "▁"  # stands for a blank
#: Longer pre-tokens are merged by a heap: the same order of merges, without an array a step.
LONG = 400
#: Pre-tokens whose counts a task remembers; it starts anew when that many are held.
REMEMBERED = 1_000_000
NO_PAIR = np.iinfo(np.int32).max


class Merges:
    """The vocabulary as arrays: id and spare bytes per character, rank and result per pair."""

    def __init__(self, pieces: dict[str, float]):
        """``pieces``: every mergeable piece with its score (higher merges first)."""
        for p in pieces:
            if MARK in p.lstrip(MARK):
                raise ValueError(f"a piece crosses a word mark: {p!r}")
        ids = {p: i for i, p in enumerate(pieces)}
        for p in pieces:
            for ch in p:
                ids.setdefault(ch, len(ids))
        order = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        self.char_id = np.full(0x110000, len(ids), np.int32)  # the last id: no piece
        for s, i in ids.items():
            if len(s) == 1:
                self.char_id[ord(s)] = i
        # A character that is no piece itself becomes one token for each of its bytes.
        code = np.arange(0x110000)
        self.spare = (1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000) - 1).astype(np.int64)
        for s in pieces:
            if len(s) == 1:
                self.spare[ord(s)] = 0
        self.base = np.int64(len(ids) + 1)
        pairs = {}
        for p, score in pieces.items():
            for cut in range(1, len(p)):
                if p[:cut] in ids and p[cut:] in ids:
                    pairs[ids[p[:cut]] * int(self.base) + ids[p[cut:]]] = (order[score], ids[p])
        self.pairs = pairs
        self._fill(pairs)

    def _fill(self, pairs: dict[int, tuple[int, int]]) -> None:
        """Open-addressing table, so that many pairs are looked up at once."""
        bits = max(4, int(np.ceil(np.log2(max(1, len(pairs)) * 3))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, NO_PAIR, np.int32)
        self.made = np.zeros(1 << bits, np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        value = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] == -1]
            self.keys[slot[free]] = keys[free]  # one of several for a slot stays
            placed = self.keys[slot[left]] == keys[left]
            done = left[placed]
            self.rank[slot[done]], self.made[slot[done]] = value[done].T
            left = left[~placed]
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NO_PAIR: none) and result of each pair."""
        keys = left.astype(np.int64) * self.base + right
        slot = self._slot(keys)
        found = self.keys[slot]
        while True:
            wrong = np.flatnonzero((found != keys) & (found != -1))
            if not len(wrong):
                break
            slot[wrong] = (slot[wrong] + 1) & self.mask
            found[wrong] = self.keys[slot[wrong]]
        hit = found == keys
        return np.where(hit, self.rank[slot], NO_PAIR), self.made[slot]

    def merge_rows(self, ids: np.ndarray) -> np.ndarray:
        """Symbols that survive in each row of equally long sequences."""
        n, width = ids.shape
        left = np.full(n, width, np.int64)
        if width < 2:
            return left
        flat_rank, flat_made = self.look_up(ids[:, :-1].ravel(), ids[:, 1:].ravel())
        rank, made = flat_rank.reshape(n, -1), flat_made.reshape(n, -1)
        rows = np.arange(n)
        while True:
            at = rank.argmin(axis=1)  # the leftmost of the lowest
            live = rank[np.arange(len(at)), at] != NO_PAIR
            if not live.all():
                rows, ids, rank, made, at = rows[live], ids[live], rank[live], made[live], at[live]
            if not len(rows):
                return left
            left[rows] -= 1
            every = np.arange(len(rows))
            new = made[every, at]
            width = rank.shape[1]
            if width == 1:
                return left
            # Close the gap: symbols after the pair move one to the left, and so do their pairs.
            move = np.arange(width)[None, :] > at[:, None]
            ids = np.where(move, ids[:, 1:], ids[:, :-1])
            ids[every, at] = new
            move = np.arange(width - 1)[None, :] >= at[:, None]
            rank, made = np.where(move, rank[:, 1:], rank[:, :-1]), np.where(move, made[:, 1:], made[:, :-1])
            for first, there in ((at - 1, at > 0), (at, at < width - 1)):
                r, c = every[there], first[there]
                rank[r, c], made[r, c] = self.look_up(ids[r, c], ids[r, c + 1])

    def merge_long(self, ids: list[int]) -> int:
        """The same for one long sequence: a heap of (rank, place) over linked symbols."""
        n, base = len(ids), int(self.base)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*self.pairs[k], i, ids[i], ids[i + 1]) for i in range(n - 1) if (k := ids[i] * base + ids[i + 1]) in self.pairs]
        heap = [(r, i, a, b, m) for r, m, i, a, b in heap]
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            left -= 1
            for x in (before[i], i):
                y = after[x] if x >= 0 else n
                if x >= 0 and y < n and (got := self.pairs.get(ids[x] * base + ids[y])):
                    heapq.heappush(heap, (got[0], x, ids[x], ids[y], got[1]))
        return left

    def count(self, tokens: list[str]) -> np.ndarray:
        """Number of tokens of each pre-token, given without its first mark."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
        code = np.frombuffer((MARK + MARK.join(tokens)).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum(lengths) - lengths
        ids = self.char_id[code]
        counts = sums_by(self.spare[code], lengths)
        for width in np.unique(lengths):
            some = np.flatnonzero(lengths == width)
            if width > LONG:
                for i in some:
                    counts[i] += self.merge_long(ids[starts[i] : starts[i] + width].tolist())
                continue
            for part in np.array_split(some, len(some) * int(width) // 4_000_000 + 1):
                counts[part] += self.merge_rows(ids[starts[part][:, None] + np.arange(width)])
        return counts


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text, each without its first mark."""
    if not text:
        return []
    if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
        return [t[1:] for t in re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))]
    return text.split(" ")


@functools.lru_cache(maxsize=2)
def merges_of(path: str) -> Merges:
    """Merges of a model file; only plain BPE models with byte fallback and no text rewriting."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.normalize(" Åﬁ  a\t　") != " Åﬁ  a\t　".replace(" ", MARK).join([MARK, ""]):
        raise ValueError("the model rewrites texts; only models with the identity rule are counted here")
    special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    return Merges({model.id_to_piece(i): model.get_score(i) for i in range(len(model)) if not special(i)})


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of whole texts.

    ``path``: model file, by default the public one. A null or empty text has no bytes and no
    tokens; repeated rows are counted each; columns but doc_id and text are ignored. One pass
    without a shuffle.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, known = merges_of(path), {}
        for batch in (part for whole in batches for part in parts_of(whole, 1)):
            texts = batch.column(1).to_pylist()
            lists = [pre_tokens(t) for t in texts]
            lengths = np.fromiter(map(len, lists), np.int64, len(lists))
            coded = pa.array([t for x in lists for t in x], pa.string()).dictionary_encode()
            tokens = coded.dictionary.to_pylist()
            if len(known) > REMEMBERED:
                known = {}
            new = [t for t in tokens if t not in known]
            if new:
                known.update(zip(new, merges.count(new).tolist(), strict=True))
            each = np.fromiter((known[t] for t in tokens), np.int64, len(tokens))
            counts = sums_by(each[coded.indices.to_numpy(zero_copy_only=False)], lengths)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts)], ["doc_id", "n_tokens"])

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    both = docs.select("doc_id", text_or_empty().alias("text"))
    # The length in bytes rides along as the key column's partner; it needs no Python.
    keyed = both.select(F.struct("doc_id", F.octet_length("text").cast("long").alias("n_bytes")).alias("key"), "text")
    counted = map_arrow(keyed, run, f"doc_id struct<doc_id: {doc_type}, n_bytes: bigint>, n_tokens bigint")
    return counted.select(
        "doc_id.doc_id", "doc_id.n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document by the 32k piece model."""
    return count_tokens(read(spark, folder, "documents"))
