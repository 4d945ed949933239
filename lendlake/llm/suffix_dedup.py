"""Removal of long byte strings that occur more than once, by deep-shallow sorting of suffixes.

Suffixes are sorted at anchors only: of the positions of every LENGTH-byte window the one whose
8-byte hash is least (the leftmost of equals). Equal windows have the same anchor at the same
offset, so a window repeats exactly if its anchor's context (what lies less than LENGTH bytes
away) agrees with another context over that window. Contexts that are equal as a whole are one
type, and repeat. Types that share the GRAM bytes at the anchor are sorted by what follows
and by what precedes: a multikey sort to a shallow depth, blind tries for groups that still
agree there. From the two orders and their common prefixes follow the offsets that repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from .common import BLANKS, free, map_arrow, parts_of, raw_bytes, read, row_of, ship, staged, text_or_empty, word_codes

LENGTH = 400
#: Words of the shortest passage over 50 words, and bytes of a word's hash where words are compared.
PASSAGE_WORDS = 51
CODE = 6
GRAM = 32
SHALLOW = 32
#: Types of one anchor string that are sorted together (26 MB of contexts); more of them are parted by cores first.
MOST_TYPES = 32_768
#: Ranges of window offsets whose common bytes (the core) part a hot anchor string.
RANGES = 4
PIECE = 1_000_000
ROWS_AT_ONCE = 4_000
_HASH = np.uint64(0x9E3779B97F4A7C15)
_HIGH = ~np.uint64((1 << 24) - 1)


# --- anchors ------------------------------------------------------------------------------------


def anchor_places(body: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Sorted anchors of all windows inside texts that lie one after the other in ``body``."""
    width = length - GRAM + 1  # candidate positions of a window
    n = len(body)
    if n < length:
        return np.zeros(0, np.int64)
    found = []
    for begin in range(0, n - length + 1, PIECE):
        part = np.ascontiguousarray(body[begin : begin + PIECE + length - 1])
        starts = len(part) - length + 1
        words = np.ndarray((len(part) - 7,), np.dtype("<u8"), buffer=part.data, strides=(1,))
        key = words[: len(part) - GRAM + 1] * _HASH
        key ^= key >> np.uint64(32)
        key *= np.uint64(0xD6E8FEB86659FD93)
        key = (key & _HIGH) | np.arange(len(key), dtype=np.uint64)
        # Least key of every window, from running minima inside blocks of the window's width.
        padded = np.full(-(-len(key) // width) * width, ~np.uint64(0))
        padded[: len(key)] = key
        blocks = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts])
        at = begin + (least & ~_HIGH).astype(np.int64)
        start = begin + np.arange(starts)
        # A window lies inside one text if no text begins in it after its first byte.
        end_of = offsets[np.searchsorted(offsets, start, side="right")]
        found.append(np.unique(at[start + length <= end_of]))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


# --- deep-shallow sorting -----------------------------------------------------------------------


class BlindTrie:
    """Order of equally long byte strings: a trie of branching depths, strings only at leaves."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.numbers = [int.from_bytes(s, "big") for s in strings]
        self.width = len(strings[0])
        self.root: int | tuple | None = None
        for i in range(len(strings)):
            self._insert(i)

    def _common(self, i: int, j: int) -> int:
        differ = (self.numbers[i] ^ self.numbers[j]).bit_length()
        return self.width - (differ + 7) // 8

    def _insert(self, i: int) -> None:
        if self.root is None:
            self.root = [i]
            return
        string, node = self.strings[i], self.root
        while isinstance(node, tuple):  # blindly: only branching bytes are looked at
            depth, branches = node
            node = branches.get(string[depth]) or next(iter(branches.values()))
        common = self._common(i, node[0])  # one comparison tells where it leaves the trie
        if common == self.width:
            node.append(i)
            return
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < common:
            above, node = node, node[1][string[node[0]]]
        if isinstance(node, tuple) and node[0] == common:
            node[1][string[common]] = [i]
            return
        other = node
        while isinstance(other, tuple):
            other = next(iter(other[1].values()))
        split = (common, {self.strings[other[0]][common]: node, string[common]: [i]})
        if above is None:
            self.root = split
        else:
            above[1][string[above[0]]] = split

    def order(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
            else:
                out.extend(node)
        return out


def deep_shallow_order(rows: np.ndarray, group: np.ndarray, skip: int) -> np.ndarray:
    """Order of equally long byte rows inside each group; rows of a group agree in the first
    ``skip`` bytes. ``group`` is sorted."""
    order = np.arange(len(rows))
    cls = group.astype(np.int64)
    live = np.arange(len(rows))
    depth = skip
    while depth < min(skip + SHALLOW, rows.shape[1]) and len(live):
        # Multikey step: the next eight bytes part every class that has several rows.
        word = np.zeros((len(live), 8), np.uint8)
        part = rows[order[live], depth : depth + 8]
        word[:, : part.shape[1]] = part
        word = word.view(">u8").ravel().astype(np.uint64)
        rank = np.lexsort((word, cls[live]))
        order[live] = order[live][rank]
        word, own = word[rank], cls[live]
        new = np.ones(len(live), bool)
        new[1:] = (own[1:] != own[:-1]) | (word[1:] != word[:-1])
        cls[live] = live[new][np.cumsum(new) - 1]  # a class is named by its first place
        size = np.diff(np.append(np.flatnonzero(new), len(live)))
        live = live[np.repeat(size > 1, size)]
        depth += 8
    if len(live) and depth < rows.shape[1]:
        own = cls[live]
        edge = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        for a, b in zip(edge, np.append(edge[1:], len(live)), strict=True):
            place = live[a:b]
            deep = [rows[i, depth:].tobytes() for i in order[place]]
            order[place] = order[place][BlindTrie(deep).order()]
    return order


def common_prefixes(rows: np.ndarray, lengths: np.ndarray, order: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Common bytes of each row in order with the one before it (0 across groups)."""
    a, b = order[1:], order[:-1]
    differ = rows[a] != rows[b]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    common = np.minimum(common, np.minimum(lengths[a], lengths[b]))
    return np.concatenate([[0], np.where(group[a] == group[b], common, 0)])


def repeated_offsets(
    left: np.ndarray, left_size: np.ndarray, right: np.ndarray, right_size: np.ndarray,
    group: np.ndarray, length: int = LENGTH,
) -> list[list[tuple[int, int]]]:
    """For each context, the ranges (first, last) of window offsets that another context of its
    group repeats. ``left``: bytes before the anchor, nearest first; ``right``: from the anchor
    on; both filled up with zeros. ``group`` is sorted; contexts of a group are distinct."""
    n = len(group)
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    if n < 2:
        return out
    right_order = deep_shallow_order(right, group, GRAM)
    left_order = deep_shallow_order(left, group, 0)
    right_common = common_prefixes(right, right_size, right_order, group)
    left_common = common_prefixes(left, left_size, left_order, group)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(starts, n))
    for s in starts[sizes == 2]:
        r, l = int(right_common[s + 1]), int(left_common[s + 1])
        if l + r >= length:
            out[s], out[s + 1] = [(length - r, l)], [(length - r, l)]
    for s, m in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
        lc, rc = left_common[s + 1 : s + m], right_common[s + 1 : s + m]
        if lc.max() + rc.max() < length:
            continue
        lo, ro = left_order[s : s + m] - s, right_order[s : s + m] - s
        cuts = np.unique(np.concatenate([[0], lc + 1, np.maximum(0, length - rc)]))
        cuts = cuts[cuts <= min(lc.max(), length - GRAM)]
        cls = np.empty((2, m), np.int64)
        for k, o in enumerate(cuts):
            # Contexts are alike for this offset if both sides agree far enough.
            cls[0, lo] = np.cumsum(np.append(True, lc < o)) - 1
            cls[1, ro] = np.cumsum(np.append(True, rc < length - o)) - 1
            _, pair, count = np.unique(cls[0] * m + cls[1], return_inverse=True, return_counts=True)
            last = int(cuts[k + 1] - 1 if k + 1 < len(cuts) else min(lc.max(), length - GRAM))
            for i in np.flatnonzero(count[pair] > 1):
                own = out[s + i]
                if own and own[-1][1] == o - 1:
                    own[-1] = (own[-1][0], last)
                else:
                    own.append((int(o), last))
    return out


# --- jobs ---------------------------------------------------------------------------------------


TEXT_KEY = "substring(unhex(sha2(text, 256)), 1, 16)"


def _key(raw: bytes) -> bytes:
    """The same as TEXT_KEY in Python."""
    return hashlib.sha256(raw).digest()[:16]


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    """h (hash of the anchor's GRAM bytes), c (hash of its context), text key, place, and the
    context's bytes before (l) and from the anchor on (r); staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, 0, 1_000_000):
                body, offsets = raw_bytes(part.column(0))
                places = anchor_places(body, offsets, length)
                raw = body.tobytes()
                text = np.searchsorted(offsets, places, side="right") - 1
                l = np.minimum(places - offsets[text], length - GRAM)
                r = np.minimum(offsets[text + 1] - places, length)
                keys = {t: _key(raw[offsets[t] : offsets[t + 1]]) for t in np.unique(text).tolist()}
                h = [xxhash.xxh3_64_intdigest(raw[p : p + GRAM]) for p in places.tolist()]
                c = [
                    xxhash.xxh3_64_intdigest(raw[p - x : p + y], seed=x)
                    for p, x, y in zip(places.tolist(), l.tolist(), r.tolist(), strict=True)
                ]
                arrays = [
                    pa.array(np.array(h, np.uint64).view(np.int64)),
                    pa.array(np.array(c, np.uint64).view(np.int64)),
                    pa.array([keys[t] for t in text.tolist()], pa.binary()),
                    pa.array((places - offsets[text]).astype(np.int64)),
                    pa.array(l.astype(np.int32)),
                    pa.array(r.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["h", "c", "key", "place", "l", "r"])

    source = docs.select(text_or_empty().cast("binary").alias("text")).where(F.octet_length("text") >= length)
    return staged(map_arrow(source, run, "h bigint, c bigint, key binary, place bigint, l int, r int"), "anchors")


def _contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the contexts ``wanted`` (h, c, key, place, l, r, types): h, c, l, r, types, context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, own in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                raw = text.as_py()
                part = pa.array([raw[x["place"] - x["l"] : x["place"] + x["r"]] for x in own], pa.binary())
                kinds = {"h": pa.int64(), "c": pa.int64(), "l": pa.int32(), "r": pa.int32(), "types": pa.int64()}
                columns = [pa.array([x[k] for x in own], t) for k, t in kinds.items()]
                yield pa.RecordBatch.from_arrays([*columns, part], ["h", "c", "l", "r", "types", "context"])

    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("h", "c", "place", "l", "r", "types")).alias("own"))
    texts = (
        docs.select(text_or_empty().cast("binary").alias("text"))
        .where(F.octet_length("text") >= length)
        .select(F.expr(TEXT_KEY).alias("key"), "text")
        .join(lists.select("key"), "key", "left_semi")
        .groupBy("key")
        .agg(F.first("text").alias("text"))
    )
    joined = texts.join(lists, "key").select("text", "own")
    return map_arrow(joined, run, "h bigint, c bigint, l int, r int, types bigint, context binary")


def _sides(table: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Left (nearest byte first) and right bytes of contexts as matrices, and their sizes."""
    l, r = table.column("l").to_numpy().astype(np.int64), table.column("r").to_numpy().astype(np.int64)
    body, offsets = raw_bytes(table.column("context"))
    anchor = offsets[:-1] + l
    wide = np.concatenate([np.zeros(length, np.uint8), body, np.zeros(length, np.uint8)])
    step = np.arange(length - GRAM)
    left = wide[length + anchor[:, None] - 1 - step]
    left[step[None, :] >= l[:, None]] = 0
    step = np.arange(length)
    right = wide[length + anchor[:, None] + step]
    right[step[None, :] >= r[:, None]] = 0
    return left, l, right, r


def _packed(ranges: list[tuple[int, int]], length: int) -> list[int]:
    """Covered bytes relative to the anchor, from ranges of window offsets."""
    return [x for first, last in ranges for x in (-last, length - first)]


def _sorted_types(contexts: DataFrame, length: int) -> DataFrame:
    """h, c, spans of the types that others repeat in part; contexts of an h lie together."""

    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        h = table.column("h").to_numpy()
        group = np.concatenate([[0], np.cumsum(h[1:] != h[:-1])])
        found = repeated_offsets(*_sides(table, length), group, length)
        some = [i for i, x in enumerate(found) if x]
        spans = pa.array([_packed(found[i], length) for i in some], pa.list_(pa.int32()))
        index = pa.array(some, pa.int64())
        arrays = [table.column("h").combine_chunks().take(index), table.column("c").combine_chunks().take(index), spans]
        yield pa.RecordBatch.from_arrays(arrays, ["h", "c", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < ROWS_AT_ONCE:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            h = table.column("h").to_numpy()
            cut = int(np.flatnonzero(h == h[-1])[0])  # the last group may go on
            if cut:
                yield from solve(table.slice(0, cut))
            rest = table.slice(cut).combine_chunks()
            held, rows = rest.to_batches(), rest.num_rows
        if rows:
            yield from solve(pa.Table.from_batches(held).combine_chunks())

    together = contexts.repartition("h").sortWithinPartitions("h")
    return map_arrow(together, run, "h bigint, c bigint, spans array<int>")


def offset_ranges(length: int) -> list[tuple[int, int]]:
    """RANGES runs (first, last) of all window offsets."""
    edges = [(length - GRAM + 1) * i // RANGES for i in range(RANGES + 1)]
    return [(a, b - 1) for a, b in zip(edges, edges[1:], strict=False) if a < b]


def _cored_types(docs: DataFrame, wanted: DataFrame, length: int, most_types: int) -> DataFrame:
    """h, c, spans for anchor strings of very many types (``wanted``).

    All windows of a range of offsets have a core in common, most of a window's bytes. Contexts
    that share a window share the core of its range, so they are parted by range and core; cores
    that come once go, and the bytes of the others are compared over that range alone.
    """
    ranges = offset_ranges(length)

    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            names = ("h", "c", "l", "r", "context")
            for h, c, l, r, raw in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True):
                for first, last in ranges:
                    x, y = min(l, last), min(r, length - first)
                    if x >= first and y >= length - last and x + y >= length:
                        core = xxhash.xxh3_64_intdigest(raw[l - first : l + length - last], seed=first)
                        own = xxhash.xxh3_64_intdigest(raw[l - x : l + y], seed=x)
                        out.append((core, own, h, c, x, y))
            core, own, h, c, x, y = zip(*out, strict=True) if out else [()] * 6
            arrays = [
                pa.array(np.array(core, np.uint64).view(np.int64)),
                pa.array(np.array(own, np.uint64).view(np.int64)),
                pa.array(h, pa.int64()),
                pa.array(c, pa.int64()),
                pa.array(x, pa.int32()),
                pa.array(y, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["core", "own", "h", "c", "l", "r"])

    kind = "core bigint, own bigint, h bigint, c bigint, l int, r int"
    dealt = staged(map_arrow(_contexts(docs, wanted, length), cores, kind), "cores")
    common = dealt.groupBy("core").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("core")
    shared = staged(dealt.join(common, "core"), "shared-cores")
    owns = staged(
        shared.groupBy("core", "own").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("h", "c")).alias("at"), F.min("l").alias("l"), F.min("r").alias("r")
        ),
        "core-types",
    )
    several = owns.groupBy("core").agg(F.count(F.lit(1)).alias("types")).where("types > 1")
    places = wanted.select(F.col("h").alias("_h"), F.col("c").alias("_c"), "key", "place")
    again = (
        owns.join(several, "core")
        .select("core", "own", F.col("at.h").alias("_h"), F.col("at.c").alias("_c"), "l", "r", "types")
        .join(places, ["_h", "_c"])
        .select(F.col("core").alias("h"), F.col("own").alias("c"), "key", "place", "l", "r", "types")
    )
    contexts = _contexts(docs, staged(again, "core-contexts"), length)
    found = owns.where("n > 1").select(F.col("core").alias("h"), F.col("own").alias("c"), F.array(-F.col("l"), F.col("r")).alias("spans"))
    found = found.unionByName(_sorted_types(contexts.where(f"types <= {most_types}"), length))
    many = several.where(f"types > {most_types}").agg(F.coalesce(F.sum("types"), F.lit(0))).first()[0]
    if many:
        parts = int(many * length // RANGES // 2_000_000 + 1)
        found = found.unionByName(_fingerprinted_types(contexts.where(f"types > {most_types}"), length, parts))
    found = found.select(F.col("h").alias("core"), F.col("c").alias("own"), "spans")
    return shared.select("core", "own", "h", "c").join(found, ["core", "own"]).select("h", "c", "spans")


def _fingerprinted_types(contexts: DataFrame, length: int, parts: int) -> DataFrame:
    """The same for cores of very many types: every window's 64-bit fingerprint is dealt
    to parts by its value, in packed rows, and fingerprints that come twice are repeats."""

    entry = np.dtype([("f", "<u8"), ("c", "<i8"), ("h", "<i8"), ("o", "<i4")])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = np.ones(length + 1, np.uint64)
        base = np.uint64(0x100000001B3)
        with np.errstate(over="ignore"):
            for i in range(1, length + 1):
                power[i] = power[i - 1] * base
            for batch in batches:
                for a in range(0, batch.num_rows, 2_000):
                    table = pa.Table.from_batches([batch.slice(a, 2_000)])
                    h, c = table.column("h").to_numpy(), table.column("c").to_numpy()
                    l, anchor = table.column("l").to_numpy(), h.view(np.uint64)
                    out = []
                    for i, raw in enumerate(table.column("context").to_pylist()):
                        value = (np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)) * _HASH
                        value ^= value >> np.uint64(29)
                        # Polynomial of every window, from the sums of its prefixes.
                        inverse = np.uint64(pow(0x100000001B3, -1, 1 << 64))
                        scale = np.cumprod(np.append(np.uint64(1), np.full(len(value) - 1, inverse)), dtype=np.uint64)
                        prefix = np.append(np.uint64(0), np.cumsum(value * scale, dtype=np.uint64))
                        undo = np.cumprod(np.append(np.uint64(1), np.full(len(value) - 1, base)), dtype=np.uint64)
                        start = np.arange(0, len(value) - length + 1)
                        f = (prefix[start + length] - prefix[start]) * undo[start]
                        o = l[i] - start
                        good = (o >= 0) & (o <= length - GRAM)
                        rows = np.zeros(int(good.sum()), entry)
                        rows["f"], rows["o"], rows["c"], rows["h"] = f[good], o[good], c[i], h[i]
                        rows["f"] = (rows["f"] ^ (rows["o"].astype(np.uint64) * _HASH) ^ anchor[i]) * _HASH
                        out.append(rows)
                    if out:
                        every = np.concatenate(out)
                        part = ((every["f"] >> np.uint64(20)) % np.uint64(parts)).astype(np.int32)
                        order = np.argsort(part, kind="stable")
                        every, part = every[order], part[order]
                        edge = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                        packed = [x.tobytes() for x in np.split(every, edge[1:])]
                        yield pa.RecordBatch.from_arrays([pa.array(part[edge]), pa.array(packed, pa.binary())], ["part", "rows"])

    def match(group: pa.Table) -> pa.Table:
        every = np.frombuffer(b"".join(group.column("rows").to_pylist()), entry)
        _, place, count = np.unique(every["f"], return_inverse=True, return_counts=True)
        every = every[count[place] > 1]
        order = np.lexsort((every["o"], every["c"], every["h"]))
        every = every[order]
        new = np.append(True, (every["c"][1:] != every["c"][:-1]) | (every["h"][1:] != every["h"][:-1])) if len(every) else np.zeros(0, bool)
        edge = np.flatnonzero(new)
        lists = [x.astype(np.int32) for x in np.split(every["o"], edge[1:])] if len(edge) else []
        return pa.table({"h": every["h"][edge], "c": every["c"][edge], "offsets": pa.array(lists, pa.list_(pa.int32()))})

    ship(contexts.sparkSession)
    dealt = map_arrow(contexts, windows, "part int, rows binary")
    offsets = dealt.groupBy("part").applyInArrow(match, "h bigint, c bigint, offsets array<int>")
    merged = offsets.groupBy("h", "c").agg(F.flatten(F.collect_list("offsets")).alias("offsets"))
    # Every repeated offset covers its window.
    spans = F.flatten(F.transform("offsets", lambda o: F.array(-o, F.lit(length) - o)))
    return merged.select("h", "c", spans.alias("spans"))


def merged_spans(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by (start, end) pairs that lie one after the other in ``flat``."""
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end = flat[::2], flat[1::2]
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.append(True, start[1:] > end[:-1])
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def _spans(docs: DataFrame, length: int, most_types: int) -> DataFrame:
    """key (of a text), spans (flat starts and ends of what repeats in it, unmerged)."""
    ship(docs.sparkSession)
    every = _anchors(docs, length)
    # Most anchor strings occur once; what follows sees the others only.
    repeated = staged(every.groupBy("h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("h"), "repeated-strings")
    # Both sides of the join are stored, so Spark can split the rows of a hot anchor string.
    anchors = staged(every.join(repeated, "h"), "repeated-anchors")
    free(every, repeated)
    types = staged(
        anchors.groupBy("h", "c").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place")).alias("at"), F.min("l").alias("l"), F.min("r").alias("r")
        ),
        "types",
    )
    several = types.groupBy("h").agg(F.count(F.lit(1)).alias("types"), F.max("n").alias("_n")).where("types > 1")
    wanted = types.join(several.select("h", "types"), "h").select("h", "c", "at.key", "at.place", "l", "r", "types")
    whole = types.where(f"n > 1 and l + r >= {length}").select("h", "c", F.array(-F.col("l"), F.col("r")).alias("spans"))
    contexts = _contexts(docs, wanted.where(f"types <= {most_types}"), length)
    covered = whole.unionByName(_sorted_types(contexts, length))
    if not several.where(f"types > {most_types}").isEmpty():
        hot = staged(wanted.where(f"types > {most_types}"), "hot-types")
        covered = covered.unionByName(_cored_types(docs, hot, length, most_types))
    covered = staged(covered, "covered-types")
    free(types)

    spans = staged(
        anchors.select("h", "c", "key", "place")
        .join(covered, ["h", "c"])
        .select("key", F.transform("spans", lambda x: x + F.col("place")).alias("spans"))
        .groupBy("key")
        .agg(F.flatten(F.collect_set("spans")).alias("spans")),
        "spans",
    )
    free(anchors, covered)
    return spans


def word_bytes(texts: pa.Array) -> pa.Array:
    """Each text as the hashes of its words, CODE bytes each, so that words are windows of bytes."""
    lists = [t.split() for t in texts.to_pylist()]
    codes, distinct = word_codes([w for x in lists for w in x])
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()], "<u8")
    raw = hashes.view(np.uint8).reshape(-1, 8)[codes, :CODE].tobytes()
    ends = np.cumsum([0] + [len(x) * CODE for x in lists]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw)])


_BLANK = np.isin(np.arange(256), list(BLANKS.encode()))


def word_edges(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word, and the one after its last."""
    solid = ~_BLANK[np.frombuffer(raw, np.uint8)]
    edge = np.flatnonzero(np.diff(solid.astype(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2]


def passage_spans(raw: bytes, coded: np.ndarray, words: int) -> np.ndarray:
    """Spans of a text's bytes from spans of its ``word_bytes``: from the first word to the last."""
    first, after = -(-coded[::2] // CODE), coded[1::2] // CODE
    some = after - first >= words  # bytes of hashes that agree by chance make no word
    start, end = word_edges(raw)
    return np.stack([start[first[some]], end[after[some] - 1]], axis=1).ravel()


def _passages(docs: DataFrame, words: int, most_types: int) -> DataFrame:
    """key (of a text), coded (spans of its ``word_bytes``): passages of ``words`` words that repeat.

    Hashes of words take the place of the text, so the same anchors and sorts find the windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, 0, 1_000_000):
                yield pa.RecordBatch.from_arrays([part.column(0), word_bytes(part.column(0))], ["raw", "text"])

    source = docs.select(text_or_empty().cast("binary").alias("raw")).where(F.octet_length("raw") >= 2 * words - 1)
    coded = map_arrow(source, run, "raw binary, text binary").where(F.octet_length("text") >= CODE * words)
    names = coded.select(F.expr(TEXT_KEY.replace("text", "raw")).alias("_key"), F.expr(TEXT_KEY).alias("key")).distinct()
    found = _spans(coded.select("text"), CODE * words, most_types)
    return staged(names.join(found, "key").select(F.col("_key").alias("key"), F.col("spans").alias("coded")), "passages")


def find_repeats(
    docs: DataFrame, length: int = LENGTH, keep: list[str] | None = None, most_types: int = MOST_TYPES, words: int = 0
) -> DataFrame:
    """row (the columns ``keep``, by default all), text (bytes), spans (flat starts and ends of
    the strings that repeat, unmerged) of every document; with ``words`` also passages (the same
    of passages).

    A null or empty text has no bytes; texts below ``length`` bytes repeat nothing; equal texts
    of at least ``length`` bytes repeat each other as a whole; an empty table gives no rows.
    Columns but text are carried along only. Strings are compared by 64-bit hashes of whole
    contexts and by their bytes. With ``words``, passages of that many words (runs of non-blank
    bytes, whatever blanks part them) that occur more than once are found besides, however few
    bytes they have; their words are compared by 48-bit hashes.
    """
    spans = _spans(docs, length, most_types)
    own = row_of(docs, keep).alias("row")
    raw = text_or_empty().cast("binary")
    rows = docs.select(own, raw.alias("text")).withColumn(
        "key", F.expr(TEXT_KEY)
    )
    if not words:
        return rows.join(spans, "key", "left").select("row", "text", "spans")

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [
                passage_spans(text.as_py(), np.array(coded.as_py(), np.int64), words) if coded.is_valid else None
                for text, coded in zip(batch.column(1), batch.column(3), strict=True)
            ]
            arrays = [*batch.columns[:3], pa.array(every, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "text", "spans", "passages"])

    passages = _passages(docs, words, most_types)
    none = F.lit(None).cast("array<bigint>")
    merged = (
        spans.withColumn("coded", none)
        .unionByName(passages.withColumn("spans", none))
        .groupBy("key")
        .agg(F.first("spans", True).alias("spans"), F.first("coded", True).alias("coded"))
    )
    found = rows.join(merged, "key", "left").select("row", "text", "spans", "coded")
    return map_arrow(found, located, StructType(found.schema.fields[:3]).add("passages", ArrayType(LongType())))


def removal_report(repeats: DataFrame) -> DataFrame:
    """Digest per document of ``find_repeats``; where passages were looked for, also n_passages and
    n_passage_bytes (runs of repeated passages, and their bytes)."""
    wide = "passages" in repeats.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, runs, digests, sizes = [], [], [], []
            for text, flat in zip(batch.column(1), batch.column(2), strict=True):
                raw = text.as_py()
                start, end = merged_spans(np.array(flat.as_py() or [], np.int64))
                kept = hashlib.sha256()
                at = 0
                for a, b in zip(start.tolist(), end.tolist(), strict=True):
                    kept.update(raw[at:a])
                    at = b
                kept.update(raw[at:])
                sizes.append(len(raw))
                removed.append(int((end - start).sum()))
                runs.append(len(start))
                digests.append(kept.hexdigest())
            arrays = [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, runs)), pa.array(digests, pa.string())]
            if wide:
                merged = [merged_spans(np.array(flat.as_py() or [], np.int64)) for flat in batch.column(3)]
                arrays += [pa.array([len(a) for a, _ in merged], pa.int64()), pa.array([int((b - a).sum()) for a, b in merged], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["n_passages", "n_passage_bytes"][: 2 * wide]]
    schema = StructType([repeats.schema["row"]])
    for name in names[1:]:
        schema = schema.add(name, "string" if name == "kept_sha256" else "long")
    return map_arrow(repeats, run, schema).select("row.*", *names[1:])


def remove_repeats(docs: DataFrame, length: int = LENGTH, words: int = 0) -> DataFrame:
    """``docs`` without the repeated strings (and passages of ``words`` words), n_chars set anew;
    no row goes. A character that a removed run covers in part only is removed with it, so texts
    stay valid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, *flats in zip(*batch.columns[1:], strict=True):
                raw = text.as_py()
                start, end = merged_spans(np.array([x for flat in flats for x in flat.as_py() or []], np.int64))
                kept, at = [], 0
                for a, b in zip(start.tolist(), end.tolist(), strict=True):
                    kept.append(raw[at:a])
                    at = b
                kept.append(raw[at:])
                # Cut characters leave incomplete bytes at the edges; those go.
                texts.append("".join(x.decode("utf-8", "ignore") for x in kept) if len(start) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "new"])

    found = find_repeats(docs, length, words=words)
    both = map_arrow(found, run, StructType([found.schema["row"]]).add("new", "string"))
    columns = []
    for c in docs.columns:
        old = F.col("row").getField(c)
        if c == "text":
            columns.append(F.coalesce("new", old).alias(c))
        elif c == "n_chars":
            columns.append(F.coalesce(F.length("new").cast(docs.schema[c].dataType), old).alias(c))
        else:
            columns.append(old.alias(c))
    return both.select(*columns)


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Removed bytes of all documents (strings of 400 bytes that start anywhere else too), and their repeated passages of over 50 words."""
    return removal_report(find_repeats(read(spark, folder, "documents"), keep=["doc_id"], words=PASSAGE_WORDS))
