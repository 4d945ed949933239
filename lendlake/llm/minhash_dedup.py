"""Near-duplicate documents by HyperMinHash sketches, banding and exact verification.

Every document's shingles are hashed once; a hash falls into one of REGISTERS buckets, and a
bucket keeps the least of its hashes as a leading-zero count and mantissa bits. Bands of
registers are the keys under which similar sets meet. Documents with equal word sequences are
one class from the start. Classes that meet are linked to a pivot first; only what stays in
different components of a band is compared further, by the collision-corrected estimate. All
links are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free, map_arrow, parts_of, read, row_of, ship, staged, text_or_empty, word_codes

WORDS = 5
PERCENT = 80
BANDS, BAND_ROWS = 48, 6
REGISTERS = BANDS * BAND_ROWS
ZERO_BITS, MANTISSA_BITS = 6, 26
#: Members of a band that are compared as one block; larger bands are split to pairs of blocks.
BLOCK = 256
#: Bytes of text whose shingles are made at once.
PART_BYTES = 2_000_000
#: The estimate must be that many standard errors below the threshold to drop a pair unverified.
MARGIN = 6.0


# --- sets and sketches --------------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray, list[bytes | None]]:
    """Sorted distinct shingle hashes of all texts in a row, their number per text, and a digest
    of each word sequence (None without words)."""
    import xxhash

    lists = [t.lower().split() for t in texts]
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    digests = [hashlib.sha256(b" ".join(x)).digest()[:16] if x else None for x in lists]
    codes, distinct = word_codes([w for x in lists for w in x])
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(len(lists), np.int64), digests
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()], np.uint64)[codes]
    size = np.where(lengths >= words, lengths - words + 1, np.minimum(lengths, 1))
    ends = np.cumsum(lengths)
    text = np.repeat(np.arange(len(lists)), size)
    start = np.repeat(ends - lengths - (np.cumsum(size) - size), size) + np.arange(size.sum())
    short = lengths[text] < words
    value = np.zeros(len(start), np.uint64)
    for i in range(words):
        inside = ~short | (i < lengths[text])
        here = hashes[np.minimum(start + i, len(hashes) - 1)]
        value = np.where(inside, mixed(value * np.uint64(3) + here), value)
    value = np.where(short, mixed(value + np.uint64(1)), value)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[new], np.bincount(text[new], minlength=len(lists)), digests


def sketches(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of sorted sets (rows); 0 for a bucket without hashes."""
    out = np.zeros((len(sizes), REGISTERS), np.uint32)
    if not len(values):
        return out
    text = np.repeat(np.arange(len(sizes)), sizes)
    # The bucket is the hash's place in equal ranges, so the first of a bucket is its least.
    wide = np.uint64((1 << 64) // REGISTERS + 1)
    bucket = values // wide
    rest = (values % wide).astype(np.float64) / float(wide)  # in [0, 1)
    first = np.ones(len(values), bool)
    first[1:] = (bucket[1:] != bucket[:-1]) | (text[1:] != text[:-1])
    rest = np.maximum(rest[first], 2.0**-60)
    mantissa, exponent = np.frexp(rest)  # rest = mantissa * 2**exponent, mantissa in [0.5, 1)
    zeros = np.minimum(-exponent, (1 << ZERO_BITS) - 2).astype(np.uint32)
    digits = ((mantissa * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.uint32)
    out[text[first], bucket[first].astype(np.int64)] = ((zeros + 1) << MANTISSA_BITS) | digits
    return out


def band_keys(registers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit key of each band (rows x BANDS), and whether the band has any hash."""
    bands = registers.reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2]).copy()
    for i in range(BAND_ROWS):
        key = mixed(key * np.uint64(5) + bands[:, :, i])
    return key.view(np.int64), (bands > 0).any(axis=2)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Corrected Jaccard estimates of register rows, and the number of registers they rest on.

    Registers can agree by chance: two different least hashes of a bucket share leading zeros
    and mantissa with about the probability below, which is taken off.
    """
    used = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    load = np.maximum(1.0, np.minimum(size_a, size_b) / REGISTERS)
    chance = np.minimum(0.5, load / 2.0**MANTISSA_BITS)  # expected for the fuller buckets, an upper bound
    raw = same / np.maximum(used, 1)
    return np.maximum(0.0, (raw - chance) / (1 - chance)), used


def may_link(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets with register rows ``a`` and ``b`` can have ``percent`` in common; never wrong to say no.

    Registers that differ have different least hashes, and the lesser one is in one set only. So
    the sets differ in at least as many hashes as in registers, and linked sets of m and n hashes
    differ in at most (100 - percent) / (100 + percent) * (m + n). For sets that hardly fill their
    registers, whose estimate rests on few of them, this decides nearly all pairs.
    """
    differ = (a != b).sum(axis=1)
    return (100 + percent) * differ <= (100 - percent) * (size_a + size_b)


# --- components ---------------------------------------------------------------------------------


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component: the least id that can be reached) for all ``nodes`` (id).

    Links (a, b) are contracted in rounds: every node hangs itself under the least of its
    neighbours' labels, chains are followed, and links inside a component go. Each round is
    written to the shared folder; no round collects links or labels.
    """
    labels = staged(nodes.select("id", F.col("id").alias("component")), "labels")
    links, before = links.where("a <> b").select("a", "b"), None
    while True:
        # Links between the labels of their ends.
        ends = (
            links.join(labels.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a")
            .join(labels.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b")
            .where("ca <> cb")
            .select(F.least("ca", "cb").alias("low"), F.greatest("ca", "cb").alias("high"))
            .distinct()
        )
        ends = staged(ends, "links")
        if before is not None:
            free(before)
        if ends.isEmpty():
            free(ends)
            return labels
        parents = staged(ends.groupBy("high").agg(F.min("low").alias("low"), F.lit(True).alias("moved")), "parents")
        # Pointer jumping until no parent has a parent: chains end at their least label.
        while True:
            up = parents.select(F.col("high").alias("low"), F.col("low").alias("up"))
            jumped = staged(
                parents.select("high", "low").join(up, "low", "left").select(
                    "high", F.coalesce("up", "low").alias("low"), F.col("up").isNotNull().alias("moved")
                ),
                "parents",
            )
            free(parents)
            parents = jumped
            if jumped.where("moved").isEmpty():
                break
        hung = staged(
            labels.join(parents.select(F.col("high").alias("component"), "low"), "component", "left").select(
                "id", F.coalesce("low", "component").alias("component")
            ),
            "labels",
        )
        free(labels, parents)
        labels, before = hung, ends
        links = ends.select(F.col("low").alias("a"), F.col("high").alias("b"))
        # Ends are labels, and every label is the id of one of its members.


# --- the jobs -----------------------------------------------------------------------------------


def _sketched(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, digest, registers (binary) of each row; staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, 2, PART_BYTES):
                values, sizes, digests = shingle_sets(part.column(2).to_pylist(), words)
                registers = sketches(values, sizes)
                arrays = [
                    part.column(0),
                    part.column(1),
                    pa.array(sizes),
                    pa.array(digests, pa.binary()),
                    pa.array([r.tobytes() if n else None for r, n in zip(registers, sizes, strict=True)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_hash", "n_shingles", "digest", "registers"])

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("text_hash"),
        text_or_empty().cast("binary").alias("text"),
    )
    fields = "doc_id bigint, text_hash bigint, n_shingles bigint, digest binary, registers binary"
    return staged(map_arrow(source, run, fields), "sketches")


def _text_hash() -> Column:
    """Tells the rows of one id apart; null and empty texts differ."""
    return F.xxhash64("text", F.col("text").isNull())


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of class numbers whose full sets are similar enough; sets are made anew
    from the texts of the classes that occur in pairs."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, 0, PART_BYTES):
                values, sizes, digests = shingle_sets(part.column(0).to_pylist(), words)
                packed = [x.tobytes() for x in np.split(values, np.cumsum(sizes)[:-1])]
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(packed, pa.binary())], ["digest", "set"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    # A class is found again by its least doc_id; of the rows with that id, by the digest of its words.
    own = staged(classes.join(needed, "id").select("id", "digest", F.col("least").alias("doc_id")), "needed-classes")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    with_sets = map_arrow(texts.join(own.select("doc_id").distinct(), "doc_id", "left_semi").select("text"), sets, "digest binary, set binary")
    chosen = staged(with_sets.join(own.select("id", "digest"), "digest").groupBy("id").agg(F.first("set").alias("set")), "sets")
    free(own)
    joined = pairs.join(chosen.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a").join(
        chosen.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b"
    )
    found = staged(map_arrow(joined.select("a", "b", "set_a", "set_b"), compare, "a bigint, b bigint"), "confirmed")
    free(chosen)
    return found


def _linked(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, digest, component (a number, null without words) and
    component_id of every row."""
    spark = docs.sparkSession
    ship(spark)
    sketched = _sketched(docs, words)
    # Classes of equal word sequences. Their numbers, not their ids, are the nodes: an id may
    # stand on several texts.
    classes = staged(
        sketched.where("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers"))
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    rows = staged(sketched.drop("registers"), "rows")
    free(sketched)

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            registers = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, REGISTERS)
            keys, used = band_keys(registers)
            row, no = np.nonzero(used)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            n = batch.column(2).to_numpy(zero_copy_only=False)
            arrays = [pa.array(ids[row]), pa.array(keys[used]), pa.array(no.astype(np.int8)), pa.array(n[row])]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "band", "no", "n"])

    banded = map_arrow(
        classes.select("id", "registers", "n"), bands, "id bigint, band bigint, no tinyint, n bigint"
    )
    # Sizes come from map-side combined counts; bands of one class go.
    sizes = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = staged(banded.join(sizes, "band"), "bands")

    # First one link for a class: to the weightiest pivot of its bands. The text that others are
    # copies of keeps most of its bands, so it meets the most classes, and copies form stars.
    # A pivot whose set is too small or too large for a link is passed over.
    weights = met.groupBy("id").agg(F.sum("size").alias("weight"))
    place = F.struct("weight", (-F.col("id")).alias("minus"), "n")
    pivots = met.join(weights, "id").groupBy("band").agg(F.max(place).alias("top"))
    first = (
        met.join(pivots, "band")
        .where(f"-top.minus <> id and 100 * least(n, top.n) >= {percent} * greatest(n, top.n)")
        .groupBy("id")
        .agg((-F.max("top")["minus"]).alias("pivot"))
        .select(F.greatest("id", "pivot").alias("a"), F.least("id", "pivot").alias("b"))
        .distinct()
    )
    first = staged(first, "first-pairs")
    ids = classes.select("id")
    done = _confirmed(first, classes, docs, words, percent)
    labels = components(ids, done)

    # Then whatever else shares a band and isn't connected yet.
    mixed_bands = met.join(labels, "id").select("band", "no", "id", "component")
    spread = (
        mixed_bands.groupBy("band")
        .agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count(F.lit(1)).alias("_n"))
        .where("_low <> _high")
        .select("band", "_n")
    )
    open_ = staged(mixed_bands.join(spread, "band"), "open-bands")
    free(met)
    pairs = staged(_open_pairs(open_, classes, percent).join(first, ["a", "b"], "left_anti"), "more-pairs")
    free(open_, first)
    if not pairs.isEmpty():
        more = _confirmed(pairs, classes, docs, words, percent)
        free(labels)
        labels = components(ids, done.unionByName(more))

    # A component is named by the least doc_id of its classes.
    of_class = classes.select("id", "digest", "least").join(labels, "id")
    names = of_class.groupBy("component").agg(F.min("least").alias("component_id"))
    named = of_class.join(names, "component").select("digest", "component", "component_id")
    return rows.join(named, "digest", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))


def link_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of whole texts: documents linked when
    100 * intersection >= ``percent`` * union of their sets of ``words``-word shingles.

    Words are runs of non-blank bytes, A-Z lower-cased. A text with fewer words is one shingle;
    a null, empty or blank text has none and is linked with nothing. Rows that repeat an id are
    documents of their own with that id; they are linked by their texts like others (equal ids
    alone link nothing). A component has the least doc_id of its rows. A null id takes no part
    with its row (null is its component, unless its words are those of another row). Other
    columns are ignored, and an empty table gives none.
    """
    return _linked(docs, words, percent).select("doc_id", "n_shingles", "component_id")


def _open_pairs(open_bands: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components that share a band and may be similar enough.

    A band is split to blocks of about BLOCK members, and every pair of its blocks is a group of
    its own, so no group holds more than two blocks. Sizes and estimates are compared inside the
    group; only pairs that could reach the threshold come out.
    """
    share = percent / 100

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids, comp, n = (group.column(c).to_numpy() for c in ("id", "component", "n"))
        side = group.column("side").to_numpy(zero_copy_only=False)
        registers = np.frombuffer(b"".join(group.column("registers").to_pylist()), np.uint32).reshape(-1, REGISTERS)
        out_a, out_b = [], []
        bands = registers.reshape(-1, BANDS, BAND_ROWS)
        no = group.column("no")[0].as_py()
        same_block = not side.any()
        left = np.flatnonzero(~side) if not same_block else np.arange(len(ids))
        right = np.flatnonzero(side) if not same_block else np.arange(len(ids))
        for i in left:
            other = right[(comp[right] != comp[i])]
            if same_block:
                other = other[other > i]
            other = other[(100 * n[other] >= percent * n[i]) & (100 * n[i] >= percent * n[other])]
            other = other[may_link(registers[[i]], registers[other], n[i], n[other], percent)]
            if not len(other):
                continue
            # A pair counts in the first band that it shares, and in no other.
            alike = (bands[other, : no + 1] == bands[i, : no + 1]).all(axis=2) & (bands[i, : no + 1] > 0).any(axis=1)
            other = other[alike.argmax(axis=1) == no]
            if not len(other):
                continue
            value, used = estimate(registers[[i]], registers[other], n[i], n[other])
            error = np.sqrt(share * (1 - share) / np.maximum(used, 1))
            for j in other[value >= share - MARGIN * error]:
                out_a.append(max(ids[i], ids[j]))
                out_b.append(min(ids[i], ids[j]))
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    blocks = F.expr(f"cast(greatest(1, (_n + {BLOCK - 1}) div {BLOCK}) as int)")
    members = (
        open_bands.join(classes.select("id", "n", "registers"), "id")
        .withColumn("_blocks", blocks)
        .withColumn("_own", F.expr("pmod(xxhash64(id, band), _blocks)"))
        .withColumn("_other", F.explode(F.expr("sequence(0, _blocks - 1)")))
        .select(
            "band", "no", "id", "component", "n", "registers",
            F.least("_own", "_other").alias("low"), F.greatest("_own", "_other").alias("high"),
            (F.col("_own") > F.col("_other")).alias("side"),
        )
    )
    return members.groupBy("band", "low", "high").applyInArrow(compare, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``link_documents`` with kept: whether the document stays for its component."""
    linked = link_documents(docs, words, percent)
    return linked.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component: that of the least doc_id.

    Documents without words and rows with a null id stay. Of rows that are equal in id and text
    one stays; where the least id stands on several texts of a component, one of them does.
    Columns may have any name.
    """
    linked = _linked(docs, words, percent).where("doc_id is not null and doc_id = component_id")
    one = linked.where("digest is not null").groupBy("component").agg(F.first(F.struct("doc_id", "text_hash"), True).alias("_one"))
    firsts = one.select("_one.doc_id", "_one.text_hash").unionByName(linked.where("digest is null").select("doc_id", "text_hash").distinct())
    firsts = staged(firsts, "kept-rows")
    rows = docs.select(
        row_of(docs).alias("doc"),
        F.col("doc_id").cast("long").alias("doc_id"),
        _text_hash().alias("text_hash"),
    )
    rest = rows.join(firsts, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])
    return rest.unionByName(rows.where("doc_id is null")).select("doc.*")


def op5_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents under two-word shingles and a similarity of 0.8."""
    return near_duplicates(read(spark, folder, "documents"), words=2)
