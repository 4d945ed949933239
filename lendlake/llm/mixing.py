"""Mixing sources to target weights: fixed-length blocks, drawn slots, index permutations.

All of it is DataFrame work. A source's documents form one stream of words (in the order of a
hash), cut into blocks of a fixed length. A source whose target is t words of its w takes
``t div w`` whole epochs of its blocks and a part of one more. Every slot of an epoch is mapped
to a block by a permutation of the block numbers (swap-or-not, keyed by source and epoch), so
that an epoch takes each block once. Slots are thrown at output shards independently, which
makes the source counts of a shard multinomial, given the totals. The mix is written out: each
slot's block packed with its words, one folder for a shard. The streams are packed in PARTS
stretches, one after the other, so that the shuffle files of one are gone before the next.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, staged

BLOCK_WORDS = 64
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 20_251
ROUNDS = 16
SLOTS_PER_SHARD = 16_384
ROWS_PER_BUCKET = 4_000
SLOTS_PER_CHUNK = 8_192
#: Stretches of the streams whose texts are on the way at one time.
PARTS = 2


def word_count(text: Column) -> Column:
    """Number of runs of non-blank characters; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def spaced(text: Column) -> Column:
    """The words that ``word_count`` counts with one blank between them."""
    return F.trim(F.regexp_replace(text, F.lit(r"[\x20\x09-\x0D]+"), F.lit(" ")))


def spaced_count(text: Column) -> Column:
    """Number of words of a text as ``spaced`` gives it."""
    blanks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(text == "", F.lit(0)).otherwise(blanks + 1).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """Target words per source, from (source, source_size).

    Sources by code point, null last, get the weights in turn and share the sum of all sizes. A
    target stops at ``max_repeats`` times its source's size; what is above goes to the others by
    weight. In the order of size over weight, the capped sources come first, so that running
    sums find them in one pass. One row per source meets in a single task.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("_cap") / F.col("weight"), "source_no")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    weighed = (
        sizes.withColumn("source_no", F.row_number().over(turn) - 1)
        .withColumn(
            "weight",
            F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1)).cast("double"),
        )
        .withColumn("_cap", F.col("source_size") * F.lit(float(max_repeats)))
    )
    zero = F.lit(0.0)
    level = weighed.select(
        "*",
        F.sum(F.col("source_size").cast("double")).over(every).alias("_all"),
        F.sum("weight").over(every).alias("_weights"),
        F.coalesce(F.sum("_cap").over(before), zero).alias("_caps_before"),
        F.coalesce(F.sum("weight").over(before), zero).alias("_weights_before"),
    ).withColumn(
        "_capped",
        F.col("_cap") * (F.col("_weights") - F.col("_weights_before"))
        <= F.col("weight") * (F.col("_all") - F.col("_caps_before")),
    )
    rest = level.select(
        "*",
        (F.col("_all") - F.sum(F.when(F.col("_capped"), F.col("_cap")).otherwise(0.0)).over(every)).alias("_left"),
        F.sum(F.when(F.col("_capped"), 0.0).otherwise(F.col("weight"))).over(every).alias("_open"),
    )
    target = F.when(F.col("_capped"), F.col("_cap")).otherwise(F.col("weight") * F.col("_left") / F.col("_open"))
    return rest.select("source", "source_no", "source_size", "weight", target.alias("target"))


def permutation_keys(size: str, *key: str, rounds: int = ROUNDS) -> Column:
    """What ``permuted`` takes for each round, the same for all indexes of a key."""
    keys = ", ".join(key)
    return F.expr(f"transform(sequence(0, {rounds - 1}), r -> pmod(xxhash64({keys}, r, {SEED}), {size}))")


def permuted(index: str, size: str, turns: str, *key: str, rounds: int = ROUNDS) -> Column:
    """Pseudorandom permutation of 0 .. size-1 (swap-or-not), as an expression; ``turns``: its ``permutation_keys``."""
    keys = ", ".join(key)
    return F.expr(
        f"""aggregate(sequence(0, {rounds - 1}), cast({index} as bigint), (x, r) ->
              case when xxhash64({SEED}, {keys}, r, greatest(x, pmod({turns}[r] - x, {size}))) % 2 = 0
                   then x
                   else pmod({turns}[r] - x, {size}) end)"""
    )


@contextmanager
def subset_keys(spark: SparkSession) -> Iterator[None]:
    """Joins planned inside may use a partitioning by some of their keys as it is."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@dataclass
class Mix:
    """What a mix is made of.

    ``sources``: source, source_no, source_size, weight, target. ``slots``: source_no, epoch,
    slot, shard, block, words (fewer than a whole block only in a source's last slot or in its
    stream's last block). ``documents``: doc_id, source_no, size, start (place in the source's stream).
    ``texts``: for a part of the streams, the same with text (words with one blank between them) and
    bucket, dealt by source_no and bucket. ``buckets``: source_no, bucket, part, first and last block of the
    part that the bucket's words reach; a block is of the part where it begins, so that a bucket can
    have rows in two.
    """

    sources: DataFrame
    documents: DataFrame
    texts: Callable[[int], DataFrame]
    buckets: DataFrame
    slots: DataFrame
    block_words: int
    parts: int = 1
    _written: DataFrame | None = None

    def shard_counts(self) -> DataFrame:
        """Slots of each source in each output shard: the multinomial draw."""
        return self.slots.groupBy("shard", "source_no").agg(F.count(F.lit(1)).alias("slots"))

    def pieces(self, part: int = 0) -> DataFrame:
        """source_no, bucket, block, piece: what each document gives to each block, words from ``at`` to
        ``until`` of the block. They lie where ``texts`` are dealt to."""
        n = self.block_words
        # The words are the element of an outer array, so that they are split once and not for each block.
        pieces = F.expr(
            f"""transform(array(split(text, ' ')), w ->
                  transform(sequence(start div {n}, (start + size - 1) div {n}), b -> named_struct(
                    'block', b, 'at', greatest(0L, start - b * {n}), 'until', least({n}L, start + size - b * {n}),
                    'text', array_join(slice(w, cast(greatest(0L, b * {n} - start) as int) + 1, cast(
                      least({n}L, start + size - b * {n}) - greatest(0L, start - b * {n}) as int)), ' '))))[0]"""
        )
        some = self.texts(part).select("doc_id", "source_no", "bucket", "size", "start", F.explode(pieces).alias("p"))
        piece = F.struct("p.at", "p.until", "start", "size", "doc_id", "p.text")
        return some.select("source_no", "bucket", F.col("p.block").alias("block"), piece.alias("piece"))

    def placed_slots(self, part: int = 0) -> DataFrame:
        """The slots with each bucket that has words of their blocks, dealt as ``texts``: numbers alone move."""
        homes = self.buckets.where(F.col("part") == part).select("source_no", "bucket", F.explode(F.expr("sequence(first, last)")).alias("block"))
        # Catalyst takes the exploded slots for a few bytes, so merge joins are asked for by name.
        return self.slots.join(homes.hint("merge"), ["source_no", "block"]).repartition("source_no", "bucket")

    def packed(self, part: int = 0) -> DataFrame:
        """Each slot of a part's blocks with the pieces of its block. Texts move once to their buckets, where slots come to
        meet them, and once to the shards: the pieces of a block from several buckets meet there."""
        key = ("shard", "source_no", "epoch", "slot", "block", "words")
        met = self.pieces(part).join(self.placed_slots(part).hint("merge"), ["source_no", "bucket", "block"])
        # Pieces behind a short slot's words are not taken.
        used = met.where("piece.at < words").select(*key, "piece").repartition("shard")
        return used.groupBy(*key).agg(F.sort_array(F.collect_list("piece")).alias("pieces"))  # at most a word's piece each

    def laid(self, part: int) -> DataFrame:
        """What ``written`` has of a part."""
        whole = F.expr("array_join(transform(pieces, p -> p.text), ' ')")
        rows = self.packed(part).select(
            "shard", "source_no", "epoch", "slot", "block", "words",
            F.when(F.expr("element_at(pieces, -1).until <= words"), whole)
            .otherwise(F.array_join(F.slice(F.split(whole, " "), 1, F.col("words").cast("int")), " "))
            .alias("text"),
            F.expr(
                """transform(pieces, p -> named_struct(
                     'doc_id', p.doc_id, 'size', p.size, 'start', p.start, 'words', least(p.until, words) - p.at))"""
            ).alias("pieces"),
        )
        order = F.xxhash64(F.lit(SEED + 2), "source_no", "slot")
        return rows.sortWithinPartitions("shard", order, "source_no", "slot")

    def written(self) -> DataFrame:
        """The mix: shard, source_no, epoch, slot, block, words, text, and the documents that it is of.

        Rows of a shard lie in a folder of their own, for each part (a random share of every source) in the
        order of a hash. ``pieces`` has doc_id, size, start and the words taken of each document. Made once.
        """
        if self._written is None:
            with subset_keys(self.slots.sparkSession):
                self._written = staged(map(self.laid, range(self.parts)), "mix-shards", by="shard", compression="zstd")
        return self._written

    def taken(self) -> DataFrame:
        """Words that the mix takes of each document, repeats counted, from the written mix."""
        own = self.written().select("source_no", F.explode("pieces").alias("p"))
        key = ("source_no", "start", "size", "doc_id")
        every = self.documents.select(*key, F.lit(0).cast("long").alias("taken"))
        # Documents with words have starts of their own; those without share them, and are rows as they are.
        used = (
            own.select("source_no", "p.start", "p.size", "p.doc_id", F.col("p.words").alias("taken"))
            .unionByName(every.where("size > 0"))
            .groupBy(*key)
            .agg(F.sum("taken").cast("long").alias("taken"))
            .unionByName(every.where("size = 0"))
        )
        about = self.sources.select("source_no", "source_size", "target", F.col("source").alias("source"))
        return (
            used.join(about, "source_no")
            .select("doc_id", "source", "size", "source_size", "target", "taken")
        )


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
) -> Mix:
    """Mix documents (doc_id, source, text; other columns are ignored) to target weights.

    Null or blank texts have size 0 and are never taken; a null source is a source of its own,
    last in order; repeated rows count as documents of their own; an empty table gives empty
    tables. A hot source is spread by hash buckets: no window, slot list or join holds more than
    a bucket, a chunk or a block of it.
    """
    text, own = F.col("text"), F.xxhash64("doc_id", "text").alias("_hash")
    rows = staged(docs.select("doc_id", "source", word_count(text).alias("size"), own), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = staged(source_targets(sizes, weights, max_repeats), "mix-sources")

    buckets = max(1, rows.count() // ROWS_PER_BUCKET)
    parts = min(PARTS, buckets)
    part_of = F.expr(f"cast(_bucket * {parts} div {buckets} as int)")

    def placed(some: DataFrame) -> DataFrame:
        return some.withColumn("_bucket", F.pmod("_hash", F.lit(buckets))).join(
            sources.select(F.col("source").alias("_source"), "source_no"),
            F.col("source").eqNullSafe(F.col("_source")),
        )

    inside = Window.partitionBy("source_no", "_bucket").orderBy("_hash", "doc_id", "size")
    bucket_sizes = placed(rows).groupBy("source_no", "_bucket").agg(F.sum("size").alias("_sum"))
    along = Window.partitionBy("source_no").orderBy("_bucket")
    starts = bucket_sizes.select(
        "source_no", "_bucket", "_sum",
        F.coalesce(F.sum("_sum").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"),
    )
    starts = staged(starts, "mix-buckets")

    def in_stream(some: DataFrame) -> DataFrame:
        """Placed rows with their start."""
        local = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return (
            some.withColumn("_local", local)
            .join(starts.drop("_sum"), ["source_no", "_bucket"])
            .withColumn("start", F.col("_base") + F.col("_local"))
        )

    documents = in_stream(placed(rows)).select("doc_id", "source_no", "size", "start")

    n = block_words
    # A block is of the part that has its first word.
    stretches = starts.groupBy("source_no", part_of.alias("part")).agg(
        F.expr(f"(min(_base) + {n - 1}) div {n}").alias("_first"),
        F.expr(f"(min(_base) + sum(_sum) + {n - 1}) div {n} - 1").alias("_last"),
    )
    reached = (
        starts.where("_sum > 0")
        .withColumn("_part", part_of)
        .join(stretches, "source_no")
        .select(
            "source_no", F.col("_bucket").alias("bucket"), "part", "_part",
            F.expr(f"greatest(_first, _base div {n})").alias("first"),
            F.expr(f"least(_last, (_base + _sum - 1) div {n})").alias("last"),
        )
        .where("first <= last")
    )
    reached = staged(reached, "mix-reached")

    def texts(part: int) -> DataFrame:
        some = placed(docs.where(text.rlike(r"[^\x20\x09-\x0D]")).select("doc_id", "source", "text", own))
        if parts > 1:
            # Besides the part's own buckets those few of others that its last blocks reach.
            more = reached.where(f"part = {part} and _part <> {part}").select(
                "source_no", F.col("bucket").alias("_bucket"), F.lit(True).alias("_more")
            )
            some = some.join(F.broadcast(more), ["source_no", "_bucket"], "left").where((part_of == part) | F.col("_more"))
        some = some.withColumn("text", spaced(text)).withColumn("size", spaced_count(text))
        return in_stream(some).select(
            "doc_id", "source_no", F.col("_bucket").alias("bucket"), "size", "start", "text"
        )

    shared = (
        sources.where("source_size > 0")
        .withColumn("_take", F.least(F.round("target"), F.col("source_size") * max_repeats).cast("long"))
        .withColumn("_whole", F.expr(f"source_size div {n}"))
        .withColumn("_blocks", F.expr(f"(source_size + {n - 1}) div {n}"))
        .withColumn("_epochs", F.expr("_take div source_size"))
        .withColumn("_rest", F.expr("_take % source_size"))
        .withColumn("_slots", F.expr(f"_epochs * _blocks + (_rest + {n - 1}) div {n}"))
        .where("_slots > 0")
    )
    # Chunks end with their epoch, whose keys of the permutation they have.
    epochs = shared.select("*", F.explode(F.expr("sequence(0L, (_slots - 1) div _blocks)")).alias("epoch"))
    chunks = (
        epochs.withColumn("_turns", permutation_keys("greatest(_whole, 1L)", "source_no", "epoch"))
        .withColumn("_end", F.expr("least(_slots, (epoch + 1) * _blocks)"))
        .select("*", F.explode(F.expr(f"sequence(epoch * _blocks, _end - 1, {SLOTS_PER_CHUNK}L)")).alias("_chunk"))
        .repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source_no", "_chunk")
    )
    # With a number of its own, the exchange of these few rows is not coalesced: each becomes many slots.
    slots = chunks.select(
        "*",
        F.explode(F.expr(f"sequence(_chunk, least(_end, _chunk + {SLOTS_PER_CHUNK}) - 1)")).alias("slot"),
    )
    total = shared.agg(F.coalesce(F.sum("_slots"), F.lit(0))).first()[0]
    shards = max(1, total // SLOTS_PER_SHARD)
    slots = (
        slots.withColumn("_index", F.expr("slot % _blocks"))
        # The short last block of the stream stays last, so a partial epoch takes whole blocks.
        .withColumn(
            "block",
            F.when(
                F.expr("_index < _whole"), permuted("_index", "greatest(_whole, 1L)", "_turns", "source_no", "epoch")
            ).otherwise(F.col("_index")),
        )
        .withColumn(
            "words",
            F.when(
                F.expr("epoch < _epochs"), F.least(F.lit(n), F.expr(f"source_size - block * {n}"))
            ).otherwise(F.least(F.lit(n), F.expr(f"_rest - _index * {n}"))),
        )
        .withColumn("shard", F.pmod(F.xxhash64(F.lit(SEED + 1), "source_no", "slot"), F.lit(shards)))
        .select("source_no", "epoch", "slot", "shard", "block", "words")
    )
    if parts > 1:
        slots = staged(slots, "mix-slots")
    return Mix(sources, documents, texts, reached, slots, block_words, parts)


def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Words taken of each document by a mix of all sources to weights 5, 2, 1."""
    return mix_sources(read(spark, folder, "documents")).taken().drop("source")
