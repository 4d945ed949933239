"""Shards that all match the mixture: proportional stratified interleaving.

The rows of a source are shuffled by a seeded hash and ranked. A row's fractional rank, its rank
plus an offset of the source (0 to 1) over the source's size, spreads every source evenly over 0
to 1, so the order by fractional rank interleaves the sources in proportion, and every piece of
that order has the mixture of the whole. The offsets spread sources of few rows as well.
The order is cut into shards whose row counts differ by one at most.

No rank needs a source, or the table, in one task. Rows are dealt to buckets by ranges of their
hash; the rows of a source in a bucket follow each other in the source's order, so counts by
(bucket, source) give every rank, and the texts cross the network once, to their bucket. All of
it is DataFrame work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from .common import named, read, row_of, staged

SHARDS = 8
SEED = 20_263
ROWS_PER_BUCKET = 4_000
#: Buckets whose sums are added up together before the sums of such groups are.
BUCKETS_PER_GROUP = 512


def running(df: DataFrame, by: Sequence[str], at: str, value: str) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the rows of the same ``by`` with a smaller ``at``.

    (by, at) is unique. Sums of groups of ``at`` come first, so that no task holds more than a
    group, or one row per group.
    """
    grouped = df.withColumn("_group", F.expr(f"{at} div {BUCKETS_PER_GROUP}"))
    along = Window.partitionBy(*by).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        grouped.groupBy(*by, "_group")
        .agg(F.sum(value).alias("_sum"))
        .select(*by, "_group", F.coalesce(F.sum("_sum").over(along), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(*by, "_group").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    return (
        grouped.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts.hint("merge"), [*by, "_group"])
        .withColumn("before", F.col("_start") + F.col("_inside"))
        .drop("_group", "_start", "_inside")
    )


def _hashable(kind: DataType) -> bool:
    """Whether a hash of values of this type exists (none does of maps, at any depth)."""
    if isinstance(kind, StructType):
        return all(_hashable(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def _hashed(docs: DataFrame, seed: int) -> DataFrame:
    """The row as a struct, its source as a key without nulls, and its seeded hash."""
    parts = [named(f.name) for f in docs.schema if _hashable(f.dataType)]
    return docs.select(
        row_of(docs).alias("doc"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_source"),
        F.xxhash64(F.lit(seed), *parts).alias("_hash"),
    )


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """Bucket numbers by ranges of the hash."""
    high = F.shiftright("_hash", 32) + F.lit(1 << 31)  # 0 to 2^32 - 1
    return rows.withColumn("_bucket", F.shiftright(high * F.lit(buckets), 32))


def places(counts: DataFrame, buckets: int, total: int, shards: int, seed: int) -> DataFrame:
    """(_bucket, _places): shard and slot of each bucket's rows, in the order of source and hash.

    ``counts`` has (_bucket, _source, n). The place of a row in the interleaved order is its rank
    among the fractional ranks; those are even over 0 to 1, so ranges of them hold few rows each.
    """
    ranked = running(counts, ["_source"], "_bucket", "n")
    sizes = counts.groupBy("_source").agg(F.sum("n").alias("_size"))
    offset = (F.pmod(F.xxhash64(F.lit(seed), "_source"), F.lit(1 << 20)) + 0.5) / (1 << 20)
    rows = (
        ranked.join(sizes.hint("merge"), "_source")
        .select("_bucket", "_source", "_size", "before", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("_local"))
        .withColumn("_fraction", (F.col("before") + F.col("_local") + offset) / F.col("_size"))
        .withColumn("_range", F.least(F.floor(F.col("_fraction") * buckets), F.lit(buckets - 1)).cast("long"))
    )
    starts = running(rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).withColumn("_one", F.lit(1)), ["_one"], "_range", "n")
    # A source stands at one fraction once; at equal fractions the sources come by code point, null last.
    order = Window.partitionBy("_range").orderBy("_fraction", (F.col("_source") == "").asc(), "_source")
    placed = (
        rows.withColumn("_inside", F.row_number().over(order) - 1)
        .join(starts.select("_range", F.col("before").alias("_start")).hint("merge"), "_range")  # Catalyst can't tell the exploded rows' size
        .withColumn("_place", F.col("_start") + F.col("_inside"))
        .withColumn("_shard", F.expr(f"cast(_place * {shards} div {total} as int)"))
        .withColumn("_slot", F.expr(f"_place - (cast(_shard as bigint) * {total} + {shards - 1}) div {shards}"))
    )
    one = F.struct("_source", "_local", "_shard", "_slot")
    return placed.groupBy("_bucket").agg(
        F.transform(F.sort_array(F.collect_list(one)), lambda x: F.struct(x["_shard"].alias("shard"), x["_slot"].alias("slot"))).alias("_places")
    )


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``doc`` (the row as a struct), ``shard`` and ``slot`` of every row of ``docs``.

    Shards are 0 to ``shards - 1``, slots gapless from 0 in each shard, and row counts at most one
    apart. A source has its even share of each shard, give or take a row and its share of one row
    for each source. Needs a column ``source``; the others, of any name, go along in ``doc``. A
    null source is a source of its own; null, empty or very long texts are rows like others;
    repeated rows each have a place of their own; fewer rows than shards leave shards empty; an
    empty table gives no rows. The input is read twice after its count (a stored table is best).
    The same rows have the same places in each run; rows that are equal in all columns may change
    places with one another.
    """
    total = docs.count()
    rows = _hashed(docs, seed)
    if not total:
        return rows.select("doc", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    buckets = total // rows_per_bucket + 1
    counts = staged(_bucketed(rows, buckets).groupBy("_bucket", "_source").agg(F.count(F.lit(1)).alias("n")), "shard-counts")
    # The window and the join share the deal by bucket: the texts are shuffled once.
    order = Window.partitionBy("_bucket").orderBy("_source", "_hash")
    ordered = _bucketed(rows, buckets).withColumn("_at", F.row_number().over(order))
    place = F.element_at("_places", F.col("_at"))
    return ordered.join(places(counts, buckets, total, shards, seed).hint("merge"), "_bucket").select(
        "doc", place["shard"].alias("shard"), place["slot"].alias("slot")
    )


def written_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The shards as stored files (doc, slot, shard): a folder for each shard, every file in the order of its slots."""
    laid = interleave(docs, shards, seed).sortWithinPartitions("shard", "slot")
    return staged(laid.select("doc", "slot", "shard"), "shards", by="shard")


def op12_shard_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document, with size and checksum of the text as it lies in the shard's files."""
    stored = written_shards(read(spark, folder, "documents"))
    text = F.coalesce(F.col("doc.text"), F.lit("")).cast("binary")
    return stored.select(
        "doc.doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("doc.source").alias("source"),
    )
