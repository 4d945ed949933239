"""WARC archives of pages, and their global index by external merging of sorted runs.

Writing: each archive is a text file of whole records, so any file system Spark writes to can
hold it, and Spark's commit keeps it whole when executors are lost. Reading: an archive is
parsed to captures, which its task sorts by URL key and time: a run. Runs are cut at common
splitters, and every range of keys is merged from the slices of all runs by a loser tree.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free, map_arrow, read, staged

LEAST_REVISIT = 100
EPOCH = 1_700_000_000
#: Bytes of payload that an archive holds on average, and captures of a range of the index.
ARCHIVE_BYTES = 8_000_000
RANGE_ROWS = 20_000
#: Shares of the pages that are dealt to archives one after the other: only one share's payloads lie in shuffle files.
SHARES = 4
#: Keys that the splitters are chosen from, for each range.
SAMPLED_KEYS = 64

CAPTURE = (
    "url_key string, capture_time bigint, page_id bigint, url string, record_type string, "
    "payload_bytes bigint, payload_digest string, refers_to bigint, archive string, offset bigint, length bigint"
)


# --- writing ------------------------------------------------------------------------------------


def with_records(pages: DataFrame, least: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to (the page that a revisit repeats),
    dealt so that a partition is an archive of about ``archive_bytes`` of payload."""
    return next(record_shares(pages, least, archive_bytes, shares=1))


def record_shares(
    pages: DataFrame, least: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES, shares: int = SHARES
) -> Iterator[DataFrame]:
    """The rows of ``with_records`` in up to ``shares`` frames, each page in one of them.

    Of payloads of at least ``least`` bytes that are equal, the smallest page_id's is stored.
    The first pages are found on ids, lengths and digests alone, with group minima made before rows are
    shuffled. Payloads are shuffled once, by archive, and meet their revisit marks there. Pages
    are dealt by page and digest, so that neither a hot host nor a hot page id makes a large archive.
    Every share reads the pages again, for its own payloads.
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        body.alias("payload"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha2(body, 256).alias("payload_digest"),
    ).withColumn("_deal", F.xxhash64("page_id", "url", "payload_digest"))
    slim = staged(keyed.select("page_id", "payload_bytes", "payload_digest", "_deal"), "payloads")
    groups = (
        slim.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    # Both sides of the join are stored, so Spark can split a payload that a third of all pages share.
    marks = slim.join(staged(groups, "first-pages"), "payload_digest")
    revisits = marks.where("first <> page_id").select("_deal", F.col("first").alias("refers_to")).distinct()
    size = slim.agg(F.coalesce(F.sum("payload_bytes"), F.lit(0))).first()[0]
    shares = int(min(shares, size // archive_bytes + 1))
    archives = size // archive_bytes // shares + 1
    if shares > 1:
        revisits = staged(revisits, "revisits")
    for i in range(shares):
        own = F.pmod("_deal", F.lit(shares)) == i
        dealt = keyed.where(own).repartition(archives, "_deal")
        yield dealt.join(revisits.where(own).repartition(archives, "_deal").hint("merge"), "_deal", "left").drop("_deal")


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _one_line(col: str) -> Column:
    """Header text: control characters can't stand in a header, so they are percent-coded."""
    safe = F.col(col)
    for c in ("%", "\r", "\n"):
        safe = F.replace(safe, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return safe


def record_of() -> Column:
    """A record as bytes, without the two line ends that close it."""
    revisit = F.col("refers_to").isNotNull()
    stored = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    time = F.date_format(
        F.timestamp_seconds(F.lit(EPOCH) + F.coalesce(F.col("page_id"), F.lit(0)) % 100_000_000), "yyyy-MM-dd'T'HH:mm:ss'Z'"
    )
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page, F.lit(">"))),
        F.when(F.col("url").isNotNull(), _line("WARC-Target-URI", _one_line("url"))).otherwise(F.lit("")),
        _line("WARC-Date", time),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(
            revisit,
            F.concat(
                F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
                _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
            ),
        ).otherwise(F.lit("")),
        F.lit("Content-Type: text/html\r\n"),
        _line("Content-Length", F.octet_length(stored).cast("string")),
        F.lit("\r\n"),
    )
    return F.concat(head.cast("binary"), stored)


def write_archives(records: DataFrame, path: str, more: bool = False) -> None:
    """Write one WARC record a row to a new folder (or, for ``more``, to one that has archives); a text file whose rows end with two line ends is an archive."""
    lines = records.select(record_of().cast("string").alias("value"))
    lines.write.mode("append" if more else "errorifexists").option("lineSep", "\r\n\r\n").text(path)


# --- reading ------------------------------------------------------------------------------------


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], int, int, int]]:
    """(headers, offset, begin and end of the payload) of each record of an archive."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        begin = head_end + 4
        end = begin + int(headers["Content-Length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} has no end")
        yield headers, at, begin, end
        at = end + 4


def url_key(url: str | None) -> str:
    """Host labels from the last to the first, then path and query; no scheme, all lower case."""
    if url is None:
        return ""
    rest = url.split("://", 1)[-1].lower()
    cut = min([len(rest), *(rest.index(c) for c in "/?#" if c in rest)])
    host = rest[:cut].rsplit("@", 1)[-1]
    return ",".join(reversed(host.split(":")[0].split("."))) + ")" + (rest[cut:] or "/")


def _page(text: str | None) -> int | None:
    number = text[len("<urn:page:") : -1] if text else "null"
    return None if number == "null" else int(number)


def _uncoded(text: str | None) -> str | None:
    if text is None:
        return None
    for c in ("\n", "\r", "%"):
        text = text.replace(f"%{ord(c):02X}", c)
    return text


def captures_of(archive: str, data: bytes) -> list[tuple]:
    """The sorted run of an archive. A response's length and digest are those of its stored
    payload; a revisit's are taken from its headers, as its payload is elsewhere."""
    out = []
    for headers, at, begin, end in parse_archive(data):
        kind, page = headers["WARC-Type"], _page(headers["WARC-Record-ID"])
        digest, size = headers["WARC-Payload-Digest"].removeprefix("sha256:"), int(headers["X-Payload-Length"])
        if kind == "response":
            size, found = end - begin, hashlib.sha256(data[begin:end]).hexdigest()
            if found != digest:
                raise ValueError(f"damaged payload in {archive} at {at}")
        url = _uncoded(headers.get("WARC-Target-URI"))
        time = int(pd.Timestamp(headers["WARC-Date"]).timestamp())
        refers = _page(headers.get("WARC-Refers-To"))
        out.append((url_key(url), time, page, url, kind, size, digest, refers, archive, at, end + 4 - at))
    return sorted(out, key=capture_key)


def capture_key(c: Sequence) -> tuple:
    """Order of the index: URL key, time, then page and place, so that ties have one order."""
    return c[0], c[1], -1 if c[2] is None else c[2], c[8], c[9]


# --- merging ------------------------------------------------------------------------------------


class LoserTree:
    """Merges sorted iterators: each step replays one path of log2(k) losers."""

    def __init__(self, runs: Sequence[Iterator[tuple]], key=capture_key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.k = len(runs)
        self.heads: list = [next(r, None) for r in self.runs]
        self.keys: list = [None if h is None else key(h) for h in self.heads]
        self.losers = [-1] * self.k
        self.winner = -1
        for leaf in range(self.k):
            self._replay(leaf)

    def _less(self, a: int, b: int) -> bool:
        """Whether run a goes before run b; ended runs go last."""
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[a] is not None
        return (self.keys[a], a) < (self.keys[b], b)

    def _replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self.losers[node] == -1:  # while the tree is built: wait for the other side
                self.losers[node] = winner
                return
            if self._less(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.winner = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.keys[self.winner] is not None:
            run = self.winner
            yield self.heads[run]
            head = self.heads[run] = next(self.runs[run], None)
            self.keys[run] = None if head is None else self.key(head)
            self._replay(run)


def _columns(rows: list[tuple], names: list[str]) -> pa.Table:
    return pa.table({c: [r[i] for r in rows] for i, c in enumerate(names)}, schema=_ARROW)


_ARROW = pa.schema(
    [(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.strip().split(" ") for x in CAPTURE.split(","))]
)
NAMES = _ARROW.names
_HEAD = struct.Struct("<q")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Captures of all archives of a folder; each archive's rows are one sorted run."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = captures_of(name.rsplit("/", 1)[-1], data.as_py())
                yield from _columns(rows, NAMES).to_batches(max_chunksize=10_000)

    return map_arrow(files, run, CAPTURE)


def merge_runs(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The global index: captures of all runs in order, in ranges numbered ``range_no``.

    Splitters are whole sort keys, so a URL that a third of all captures share is spread over
    many ranges. They come from a bounded sample (SAMPLED_KEYS a range); the sample decides
    where ranges are cut, not what is in them. Rows inside a range are in order of ``rank``.
    """
    spark = runs.sparkSession
    total = runs.count()
    ranges = total // range_rows + 1
    order = F.xxhash64("archive", "offset")
    share = min(1.0, ranges * SAMPLED_KEYS / max(1, total))
    least = int(-(2**63) + share * 2 * (2**63 - 1)) if share < 1 else 2**63 - 1
    keys = runs.where(order <= F.lit(least)).select("url_key", "capture_time", "page_id", "archive", "offset")
    sample = sorted(
        (r.url_key, r.capture_time, -1 if r.page_id is None else r.page_id, r.archive, r.offset) for r in keys.collect()
    )
    cuts = [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []
    shared = spark.sparkContext.broadcast(cuts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A run's slices: consecutive rows of one archive in one range, packed as one row."""
        import bisect

        held: tuple | None = None
        rows: list[tuple] = []
        seq = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = (bisect.bisect_right(shared.value, capture_key(row)), row[8])
                if at != held or len(rows) >= 10_000:
                    if rows:
                        yield _slice(held, seq, rows)
                    seq = seq + 1 if at == held else 0
                    held, rows = at, []
                rows.append(row)
        if rows:
            yield _slice(held, seq, rows)

    slices = map_arrow(runs, cut, "range_no int, archive string, seq int, rows binary")
    return slices.groupBy("range_no").applyInArrow(_merge_range, f"range_no int, rank bigint, {CAPTURE}")


def _slice(at: tuple, seq: int, rows: list[tuple]) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    table = _columns(rows, NAMES)
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    values = [pa.array([at[0]], pa.int32()), pa.array([at[1]]), pa.array([seq], pa.int32())]
    return pa.RecordBatch.from_arrays([*values, pa.array([sink.getvalue().to_pybytes()])], ["range_no", "archive", "seq", "rows"])


def _merge_range(slices: pa.Table) -> pa.Table:
    """Loser-tree merge of one range (about ``range_rows`` captures) from the slices of all runs."""
    runs: dict[str, list[tuple[int, bytes]]] = {}
    for archive, seq, packed in zip(*(slices.column(c).to_pylist() for c in ("archive", "seq", "rows")), strict=True):
        runs.setdefault(archive, []).append((seq, packed))

    def rows(parts: list[tuple[int, bytes]]) -> Iterator[tuple]:
        for _, packed in sorted(parts):
            table = pa.ipc.open_stream(packed).read_all()
            yield from zip(*(c.to_pylist() for c in table.columns), strict=True)

    merged = _columns(list(LoserTree([rows(runs[a]) for a in sorted(runs)])), NAMES)
    no = slices.column("range_no")[0].as_py()
    merged = merged.add_column(0, "rank", pa.array(range(merged.num_rows), pa.int64()))
    return merged.add_column(0, "range_no", pa.array([no] * merged.num_rows, pa.int32()))


def archive_and_index(pages: DataFrame, path: str) -> DataFrame:
    """Write all pages as WARC records under ``path``, read them back, and merge their index.

    A null html has an empty payload, a null url no target line and the key "", a null page_id
    no number. A page_id that repeats gives a record for each row; of equal payloads under one
    page_id that is the smallest, every such row is a response. An empty table gives no captures.
    Other columns are ignored.
    """
    for i, share in enumerate(record_shares(pages)):
        write_archives(share, path, more=i > 0)
        del share
        free()  # the share's payloads
    return merge_runs(staged(read_runs(pages.sparkSession, path), "capture-runs"))


def op4_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    """Captures of all pages, from the merged index of their archives."""
    from ..session import fresh_path

    index = archive_and_index(read(spark, folder, "pages"), fresh_path(spark, "warc"))
    return index.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
    )


ORACLE_SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
  from pages
), g as (
  select *, min(page_id) over (partition by payload_digest) as first from p
)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and first <> page_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and first <> page_id then first end as refers_to
from g
"""
