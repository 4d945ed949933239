"""Language-model scores of texts by prediction by partial matching, learned from the corpus.

The model is a trie of byte contexts: up to ORDER bytes before a symbol, where blanks stand for
the text's start, one blank ends every word, and one more the text. Contexts run over the ends
of words; where texts are taken as single words they stop there, blanks stand for the word's
start, and an end of text is a word of no bytes. The trie is held as counted paths (context and symbol, ORDER + 1 bytes) of a distributed
table. A symbol that a context hasn't seen is reached by an escape (method D: half a count of
every seen symbol) to the next shorter context, where the longer one's symbols are excluded.

Texts are cut to blocks of documents, each with its own dictionary: only the distinct words and
paths of a block are shuffled to the counts of the whole corpus and back, dealt to parts and in packed
runs: paths sorted by their context from its last byte on, a byte column after the other, compressed.
"""

from __future__ import annotations

import secrets
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, free, map_arrow, read, release_memory, ship, staged, sums_by, text_or_empty, word_codes

ORDER = 6
FOLDS, HELD_OUT = 7, 2
#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 24_000_000
#: Words of texts whose paths are made at once.
SLICE_WORDS = 400_000
BLANK = 0x20
#: Parts that paths are dealt to by the last two bytes of their context (and as many, numbered behind
#: them, for words by their checksum), and paths or words of a packed run.
PARTS, RUN_PATHS = 1024, 50_000
#: Bytes of text that are split to words at once.
PIECE_BYTES = 2_000_000
#: Paths that a task gathers before it adds up equal ones.
GATHERED = 2_000_000


# --- paths --------------------------------------------------------------------------------------


def paths_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All paths of the words as integers (ORDER context bytes, then the symbol), and how many each has."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    gap = b" " * ORDER
    # A word and the blank that ends it give a symbol each; the other blanks are only context.
    first = ORDER + np.cumsum(lengths + ORDER - 1) - (lengths + ORDER - 1)
    return _paths_at(gap + gap.join(words) + gap, first, lengths), lengths


def _paths_at(raw: bytes, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Paths of runs of symbols, from where each begins and how many it has."""
    # Eight bytes from each place on, of which a path has the first.
    spare = 7 - ORDER
    line = np.ndarray(len(raw) - ORDER, ">u8", raw + bytes(spare), strides=(1,))
    path = line.astype(np.int64) >> (8 * spare) & ((1 << 8 * (ORDER + 1)) - 1)
    at = np.repeat(first - (np.cumsum(lengths) - lengths) - ORDER, lengths) + np.arange(lengths.sum())
    return path[at]


def stream_paths(words: list[bytes], codes: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Paths of texts (``lengths`` words each, by their codes), their words joined by one blank.

    For slices of the texts: the first, the one after the last, the slice's distinct paths, the
    number of each of its symbols' path among them, and how many symbols each text has.
    """
    gap, ends = b" " * ORDER, np.cumsum(lengths)
    part = ends // SLICE_WORDS
    edge = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
    for a, b in zip(edge, [*edge[1:], len(lengths)], strict=True):
        texts = []
        for i in range(a, b):
            own = [words[c] for c in codes[ends[i] - lengths[i] : ends[i]].tolist()]
            # Every word is ended by a blank, and the text by one more.
            texts.append(gap + b" ".join([*own, b" "]))
        many = np.fromiter(map(len, texts), np.int64, len(texts)) - ORDER
        first = np.cumsum(many + ORDER) - many
        coded = pa.array(_paths_at(b"".join(texts), first, many)).dictionary_encode()
        yield int(a), int(b), coded.dictionary.to_numpy(), coded.indices.to_numpy(), many


END_PATH = int.from_bytes(b" " * (ORDER + 1), "big")


def turned(paths: np.ndarray) -> np.ndarray:
    """The paths with their context's bytes from the last to the first; turned twice they are as before."""
    out = paths & 0xFF
    for i in range(1, ORDER + 1):
        out = out | ((paths >> (8 * i)) & 0xFF) << (8 * (ORDER + 1 - i))
    return out


def dealt(paths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Part of each path, the turned paths, and the order by both."""
    keys = turned(paths)
    part = ((keys >> (8 * (ORDER - 1))) * 2654435761 >> 16) % PARTS
    return part, keys, np.lexsort((keys, part))


def pack(values: np.ndarray) -> bytes:
    """Numbers of 8 bytes, a byte column after the other, compressed; behind how many there are."""
    columns = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T)
    if not len(values):
        return bytes(8)
    return len(values).to_bytes(8, "little") + pa.compress(columns.tobytes(), "zstd", asbytes=True)


def unpack(raw: bytes, kind: type = np.int64) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    if not size:
        return np.zeros(0, kind)
    columns = np.frombuffer(pa.decompress(raw[8:], size * 8, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(columns.reshape(8, -1).T).reshape(-1).view(kind)


def pack_scores(scores: np.ndarray) -> bytes:
    """Scores by their distinct values, as many paths have the same."""
    values, place = np.unique(scores, return_inverse=True)
    first = pack(values)
    return len(first).to_bytes(8, "little") + first + pack(place.astype(np.int64))


def unpack_scores(raw: bytes) -> np.ndarray:
    end = 8 + int.from_bytes(raw[:8], "little")
    return unpack(raw[8:end], np.float64)[unpack(raw[end:])]


def pack_words(words: list[bytes]) -> bytes:
    """Words (which hold no blanks), compressed; behind their size."""
    raw = b" ".join(words)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack_words(raw: bytes) -> list[bytes]:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True).split(b" ")


def word_parts(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Part of each word, and the order by part and place."""
    part = PARTS + np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % PARTS
    return part, np.argsort(part, kind="stable")


def coded(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Code of each word of the texts in a row, the words by code, and how many words each text has.

    Texts are split a piece at a time: only the distinct words are held as words.
    """
    seen: dict[bytes, int] = {}
    codes, lengths = [np.zeros(0, np.int64)], []
    piece = np.cumsum([len(t) for t in texts]) // PIECE_BYTES
    edge = np.flatnonzero(np.append(True, piece[1:] != piece[:-1])) if len(piece) else []
    for a, b in zip(edge, [*edge[1:], len(texts)], strict=False):
        lists = [t.lower().split() for t in texts[a:b]]
        lengths += map(len, lists)
        own, distinct = word_codes([w for x in lists for w in x])
        codes.append(np.array([seen.setdefault(w, len(seen)) for w in distinct.to_pylist()], np.int64)[own])
    return np.concatenate(codes), list(seen), np.array(lengths, np.int64)


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of all runs, sorted, and the sums of their counts."""
    every, each = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, each = every[order], each[order]
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    return every[first], np.add.reduceat(each, first)


def scores_of(paths: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """The score of each path; ``scores`` has those of the distinct paths in the order of ``dealt``."""
    found = pa.array(paths).dictionary_encode()
    own = np.zeros(len(found.dictionary))
    own[dealt(found.dictionary.to_numpy())[2]] = scores
    return own[found.indices.to_numpy()]


# --- the model ----------------------------------------------------------------------------------


def path_scores(paths: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 probability of each path's symbol after its context.

    ``paths`` must hold every counted path whose last two context bytes occur in it; ``pairs``
    (256 x 256) has the counts of symbols after a single byte, for the shortest contexts.
    """
    n = len(paths)
    score, open_ = np.zeros(n), np.ones(n, bool)
    symbol = paths & 0xFF
    longer = None  # of the order above: context number per path, symbols seen, (context, symbol) rows
    for order in range(ORDER, -1, -1):
        if order >= 2:
            key = paths & ((1 << (8 * (order + 1))) - 1)
            keys, number = np.unique(key, return_inverse=True)
            c = np.bincount(number, counts, len(keys))
            contexts, context = np.unique(keys >> 8, return_inverse=True)
            total = np.bincount(context, c, len(contexts))
            seen = np.bincount(context, c > 0, len(contexts))
            own_c, own_context, own_total, own_seen = c[number], context[number], total[context][number], seen[context][number]
            below = keys  # its suffix is the row of the next order
        else:
            table = pairs if order == 1 else pairs.sum(axis=0)[None, :]
            row = (paths >> 8) & 0xFF if order == 1 else np.zeros(n, np.int64)
            total, seen = table.sum(axis=1), (table > 0).sum(axis=1)
            own_c, own_context, own_total, own_seen = table[row, symbol], row, total[row], seen[row]
            contexts, c, context, below = np.arange(len(table)), table.ravel(), np.repeat(np.arange(len(table)), 256), None
        if longer is not None:
            # Exclude what the longer context has seen: those symbols' counts, and their number.
            up_contexts, up_context_of_row, up_keys, up_c, up_seen, up_own = longer
            if up_keys is None:  # order 1 above order 0
                here = np.where(up_c.reshape(256, 256) > 0, table, 0).sum(axis=1)
            else:
                if order >= 2:
                    at = np.searchsorted(keys, up_keys & ((1 << (8 * (order + 1))) - 1))
                    value = c[at]
                else:
                    value = table[(up_keys >> 8) & 0xFF if order == 1 else 0, up_keys & 0xFF]
                here = np.bincount(up_context_of_row, np.where(up_c > 0, value, 0), len(up_contexts))
            own_total = own_total - here[up_own]
            own_seen = own_seen - up_seen[up_own]
        some = open_ & (own_seen > 0)
        hit = some & (own_c > 0)
        score[hit] += np.log10((own_c[hit] - 0.5) / own_total[hit])
        miss = some & ~hit
        score[miss] += np.log10(0.5 * own_seen[miss] / own_total[miss])
        open_ &= ~hit
        longer = (contexts, context, below, c, seen, own_context)
    unseen = 256 - (pairs.sum(axis=0) > 0).sum()
    score[open_] -= np.log10(max(1, unseen))
    return score


# --- jobs ---------------------------------------------------------------------------------------


def runs_of(part: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs of up to RUN_PATHS equal (sorted) parts: begin, end, and the run's number in its part."""
    edge = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
    for a, b in zip(edge, [*edge[1:], len(part)], strict=False):  # without parts there is no run
        for no, at in enumerate(range(a, b, RUN_PATHS)):
            yield at, min(b, at + RUN_PATHS), no


def _blocks(docs: DataFrame, over_words: bool) -> DataFrame:
    """Documents as word codes, and the dictionary of their block, in one staged table.

    Rows of documents have ``codes``. Rows with a ``part`` have a run of the block's distinct paths or
    words (number ``code`` of the part) and their ``counts`` in the block's training documents. Rows
    with ``words`` alone have the words of codes from RUN_PATHS * ``code`` on; rows with only ``code``
    and ``n`` count the symbol code % 256 after the byte code // 256.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = pa.schema(
        [("block", pa.int64()), ("held_out", pa.bool_()), ("codes", pa.binary()), ("code", pa.int32()), ("n", pa.int64()),
         ("part", pa.int32()), ("paths", pa.binary()), ("counts", pa.binary()), ("words", pa.binary())]
    )

    def block(ids: pa.Array, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        number = secrets.randbits(62)
        codes, words, lengths = coded(texts)
        held = np.array([crc_mod(i, FOLDS) == HELD_OUT for i in ids.to_pylist()], bool)
        counts = np.bincount(codes[np.repeat(~held, lengths)], minlength=len(words))
        packed = [pack(x) for x in np.split(codes, np.cumsum(lengths)[:-1])]
        yield from rows(number, len(texts), ids=ids, held_out=pa.array(held), codes=pa.array(packed, pa.binary()))
        names = [pack_words(words[a : a + RUN_PATHS]) for a in range(0, len(words), RUN_PATHS)]
        yield from rows(number, len(names), code=pa.array(range(len(names)), pa.int32()), words=pa.array(names, pa.binary()))
        own: dict[str, list] = {"code": [], "part": [], "words": [], "counts": []}
        part, order = word_parts(words)
        for a, b, run_no in runs_of(part[order]):
            own["code"].append(run_no)
            own["part"].append(part[order[a]])
            own["words"].append(pack_words([words[i] for i in order[a:b].tolist()]))
            own["counts"].append(pack(counts[order[a:b]].astype(np.int64)))
        yield from rows(number, len(own["part"]), **{c: pa.array(v, schema.field(c).type) for c, v in own.items()})
        if over_words:
            gathered, weights, size, least = [], [], 0, GATHERED
            for a, b, own_paths, place, many in stream_paths(words, codes, lengths):
                order = np.argsort(own_paths)  # sorted runs are added up the fastest
                gathered.append(own_paths[order])
                weights.append(np.bincount(place, np.repeat(~held[a:b], many), len(own_paths)).astype(np.int64)[order])
                size += len(own_paths)
                if size > least:
                    path, weight = summed(gathered, weights)
                    gathered, weights, size, least = [path], [weight], len(path), 2 * len(path) + GATHERED
        else:
            path, many = paths_of(words) if words else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            gathered = [path, np.array([END_PATH])]
            weights = [np.repeat(counts, many).astype(np.int64), np.array([(~held).sum()])]
        paths, n = summed(gathered, weights)
        pairs = np.bincount(paths & 0xFFFF, n, 1 << 16).astype(np.int64)
        seen = np.flatnonzero(pairs)
        yield from rows(number, len(seen), code=pa.array(seen.astype(np.int32)), n=pa.array(pairs[seen]))
        part, turn, order = dealt(paths)
        part, turn, n = part[order], turn[order], n[order]
        own = {"code": [], "part": [], "paths": [], "counts": []}
        for a, b, run_no in runs_of(part):
            own["code"].append(run_no)
            own["part"].append(part[a])
            own["paths"].append(pack(turn[a:b]))
            own["counts"].append(pack(n[a:b]))
        yield from rows(number, len(own["part"]), **{c: pa.array(v, schema.field(c).type) for c, v in own.items()})

    def rows(number: int, size: int, ids: pa.Array | None = None, **own: pa.Array) -> Iterator[pa.RecordBatch]:
        columns = {"block": pa.array(np.full(size, number)), **own}
        arrays = [columns.get(f.name, pa.nulls(size, f.type)) for f in schema]
        table = pa.Table.from_arrays([ids if ids is not None else pa.nulls(size, id_type[0]), *arrays], names=["doc_id", *schema.names])
        yield from table.to_batches(max_chunksize=2_000 if "part" in own else 20_000)

    id_type: list = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            id_type[:] = [batch.schema.field(0).type]
            sizes = np.fromiter((len(t) for t in batch.column(1).to_pylist()), np.int64, batch.num_rows)
            a = 0
            while a < batch.num_rows:
                b = a + max(1, int(np.searchsorted(np.cumsum(sizes[a:]), BLOCK_BYTES - size, side="right")))
                part = batch.slice(a, b - a)
                ids.append(part.column(0))
                texts += part.column(1).to_pylist()
                size, a = size + int(sizes[a:b].sum()), b
                if size >= BLOCK_BYTES or a < batch.num_rows:
                    yield from block(pa.concat_arrays(ids), texts)
                    ids, texts, size = [], [], 0
        if texts:
            yield from block(pa.concat_arrays(ids), texts)

    source = docs.select("doc_id", text_or_empty().cast("binary").alias("text"))
    fields = "block bigint, held_out boolean, codes binary, code int, n bigint, part int, paths binary, counts binary, words binary"
    return staged(map_arrow(source, run, f"doc_id {kind}, {fields}"), "lm-blocks")


def score_texts(docs: DataFrame, over_words: bool = False) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of whole texts.

    Learns from documents whose crc32(doc_id as text) mod 7 is not 2 (a null id counts as the
    empty text). A null, empty or blank text is one token, its end; repeated rows count and are
    scored each; other columns are ignored; an empty table has no scores. ``base_score`` is the
    add-one word model, ``score`` the byte-context model, both log10 of the text's probability.
    With ``over_words`` its contexts run over the ends of words, else they stop there.
    """
    spark = docs.sparkSession
    ship(spark)
    blocks = _blocks(docs, over_words)
    runs = blocks.where("part is not null").select("block", "part", F.col("code").alias("no"), "paths", "words", "counts")
    texts = blocks.where("codes is not null").agg(F.count_if(~F.col("held_out")), F.count_distinct("block")).first()
    trained, tasks = texts[0], min(PARTS, max(24, 2 * texts[1]))

    # Symbols after one byte: 256 x 256 sums at most, whatever the corpus.
    pairs = np.zeros((256, 256))
    of_pairs = blocks.where("n is not null")
    for r in of_pairs.groupBy("code").agg(F.sum("n").alias("n")).collect():
        pairs[r.code >> 8, r.code & 0xFF] = r.n
    shared = spark.sparkContext.broadcast(pairs)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds up the blocks' runs of each part: (part, run of paths, their scores), (part, words, their counts)."""
        held, gathered, counts, size, least = None, [], [], 0, GATHERED
        of_words: dict[bytes, int] = {}

        def row(paths: bytes | None, words: bytes | None, scores: bytes, total: int = 0, known: int = 0) -> pa.RecordBatch:
            values = [(held, pa.int32()), (paths, pa.binary()), (words, pa.binary()), (scores, pa.binary()), (total, pa.int64()), (known, pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in values], ["part", "paths", "words", "scores", "total", "known"])

        def done() -> Iterator[pa.RecordBatch]:
            if gathered:
                key, n = summed(gathered, counts)
                value = path_scores(turned(key), n.astype(float), shared.value)
                for a in range(0, len(key), RUN_PATHS):
                    yield row(pack(key[a : a + RUN_PATHS]), None, pack_scores(value[a : a + RUN_PATHS]))
            names, n = list(of_words), np.fromiter(of_words.values(), np.int64, len(of_words))
            for a in range(0, len(names), RUN_PATHS):
                own = n[a : a + RUN_PATHS]
                yield row(None, pack_words(names[a : a + RUN_PATHS]), pack(own), int(own.sum()), int((own > 0).sum()))

        for batch in batches:
            for part, paths, words, own in zip(*(batch.column(i) for i in range(4)), strict=True):
                if part.as_py() != held:
                    yield from done()
                    held, gathered, counts, size, least, of_words = part.as_py(), [], [], 0, GATHERED, {}
                if words.is_valid:
                    for w, n in zip(unpack_words(words.as_py()), unpack(own.as_py()).tolist(), strict=True):
                        of_words[w] = of_words.get(w, 0) + n
                    continue
                gathered.append(unpack(paths.as_py()))
                counts.append(unpack(own.as_py()))
                size += len(gathered[-1])
                if size > least:
                    key, n = summed(gathered, counts)
                    gathered, counts, size, least = [key], [n], len(key), 2 * len(key) + GATHERED
        yield from done()

    # A task has whole subtries: all paths whose context ends with the same two bytes.
    together = runs.select("part", "paths", "words", "counts").repartition(tasks, "part").sortWithinPartitions("part")
    trie = staged(map_arrow(together, score, "part int, paths binary, words binary, scores binary, total bigint, known bigint"), "lm-trie")
    free()  # the runs that were dealt for it
    known = trie.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    tokens, distinct = known[0] + trained, known[1] + (trained > 0)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Scores or counts of each run of a block: the rows of its whole part come first."""
        held, key, value, of_words, sorted_ = None, [], [], {}, False
        for batch in batches:
            for part, block, no, paths, words, scores in zip(*(batch.column(i) for i in range(6)), strict=True):
                if part.as_py() != held:
                    held, key, value, of_words, sorted_ = part.as_py(), [], [], {}, False
                if not block.is_valid:
                    if words.is_valid:
                        of_words |= zip(unpack_words(words.as_py()), unpack(scores.as_py()).tolist(), strict=True)
                    else:
                        key.append(unpack(paths.as_py()))
                        value.append(unpack_scores(scores.as_py()))
                    continue
                if words.is_valid:
                    names = unpack_words(words.as_py())
                    own = pack(np.fromiter((of_words[w] for w in names), np.int64, len(names)))
                else:
                    if not sorted_:
                        key, value, sorted_ = np.concatenate(key), np.concatenate(value), True
                        order = np.argsort(key, kind="stable")
                        key, value = key[order], value[order]
                    own = pack_scores(value[np.searchsorted(key, unpack(paths.as_py()))])
                arrays = [pa.array([block.as_py()]), pa.array([held], pa.int32()), pa.array([no.as_py()], pa.int32()), pa.array([own])]
                yield pa.RecordBatch.from_arrays(arrays, ["of_block", "part", "no", "scores"])

    of_blocks = runs.select("part", "block", "no", "paths", "words", F.lit(None).cast("binary").alias("scores"))
    of_trie = trie.select("part", F.lit(None).cast("long").alias("block"), F.lit(None).cast("int").alias("no"), "paths", "words", "scores")
    met = of_trie.unionByName(of_blocks).repartition(tasks, "part").sortWithinPartitions("part", F.col("block").asc_nulls_first())
    found = map_arrow(met, find, "of_block bigint, part int, no int, scores binary")

    total = np.log10(float(tokens + distinct + 1))
    ends = (trained, np.log10(trained + 1.0) - total)

    def finish(texts: pa.Table, values: pa.Table) -> pa.Table:
        of_names = texts.column("words").combine_chunks().is_valid()
        names = [w for x in texts.filter(of_names).sort_by("code").column("words").to_pylist() for w in unpack_words(x)]
        texts = texts.filter(pc.invert(of_names))
        values = values.sort_by([("part", "ascending"), ("no", "ascending")])
        runs = list(zip(values.column("part").to_pylist(), values.column("scores").to_pylist(), strict=True))
        of_runs = np.concatenate([unpack_scores(x) for part, x in runs if part < PARTS])
        del values
        word_count = np.zeros(len(names), np.int64)
        word_count[word_parts(names)[1]] = np.concatenate([np.zeros(0, np.int64), *(unpack(x) for part, x in runs if part >= PARTS)])
        packed = [unpack(x) for x in texts.column("codes").to_pylist()]
        lengths = np.fromiter(map(len, packed), np.int64, len(packed))
        codes = np.concatenate(packed)
        del packed, runs
        base = sums_by((np.log10(word_count + 1.0) - total)[codes], lengths) + ends[1]
        n_known = sums_by((word_count > 0)[codes].astype(np.int64), lengths) + (ends[0] > 0)
        # The block's paths are made again, in the order in which their scores were sent.
        if over_words:
            slices, owns = [], []
            for a, b, own, place, many in stream_paths(names, codes, lengths):
                slices.append((a, b, len(own), place.astype(np.int32, copy=False), many))
                owns.append(own)
            del names, codes
            owns = np.concatenate(owns)
            release_memory()
            value = scores_of(owns, of_runs)
            del owns
            full, at = np.zeros(len(lengths)), 0
            for a, b, size, place, many in slices:
                full[a:b] = sums_by(value[at : at + size][place], many)
                at += size
            del slices, value
        else:
            every, many = paths_of(names) if names else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            value = scores_of(np.append(every, END_PATH), of_runs)
            full = sums_by(sums_by(value[:-1], many)[codes], lengths) + value[-1]
        release_memory()
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "held_out": texts.column("held_out"),
                "n_tokens": lengths + 1,
                "n_known": n_known,
                "train_tokens": np.full(len(lengths), tokens),
                "base_score": base,
                "score": full,
            }
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = blocks.where("part is null and n is null").select("block", "doc_id", "held_out", "codes", "code", "words")
    result = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return texts.groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(finish, result)


def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of every document under the word model and the byte-context model."""
    return score_texts(read(spark, folder, "documents"), over_words=True)
