"""Corpus operators against brute force, the tokenizer's library, and hand-made edge cases."""

import collections
import hashlib
import math
import random
import re

import check
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lendlake.llm import common, decontaminate, lm_scoring, minhash_dedup, mixing, quality, queries, suffix_dedup, token_counts, topk, toxicity, warc_index
from lendlake.llm.common import crc_mod, read

EDGES = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (6, "éß 日本 \U0001f600"), (7, "word " * 3000), (None, "no id"), (8, "a" * 3000)]


@pytest.fixture(scope="module")
def edge(spark):
    """Null and empty texts, a null id, repeated rows, a long text; clashing extra columns."""
    rows = [(i, t, "x", None if i == 4 else "s", 0, 1) for i, t in EDGES + EDGES[3:4]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, label int").withColumnsRenamed({"label": "row"})


@pytest.fixture(scope="module")
def texts(spark, folder):
    return {r.doc_id: r.text or "" for r in read(spark, folder, "documents").collect()}


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_matches_sql(spark, folder, name):
    assert check.compare(queries.QUERIES[name](spark, folder), check.connect(folder), queries.CHECKS[name]) is None


# --- token counts -------------------------------------------------------------------------------


def test_token_counts_equal_the_library(spark, folder, texts, edge):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    for r in queries.QUERIES["op1_token_counts"](spark, folder).collect():
        assert (r.n_tokens, r.n_bytes) == (len(model.encode(texts[r.doc_id])), len(texts[r.doc_id].encode()))
    got = sorted((r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(edge).collect())
    want = sorted((len((t or "").encode()), len(model.encode(t or ""))) for _, t in EDGES + EDGES[3:4])
    assert got == want
    assert token_counts.count_tokens(edge.limit(0)).count() == 0
    merges, rng = token_counts.merges_of(public_tokenizers.path(token_counts.MODEL)), random.Random(1)
    for n in (1, 2, 7, 40, 300, 2000):
        for _ in range(40):
            t = "".join(rng.choices("ab cdeth er▁▁  \n\t\x00éñö日①xX<s>0A\U0001f600'\".", k=n))
            assert int(merges.count(token_counts.pre_tokens(t)).sum()) == len(model.encode(t)), t


# --- toxicity and quality -----------------------------------------------------------------------


def held_out_accuracy(df, labels, column):
    marks = {r.doc_id: r[column] for r in labels.collect()}
    rows = [(r.predicted, marks[r.doc_id]) for r in df.where("held_out").collect() if r.doc_id in marks]
    return sum(a == b for a, b in rows) / len(rows)


def test_quality_of_held_out_rows(spark, edge):
    d = "/root/testdata/sf0.01"
    docs, labels = read(spark, d, "documents"), read(spark, d, "labels")
    assert held_out_accuracy(quality.classify_quality(docs, labels), labels, "quality") > 0.95
    got = quality.classify_quality(edge, labels).collect()
    assert len(got) == len(EDGES) + 1 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (1, 2, 3)} == {0.0}
    assert quality.classify_quality(edge.limit(0), labels.limit(0)).count() == 0
    assert {r.score for r in quality.classify_quality(edge, labels.limit(0)).collect()} == {0.0, 0.5}
    assert quality.keep_good(edge, labels).columns == edge.columns


def test_votes_equal_a_plain_version(spark, folder):
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    voters = quality.train(docs, labels)
    rows = docs.select("doc_id", "text").collect()
    got = {r.doc_id: r.score for r in quality.classify_quality(docs, labels).collect()}
    for r in rows[::3]:
        counts = quality.term_counts(pa.array([r.text], pa.string()))
        if not (r.text or "").split():
            assert got[r.doc_id] == 0
            continue
        vector = voters.project(counts)[0].astype(float)
        cosines = [(float(sum(x * y for x, y in zip(vector, v.astype(float), strict=True))), label) for v, label in zip(voters.vectors, voters.labels, strict=True)]
        near = sorted(cosines, key=lambda c: -c[0])[: quality.NEIGHBOURS + 1]
        if abs(near[quality.NEIGHBOURS - 1][0] - near[-1][0]) < 1e-6:
            continue  # a tie at the last place, decided by rounding
        votes = [(max(c, 0.0) ** quality.POWER + 1e-9, label) for c, label in near[: quality.NEIGHBOURS]]
        assert got[r.doc_id] == pytest.approx(sum(w * y for w, y in votes) / sum(w for w, _ in votes), abs=1e-4)


def test_words_are_terms():
    counts = quality.term_counts(pa.array(["the river runs past the old stone mill at dawn", "win cash now click here the free pills best deal", "The RIVER", None]))
    assert (counts[0, quality.SHAPES :] != counts[1, quality.SHAPES :]).any()
    assert counts[0, quality.SHAPES :].sum() == counts[1, quality.SHAPES :].sum() == 10
    assert counts[2, quality.SHAPES :].sum() == 2 and (counts[0, quality.SHAPES :][counts[2, quality.SHAPES :] > 0] > 0).all()
    assert not counts[3].any()


def test_toxicity_chain(spark, edge):
    rng = np.random.default_rng(0)
    plain = [f"plain{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(plain, 20)) + (" nasty" * (i % 4 == 0)) + (" threatening" * (i % 8 == 0))) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0), int(i % 4 == 0)) for i in range(800)], "doc_id long, threat int, toxic int")
    chain = toxicity.train_chain(docs, labels, ["threat", "toxic"])
    assert len(chain.models[1].earlier) == 1  # the later model reads the earlier category
    for r in toxicity.predict_toxicity(docs, chain).collect():
        assert (r.predicted, r.p_threat >= 0.5) == (int(r.doc_id % 4 == 0), r.doc_id % 8 == 0)
    got = toxicity.predict_toxicity(edge, chain).collect()
    assert {r.score for r in got if r.doc_id in (1, 2, 3)} == {0.0} and len(got) == len(EDGES) + 1
    assert toxicity.predict_toxicity(edge.limit(0), toxicity.train_chain(docs.limit(0), labels, ["toxic"])).count() == 0


# --- language model -----------------------------------------------------------------------------


def plain_ppm(counts, ends):
    """The same model by dictionaries, a byte at a time."""
    k, tab = lm_scoring.ORDER, [collections.defaultdict(collections.Counter) for _ in range(lm_scoring.ORDER + 1)]

    def add(s, n):
        for j in range(k, len(s)):
            for o in range(k + 1):
                tab[o][s[j - o : j]][s[j]] += n

    for w, n in counts.items():
        add(b" " * k + w + b" ", n)
    add(b" " * (k + 1), ends)

    def score(w):
        s, total = b" " * k + w + b" ", 0.0
        for j in range(k, len(s)):
            out = set()
            for o in range(k, -1, -1):
                seen = {a: n for a, n in tab[o].get(s[j - o : j], {}).items() if n}
                left = {a: n for a, n in seen.items() if a not in out}
                out |= set(seen)
                if s[j] in left:
                    total += math.log10((left[s[j]] - 0.5) / sum(left.values()))
                    break
                if left:
                    total += math.log10(0.5 * len(left) / sum(left.values()))
            else:
                total -= math.log10(256 - len(out))
        return total

    return score


def test_lm_scores(spark, folder, texts, edge):
    def expect(rows):
        counts, ends = collections.Counter(), 0
        for i, t in rows:
            if crc_mod(i, 7) != 2:
                counts.update((t or "").encode().lower().split())
                ends += 1
        n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
        ppm = plain_ppm(counts, ends)
        out = []
        for i, t in rows:
            words = (t or "").encode().lower().split()
            base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((ends + 1) / (n + v + 1))
            out.append((i, crc_mod(i, 7) == 2, len(words) + 1, sum(counts[w] > 0 for w in words) + (ends > 0), n, base, sum(map(ppm, words)) + ppm(b"")))
        return out

    some = {i: t for i, t in texts.items() if i < 60}
    docs = read(spark, folder, "documents").where("doc_id < 60")
    for df, rows in ((docs, list(some.items())), (edge, EDGES + EDGES[3:4])):
        key = lambda r: (str(r[0]), r[2], round(r[5], 6))
        got = sorted((tuple(r) for r in lm_scoring.score_texts(df).collect()), key=key)
        want = sorted(expect(rows), key=key)
        assert [g[:5] for g in got] == [w[:5] for w in want]
        for g, w in zip(got, want, strict=True):
            assert g[5] == pytest.approx(w[5]) and g[6] == pytest.approx(w[6])
    assert lm_scoring.score_texts(edge.limit(0)).count() == 0


def test_lm_contexts_run_over_word_ends(spark, folder, texts, edge, monkeypatch):
    streams = lambda t: b"".join(w + b" " for w in (t or "").encode().lower().split())
    some = [(i, t) for i, t in texts.items() if i < 40]
    docs = read(spark, folder, "documents").where("doc_id < 40")
    for df, rows in ((docs, some), (edge, EDGES + EDGES[3:4])):
        learned = [streams(t) for i, t in rows if crc_mod(i, 7) != 2]
        ppm = plain_ppm(collections.Counter(x for x in learned if x), sum(not x for x in learned))
        want = sorted((str(i), round(ppm(streams(t)), 6)) for i, t in rows)
        got = sorted((str(r.doc_id), round(r.score, 6)) for r in lm_scoring.score_texts(df, over_words=True).collect())
        assert [g[0] for g in got] == [w[0] for w in want]
        assert [g[1] for g in got] == pytest.approx([w[1] for w in want], abs=1e-5)
    assert lm_scoring.score_texts(edge.limit(0), over_words=True).count() == 0
    assert lm_scoring.ORDER >= 6
    rows = [(i, "red cat. " * 5 if i % 2 else "old dog. " * 5) for i in range(40)] + [(100, "red cat."), (101, "red dog.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    score = {r.doc_id: r.score for r in lm_scoring.score_texts(df, over_words=True).collect() if r.doc_id >= 100}
    assert score[100] > score[101] + 1  # the word before tells the next one
    words, codes, lengths = [b"a", b"bc"], np.array([0, 1, 1, 0, 0, 1]), np.array([2, 0, 3, 1])
    whole = [(own[place].tolist(), many.tolist()) for _, _, own, place, many in lm_scoring.stream_paths(words, codes, lengths)]
    monkeypatch.setattr(lm_scoring, "SLICE_WORDS", 2)
    parts = [(own[place].tolist(), many.tolist()) for _, _, own, place, many in lm_scoring.stream_paths(words, codes, lengths)]
    assert len(whole) == 1 and len(parts) > 2 and whole[0] == (sum((p for p, _ in parts), []), sum((m for _, m in parts), []))


def test_lm_paths_travel_in_runs(spark, folder, texts, monkeypatch):
    some = read(spark, folder, "documents").where("doc_id < 60")
    blocks = lm_scoring._blocks(some, True).where("part is not null").collect()
    paths = [lm_scoring.unpack(r.paths) for r in blocks if r.paths is not None]
    words = [w for r in blocks if r.words is not None for w in lm_scoring.unpack_words(r.words)]
    assert sum(len(r.paths) + len(r.counts) for r in blocks if r.paths is not None) < 9 * sum(map(len, paths))  # one path: 16 bytes plain
    assert len(words) >= len({w for i, t in texts.items() if i < 60 for w in (t or "").encode().lower().split()})
    for values in (np.array([], np.int64), np.array([5, -(2**60), 7]), np.array([0.5, -1.25, 0.5])):
        assert lm_scoring.unpack(lm_scoring.pack(values), values.dtype).tolist() == values.tolist()
    assert lm_scoring.unpack_scores(lm_scoring.pack_scores(np.array([0.5, -1.25, 0.5]))).tolist() == [0.5, -1.25, 0.5]
    turned = lm_scoring.turned(np.concatenate(paths))
    assert (lm_scoring.turned(turned) == np.concatenate(paths)).all()
    assert (lm_scoring.dealt(turned)[0] == [r.part for r in blocks if r.paths is not None for _ in lm_scoring.unpack(r.paths)]).all()
    monkeypatch.setattr(lm_scoring, "PIECE_BYTES", 6)  # pieces share one dictionary
    codes, names, lengths = lm_scoring.coded([b"a B a", b"", b"c b", b" ", b"a dd dd c"])
    assert [names[c] for c in codes] == [b"a", b"b", b"a", b"c", b"b", b"a", b"dd", b"dd", b"c"]
    assert (names, lengths.tolist()) == ([b"a", b"b", b"c", b"dd"], [3, 0, 2, 0, 4])
    keys, sums = lm_scoring.summed([np.array([3, 9]), np.array([9, 1])], [np.array([1, 2]), np.array([4, 0])])
    assert (keys.tolist(), sums.tolist()) == ([1, 3, 9], [0, 1, 6])


# --- archives -----------------------------------------------------------------------------------


def test_archives(spark, tmp_path):
    long = "<p>" + "x" * 200
    rows = [(1, "http://a.b/c", long), (2, "http://a.b/c", long), (3, None, "short"), (4, "HTTP://B.a/%\r\n", "short"), (5, "u", None), (None, "u", "é\r\n\r\n" * 60), (2, "http://q", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as row", "url as archive")
    got = warc_index.archive_and_index(pages, str(tmp_path / "warc")).collect()
    assert len(got) == len(rows)
    assert sorted((r.page_id, r.refers_to) for r in got if r.record_type == "revisit") == [(2, 1), (2, 1)]
    assert {r.url for r in got} == {r[1] for r in rows}
    for r in got:
        assert r.payload_digest in {hashlib.sha256((x[2] or "").encode()).hexdigest() for x in rows if x[0] == r.page_id}
    keys = [warc_index.capture_key(r[2:]) for r in sorted(got, key=lambda r: (r.range_no, r.rank))]
    assert keys == sorted(keys)
    assert warc_index.archive_and_index(pages.limit(0), str(tmp_path / "none")).count() == 0


def test_shares_of_archives(spark, tmp_path, monkeypatch):
    rows = [(i if i % 9 else None, f"http://h{i % 7}.x/{i}", f"<p>{i % 40}" + "y" * 150 if i % 5 else None) for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    shares = list(warc_index.record_shares(pages, archive_bytes=2_000))
    assert len(shares) == warc_index.SHARES
    parts = [{r.url for r in x.collect()} for x in shares]
    assert all(parts) and sum(map(len, parts)) == 400 and set.union(*parts) == {r[1] for r in rows}  # every page in one share
    key = lambda r: (r.url, r.page_id, r.payload_digest, r.refers_to, r.record_type)
    whole = sorted(map(key, warc_index.archive_and_index(pages, str(tmp_path / "one")).collect()), key=str)
    monkeypatch.setattr(warc_index.record_shares, "__defaults__", (warc_index.LEAST_REVISIT, 2_000, 3))
    assert sorted(map(key, warc_index.archive_and_index(pages, str(tmp_path / "three")).collect()), key=str) == whole
    assert any(r[3] is not None for r in whole) and len(list((tmp_path / "three").glob("*.txt"))) > len(list((tmp_path / "one").glob("*.txt")))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        warc_index.archive_and_index(pages, str(tmp_path / "one"))


def test_merge_in_many_ranges(spark, folder, tmp_path):
    warc_index.write_archives(warc_index.with_records(read(spark, folder, "pages"), archive_bytes=20_000), str(tmp_path / "w"))
    got = warc_index.merge_runs(warc_index.read_runs(spark, str(tmp_path / "w")), 8).collect()
    keys = [warc_index.capture_key(r[2:]) for r in sorted(got, key=lambda r: (r.range_no, r.rank))]
    assert keys == sorted(keys) and len({r.range_no for r in got}) > 3


# --- duplicates ---------------------------------------------------------------------------------


def plain_components(rows, words, percent=80):
    sets, parent = {}, {i: i for i, _ in rows}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + words]) for j in range(max(1, len(w) - words + 1))} if w else set()

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j]) if i < j else 0
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_differing_registers_never_part_linked_sets():
    rng = np.random.default_rng(5)
    for size in (1, 4, 5, 9, 40, 300, 2000):
        base = rng.integers(0, 2**63, size, dtype=np.uint64)
        for _ in range(40):
            kept = base[rng.random(size) > rng.random() * 0.3]
            other = np.concatenate([kept, rng.integers(0, 2**63, rng.integers(0, size // 5 + 2), dtype=np.uint64)])
            x, y = np.unique(base), np.unique(other)
            both = len(np.intersect1d(x, y))
            a, b = (minhash_dedup.sketches(v, np.array([len(v)])) for v in (x, y))
            if 100 * both >= 80 * (len(x) + len(y) - both):
                assert minhash_dedup.may_link(a, b, np.array([len(x)]), np.array([len(y)]), 80)[0]
    strangers = [np.unique(rng.integers(0, 2**63, 20, dtype=np.uint64)) for _ in range(2)]
    a, b = (minhash_dedup.sketches(v, np.array([len(v)])) for v in strangers)
    assert not minhash_dedup.may_link(a, b, np.array([20]), np.array([20]), 80)[0]


def test_estimates_far_below_the_threshold_are_verified(spark):
    rng = np.random.default_rng(11)
    one = rng.integers(1, 2**32, minhash_dedup.REGISTERS, dtype=np.uint32)
    other = one.copy()
    other[-95:] = rng.integers(1, 2**32, 95, dtype=np.uint32)  # 193 of 288 agree: 5.5 standard errors below 0.8
    rows = [(1, 2000, bytearray(one.tobytes())), (2, 2000, bytearray(other.tobytes()))]
    classes = spark.createDataFrame(rows, "id long, n long, registers binary")
    met = spark.createDataFrame([(7, 0, i, i, 2) for i in (1, 2)], "band long, no byte, id long, component long, _n long")
    assert [tuple(r) for r in minhash_dedup._open_pairs(met, classes, 80).collect()] == [(2, 1)]


def test_near_duplicates(spark, folder, texts, edge):
    for r in queries.QUERIES["op5_minhash_dedup"](spark, folder).collect():
        want = test_near_duplicates.__dict__.setdefault("want", plain_components(list(texts.items()), 2))
        assert (r.n_shingles, r.component_id) == want[r.doc_id]
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(150):  # many copies at and around the threshold, of which few link directly
        own = list(base)
        for _ in range(rng.choice([0, 3, 6, 7, 8, 12])):
            own[rng.randrange(len(own))] = f"z{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    want = plain_components(rows, 2)
    got = minhash_dedup.link_documents(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    got = minhash_dedup.near_duplicates(edge).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, None: None, 8: 8}
    assert minhash_dedup.near_duplicates(edge.limit(0)).count() == 0
    assert sorted(r.doc_id or 0 for r in minhash_dedup.drop_near_duplicates(edge).collect()) == [0, 1, 2, 3, 4, 6, 7, 8]


def test_one_id_on_several_texts(spark):
    rng = random.Random(12)
    one, other, alone = ([f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(3))
    near = [*one[:30], "changed", *one[31:]]
    rows = [(1, " ".join(one)), (7, " ".join(near)), (7, " ".join(other)), (9, " ".join([*other[:30], "x", *other[31:]])), (7, " ".join(alone))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.component_id) for r in minhash_dedup.link_documents(docs, 2).collect())
    assert found == [(1, 1), (7, 1), (7, 7), (7, 7), (9, 7)]
    kept = sorted((r.doc_id, r.text) for r in minhash_dedup.drop_near_duplicates(docs, 2).collect())
    assert kept == sorted([rows[0], rows[2], rows[4]])


def test_stages_keep_columns_of_any_name(spark, folder):
    import corpus_pipeline

    columns = ["doc_id", "text", "lang", "source", "n_chars", "_row", "a.b", "x y", "text_hash", "component", "shard", "bl`ock"]
    rows = [(i, f"w{i} " * 40 + "some plain words of a text", "en", "s", 0, 1, 2, 3, 4, 5, 6, 7) for i in range(4)]
    docs = spark.createDataFrame(rows, columns)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, folder)
        assert got.columns == columns, name
        assert all(tuple(r)[5:] == (1, 2, 3, 4, 5, 6, 7) for r in got.collect()), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 4


# --- repeated strings ---------------------------------------------------------------------------


def plain_removal(text, count, length=400):
    spans = []
    for i in range(len(text) - length + 1):
        if count[text[i : i + length]] > 1:
            if spans and i <= spans[-1][1]:
                spans[-1][1] = i + length
            else:
                spans.append([i, i + length])
    kept = b"".join(text[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(text)], strict=True))
    return len(text), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("most", [suffix_dedup.MOST_TYPES, 3])
def test_repeated_strings(spark, edge, most):
    rng = random.Random(2)
    base = ["".join(rng.choices("abcdefgh ", k=900)) for _ in range(3)]
    rows = [(i, t) for i, t in EDGES if i is not None] + [(100, "a" * 400), (101, "ab" * 700)]
    for i in range(200, 320):
        b, a, e = rng.choice(base), rng.randint(0, 450), rng.randint(800, 900)
        rows.append((i, "".join(rng.choices("xyz", k=rng.randint(0, 500))) + b[a:e] + "".join(rng.choices("xyzé", k=rng.randint(0, 500)))))
    raw = {i: (t or "").encode() for i, t in rows}
    count = collections.Counter(t[j : j + 400] for t in raw.values() for j in range(len(t) - 399))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.removal_report(suffix_dedup.find_repeats(docs, keep=["doc_id"], most_types=most)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {i: plain_removal(t, count) for i, t in raw.items()}
    cut = suffix_dedup.remove_repeats(edge)
    assert cut.columns == edge.columns and cut.count() == edge.count()
    assert suffix_dedup.removal_report(suffix_dedup.find_repeats(edge.limit(0))).count() == 0


def plain_passages(texts, words=51, length=400):
    """Texts without strings of ``length`` bytes and passages of ``words`` words that repeat."""
    raw = [t.encode() for t in texts]
    places = [[m.span() for m in re.finditer(rb"[^ \t-\r]+", t)] for t in raw]
    runs = [[tuple(t[a:b] for a, b in p[j : j + words]) for j in range(len(p) - words + 1)] for t, p in zip(raw, places, strict=True)]
    count = collections.Counter(w for x in runs for w in x)
    strings = collections.Counter(t[j : j + length] for t in raw for j in range(len(t) - length + 1))
    out = []
    for t, p, own in zip(raw, places, runs, strict=True):
        gone = np.zeros(len(t), bool)
        for j, w in enumerate(own):
            if count[w] > 1:
                gone[p[j][0] : p[j + words - 1][1]] = True
        for j in range(len(t) - length + 1):
            if strings[t[j : j + length]] > 1:
                gone[j : j + length] = True
        kept = np.split(np.arange(len(t)), np.flatnonzero(np.diff(gone)) + 1)
        out.append("".join(t[x[0] : x[-1] + 1].decode("utf-8", "ignore") for x in kept if len(x) and not gone[x[0]]))
    return out


def test_pipeline_cuts_short_repeated_passages(spark, folder):
    import corpus_pipeline

    rng = random.Random(7)
    fresh = lambda n: [f"{rng.choice('abcé')}{rng.randrange(10**6)}" for _ in range(n)]
    short = lambda n: [rng.choice("abcdefghij") + rng.choice(["", "x", "y"]) for _ in range(n)]
    exact, under, longer = short(51), short(50), short(70)
    solid = "".join(rng.choices("mnopq日", k=450))
    rows = []
    for part in (exact, exact, under, under, longer, longer[9:], longer[:62], [solid], [solid[20:430]], fresh(60)):
        words = fresh(rng.randrange(30)) + part + fresh(rng.randrange(30))
        rows.append("".join(w + rng.choice([" ", "  ", "\n", "\t"]) for w in words))
    rows += [" ".join(exact), "", "one", " \n"]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(rows)] + [(99, None, 0)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in dict(corpus_pipeline.STAGES)["repeated_strings"](spark, docs, folder).collect()}
    want = plain_passages(rows)
    assert [got[i].text for i in range(len(rows))] == want and got[99].text is None
    assert all(got[i].n_chars == len(want[i]) for i in range(len(rows)))
    assert " ".join(exact) not in " ".join(want[0].split()) and want[10] == ""
    assert " ".join(under) in " ".join(want[2].split())  # 50 words stay


def test_repeat_query(spark, folder, texts):
    raw = {i: t.encode() for i, t in texts.items()}
    count = collections.Counter(t[j : j + 400] for t in raw.values() for j in range(len(t) - 399))
    spans = {i: [m.span() for m in re.finditer(rb"[^ \t-\r]+", t)] for i, t in raw.items()}
    windows = {i: [tuple(raw[i][a:b] for a, b in p[j : j + 51]) for j in range(len(p) - 50)] for i, p in spans.items()}
    often = collections.Counter(w for x in windows.values() for w in x)
    for r in queries.QUERIES["op6_suffix_dedup"](spark, folder).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == plain_removal(raw[r.doc_id], count)
        gone = np.zeros(len(raw[r.doc_id]) + 1, np.int8)
        for j, w in enumerate(windows[r.doc_id]):
            if often[w] > 1:
                gone[spans[r.doc_id][j][0] : spans[r.doc_id][j + 50][1]] = 1
        assert (r.n_passage_bytes, r.n_passages) == (gone.sum(), (np.diff(gone, prepend=0) == 1).sum())


def test_blind_trie_sorts():
    rng = random.Random(3)
    for _ in range(200):
        words = ["".join(rng.choices("ab", k=12)).encode() for _ in range(rng.randint(1, 30))]
        assert [words[i] for i in suffix_dedup.BlindTrie(words).order()] == sorted(words)


# --- leaks --------------------------------------------------------------------------------------


def plain_leaks(docs, items, n=10):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = decontaminate.item_words(t)
        for j in range(max(1, len(w) - n + 1) if w else 0):
            windows[tuple(w[j : j + n])].add(str(i))
    sizes, out = {len(w) for w in windows}, []
    for i, t in docs:
        w = decontaminate.item_words(t)
        hit, own = [False] * len(w), set()
        for k in sizes:
            for j in range(len(w) - k + 1):
                if tuple(w[j : j + k]) in windows:
                    own |= windows[tuple(w[j : j + k])]
                    hit[j : j + k] = [True] * k
        digest = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
        out.append((i, len(w), sum(hit), len(own), digest, any(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [decontaminate.ITEM_BYTES, 300])
def test_leaks(spark, folder, texts, edge, block):
    rng = random.Random(4)
    items = [(r.item_id, r.text) for r in read(spark, folder, "benchmark").collect()][:12] + [(50, None), (51, "!"), (52, "One"), (53, "a b"), (54, "a b")]
    rows = EDGES + [(i, t) for i, t in texts.items() if 20 < i < 60] + [(900 + i, " ".join(rng.choices("ab", k=30))) for i in range(20)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, row int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.leak_report(decontaminate.find_leaks(docs, bench, block_bytes=block)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_leaks(rows, items)
    none = decontaminate.leak_report(decontaminate.find_leaks(docs, bench.limit(0), block_bytes=block))
    assert none.where("contaminated").count() == 0
    cut = decontaminate.remove_leaks(edge, bench)
    assert cut.columns == edge.columns and cut.count() == edge.count()


def test_scores_of_paths_in_any_order():
    """A block's paths find their scores by their place among the distinct ones, repeated and unsorted as they are."""
    rng = np.random.default_rng(3)
    paths = np.append(rng.integers(0, 1 << 55, 500)[rng.integers(0, 500, 4000)], lm_scoring.END_PATH)
    distinct = np.unique(paths)
    scores = rng.random(len(distinct))
    want = dict(zip(distinct[lm_scoring.dealt(distinct)[2]].tolist(), scores, strict=True))
    assert lm_scoring.scores_of(paths, scores).tolist() == [want[p] for p in paths.tolist()]


def test_tasks_give_memory_back(monkeypatch):
    """A Python worker outlives its task; what the task has freed goes back at its end."""
    released = []
    monkeypatch.setattr(common, "ship", lambda spark: None)
    monkeypatch.setattr(common, "release_memory", lambda: released.append(len(seen)))

    class Frame:
        sparkSession = None

        def mapInArrow(self, run, schema):
            return run

    seen = []
    task = common.map_arrow(Frame(), lambda batches: (seen.append(b) or b for b in batches), "x int")
    assert list(task(iter([1, 2, 3]))) == [1, 2, 3] and released == [3]
    monkeypatch.undo()
    common.release_memory()


# --- mixing -------------------------------------------------------------------------------------


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        left, w = total - sum(fixed.values()), sum(weight[s] for s in names if s not in fixed)
        target = fixed | {s: left * weight[s] / w for s in names if s not in fixed}
        over = [s for s in names if s not in fixed and target[s] > 3 * sizes[s]]
        if not over:
            return target
        fixed |= {s: 3 * sizes[s] for s in over}


def test_mix(spark, folder, edge):
    rng = random.Random(6)
    rows = [(i, " w" * rng.randrange(200), rng.choice(["a", "a", "a", "b", "c", "", None, "é", "z" + str(i % 40)])) for i in range(600)]
    own = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for docs in (read(spark, folder, "documents"), own, edge):
        mix = mixing.mix_sources(docs)
        got = mix.taken().collect()
        sizes = collections.Counter()
        for r in got:
            sizes[r.source] += r["size"]
            assert 0 <= r.taken <= 3 * r["size"]
        target, taken = plain_targets(sizes), collections.Counter()
        for r in got:
            assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
            taken[r.source] += r.taken
        assert all(abs(taken[s] - target[s]) <= 0.51 for s in target)
        again = mixing.mix_sources(docs.repartition(3)).taken().collect()
        assert sorted(map(str, again)) == sorted(map(str, got))
        whole = mix.slots.groupBy("source_no", "epoch").count().count()
        assert mix.slots.select("source_no", "epoch", "block").distinct().count() == mix.slots.count() and whole >= 0
    assert mixing.mix_sources(edge.limit(0)).taken().count() == 0


def test_rows_without_words_stay_rows(spark):
    rows = [(1, None, "s"), (1, None, "s"), (2, "", "s"), (2, "", "s"), (3, "a b c", "s"), (3, "a b c", "s")]
    mix = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = mix.taken().collect()
    assert sorted((r.doc_id, r["size"]) for r in got) == [(1, 0), (1, 0), (2, 0), (2, 0), (3, 3), (3, 3)]
    assert sum(r.taken for r in got) == 6


def test_slots_are_not_broadcast(spark, folder):
    mix = mixing.mix_sources(read(spark, folder, "documents"))
    with mixing.subset_keys(spark):
        plan = mix.packed()._jdf.queryExecution().executedPlan().toString().splitlines()
    joins = [line for line in plan if "Join" in line]
    assert "SortMergeJoin" in joins[0] and "bucket" in joins[0]
    # Texts move twice: to their buckets, where the pieces stay for the join with slots, and to the shards.
    depth = {i: len(line) - len(line.lstrip(" :+-")) for i, line in enumerate(plan)}
    top = plan.index(joins[0])
    below = next(i for i in range(top + 1, len(plan)) if "Window" in plan[i])
    assert not [line for line in plan[top:below] if "Exchange" in line]
    assert len([i for i in range(top) if "Exchange" in plan[i] and depth[i] < depth[top]]) == 1


def test_written_mix(spark, edge, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS_PER_SHARD", 40)
    rng = random.Random(8)
    blank = lambda: rng.choice([" ", "  ", "\n", "\t\x0b", "\r\x0c"])
    rows = [(i, "".join(f"{rng.choice('aé日')}{rng.randrange(99)}" + blank() for _ in range(rng.choice([0, 1, 3, 30, 400]))), rng.choice(["a", "a", "b", None])) for i in range(120)]
    rows += rows[:3]
    for docs in (spark.createDataFrame(rows, "doc_id long, text string, source string"), edge):
        text = {r.doc_id: (r.text or "").encode().split() for r in docs.collect()}
        mix = mixing.mix_sources(docs)
        stream, owner = collections.defaultdict(dict), collections.defaultdict(dict)
        for d in mix.documents.collect():
            for k in range(d["size"]):
                stream[d.source_no][d.start + k] = text[d.doc_id][k]
                owner[d.source_no][d.start + k] = d.doc_id
        slots = {(s.source_no, s.slot): s for s in mix.slots.collect()}
        got, taken = mix.written().collect(), collections.Counter()
        assert len(got) == len(slots) and {(r.source_no, r.slot) for r in got} == set(slots)
        for r in got:
            s, place = slots[r.source_no, r.slot], range(r.block * 64, r.block * 64 + r.words)
            assert (r.shard, r.block, r.words, r.epoch) == (s.shard, s.block, s.words, s.epoch)
            assert r.text.encode() == b" ".join(stream[r.source_no][k] for k in place)
            taken.update(owner[r.source_no][k] for k in place)
        want = collections.Counter((s.shard, s.source_no) for s in slots.values())
        assert collections.Counter((r.shard, r.source_no) for r in got) == want == {(c.shard, c.source_no): c.slots for c in mix.shard_counts().collect()}
        shards = max(1, len(slots) // 40)
        assert {s for s, _ in want} <= set(range(shards)) and (shards == 1 or len({s for s, _ in want}) > shards // 2)
        assert all(f"/shard={r.shard}/" in r.file for r in mix.written().selectExpr("shard", "input_file_name() as file").collect())
        totals = collections.Counter()
        for r in mix.taken().collect():
            totals[r.doc_id] += r.taken
        assert totals == taken


def test_mix_in_parts(spark, monkeypatch):
    """The streams are packed in two parts; blocks that begin in one and end in the other are whole, the words taken are the same."""
    rng = random.Random(9)
    rows = [(i, "\n".join(f"{i}_{k}" for k in range(rng.choice([0, 1, 2, 5, 90, 300]))), rng.choice(["a", "a", "b", "c", None])) for i in range(160)]
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 8)
    mix = mixing.mix_sources(docs)
    assert mix.parts == mixing.PARTS == 2
    halves = [mix.texts(part).count() for part in range(2)]
    filled = docs.where("text <> ''").count()
    assert max(halves) < 0.75 * filled and filled <= sum(halves) < 1.4 * filled
    got = {(r.source_no, r.slot): r for r in mix.written().collect()}
    slots = mix.slots.collect()
    assert len(got) == len(slots) == mix.written().count()
    starts = {}
    for d in mix.documents.collect():
        for k in range(d["size"]):
            starts[d.source_no, d.start + k] = f"{d.doc_id}_{k}"
    for s in slots:
        r = got[s.source_no, s.slot]
        assert r.text.split(" ") == [starts[s.source_no, s.block * 64 + k] for k in range(s.words)] and r.shard == s.shard
    taken = sorted(map(str, mix.taken().collect()))
    monkeypatch.setattr(mixing, "PARTS", 1)
    assert sorted(map(str, mixing.mix_sources(docs).taken().collect())) == taken


def test_spaced_text_has_the_counted_words(spark):
    rows = [(None,), ("",), (" \t\n",), ("a",), (" a\x0b\x0cb\r\n c ",), ("é x  日",), ("\x0e \x1f",)]
    got = spark.createDataFrame(rows, "t string").select(
        "t", mixing.word_count(F.col("t")).alias("n"), mixing.spaced(F.col("t")).alias("s"), mixing.spaced_count(mixing.spaced(F.col("t"))).alias("m")
    )
    for r in got.where("t is not null").collect():
        words = r.t.encode().split()
        assert (r.n, r.m, r.s.encode()) == (len(words), len(words), b" ".join(words))


# --- search -------------------------------------------------------------------------------------


def test_topk(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(700, 8)))]
    rows += [(700, None), (800, [1.0, None]), (801, [float("nan")]), (802, [float("inf")]), (5, rows[6][1]), (900, [2.0] * 11), (None, [1.0])]
    vectors = topk.whole_vectors(spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, parts int").drop("parts"))
    want = []
    whole = [(i, [math.floor(1024 * x) for x in np.array(v, np.float32).astype(float)]) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    for q, a in whole:
        if q % 100 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in whole if c != q)[:10]
            want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    for per_pass in (8192, 2):
        got = topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), block_rows=32, per_pass=per_pass)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert topk.top_k(vectors.limit(0), vectors).count() == 0
    assert topk.top_k(vectors, vectors.limit(0)).count() == 0


def test_blocks_are_pruned():
    rng = np.random.default_rng(2)
    rows = np.floor(np.repeat(rng.normal(size=(20, 16)) * 4000, 50, axis=0) + rng.normal(size=(1000, 16)) * 50)
    _, _, _, scored = topk.best_of(np.arange(1000), rows, np.arange(0, 1000, 100), rows[::100], 10, 50)
    assert scored < 10 * 20 / 2


# --- pipeline -----------------------------------------------------------------------------------


def test_pipeline(spark, folder):
    import corpus_pipeline

    docs = read(spark, folder, "documents").cache()
    first = corpus_pipeline.STAGES[0][1](spark, docs, folder)
    assert first.columns == docs.columns and 0 < first.count() < docs.count()
    second = corpus_pipeline.STAGES[1][1](spark, docs, folder)
    want = plain_components([(r.doc_id, r.text) for r in docs.collect()], 5)
    assert {r.doc_id for r in second.collect()} == {c for _, c in want.values()}
    fourth = corpus_pipeline.STAGES[3][1](spark, docs, folder)
    assert fourth.columns == docs.columns
    assert decontaminate.leak_report(decontaminate.find_leaks(fourth, read(spark, folder, "benchmark"))).where("contaminated").count() == 0
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_voters_are_fitted_off_the_driver(spark, monkeypatch):
    """The factoring needs some 400 MB; the driver gets the voters only, those of the plain fit."""
    rows = [(i, ("good plain words of a story " if i % 2 else "win CASH now!!! ") * (1 + i % 5) + str(i)) for i in range(1, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    sample = quality.labelled_sample(docs, labels, "quality").collect()
    counts = quality.term_counts(pa.array([r.text for r in sample]))
    want = quality.fit_voters(counts, np.array([r.label for r in sample], float))
    packed = quality.PackedCounts(quality.PackedCounts.pack(counts))
    assert (packed[0:99] == counts).all()

    def refuse(*_):
        raise AssertionError("factored on the driver")

    monkeypatch.setattr(np.linalg, "eigh", refuse)
    got = quality.train(docs, labels)
    assert (got.labels == want.labels).all() and np.allclose(got.weights, want.weights)
    # the leading directions; so few texts leave the last ones of RANK undetermined
    assert np.allclose(np.abs(got.basis[:, :2]), np.abs(want.basis[:, :2]), atol=1e-3) and got.vectors.shape == want.vectors.shape
    assert quality.train(docs, labels.limit(0)).prior == 0.5
