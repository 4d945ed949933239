"""Hard negatives, shards and repaired conversations against brute force and made cases."""

import collections
import functools
import hashlib
import itertools
import random
import re
import zlib

import check
import pytest
from pyspark.sql import functions as F

from lendlake.llm import conversations, hard_negatives, queries, sharding
from lendlake.llm.common import read

# --- hard negatives -----------------------------------------------------------------------------


def plain_negatives(rows, k=5, lowest=80):
    """From (vec_id, label, parts) rows; anchors are the ids divisible by 100."""
    width = max([len(p) for _, _, p in rows], default=0)
    full = [(i, label, [*p, *[0] * (width - len(p))]) for i, label, p in rows]
    out = collections.Counter()
    for i, label, q in {(i, label, tuple(q)) for i, label, q in full if i % 100 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, x)), j, other) for j, other, x in full if j != i)
        for s, j, _ in [x for x in scored if x[2] == label][:k]:
            fit = [x for x in scored if x[2] != label and lowest * -s <= 100 * -x[0] <= 100 * -s][:k]
            out.update((i, j, r, n, -s, -t) for r, (t, n, _) in enumerate(fit, 1))
    return out


@pytest.mark.parametrize("blocks", [(2_048, 16_384), (2, 7)])
def test_hard_negatives(spark, blocks, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS_PER_BLOCK", blocks[0])
    monkeypatch.setattr(hard_negatives, "ROWS_PER_BLOCK", blocks[1])
    rng = random.Random(5)
    rows = [(i * 25, rng.randrange(3), [rng.randrange(-3, 4) for _ in range(3)]) for i in range(60)]  # many ties
    rows += [(7, 1, [2]), (300, 2, [1, 1, 1]), (8, 0, [3, 3, 3, 9]), (8, 0, [3, 3, 3, 9])]  # other lengths, repeats
    df = spark.createDataFrame(rows, "vec_id long, label int, parts array<int>")
    df = df.withColumn("parts", F.col("parts").cast("array<double>"))
    got = hard_negatives.mine_hard_negatives(df.where("vec_id % 100 = 0"), df)
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert collections.Counter(map(tuple, got.select(cols).collect())) == plain_negatives(rows)
    assert hard_negatives.mine_hard_negatives(df.limit(0), df).count() == 0
    assert hard_negatives.mine_hard_negatives(df, df.limit(0)).count() == 0


def test_rows_that_take_no_part(spark, folder, tmp_path):
    inf, nan = float("inf"), float("nan")
    good = [(100, 1, [1.0, 0.0], "x"), (1, 1, [1.0, 0.0], "x"), (2, 2, [0.95, 0.0], "x"), (7, 1, [0.9, 0.0], "x"), (3, 2, [0.5, 0.0], "x")]
    bad = [(4, None, [1.0, 0.0], "x"), (5, 2, None, "x"), (6, 2, [1.0, None], "x"), (8, 2, [1.0, nan], "x"), (9, 2, [inf, 0.0], "x"), (None, 2, [1.0, 0.0], "x")]
    path = f"{tmp_path}/embeddings.parquet"
    spark.createDataFrame(good + bad, "vec_id long, label int, embedding array<float>, anchor string").write.parquet(path)
    got = {(r.anchor_id, r.positive_id, r.rank, r.negative_id) for r in hard_negatives.op11_hard_negatives(spark, str(tmp_path)).collect()}
    assert got == {(100, 1, 1, 2), (100, 1, 2, 7)}  # 7 counts as label 2; 3 is below the window


@pytest.mark.parametrize("name", ["op11_hard_negatives"])
def test_query_matches_sql(spark, folder, name):
    for f in (folder, "/root/testdata/sf0.1"):
        assert check.compare(queries.QUERIES[name](spark, f), check.connect(f), queries.CHECKS[name]) is None


# --- shards -------------------------------------------------------------------------------------


def assert_even(rows, shards):
    """``rows``: (shard, slot, source)."""
    by = collections.defaultdict(list)
    for shard, slot, _ in rows:
        by[shard].append(slot)
    sizes = [len(by[s]) for s in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sources = collections.Counter(x for *_, x in rows)
    for (source, _), n in collections.Counter((x, s) for s, _, x in rows).items():
        share = sources[source] / len(rows)
        assert abs(n - sources[source] / shards) <= 1 + share * (len(sources) + shards)


@pytest.mark.parametrize("per_bucket", [4_000, 7])
def test_shards_match_the_mixture(spark, per_bucket, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKETS_PER_GROUP", 3 if per_bucket == 7 else 512)
    rows = [(i % 300, None if i % 11 == 0 else f"text {i % 50}", "hot" if i % 3 else None if i % 2 else f"s{i % 40}") for i in range(1_000)]
    rows += [(1, "", "hot")] * 30 + [(None, None, "hot")] * 30 + [(5, "w " * 30_000, "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {"shard": F.lit("mine"), "_bucket": F.lit(1), "a.b": F.lit(2), "x y": F.create_map(F.lit("k"), F.lit(1))}
    )
    got = sharding.interleave(docs, 8, rows_per_bucket=per_bucket)
    found = got.select("shard", "slot", "doc.source", "doc.doc_id", "doc.text").collect()
    assert_even([r[:3] for r in found], 8)
    assert collections.Counter((r.doc_id, r.text, r.source) for r in found) == collections.Counter(rows)
    assert got.schema["doc"].dataType.names == docs.columns
    again = sharding.interleave(docs.repartition(5), 8, rows_per_bucket=per_bucket)
    places = lambda df: collections.Counter(map(tuple, df.select("shard", "slot", "doc.source", "doc.doc_id", "doc.text").collect()))
    assert places(again) == places(got)
    few = sharding.interleave(docs.limit(3), 8).collect()
    assert len({r.shard for r in few}) == 3 and {r.slot for r in few} == {0}
    assert sharding.interleave(docs.limit(0), 8).count() == 0


def test_sources_of_one_row_are_spread(spark):
    docs = spark.createDataFrame([(i, "t", f"s{i}") for i in range(800)], "doc_id long, text string, source string")
    ranges = sharding.places(
        sharding._bucketed(sharding._hashed(docs, 1), 16).groupBy("_bucket", "_source").agg(F.count(F.lit(1)).alias("n")), 16, 800, 8, 1
    )
    assert sorted(x.shard for r in ranges.collect() for x in r[1]) == [k for k in range(8) for _ in range(100)]


def test_shard_query(spark, folder):
    texts = {r.doc_id: (r.text or "", r.source) for r in read(spark, folder, "documents").collect()}
    found = sharding.op12_shard_documents(spark, folder).collect()
    assert_even([(r.shard, r.slot, texts[r.doc_id][1]) for r in found], 8)
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        body = texts[r.doc_id][0].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(body) + 1, zlib.crc32(body), "rows", None)
    # Read back file by file, a shard's rows come in the order of their slots.
    stored = sharding.written_shards(read(spark, folder, "documents"))
    files = collections.defaultdict(list)
    for r in stored.select("slot", F.input_file_name().alias("f")).collect():
        files[r.f].append(r.slot)
    assert all(v == sorted(v) for v in files.values())


def test_texts_are_shuffled_once(spark, folder):
    plan = sharding.interleave(read(spark, folder, "documents"))._jdf.queryExecution().executedPlan().toString()
    tail = plan.split("isFinalPlan=false")[-1]
    assert tail.count("BroadcastNestedLoopJoin") == tail.count("CartesianProduct") == 0
    texts = [line for line in tail.splitlines() if "Exchange" in line]
    assert sum("_bucket" in line and "hashpartitioning(_bucket" in line for line in texts) <= 2


# --- conversations ------------------------------------------------------------------------------

NO_CHAR = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """Faults, cost, audit and repaired rows of one conversation's (turn, role, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.translate({ord(c): None for c in NO_CHAR})
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    nexts = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    @functools.lru_cache(None)
    def best(i, state, inserted):
        ways = []
        if i == len(rows) and state in (0, 3):
            ways.append((0, "", ()))
        if inserted < 3:
            for to in "ua":
                if to in nexts[state]:
                    cost, audit, roles = best(i, nexts[state][to], inserted + 1)
                    ways.append((cost + 5, "I" + audit, (({"u": "user", "a": "assistant"}[to], ""), *roles)))
        if i < len(rows):
            cost, audit, roles = best(i + 1, state, 0)
            ways.append((cost + 2, "D" + audit, roles))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                for to in "sua":
                    name = rows[i][1] if rows[i][1][:1] == to else {"u": "user", "a": "assistant"}.get(to)
                    if to in nexts[state] and name:
                        cost, audit, roles = best(i + 1, nexts[state][to], 0)
                        kept = rows[i][1][:1] == to
                        ways.append((cost + more + (not kept), "KR"[not kept] + audit, ((name, rows[i][2]), *roles)))
        return min(ways, default=(10**9, "", ()))

    cost, audit, roles = best(0, 0, 0)
    turns = {r[0] for r in rows} - {None}
    count = collections.Counter(faults)
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    text = "\n".join(f"{role}:{text}" for role, text in roles)
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def made_conversations():
    rng = random.Random(11)
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(1, 14)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "User", "", None, "umpire"])
            text = rng.choice(["Yes.", "No!", "Why?", "half a", "", " \t", None, f"line {turn}.", "é。", "ok.\n"])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None, turn * 1_000, -turn]), role, text))
    return [*rows, (None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (7_000, 0, "user", "Hi.")]


@pytest.mark.parametrize("turns", [1_024, 2])
def test_repair(spark, tmp_path, turns, monkeypatch):
    monkeypatch.setattr(conversations, "TURNS_PER_SEGMENT", turns)
    rows = made_conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"_conv": F.lit(1), "place": F.lit("x"), "a.b": F.lit(0)})
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    want = {}
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in plain_damage(rows) if r[0] == conv]
        want[conv] = plain_repair(mine)
    got = {r.conv_id: tuple(r[c] for c in FIGURES) for r in conversations.op13_repair_conversations(spark, str(tmp_path)).collect()}
    assert got == want
    assert conversations.Repair(df.limit(0)).edits.count() == 0


def test_repair_query(spark, folder):
    rows = [tuple(r) for r in read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    by = collections.defaultdict(list)
    for conv, *rest in plain_damage(rows):
        by[conv].append(tuple(rest))
    got = conversations.op13_repair_conversations(spark, folder).collect()
    assert {r.conv_id: tuple(r[c] for c in FIGURES) for r in got} == {c: plain_repair(by[c]) for c in {r[0] for r in rows}}
    edits = conversations.Repair(conversations.damaged(read(spark, folder, "conversations"))).edits
    roles = collections.defaultdict(list)
    for r in sorted(edits.where("edit <> 'D'").collect(), key=lambda r: r.place):
        roles[r.conv_id].append(r.role[:1])
    assert all(re.fullmatch("(s?(ua)+)?", "".join(v)) for v in roles.values())


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(conversations, "TURNS_PER_SEGMENT", 16)
    rng = random.Random(3)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), rng.choice([f"line {i}.", "cut", "again."])) for i in range(200)]
    repair = conversations.Repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert repair._segments.count() == 13
    want = plain_repair([r[1:] for r in rows])
    assert tuple(repair.figures.select(*FIGURES[:-1]).first()) == want[:-1]
