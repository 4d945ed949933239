"""Repair of conversation structure: a generalised LR parse with weighted edits.

The roles of a conversation have to read as the grammar ``conversation -> empty | s pairs | pairs``,
``pairs -> u a | pairs u a``. Each row may be kept, given another role or deleted, and empty rows
may be put in, all at a price. The parser carries a graph-structured stack: its tops are LR
states, every edit advances them, and tops of the same state are merged, the least (cost, audit)
staying. The grammar is left-recursive, so stacks have four states at most, and a merged top
continues as any of its stacks would.

A conversation is parsed in segments of turns, in parallel: a segment gives, for each stack that
it may begin with, the cheapest way to each top (the first segment begins with the empty stack
alone). A chain over the segments, one small row each, picks the ways; then the edits go back to
the rows. (cost, audit) keeps its order when both sides go on alike: of two audits of the same
rows and the same cost none is the beginning of the other, as more insertions cost more.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_arrow, read, staged

TURNS_PER_SEGMENT = 1_024
RESHAPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}

# The parser's tables: states after a shift of s, u or a, and the reductions that follow a shift
# at once (number of states taken off, state gone to from the one below).
_SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 6, (3, "u"): 7, (5, "u"): 7, (7, "a"): 8}
_GOTO = {0: 3, 1: 5}
_REDUCE = {6: 2, 8: 3}
_ACCEPT = (0, 3, 5)
EMPTY = (0,)
#: Every stack that can stand between two rows.
STACKS = (EMPTY, (0, 1), (0, 2), (0, 1, 2), (0, 3), (0, 1, 5), (0, 3, 7), (0, 1, 5, 7))


def _shifted(stack: tuple, symbol: str) -> tuple | None:
    state = _SHIFT.get((stack[-1], symbol))
    if state is None:
        return None
    stack = (*stack, state)
    if state in _REDUCE:
        below = stack[: -_REDUCE[state]]
        return (*below, _GOTO[below[-1]])
    return stack


_STEP = {(s, x): _shifted(s, x) for s in STACKS for x in "sua"}


class Tops:
    """Tops of a graph-structured stack: by state, the least (cost, audit) and its stack.

    What all audits begin with is moved to ``settled``, so that comparisons stay short.
    """

    def __init__(self, stack: tuple = EMPTY):
        self.tops = {stack[-1]: (0, "", stack)}
        self.settled: list[str] = []

    def _put(self, tops: dict, cost: int, audit: str, stack: tuple) -> bool:
        held = tops.get(stack[-1])
        if held is None or (cost, audit) < held[:2]:
            tops[stack[-1]] = (cost, audit, stack)
            return True
        return False

    def insert(self) -> None:
        """Empty rows may come in here, as long as one makes a top cheaper."""
        todo = list(self.tops.values())
        while todo:
            cost, audit, stack = todo.pop()
            for symbol in "ua":
                after = _STEP[stack, symbol]
                if after and self._put(self.tops, cost + INSERT, audit + "I", after):
                    todo.append(self.tops[after[-1]])

    def row(self, symbol: str, fault: str) -> None:
        """One row: kept, given another role or deleted (blank and duplicate rows only deleted)."""
        tops: dict = {}
        for cost, audit, stack in self.tops.values():
            self._put(tops, cost + DELETE, audit + "D", stack)
            if fault in ("blank", "duplicate"):
                continue
            stays = TRUNCATED if fault == "truncated" else 0
            for to in "sua":
                after = _STEP[stack, to]
                if after and to == symbol:
                    self._put(tops, cost + stays, audit + "K", after)
                elif after and to in ROLES:
                    self._put(tops, cost + stays + RESHAPE, audit + "R", after)
        self.tops = tops
        self.insert()

    def follow(self, ways: dict) -> None:
        """A whole segment: from each top over its stack's ways."""
        tops: dict = {}
        for cost, audit, stack in self.tops.values():
            for more, text, after in ways[stack]:
                self._put(tops, cost + more, audit + text, after)
        self.tops = tops
        same = os.path.commonprefix([audit for _, audit, _ in tops.values()])
        self.settled.append(same)
        self.tops = {k: (c, a[len(same) :], s) for k, (c, a, s) in tops.items()}

    def best(self) -> tuple[int, str]:
        """Cost and audit of the cheapest whole conversation."""
        cost, audit = min((c, a) for state, (c, a, _) in self.tops.items() if state in _ACCEPT)
        return cost, "".join(self.settled) + audit


def role_of(stack: tuple, letter: str, symbol: str) -> tuple[tuple, str]:
    """Stack after an edit, and the role initial that the edit leaves."""
    if letter == "K":
        return _STEP[stack, symbol], symbol
    to = next(x for x in "ua" if _STEP[stack, x])
    return _STEP[stack, to], to


# --- rows and their faults ----------------------------------------------------------------------


def _segment_key(rows: DataFrame) -> DataFrame:
    """conv, role and text without nulls (a space for them), segment, initial, and a digest of the text."""
    turn = F.col("turn").cast("long")
    return rows.select(
        F.col("conv_id").alias("conv_id"),
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("_conv"),
        turn.alias("turn"),
        # Turns of a segment follow each other; null turns are a segment before all others.
        F.coalesce(F.floor(turn / TURNS_PER_SEGMENT).cast("long"), F.lit(-(1 << 62))).alias("_seg"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    ).withColumn("_dig", F.md5("text"))


_ORDER = ("turn", "role", "_dig")  # ascending, nulls first
_NO_CHAR = r"[\x20\x09-\x0D]+"


def _digests(keyed: DataFrame) -> DataFrame:
    """What the parse needs of a row; texts stay behind."""
    bare = F.regexp_replace("text", _NO_CHAR, "")
    return keyed.select(
        "_conv",
        "_seg",
        "turn",
        "role",
        "_dig",
        F.when(bare == "", "blank").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("").alias("own"),
    )


def _with_firsts(digests: DataFrame) -> DataFrame:
    """Marks rows that are equal to others (``_same``) and, of those, the ones of a later turn than the first.

    The first of equal rows is found by a map-side grouping, not by a window over them.
    """
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    alike = ["_conv", "role", "_dig"]
    groups = digests.groupBy(*alike).agg(F.min(at).alias("_first"), F.count(F.lit(1)).alias("_n"))
    repeated = staged(groups.where("_n > 1").drop("_n"), "repeated-rows")
    first = F.col("_first")
    return digests.join(repeated, alike, "left").select(
        *digests.columns, first.isNotNull().alias("_same"), F.coalesce(at > first, F.lit(False)).alias("_later")
    )


# --- segments -----------------------------------------------------------------------------------

_WAYS = "array<struct<start: int, cost: long, audit: string, stop: int>>"
_SEGMENT = f"""_conv string, _seg long, n long, blank long, duplicate long, truncated long, illegal long, turns long,
    first_turn long, last_turn long, symbols string, ways {_WAYS}"""
_PAIRS = ("su", "ua", "au")
_SYMBOLS = ("s", "u", "a")  # other initials are a '?': such a role can be kept nowhere


class _Segment:
    def __init__(self, conv: str, seg: int, first: bool):
        self.key = (conv, seg)
        self.starts = {0: Tops()} if first else {i: Tops(s) for i, s in enumerate(STACKS)}
        if first:
            self.starts[0].insert()
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.symbols: list[str] = []
        self.turns = 0
        self.first = self.last = None

    def add(self, symbol: str, fault: str, turn: int | None) -> None:
        if fault:
            self.faults[fault] += 1
        for tops in self.starts.values():
            tops.row(symbol, fault)
        self.symbols.append(symbol)
        if turn is not None:
            self.turns += turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn

    def out(self) -> dict:
        ways = [
            {"start": i, "cost": c, "audit": a, "stop": STACKS.index(s)} for i, tops in self.starts.items() for c, a, s in tops.tops.values()
        ]
        return {
            "_conv": self.key[0], "_seg": self.key[1], "n": len(self.symbols), **self.faults, "illegal": _illegal(self.symbols),
            "turns": self.turns, "first_turn": self.first, "last_turn": self.last, "symbols": "".join(self.symbols), "ways": ways,
        }


def _illegal(symbols: list[str] | str) -> int:
    return sum(a + b not in _PAIRS for a, b in zip(symbols, symbols[1:], strict=False))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by segment come in; a segment's ways go out when it ends."""
    schema = _arrow(_SEGMENT_FIELDS)
    now, before = None, None
    for batch in batches:
        done = []
        for conv, seg, opens, turn, role, dig, own, same, later in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.key != (conv, seg):
                if now is not None:
                    done.append(now.out())
                now, before = _Segment(conv, seg, opens), None
            # Equal rows of one turn lie side by side.
            again = later or same and before == (turn, role, dig)
            before = (turn, role, dig)
            now.add(role[:1] if role[:1] in _SYMBOLS else "?", "duplicate" if again and own != "blank" else own, turn)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.out()], schema)


_SEGMENT_FIELDS = [
    ("_conv", pa.string()), ("_seg", pa.int64()), *((x, pa.int64()) for x in ("n", "blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn")),
    ("symbols", pa.string()),
    ("ways", pa.list_(pa.struct([("start", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("stop", pa.int32())]))),
]


def _arrow(fields: list) -> pa.Schema:
    return pa.schema([pa.field(n, t) for n, t in fields])


# --- chain --------------------------------------------------------------------------------------

_CHOSEN = """_conv string, _seg long, cost long, between long, letters string, roles string, places array<long>,
    inserts array<struct<place: long, role: string>>, audit string"""
_CHOSEN_FIELDS = [
    ("_conv", pa.string()), ("_seg", pa.int64()), ("cost", pa.int64()), ("between", pa.int64()), ("letters", pa.string()),
    ("roles", pa.string()), ("places", pa.list_(pa.int64())),
    ("inserts", pa.list_(pa.struct([("place", pa.int64()), ("role", pa.string())]))), ("audit", pa.string()),
]


class _Chain:
    """The segments of one conversation, in order."""

    def __init__(self, conv: str):
        self.conv, self.tops, self.segments = conv, Tops(), []

    def add(self, seg: int, symbols: str, ways: list[dict]) -> None:
        by_start: dict = {}
        for w in ways:
            by_start.setdefault(STACKS[w["start"]], []).append((w["cost"], w["audit"], STACKS[w["stop"]]))
        if not self.segments:
            by_start = {EMPTY: by_start[EMPTY]}
        self.tops.follow(by_start)
        self.segments.append((seg, symbols))

    def out(self) -> Iterator[dict]:
        cost, audit = self.tops.best()
        stack, at, last = EMPTY, 0, ""
        for k, (seg, symbols) in enumerate(self.segments):
            begin, letters, roles, places, inserts, i = at, [], [], [], [], 0
            while at < len(audit) and (i < len(symbols) or k + 1 == len(self.segments)):
                letter = audit[at]
                if letter == "I":
                    stack, to = role_of(stack, letter, "")
                    inserts.append({"place": at, "role": ROLES[to]})
                else:
                    to = "-"
                    if letter != "D":
                        stack, to = role_of(stack, letter, symbols[i])
                    letters.append(letter)
                    roles.append(to if letter == "R" else "-")
                    places.append(at)
                    i += 1
                at += 1
            yield {
                "_conv": self.conv, "_seg": seg, "cost": 0 if k else cost, "between": int(bool(k) and last + symbols[:1] not in _PAIRS),
                "letters": "".join(letters), "roles": "".join(roles), "places": places, "inserts": inserts, "audit": audit[begin:at],
            }
            last = symbols[-1:]


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(_CHOSEN_FIELDS)
    now = None
    for batch in batches:
        done = []
        for conv, seg, symbols, ways in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv != conv:
                if now is not None:
                    done += now.out()
                now = _Chain(conv)
            now.add(seg, symbols, ways)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if now is not None:
        for one in now.out():
            yield pa.RecordBatch.from_pylist([one], schema)


# --- the operator -------------------------------------------------------------------------------


class Repair:
    """The repaired conversations: ``edits`` row by row, and ``figures`` by conversation."""

    def __init__(self, rows: DataFrame):
        """``rows``: conv_id, turn, role, text; other columns are ignored.

        A conversation's rows are taken by turn, null turns first, ties by role and text. Null
        roles and texts count as one space; a null conv_id is a conversation of its own; a role
        without a grammar's initial can be kept nowhere; rows that repeat are duplicates; an
        empty table gives none.
        """
        self._keyed = _segment_key(rows)
        digests = staged(_digests(self._keyed), "turn-digests")
        begin = digests.groupBy("_conv").agg(F.min("_seg").alias("_begin"))
        inputs = (
            _with_firsts(digests)
            .join(begin, "_conv")
            .select("_conv", "_seg", (F.col("_seg") == F.col("_begin")).alias("_opens"), "turn", "role", "_dig", "own", "_same", "_later")
        )
        dealt = inputs.repartition("_conv", "_seg").sortWithinPartitions("_conv", "_seg", *_ORDER)
        self._segments = staged(map_arrow(dealt, _parse, _SEGMENT), "segments")
        chain = self._segments.select("_conv", "_seg", "symbols", "ways").repartition("_conv").sortWithinPartitions("_conv", "_seg")
        self._chosen = staged(map_arrow(chain, _choose, _CHOSEN), "segment-edits")

    @property
    def edits(self) -> DataFrame:
        """conv_id, place (order of the edits), turn, edit (K, R, D, I), role and text after it, old_role.

        The repaired conversation is what is not deleted. Inserted rows have no turn.
        """
        names = self._keyed.groupBy("_conv").agg(F.first("conv_id").alias("conv_id"))
        # Window and join share the deal by segment: the texts are shuffled once.
        order = Window.partitionBy("_conv", "_seg").orderBy(*_ORDER)
        numbered = self._keyed.withColumn("_i", F.row_number().over(order))
        chosen = self._chosen.select("_conv", "_seg", "letters", "roles", "places")
        to = F.substring("roles", F.col("_i"), F.lit(1))
        old = numbered.join(chosen.hint("merge"), ["_conv", "_seg"]).select(
            "_conv",
            "conv_id",
            F.element_at("places", F.col("_i")).alias("place"),
            "turn",
            F.substring("letters", F.col("_i"), F.lit(1)).alias("edit"),
            F.when(to == "u", ROLES["u"]).when(to == "a", ROLES["a"]).otherwise(F.col("role")).alias("role"),
            "text",
            F.col("role").alias("old_role"),
        )
        new = (
            self._chosen.where(F.size("inserts") > 0)
            .select("_conv", F.explode("inserts").alias("x"))
            .join(names, "_conv")
            .select(
                "_conv", "conv_id", "x.place", F.lit(None).cast("long").alias("turn"), F.lit("I").alias("edit"), "x.role",
                F.lit("").alias("text"), F.lit(None).cast("string").alias("old_role"),
            )
        )
        return old.unionByName(new)

    @property
    def figures(self) -> DataFrame:
        """_conv, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation with rows."""
        counts = self._segments.join(self._chosen.select("_conv", "_seg", "cost", "between", "audit"), ["_conv", "_seg"])
        return counts.groupBy("_conv").agg(
            F.coalesce(F.max("last_turn") - F.min("first_turn") + 1 - F.sum("turns"), F.lit(0)).alias("gaps"),
            *[F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated")],
            (F.sum("illegal") + F.sum("between")).alias("illegal"),
            F.sum("cost").alias("cost"),
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_seg", "audit"))), lambda x: x["audit"]), "").alias("audit"),
        )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, by the checksum of ``conv_id:turn`` (nulls are one space)."""
    space = F.lit(" ")
    said = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), space).alias(c) for c in ("role", "text")])
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    times = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        said.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("_kind"), times.alias("_times"))
        .where("_kind <> 0")
        .withColumn("_time", F.explode("_times"))
        .drop("_kind", "_times", "_time")
    )


def _hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's repaired rows, which come in order; rows are never held."""
    schema = pa.schema([("_conv", pa.string()), ("repaired_sha256", pa.string())])
    conv, digest = None, None
    for batch in batches:
        done = []
        for c, role, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if c != conv:
                if digest is not None:
                    done.append({"_conv": conv, "repaired_sha256": digest.hexdigest()})
                conv, digest = c, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if digest is not None:
        yield pa.RecordBatch.from_pylist([{"_conv": conv, "repaired_sha256": digest.hexdigest()}], schema)


def op13_repair_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest repair and checksum of the repaired rows of every conversation, after planted damage."""
    table = read(spark, folder, "conversations")
    repair = Repair(damaged(table))
    left = repair.edits.where("edit <> 'D'").select("_conv", "role", "text", "place")
    laid = left.repartition("_conv").sortWithinPartitions("_conv", "place").select("_conv", "role", "text")
    sums = map_arrow(laid, _hash_rows, "_conv string, repaired_sha256 string")
    name = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    every = table.select("conv_id", name.alias("_conv")).distinct()
    none: dict[str, Column] = {c: F.lit(0).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    none |= {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    found = every.join(repair.figures, "_conv", "left").join(sums, "_conv", "left")
    return found.select("conv_id", *[F.coalesce(F.col(c), value).alias(c) for c, value in none.items()])
