"""Structure repair of conversations: the cheapest edits, and of these the least audit.

A dynamic program runs over the rows of a conversation. Its states are what the repaired rows so
far end in (``START``, ``SYSTEM``, ``USER``, ``ASSISTANT``); its values are a cost and an audit, the edits'
initials in order. Audits are linked nodes that share their beginnings (``Audits``): two of the
same cost are compared by a search for their longest common prefix over binary-lifting
ancestors and rolling hashes.

No audit of a state is the beginning of another of the same rows: each row adds the inserts before it and
then one letter that is no ``I``. So the lesser of two audits stays the lesser whatever follows, and
a stretch of rows can be worked out by itself, for each state it may begin in. That is how
a conversation longer than ``BLOCK`` rows is divided: its rows are sorted across partitions,
blocks of them are worked out anywhere, and only their results are chained in one task. Shorter
conversations are worked out whole where a shuffle puts them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.storage import Scratch
from textlake.operators.merge import fits_broadcast

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ENDS = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
ROLES = {USER: "user", ASSISTANT: "assistant"}
# What a kept row's role may begin with, and where it leads.
LEGAL = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
PAIRS = {"su", "ua", "au"}
# The role that an edit gives a row, by the state before.
GIVEN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
# Rows worked out at a time; must be a power of two.
BLOCK_BITS = 12

BLANKS = "\\x20\\x09-\\x0D"
REPORT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
TURNS = "position bigint, role string, text string, edit string"


class Audits:
    """Strings as paths from a root, each node with a label and its ``2**k``-th ancestors."""

    BASE, PRIME = 1_000_003, (1 << 61) - 1

    def __init__(self, prime: int = PRIME):
        self.prime = prime
        self.up: list[list[int]] = [[]]
        self.label, self.hash, self.size = [""], [0], [0]
        self.collisions = 0

    def add(self, parent: int, label: str) -> int:
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        value = self.hash[parent]
        for letter in label.encode():
            value = (value * self.BASE + letter) % self.prime
        self.up.append(up)
        self.label.append(label)
        self.hash.append(value)
        self.size.append(self.size[parent] + len(label))
        return len(self.up) - 1

    def labels(self, node: int) -> list[str]:
        out = []
        while node:
            out.append(self.label[node])
            node = self.up[node][0]
        return out[::-1]

    def text(self, node: int) -> str:
        return "".join(self.labels(node))

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes spell the same; equal hashes are verified letter by letter."""
        if a == b or self.hash[a] != self.hash[b] or self.size[a] != self.size[b]:
            return a == b
        if self.text(a) == self.text(b):
            return True
        self.collisions += 1
        return False

    def less(self, a: int, b: int) -> bool:
        """Whether ``a`` spells less than ``b``; both lie equally deep, neither begins the other."""
        if a == b:
            return False
        for k in range(len(self.up[a]) - 1, -1, -1):
            if k < len(self.up[a]) and not self.same(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return self.label[a] < self.label[b]


def _moves() -> dict[tuple[str, bool, bool], list[list[tuple[int, int, str]]]]:
    """For each kind of row (initial, must go, truncated) and state reached: from where, cost, label."""
    found = {}
    for initial in ("s", "u", "a", ""):
        for gone, cut in ((False, False), (False, True), (True, False)):
            best: dict[tuple[int, int], tuple[int, str]] = {}
            for state in STATES:
                moves = [(state, DELETE, "D")]
                at, cost, label = state, TRUNCATED * cut, ""
                for _ in range(3):
                    if (at, initial) in LEGAL and not gone:
                        moves.append((LEGAL[at, initial], cost + KEEP, label + "K"))
                    if not gone:
                        moves.append((GIVEN[at], cost + REROLE, label + "R"))
                    at, cost, label = GIVEN[at], cost + INSERT, label + "I"
                for to, cost, label in moves:
                    best[state, to] = min(best.get((state, to), (cost, label)), (cost, label))
            found[initial, gone, cut] = [
                [(a, *best[a, to]) for a in STATES if (a, to) in best] for to in STATES
            ]
    return found


MOVES = _moves()


def solve(kinds: list[tuple[str, bool, bool]], begin: int = START) -> tuple[Audits, list[tuple[int, int] | None]]:
    """For each state after the rows: the least cost and the node of its least audit, or None."""
    audits = Audits()
    now: list[tuple[int, int] | None] = [None] * 4
    now[begin] = (0, 0)
    for kind in kinds:
        after: list[tuple[int, int] | None] = [None] * 4
        for to, moves in enumerate(MOVES[kind]):
            least = None
            for state, cost, label in moves:
                if now[state] is None:
                    continue
                total, node = now[state][0] + cost, now[state][1]
                if least is None or total < least[0] or (total == least[0] and audits.less(node, least[1])):
                    least = (total, node, label)
            if least:
                after[to] = (least[0], audits.add(least[1], least[2]))
        now = after
    return audits, now


def finish(audits: Audits, now: list[tuple[int, int] | None]) -> tuple[int, int, str]:
    """The cost, node and last inserts of the best whole repair."""
    best = None
    for state, last in ENDS.items():
        if now[state] is None:
            continue
        cost, node = now[state][0] + INSERT * len(last), now[state][1]
        if best is None or cost < best[0] or (cost == best[0] and audits.less(node, best[1])):
            best = (cost, node, last)
    return best


@dataclass
class Edits:
    """Applies an audit to rows as they pass."""

    state: int = START

    def inserted(self, n: int) -> Iterator[tuple[str, str, str]]:
        for _ in range(n):
            self.state = GIVEN[self.state]
            yield ROLES[self.state], "", "I"

    def row(self, role: str, text: str, letter: str) -> Iterator[tuple[str, str, str]]:
        if letter == "K":
            self.state = LEGAL[self.state, role[:1]]
            yield role, text, "K"
        elif letter == "R":
            self.state = GIVEN[self.state]
            yield ROLES[self.state], text, "R"


@dataclass
class Seen:
    """Counts over rows in order. Two of them, one after the other, add up."""

    turns: int = 0
    low: int | None = None
    high: int | None = None
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None

    def add(self, other: Seen) -> None:
        if other.low is not None:
            self.turns += other.turns - (other.low == self.high)
            self.low = other.low if self.low is None else self.low
            self.high = other.high
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if other.first is not None:
            if self.last is not None:
                self.illegal += self.last + other.first not in PAIRS
            self.first = other.first if self.first is None else self.first
            self.last = other.last

    def add_row(self, turn: int | None, initial: str, fault: str | None) -> None:
        row = Seen(int(turn is not None), turn, turn, first=initial, last=initial)
        if fault:
            setattr(row, fault, 1)
        self.add(row)

    def report(self, cost: int, audit: str, digest: str) -> list:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return [gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest]


def _kind(initial: str, fault: str | None) -> tuple[str, bool, bool]:
    initial = initial if initial in ("s", "u", "a") else ""
    return initial, fault in ("blank", "duplicate"), fault == "truncated"


@dataclass
class Conversation:
    """Rows of one conversation, gathered as a sorted stream passes."""

    rows: list[tuple] = field(default_factory=list)
    seen: Seen = field(default_factory=Seen)
    kinds: list = field(default_factory=list)
    texts: set = field(default_factory=set)

    def take(self, turn, role, text, is_blank, is_cut) -> None:
        fault = "blank" if is_blank else "duplicate" if (role, text) in self.texts else "truncated" if is_cut else None
        self.texts.add((role, text))
        self.seen.add_row(turn, role[:1], fault)
        self.kinds.append(_kind(role[:1], fault))
        self.rows.append((role, text))

    def repaired(self) -> tuple[int, str, list[tuple[str, str, str]]]:
        audits, now = solve(self.kinds)
        cost, node, last = finish(audits, now)
        edits, out = Edits(), []
        for (role, text), label in zip(self.rows, audits.labels(node), strict=True):
            out += edits.inserted(len(label) - 1)
            out += edits.row(role, text, label[-1])
        out += edits.inserted(len(last))
        return cost, audits.text(node) + last, out


def _digest(lines: list[tuple[str, str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{role}:{text}" for role, text, _ in lines).encode()).hexdigest()


def _stream(batches, *names) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(n).to_pylist() for n in names], strict=True)


def _batches(rows: Iterator[list], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[list] = []

    def made():
        columns = zip(*held, strict=True) if held else [[] for _ in schema]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield made()
            held = []
    if held:
        yield made()


def _arrow(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def marked(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with nulls of the last two as a space, and two faults of a row."""
    space = F.lit(" ")
    rows = conversations.select(
        "conv_id",
        F.col("turn").try_cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    return rows.select(
        "*",
        (~F.rlike("text", F.lit(f"[^{BLANKS}]"))).alias("is_blank"),
        (~F.rlike("text", F.lit(f"[.!?][{BLANKS}]*\\z"))).alias("is_cut"),
    )


def _in_order() -> list:
    return ["conv_id", F.asc_nulls_first("turn"), "role", "text"]


def _short(rows: DataFrame, turns: bool) -> DataFrame:
    """Conversations of a bounded number of rows, each worked out in one go."""
    spark = rows.sparkSession
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, {TURNS if turns else REPORT}"
    arrow = _arrow(spark, schema)

    def run(batches):
        names = ("conv_id", "turn", "role", "text", "is_blank", "is_cut")

        def results():
            for conv_id, own in groupby(_stream(batches, *names), lambda r: r[0]):
                conversation = Conversation()
                for row in own:
                    conversation.take(*row[1:])
                cost, audit, out = conversation.repaired()
                if turns:
                    yield from ([conv_id, i, *line] for i, line in enumerate(out))
                else:
                    yield [conv_id, *conversation.seen.report(cost, audit, _digest(out))]

        return _batches(results(), arrow)

    dealt = rows.repartition("conv_id").sortWithinPartitions(*_in_order())
    return dealt.mapInArrow(run, schema)


def _ordered(rows: DataFrame, bits: int, scratch: Scratch) -> DataFrame:
    """The rows in one order over all partitions, stored with ``pos`` and ``block``.

    A conversation of any length is divided by the sort; only rows equal in all columns stay together.
    """
    dealt = rows.repartitionByRange(*_in_order()).sortWithinPartitions(*_in_order())
    placed = dealt.withColumn("pos", F.monotonically_increasing_id())
    return scratch.keep(placed.withColumn("block", F.shiftright("pos", bits)), "ordered")


SEEN_FIELDS = ("turns", "low", "high", "blank", "duplicate", "truncated", "illegal", "first", "last")
BLOCKS = (
    "turns bigint, low bigint, high bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "first string, last string, costs array<bigint>, audits array<string>"
)


def _blocks(ordered: DataFrame) -> DataFrame:
    """For each conversation and block: its counts, and cost and audit from each state to each."""
    spark = ordered.sparkSession
    kind = ordered.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, block bigint, {BLOCKS}"
    arrow = _arrow(spark, schema)
    # Where each role and text of a conversation stands first; copies are combined before the shuffle.
    firsts = ordered.groupBy("conv_id", "role", "text").agg(F.min("block").alias("block"), F.min("pos").alias("pos"))
    nothing = {"conv_id": kind, "turn": "bigint", "initial": "string", "is_blank": "boolean", "is_cut": "boolean"}
    marks = firsts.select(
        "block", "pos", F.lit(0).alias("row"), *[F.lit(None).cast(t).alias(n) for n, t in nothing.items()]
    )
    light = ordered.select(
        "block", "pos", F.lit(1).alias("row"), "conv_id", "turn",
        F.substring("role", 1, 1).alias("initial"), "is_blank", "is_cut",
    )

    def summary(conv_id, block, seen, kinds):
        costs, texts = [], []
        for begin in STATES:
            audits, now = solve(kinds, begin)
            costs += [None if x is None else x[0] for x in now]
            texts += [None if x is None else audits.text(x[1]) for x in now]
        return [conv_id, block, *[getattr(seen, n) for n in SEEN_FIELDS], costs, texts]

    def run(batches):
        def results():
            first_at = None
            key, seen, kinds = None, None, None
            for block, pos, row, conv_id, turn, initial, is_blank, is_cut in _stream(
                batches, "block", "pos", "row", "conv_id", "turn", "initial", "is_blank", "is_cut"
            ):
                if not row:
                    first_at = pos
                    continue
                if key != (conv_id, block):
                    if key is not None:
                        yield summary(*key, seen, kinds)
                    key, seen, kinds = (conv_id, block), Seen(), []
                fault = "blank" if is_blank else "duplicate" if pos != first_at else "truncated" if is_cut else None
                seen.add_row(turn, initial, fault)
                kinds.append(_kind(initial, fault))
            if key is not None:
                yield summary(*key, seen, kinds)

        return _batches(results(), arrow, 16)

    dealt = marks.unionByName(light).repartition("block").sortWithinPartitions("block", "pos", "row")
    return dealt.mapInArrow(run, schema)


LAST = (1 << 63) - 1


def _chained(blocks: DataFrame) -> DataFrame:
    """The blocks of each conversation put together: its report, and each block's chosen audit.

    ``block`` is null in the row with the whole report and ``LAST`` in the one with the last inserts.
    What is held of a conversation is its audit so far, in the states still open.
    """
    spark = blocks.sparkSession
    kind = blocks.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, block bigint, {REPORT}"
    arrow = _arrow(spark, schema)

    def chained(conv_id, own):
        audits, now, seen, numbers = Audits(), [(0, 0), None, None, None], Seen(), []
        for block, costs, texts, *counts in own:
            numbers.append(block)
            seen.add(Seen(**dict(zip(SEEN_FIELDS, counts, strict=True))))
            after: list[tuple[int, int] | None] = [None] * 4
            for to in STATES:
                least = None
                for state in STATES:
                    if now[state] is None or costs[4 * state + to] is None:
                        continue
                    total, node = now[state][0] + costs[4 * state + to], now[state][1]
                    if least is None or total < least[0] or (total == least[0] and audits.less(node, least[1])):
                        least = (total, node, texts[4 * state + to])
                if least:
                    after[to] = (least[0], audits.add(least[1], least[2]))
            now = after
        cost, node, last = finish(audits, now)
        labels = audits.labels(node)
        empty = [None] * 6
        for block, label in zip(numbers, labels, strict=True):
            yield [conv_id, block, *empty, label, None]
        yield [conv_id, LAST, *empty, last, None]
        yield [conv_id, None, *seen.report(cost, "".join(labels) + last, "")]

    def run(batches):
        def results():
            names = ("conv_id", "block", "costs", "audits", *SEEN_FIELDS)
            for conv_id, own in groupby(_stream(batches, *names), lambda r: r[0]):
                yield from chained(conv_id, (row[1:] for row in own))

        return _batches(results(), arrow, 64)

    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(run, schema)


def _edited(ordered: DataFrame, labels: DataFrame, bits: int, turns: bool) -> DataFrame:
    """The rows of each conversation pass in order, and their edits with them."""
    spark = ordered.sparkSession
    kind = ordered.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, {TURNS if turns else 'repaired_sha256 string'}"
    arrow = _arrow(spark, schema)
    at = F.when(F.col("block") == LAST, F.lit(LAST)).otherwise(F.shiftleft("block", bits))
    marks = labels.select(
        "conv_id", at.alias("pos"), F.lit(0).alias("row"), F.col("audit").alias("role"), F.lit("").alias("text")
    )
    rows = ordered.select("conv_id", "pos", F.lit(1).alias("row"), "role", "text")

    def lines(own):
        edits, letters = Edits(), iter("")
        for _, pos, row, role, text in own:
            if row:
                letter = next(letters)
                while letter == "I":
                    yield from edits.inserted(1)
                    letter = next(letters)
                yield from edits.row(role, text, letter)
            elif pos == LAST:
                yield from edits.inserted(len(role))
            else:
                letters = iter(role)

    def run(batches):
        def results():
            stream = _stream(batches, "conv_id", "pos", "row", "role", "text")
            for conv_id, own in groupby(stream, lambda r: r[0]):
                if turns:
                    yield from ([conv_id, i, *line] for i, line in enumerate(lines(own)))
                    continue
                digest, between = hashlib.sha256(), b""
                for role, text, _ in lines(own):
                    digest.update(between + f"{role}:{text}".encode())
                    between = b"\n"
                yield [conv_id, digest.hexdigest()]

        return _batches(results(), arrow)

    dealt = marks.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "pos", "row")
    return dealt.mapInArrow(run, schema)


def _repair(conversations: DataFrame, turns: bool, bits: int) -> DataFrame:
    scratch = Scratch(conversations.sparkSession, "conversations")
    rows = marked(conversations)
    long = rows.groupBy(F.col("conv_id").alias("_conv_id")).count().where(F.col("count") > 1 << bits)
    long = scratch.keep(long.select("_conv_id"), "long")
    if long.isEmpty():
        return _short(rows, turns)
    # One conversation in 2**bits rows at most; sent to the rows where they are measured to be few.
    ids = F.broadcast(long) if fits_broadcast(long) else long
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id"))
    ordered = _ordered(rows.join(ids, same, "left_semi"), bits, scratch)
    chained = scratch.keep(_chained(_blocks(ordered)), "chained")
    edited = _edited(ordered, chained.where("block IS NOT NULL"), bits, turns)
    if not turns:
        digests = edited.select(F.col("conv_id").alias("_conv_id"), F.col("repaired_sha256"))
        report = chained.where("block IS NULL").drop("block", "repaired_sha256")
        edited = report.join(digests, same).drop("_conv_id")
    return _short(rows.join(ids, same, "left_anti"), turns).unionByName(edited)


def repair_report(conversations: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """One row for each ``conv_id``: faults found, the cheapest repair's cost and audit, and its digest.

    Takes ``conv_id, turn, role, text``, looks at no other column, and orders a conversation's rows by turn, nulls
    first; of equal turns by role and text, so that repeated rows stand together and ties have one
    order. A null role or text counts as one space, a null ``conv_id`` as a conversation of its own. Initials
    are the first characters of roles; an empty role has none and is legal beside nothing. Texts may have
    any length and are never cut. An empty table gives no rows. Conversations of more than ``2**bits`` rows
    are worked out in blocks.
    """
    return _repair(conversations, False, bits)


def repaired_turns(conversations: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """``conv_id, position, role, text, edit`` of the repaired conversations; ``edit`` is K, R or I.

    Rows are read as ``repair_report`` reads them. A conversation of which nothing is kept has no rows.
    """
    return _repair(conversations, True, bits)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by the CRC-32 of ``conv_id:turn``, modulo 20: see ``repair_query``."""
    space = F.lit(" ")
    number = [F.coalesce(F.col(n).cast("string"), space) for n in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *number)) % 20
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        fault.alias("fault"),
    ).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def repair_query(conversations: DataFrame) -> DataFrame:
    """The report on damaged conversations, with a row for each that lost all of its rows, too."""
    report = repair_report(damaged(conversations))
    ids = conversations.select(F.col("conv_id").alias("_conv_id")).distinct()
    numbers = [n.split()[0] for n in REPORT.split(", ") if n.endswith("bigint")]
    nothing = hashlib.sha256(b"").hexdigest()
    return ids.join(report, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").select(
        F.col("_conv_id").alias("conv_id"),
        *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
