"""Repairs against every possible edit, blocks against whole conversations."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from textlake.llm import conversation_repair as cr

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLANK = re.compile(r"[\x20\x09-\x0D]*")
GOOD = re.compile(r"(s?(ua)+)?")


def ordered(rows):
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def faults(rows):
    out, seen = [], set()
    for _, _, role, text in rows:
        ink = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def every_edit(rows, found):
    """The least cost, audit and lines over all keeps, deletes, reroles and inserts of up to two rows."""
    choices = []
    for (_, _, role, text), fault in zip(rows, found, strict=True):
        cut = 5 * (fault == "truncated")
        own = [(2, "D", [])]
        if fault not in ("blank", "duplicate"):
            own.append((cut, "K", [(role, text)]))
            own += [(1 + cut, "R", [(to, text)]) for to in ("user", "assistant")]
        choices.append(own)
    u, a = ("user", ""), ("assistant", "")
    added = [(0, "", []), (5, "I", [u]), (5, "I", [a]), (10, "II", [u, a]), (10, "II", [a, u])]
    best = None
    parts = [added, *itertools.chain.from_iterable((own, added) for own in choices)]
    for edits in itertools.product(*parts):
        lines = [line for e in edits for line in e[2]]
        if GOOD.fullmatch("".join(role[:1] or "-" for role, _ in lines)):
            this = (sum(e[0] for e in edits), "".join(e[1] for e in edits), lines)
            best = min(best or this, this)
    return best


def wanted(rows):
    rows = ordered(rows)
    found = faults(rows)
    turns = {t for _, t, _, _ in rows if t is not None}
    initials = [r[2][:1] for r in rows]
    cost, audit, lines = every_edit(rows, found)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(found.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(x + y not in ("su", "ua", "au") for x, y in itertools.pairwise(initials)),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
    )


def made(rng, n, texts=("a.", "b!", "cut", " ", "", "ä?", None)):
    return [
        (rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(texts))
        for _ in range(n)
    ]


def reports(spark, rows, bits=12, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return {r["conv_id"]: tuple(r)[1:] for r in cr.repair_report(df, bits).collect()}


def conversations(seed, count, longest):
    rng = random.Random(seed)
    return [(c, *row) for c in range(count) for row in made(rng, rng.randint(1, longest))]


def test_same_as_every_edit(spark):
    rows = conversations(1, 60, 3)
    got = reports(spark, rows)
    for conv_id in range(60):
        assert got[conv_id] == wanted([r for r in rows if r[0] == conv_id]), conv_id


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_blocks_give_the_same(spark, bits):
    """Conversations cut into blocks of a few rows, one of them with most of the rows."""
    rng = random.Random(2)
    rows = conversations(3, 12, 20) + [(99, *row) for row in made(rng, 150, ("a.", "b!", "c?", "d.", "cut", ""))]
    assert reports(spark, rows, bits) == reports(spark, rows)


@pytest.mark.parametrize("bits", [2, 12])
def test_repaired_turns_are_what_the_digest_is_of(spark, bits):
    rows = conversations(4, 20, 12)
    df = spark.createDataFrame(rows, SCHEMA)
    turns = cr.repaired_turns(df, bits).orderBy("conv_id", "position").collect()
    for conv_id, report in reports(spark, rows, bits).items():
        own = [r for r in turns if r["conv_id"] == conv_id]
        assert [r["position"] for r in own] == list(range(len(own)))
        assert GOOD.fullmatch("".join(r["role"][:1] for r in own))
        lines = "\n".join(f"{r['role']}:{r['text']}" for r in own)
        assert hashlib.sha256(lines.encode()).hexdigest() == report[-1]
        assert "".join(r["edit"] for r in own) == report[-2].replace("D", "")


def test_audits_compare_as_their_texts():
    """Also where nearly all hashes are equal: each equality is verified."""
    rng = random.Random(5)
    for prime in (cr.Audits.PRIME, 2):
        audits, level = cr.Audits(prime), [0]
        for _ in range(40):
            level = [audits.add(n, label) for n in level for label in rng.sample(["D", "K", "R", "IK", "IIR"], 2)]
            level = rng.sample(level, min(len(level), 4))
            for a, b in itertools.permutations(level, 2):
                assert audits.less(a, b) == (audits.text(a) < audits.text(b))
        assert bool(audits.collisions) == (prime == 2)


def test_long_conversation_of_copies(spark):
    """Thousands of equal rows: one is kept or all go; nothing grows with their square."""
    rows = [(1, 5, "user", "same.")] * 3000 + [(1, 6, "assistant", "yes.")]
    got = reports(spark, rows, 6)[1]
    assert got[:6] == (0, 0, 2999, 0, 2999, 5998)
    assert got[6] == "D" * 0 + "K" + "D" * 2999 + "K"


def test_odd_tables(spark):
    rows = [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (7, None, None, None), (8, 3, "user", "x " * 200_000 + ".")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS pos", "2 AS block", "'x' AS audit", "3 AS _conv_id")
    for bits in (0, 12):
        got = {r["conv_id"]: tuple(r)[1:] for r in cr.repair_report(df, bits).collect()}
        assert got == {k: wanted([r for r in rows if r[0] == k]) for k in (None, 7, 8)}
    assert cr.repair_report(df.limit(0)).count() == cr.repaired_turns(df.limit(0)).count() == 0
    assert cr.repair_query(df.limit(0)).count() == 0


def test_damage_and_empty_conversations(spark):
    """Every fault of the query by hand, and conversations that lose all rows."""
    rows = [(c, t, r, "One. Two!") for c in range(120) for t, r in [(0, "user"), (1, "assistant")][: 1 + c % 2]]
    df = spark.createDataFrame(rows, SCHEMA)
    left = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = "" if fault == 1 else "One Two" if fault == 2 else text
        left += [(c, t, "user" if fault == 4 else role, text)] * (0 if not fault else 2 if fault == 3 else 1)
    damaged = [tuple(r) for r in cr.damaged(df).collect()]
    assert sorted(damaged) == sorted(left)
    got = {r["conv_id"]: tuple(r)[1:] for r in cr.repair_query(df).collect()}
    assert set(got) == set(range(120))
    lost = set(got) - {r[0] for r in left}
    assert lost
    for c in got:
        own = [r for r in left if r[0] == c]
        assert got[c] == (wanted(own) if own else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))


def test_nulls_are_damaged_as_a_space(spark):
    df = spark.createDataFrame([(None, None, None, None)], SCHEMA)
    fault = zlib.crc32(b" : ") % 20
    assert fault > 4
    row = cr.damaged(df).select(F.concat("role", "text")).first()
    assert row[0] == "  "
