"""Repeated stretches against a table of all of them."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

from textlake.llm import registry, suffix_levels

L = suffix_levels.LENGTH


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + L] for t in texts for i in range(len(t) - L + 1))
    out = []
    for (doc, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - L + 1):
            if seen[t[i : i + L]] > 1:
                gone[i : i + L] = b"\1" * L
        left = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def same(spark, rows, batches=4):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_levels.remove_repeats(docs, batches).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def made(seed):
    draw = random.Random(seed)

    def prose(n):
        return " ".join("".join(draw.choices("abcdeé", k=draw.randint(1, 7))) for _ in range(n))

    shared = [prose(draw.randint(60, 200)) for _ in range(6)]
    texts = [prose(draw.randint(0, 300)) for _ in range(25)]
    for _ in range(40):
        parts = []
        for _ in range(draw.randint(1, 4)):
            passage = draw.choice(shared)
            a = draw.randint(0, len(passage) // 2)
            b = draw.randint(a, len(passage))
            parts += [passage[a:b], prose(draw.randint(0, 20))]
        texts.append(draw.choice(["", " ", "x"]).join(parts))
    for _ in range(12):  # near copies
        text = list(draw.choice(texts[25:]) or "q")
        for _ in range(draw.randint(0, 3)):
            text[draw.randrange(len(text))] = "Z"
        texts.append("".join(text))
    texts += ["be " * 400, "a" * 399, "a" * 400, "a" * 1000, "xyz" * 200 + prose(150), "", "tail " * 81]
    texts += [shared[0]] * 5
    return [(i + 1, t) for i, t in enumerate(texts)]


def test_as_brute_force(spark):
    same(spark, made(1))
    same(spark, made(2), batches=7)


def test_given_documents(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(map(tuple, registry.op4_suffix_levels(spark, folder).collect()), key=repr) == brute(rows)


def test_odd_rows(spark):
    text = " ".join(f"n{i}" for i in range(300))
    same(spark, [(1, None), (None, text), (None, text[200:] + "k"), (0, ""), (2, "short"), (2, "short")])
    same(spark, [(5, text), (5, text), (6, text[:500])])
    empty = spark.createDataFrame([], "doc_id long, text string, key int")
    assert suffix_levels.remove_repeats(empty).count() == 0
