"""Quality rules: counts by brute force, the estimate against numpy, odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from textlake.llm import registry, robust_outliers
from textlake.llm.storage import Scratch

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = SPLIT.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(8)}
    lines, earlier = 0, set()
    for line in text.split("\n"):
        if SPLIT.search(line):
            lines += line in earlier
            earlier.add(line)
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, lines, len(repeated), failed


def fields(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_counts_of_whole_texts(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = registry.op1_robust_outliers(spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        assert fields(r) == counts(texts[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)


def test_outliers_go_and_the_rest_stays(spark):
    draw = random.Random(3)

    def prose(n):
        return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(1, 9))) for _ in range(n))

    rows = [(i, prose(draw.randint(25, 400)), "en", f"s{i % 3}") for i in range(400)]
    rows += [(1000 + i, " ".join(w + "%$#*&" for w in prose(100).split()), "en", "s1") for i in range(20)]
    rows += [(2000 + i, prose(150).upper() + " |" * 60, "en", "s2") for i in range(10)]
    rows += [(3000, prose(90), "fr", "s9"), (3001, prose(20_000), "en", "s0")]  # a small group, a long text
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in robust_outliers.quality_rules(docs).collect()}
    assert all(not got[i].kept for i in got if 1000 <= i < 3000)
    assert all(got[i].kept for i in got if i < 1000 or i >= 3000)


def test_duplicate_lines_alone_reject(spark):
    draw = random.Random(6)

    def prose(n):
        return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(1, 9))) for _ in range(n))

    def spread(menu, own):
        return "\n".join(x for _ in range(menu) for x in ("home news", prose(own)))

    rows = [(i, "\n".join(prose(30) for _ in range(draw.randint(1, 12))), "en", "s") for i in range(400)]
    for i in range(0, 400, 10):  # a line twice is common
        rows[i] = (i, rows[i][1] + "\n" + "\n".join(rows[i][1].split("\n")[:1]), "en", "s")
    rows += [(1000 + i, spread(30, 12), "en", "s") for i in range(15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in robust_outliers.quality_rules(docs).collect()}
    assert not any(got[1000 + i].base_failed for i in range(15))
    assert not any(got[1000 + i].kept for i in range(15))
    assert all(r.kept or r.base_failed for i, r in got.items() if i < 1000)


def test_estimate_as_in_numpy(spark):
    """The scatter of clean normal data comes out, whatever a fifth of outliers does."""
    draw = np.random.default_rng(1)
    shape = draw.standard_normal((5, 5))
    clean = draw.standard_normal((3000, 5)) @ shape.T * 2
    bad = draw.standard_normal((500, 5)) + 60
    names = list(robust_outliers.STATISTICS)
    rows = [("k", *map(float, v)) for v in np.concatenate([clean, bad])]
    vectors = spark.createDataFrame(rows, "key string, " + ", ".join(f"{n} double" for n in names))
    groups = robust_outliers.estimate(vectors, True, Scratch(spark, "test"))
    r = groups.first().asDict()
    factor = np.zeros((5, 5))
    for i, a in enumerate(names):
        for j, b in enumerate(names[: i + 1]):
            factor[i, j] = r[f"l_{a}_{b}"]
    scatter = factor @ factor.T * r["scale"]
    assert np.allclose([r[f"m_{a}"] for a in names], 0, atol=0.6)
    wanted = np.cov(clean.T)
    assert np.abs(scatter - wanted).max() < 0.15 * np.abs(wanted).max()


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(100_000))
    again = "one two three four five six seven eight nine " * 5
    rows = [(1, None, None, None), (2, "", "en", ""), (3, long, "", None), (4, again, "en", "a"), (4, again, "en", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.withColumns({"key": F.lit(1), "kept": F.lit("x"), "row": F.lit(2), "a.b": F.lit(0)})
    got = robust_outliers.quality_rules(docs).collect()
    texts = {1: None, 2: "", 3: long, 4: again}
    assert len(got) == 5
    for r in got:
        assert fields(r) == counts(texts[r.doc_id])
        assert r.kept == (r.doc_id == 3)
    kept = robust_outliers.keep_quality(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [3]
    assert robust_outliers.quality_rules(docs.limit(0)).count() == 0
