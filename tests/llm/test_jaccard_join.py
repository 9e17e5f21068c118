"""Near copies against all pairs."""

from __future__ import annotations

import random
import re
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textlake.llm import jaccard_join, registry
from textlake.llm.components import components
from textlake.llm.storage import BATCH_BYTES, FREE_SHUFFLES, Scratch
from textlake.llm.words import run_hash, shingles, slices, words

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k):
    words = SPLIT.findall((text or "").translate(FOLD))
    if 0 < len(words) < k:
        return {tuple(words)}
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, percent):
    """Component by place in ``rows`` of (doc_id, text)."""
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows)]


def same(spark, rows, k, percent):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnsRenamed({})
    got = sorted(map(tuple, jaccard_join.near_copies(docs, k, percent).collect()), key=repr)
    assert got == sorted(brute(rows, k, percent), key=repr)


def made(seed, n=260):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    common = " ".join(draw.choices(vocabulary, k=30))
    texts = []
    for _ in range(n):
        kind = draw.random()
        if kind < 0.45 and texts:
            words = draw.choice(texts).split() or ["x"]
            for _ in range(draw.randint(0, 4)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            texts.append(" ".join(words))
        elif kind < 0.6:
            texts.append(common + " " + " ".join(draw.choices(vocabulary, k=draw.randint(0, 60))))
        else:
            texts.append(" ".join(draw.choices(vocabulary, k=draw.randint(0, 90))))
    # A large group of different near copies, and one of exact ones.
    base = draw.choices(vocabulary, k=80)
    for i in range(70):
        own = list(base)
        own[draw.randrange(80)] = f"own{i}"
        texts.append(" ".join(own))
    texts += ["The SAME text again and Again here"] * 60
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed, k, percent", [(1, 3, 90), (2, 5, 80), (3, 3, 60)])
def test_as_all_pairs(spark, seed, k, percent):
    same(spark, made(seed), k, percent)


def test_given_documents(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted(map(tuple, registry.op3_jaccard_join(spark, folder).collect()))
    assert got == sorted(brute(rows, 3, 90))


def test_odd_rows(spark):
    long = " ".join(f"v{i % 5000}x{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one two"), (5, "ONE  two"), (6, long), (7, long + " end")]
    rows += [(None, "one two"), (None, "lonely words here now"), (6, long), (2, "")]
    same(spark, rows, 3, 90)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert jaccard_join.near_copies(docs.limit(0)).count() == 0
    wide = docs.selectExpr("*", "'x' AS node", "1 AS tokens", "2 AS component_id")
    kept = jaccard_join.keep_one(wide, 3, 90)
    assert kept.columns == wide.columns
    got = sorted(((r.doc_id, (r.text or "")[:8]) for r in kept.collect()), key=repr)
    assert got == sorted(
        [(1, ""), (2, ""), (3, " \n "), (4, "one two"), (6, long[:8]), (None, "lonely w")], key=repr
    )


def test_different_texts_that_share_a_number(spark):
    copied = " ".join(f"c{i}" for i in range(60))
    own = " ".join(f"o{i}" for i in range(60))
    rows = [(1, copied), (5, copied + " end"), (5, own), (6, own + " more"), (6, own + " again"), (6, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in jaccard_join.keep_one(docs, 3, 80).collect())
    assert got == sorted([(1, copied), (5, own), (6, "alone here")])


def test_components_of_chains_and_stars(spark):
    draw = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)]
    edges += [(draw.randint(1000, 1100), draw.randint(1000, 1100)) for _ in range(70)]
    draw.shuffle(edges)
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else find(parent[x])

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.component for r in components(df, Scratch(spark, "test")).collect()}
    assert got == {x: find(x) for u, v in edges if u != v for x in (u, v)}


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8])
def test_shingles_of_slices_with_few_words(size):
    for n in range(10):
        for texts in ([" ".join(f"w{i}" for i in range(n))], [f"w{i}" for i in range(n)]):
            (piece,) = slices(pa.array([*texts, None]))
            found = words(piece)
            made, first = shingles(found, size)
            assert first.tolist()[-1] == len(made)
            for row, text in enumerate(texts):
                own = made[first[row] : first[row + 1]].tolist()
                parts = found.hash[found.first[row] : found.first[row + 1]]
                count = len(text.split())
                runs = [parts[i : i + size] for i in range(max(count - size + 1, min(count, 1)))]
                assert own == [run_hash(r) for r in runs]


def test_stored_tables_leave_no_shuffles(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {b for b in blocks.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}

    before, setting = shuffles(), spark.conf.get(FREE_SHUFFLES)
    rows = spark.range(10_000).groupBy((F.col("id") % 1000).alias("key")).count()
    kept = Scratch(spark, "shuffles").keep(rows, "counts")
    for _ in range(50):  # the files go in the background
        left = shuffles() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and kept.count() == 1000 and spark.conf.get(FREE_SHUFFLES) == setting


def test_sets_are_read_again_only_as_far_as_needed(spark, monkeypatch):
    draw = random.Random(5)
    common = " ".join(f"c{i}" for i in range(60))
    texts = [common + " " + " ".join(f"w{draw.randrange(10**6)}" for _ in range(140)) for _ in range(60)]
    texts += [t.rsplit(" ", 3)[0] + " x y z" for t in texts[:20]]
    far = []
    plain = jaccard_join._set_rows

    def seen(documents, size, percent, whole, times=1):
        far.append("whole" if whole else times)
        return plain(documents, size, percent, whole, times)

    monkeypatch.setattr(jaccard_join, "_set_rows", seen)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.near_copies(docs, size=3, percent=90).collect()}
    assert got == {i: i if i < 60 else i - 60 for i in range(80)}
    assert jaccard_join.DEEPER in far


@pytest.mark.parametrize("told", [64, 1])
def test_a_pair_of_a_large_group_comes_once(spark, monkeypatch, told):
    # Some copies are changed little and many a lot: few links, no one text that reaches all.
    draw = random.Random(6)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(90):
        own = list(base)
        for at in draw.sample(range(120), draw.choice([1, 2, 3, 4])):
            own[at] = f"own{i}x{at}"
        rows.append((i, " ".join(own)))
    met, plain = [], jaccard_join._candidates

    def seen(pairs, percent):
        met.append((pairs.count(), pairs.select("u", "v").distinct().count()))
        return plain(pairs, percent)

    monkeypatch.setattr(jaccard_join, "_candidates", seen)
    monkeypatch.setattr(jaccard_join, "TOLD", told, raising=False)
    monkeypatch.setattr(jaccard_join, "CLOSE", 0, raising=False)
    same(spark, rows, 3, 90)
    last, pairs = met[-1]
    assert last >= pairs
    if told > 1:
        # Every pair by its own row; before, one for each list that both are in.
        assert last == pairs


def test_sets_are_made_of_few_bytes_at_a_time(spark):
    docs = spark.range(2000, numPartitions=1).selectExpr("id AS doc_id", "repeat(concat(id, ' '), 2000) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    scratch = Scratch(spark, "batches", jaccard_join.BATCH_BYTES)
    before = spark.conf.get(BATCH_BYTES)
    most = scratch.keep(docs.mapInArrow(sizes, "n long"), "sizes").agg(F.max("n")).first()[0]
    assert most < 2 * jaccard_join.BATCH_BYTES and spark.conf.get(BATCH_BYTES) == before
