"""The learned operators: language model, toxicity, mixing."""

from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from textlake.llm import attention_lm as lm
from textlake.llm import registry, soft_mixing, toxicity
from textlake.llm.storage import Scratch, held_out
from textlake.llm.words import slices

PATH = public_tokenizers.path("word_bpe_49k.json")
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return SPLIT.findall((text or "").translate(FOLD)) + [None]


def base_scores(rows):
    train = Counter(t for d, x in rows if zlib.crc32(str(d).encode()) % 5 != 1 for t in tokens(x))
    n, v = sum(train.values()), len(train)
    return n, {
        (d, x): (
            sum(math.log10((train[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x)),
            sum(train[t] > 0 for t in tokens(x)),
        )
        for d, x in rows
    }


@pytest.mark.parametrize("head", [lm.HEAD, 500])
def test_base_scores(spark, folder, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    n, wanted = base_scores(rows)
    texts = dict(rows)
    got = registry.op2_attention_lm(spark, folder).collect()
    assert len(got) == len(rows)
    for r in got:
        base, known = wanted[r.doc_id, texts[r.doc_id]]
        assert r.train_tokens == n and r.n_known == known and r.n_tokens == len(tokens(texts[r.doc_id]))
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
        assert r.score < 0


def test_scores_do_not_depend_on_the_head(spark, folder, monkeypatch):
    monkeypatch.setattr(lm, "ROUNDS", 0)
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").limit(300)
    rows = rows.union(spark.createDataFrame([(-1, "rare words twice rare words twice"), (-2, None)], rows.schema))

    def scores(head):
        monkeypatch.setattr(lm, "HEAD", head)
        got = lm.score_documents(rows, held_out(F.col("doc_id"), 1), PATH).collect()
        return {r.doc_id: r.score for r in got}

    whole = scores(1 << 20)
    for head in (500, 0):
        some = scores(head)
        assert some.keys() == whole.keys()
        assert all(math.isclose(some[d], whole[d], rel_tol=1e-9) for d in whole)


def small_model():
    counts = np.zeros(lm.vocabulary_size(PATH), np.int64)
    counts[:4000] = np.arange(4000, 0, -1)
    class_of, within, bias = lm.class_table(counts, 50)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return lm.Learned(*none, True, 0, 0, 50, class_of, within, lm.packed(lm.initial(bias)), PATH)


def test_gradients_are_the_slopes():
    draw = np.random.default_rng(0)
    model = {k: v.astype(np.float64) for k, v in lm.initial(np.zeros(lm.CLASSES)).items()}
    inputs = draw.integers(0, lm.CLASSES, (2, 2 * lm.STRIDE))
    there = np.ones_like(inputs, bool)
    there[0, :20] = False
    wanted = draw.integers(0, lm.CLASSES, (2, lm.STRIDE))

    def loss():
        scored = there[:, lm.STRIDE :]
        return -lm.log_scores(model, inputs, there, wanted)[scored].mean()

    slopes = lm.gradients(model, inputs, there, wanted)
    for name, weights in model.items():
        at = tuple(draw.integers(0, n) for n in weights.shape)
        if name == "embed":
            at = (inputs[1, 20], 3)
        old = weights[at]
        weights[at] = old + 1e-4
        up = loss()
        weights[at] = old - 1e-4
        down = loss()
        weights[at] = old
        assert math.isclose((up - down) / 2e-4, slopes[name][at], rel_tol=2e-2, abs_tol=2e-5), name


def test_each_token_is_scored_once_after_what_stands_before():
    learned = small_model()
    model = lm.Scorer(lm.unpacked(learned.flat))
    texts = ["", "one", "a longer text of some words " * 20, "x " * 16, None, "last words here"]
    at, there = lm.windows(np.array([0, 1, 40, 40, 57]))
    scored = at[:, lm.STRIDE :][there[:, lm.STRIDE :]]
    assert sorted(scored.tolist()) == list(range(57))

    def scores(values, limit=1 << 21):
        out = []
        for piece in slices(pa.array(values, pa.string()), limit):
            read = lm.Read(piece, PATH)
            out += lm.score_slice(read, learned, model, np.zeros(len(read.hash))).tolist()
        return out

    together = scores(texts)
    assert np.allclose(together, scores(texts, 1))  # alone or with others
    changed = scores([texts[2] + " more"])[0]
    assert changed < together[2]  # what comes after changes nothing before


def test_training_lowers_the_loss():
    draw = random.Random(0)
    texts = [" ".join("abcdefghij"[(s + i) % 10] for i in range(200)) for s in draw.choices(range(10), k=200)]
    learned = small_model()
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    made = list(lm._learn_rows([batch], PATH, learned.class_of, learned.flat, 0.01))[0]
    flat = made.column("value").to_numpy() / made.column("weight").to_numpy()
    read = lm.Read(next(slices(pa.array(texts[:5]))), PATH)
    zero = np.zeros(len(read.hash))
    before = lm.score_slice(read, learned, lm.Scorer(lm.unpacked(learned.flat)), zero).sum()
    after = lm.score_slice(read, learned, lm.Scorer(lm.unpacked(flat)), zero).sum()
    assert after > 0.7 * before


def test_windows_wait_without_being_copied_for_each_step(monkeypatch):
    draw = random.Random(1)
    texts = [" ".join(draw.choices(["some", "words", "to", "learn"], k=900)) for _ in range(60)]
    taken, copied = [], []
    monkeypatch.setattr(lm.Steps, "take", lambda self, *parts: taken.append(parts))
    joined = np.concatenate

    def concatenate(arrays, *rest, **named):
        made = joined(arrays, *rest, **named)
        copied.append(len(made) if made.ndim == 2 else 0)
        return made

    learned = small_model()
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 20])], names=["text"]) for i in (0, 20, 40)]
    monkeypatch.setattr(np, "concatenate", concatenate)
    assert not list(lm._learn_rows(batches, PATH, learned.class_of, learned.flat, 0.01))
    monkeypatch.undo()
    # All windows, in order, and as many at a time as ever.
    inputs, wanted, _, begins = lm._classes(lm.Read(next(slices(pa.array(texts))), PATH), learned.class_of)
    at, there = lm.windows(begins)
    at = at.clip(0, len(inputs) - 1)
    for got, whole in zip(zip(*taken, strict=True), (inputs[at], there, wanted[at[:, lm.STRIDE :]]), strict=True):
        assert [len(g) for g in got[:-1]] == [lm.BATCH] * (len(got) - 1) and 0 < len(got[-1]) <= lm.BATCH
        assert np.where(there[:, -len(whole[0]) :], whole, 0).tolist() == np.where(
            there[:, -len(whole[0]) :], joined(got), 0
        ).tolist()
    # Three arrays of windows, each joined once or twice.
    assert sum(copied) <= 6 * len(at)


@pytest.mark.parametrize("text", ["a few words", "other words here", "one more of them", "and the last text"])
def test_every_training_text_is_learned_from(spark, text):
    rows = spark.createDataFrame([(text,)], "text string")
    learned, counts = lm.train(rows, PATH, Scratch(spark, "test"))
    subwords = np.zeros(lm.vocabulary_size(PATH), np.int64)
    read = lm.Read(next(slices(pa.array([text]))), PATH)
    np.add.at(subwords, read.sequence()[0], 1)
    first = lm.packed(lm.initial(lm.class_table(subwords, 1)[2]))
    assert not np.allclose(learned.flat, first)


def test_language_model_on_odd_rows(spark):
    rows = [(1, None), (None, ""), (3, " \u0085 \x1c"), (4, "word " * 40_000), (5, "some Words é"), (5, "some Words é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS tail")
    got = lm.score_documents(docs, held_out(F.col("doc_id"), 1), PATH).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(tokens(t)) for _, t in rows)
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert lm.score_documents(docs.limit(0), F.lit(False), PATH).count() == 0
    assert lm.score_documents(docs, F.lit(True), PATH).count() == 6  # nothing to learn from


# --- toxicity ----------------------------------------------------------------


def test_grammar_reads_clauses():
    none, insult, threat, target, negation, report = range(6)

    def score(*symbols):
        return toxicity.clause_score(list(symbols), [1.0 if s in (insult, threat) else 0.0 for s in symbols])

    assert score(insult) == 1.0
    assert score(negation, insult) < 0.5 < score(negation, none, none, none, insult)
    assert score(report, none, insult) < score(insult) < score(target, insult)
    assert score(threat) < 0.2 < score(target, threat)
    assert score(report, negation, insult) < score(negation, insult)
    assert score(none, target) == 0.0


def made_toxic(n=600):
    draw = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{draw.randint(0, 400)}" for _ in range(draw.randint(5, 200))]
        toxic = i % 5 == 0
        for _ in range(draw.randint(2, 5) * toxic):
            words.insert(draw.randint(0, len(words)), draw.choice(["Grobian,", "rotten!", "idiot"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_learned_from_labels(spark):
    rows, labels = made_toxic()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    usable = ~held_out(F.col("doc_id"), 0)
    model = toxicity.train(docs, marks, usable)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    wrong = [i for i, toxic in labels if got[i].predicted != toxic]
    assert len(wrong) <= 6
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    # A label of the held-out fold changes nothing.
    turned = marks.withColumn("toxic", F.when(held_out(F.col("doc_id"), 0), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.train(docs, turned, usable)
    assert np.array_equal(again.hashes, model.hashes) and again.slope == model.slope


def test_functions_travel_without_tables(spark):
    toxicity.word_hash("idiot")  # what the driver hashes stays there
    sent = cloudpickle.dumps(toxicity.score_texts)
    assert len(sent) < 1_000_000
    model = toxicity.Model(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0), -2.0, 1.0)
    score = cloudpickle.loads(sent)
    assert score(pa.array(["you idiot", None]), model).tolist() == [1 / (1 + math.exp(2))] * 2


def test_learning_leaves_no_texts_behind(spark, monkeypatch):
    made = []
    monkeypatch.setattr(toxicity, "Scratch", lambda *a: made.append(Scratch(*a)) or made[-1])
    docs = spark.createDataFrame([(1, "you idiot"), (2, "fine")], "doc_id long, text string")
    for labels in ([(1, 1), (2, 0)], [(1, 1), (2, 1)]):
        toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    assert len(made) == 2 and not [f for s in made for f in Path(s.root.split(":", 1)[-1]).rglob("*.parquet")]


def test_toxicity_on_odd_rows(spark):
    rows = [(1, None), (None, ""), (3, "idiot you moron, " * 30_000), (4, "!!! ... ,"), (5, "you idiot"), (5, "you idiot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS toxic", "'a' AS score")
    labels = spark.createDataFrame([(1, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    got = toxicity.score_documents(docs, model).collect()
    assert len(got) == 6 and {r.score for r in got if r.doc_id in (1, None, 4)} == {1 / (1 + math.exp(2))}
    assert toxicity.score_documents(docs.limit(0), model).count() == 0


def test_toxicity_of_given_documents(spark, folder):
    got = {r.doc_id: r for r in registry.op7_toxicity(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(rows)
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


# --- mixing ------------------------------------------------------------------


def test_rates_bring_the_targets(spark):
    draw = np.random.default_rng(5)
    p = draw.dirichlet([0.4, 0.3, 0.2], 2000)
    n = draw.integers(0, 3000, 2000)
    rows = spark.createDataFrame(
        [(i, int(k), [float(x) for x in q]) for i, (k, q) in enumerate(zip(n, p, strict=True))],
        "doc_id long, n_tokens long, p array<double>",
    )
    targets = {"a": 0.8, "b": 0.13, "c": 0.07}
    steps = soft_mixing.fit_rates(rows, targets)
    rate = np.array([r.r for r in rows.withColumn("r", soft_mixing._rate(steps)).orderBy("doc_id").collect()])
    assert (rate >= 0).all() and (rate == 0).any()
    totals = (rate * n) @ p
    assert np.allclose(totals / n.sum(), list(targets.values()), atol=2e-4)
    # The same steps in numpy.
    other = np.ones(len(n))
    for step in steps:
        other = np.maximum(0, other - p @ step)
    assert np.allclose(rate, other)


@pytest.mark.parametrize("wanted", [[0.9, 0.07, 0.03], [0.92, 0.06, 0.02], [0.8, 0.13, 0.07], [0.05, 0.05, 0.9]])
def test_rates_meet_the_tolerance(spark, wanted):
    draw = np.random.default_rng(5)
    p = draw.dirichlet([0.4, 0.3, 0.2], 2000)
    n = draw.integers(0, 3000, 2000)
    rows = spark.createDataFrame(
        [(int(k), [float(x) for x in q]) for k, q in zip(n, p, strict=True)], "n_tokens long, p array<double>"
    )
    steps = soft_mixing.fit_rates(rows, dict(zip("abc", wanted, strict=True)))
    rate = np.ones(len(n))
    for step in steps:
        rate = np.maximum(0, rate - p @ step)
    assert np.abs((rate * n) @ p / n.sum() - wanted).max() <= soft_mixing.TOLERANCE


@pytest.mark.parametrize("poor, toxic", [(0.005, 0.12), (0, 0.12), (0.005, 0.02), (0, 0), (0.2, 0.2)])
def test_clean_documents_stay(spark, poor, toxic):
    draw = np.random.default_rng(8)
    kind = draw.choice(3, 4000, p=[1 - poor - toxic, poor, toxic])
    p = np.stack([draw.dirichlet(np.where(np.arange(3) == k, 40, 0.5)) for k in kind])
    n = draw.integers(20, 3000, 4000)
    rows = spark.createDataFrame(
        [(i, int(k), [float(x) for x in q]) for i, (k, q) in enumerate(zip(n, p, strict=True))],
        "doc_id long, n_tokens long, p array<double>",
    )
    steps = soft_mixing.fit_rates(rows, least=soft_mixing.clean_least())
    rated = rows.withColumn("r", soft_mixing._rate(steps, soft_mixing.clean_least()))
    rate = np.array([r.r for r in rated.orderBy("doc_id").collect()])
    assert (rate[p[:, 0] > 0.5] >= 1).all()
    there = [True, poor > 0, toxic > 0]
    totals = ((rate * n) @ p)[there]
    wanted = np.array(list(soft_mixing.TARGETS.values()))[there]
    assert np.allclose(totals / totals.sum(), wanted / wanted.sum(), atol=1e-5)


def test_plain_documents_alone_all_stay(spark):
    rows, labels = made_toxic(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1, toxic) for i, toxic in labels], "doc_id long, quality int, toxic int")
    plain = docs.join(marks.where("toxic = 0").select("doc_id"), "doc_id")
    assert soft_mixing.mixed_documents(plain, marks).count() == 240


def test_targets_out_of_reach_are_reported(spark):
    rows = [(100, [0.6, 0.4, 0.0]), (100, [0.4, 0.55, 0.05]), (100, [0.3, 0.1, 0.6])]
    rows = spark.createDataFrame(rows, "n_tokens long, p array<double>")
    with pytest.warns(UserWarning, match="missed"):
        steps = soft_mixing.fit_rates(rows, {"a": 0.98, "b": 0.01, "c": 0.01})
    assert all(np.isfinite(s).all() for s in steps)


def test_mixing_given_documents(spark, folder):
    got = registry.op5_soft_mixing(spark, folder).toPandas()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    shares = [(got.rate * got.n_tokens * got[f"p_{k}"]).sum() / got.n_tokens.sum() for k in soft_mixing.TARGETS]
    assert np.allclose(shares, list(soft_mixing.TARGETS.values()), atol=1e-3)
    assert ((got.copies - got.rate).abs() < 1).all()


def test_mixing_odd_rows(spark):
    rows = [(1, None, 1), (None, "", 2), (3, "a b c " * 50_000, 3), (4, "x", 4), (4, "x", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, p int").selectExpr("*", "1 AS copies", "2 AS `row`")
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = soft_mixing.document_rates(docs, labels).collect()
    assert len(got) == 5 and all(r.rate >= 0 and math.isfinite(r.rate) for r in got)
    mixed = soft_mixing.mixed_documents(docs, labels)
    assert mixed.columns == [*docs.columns, "mix_rate", "mix_copies"]
    assert mixed.count() == sum(r.copies > 0 for r in got)
    assert soft_mixing.document_rates(docs, labels.limit(0)).count() == 5
    assert soft_mixing.document_rates(docs.limit(0), labels).count() == 0


def test_words_too_unlikely_for_a_double_keep_their_score():
    read = SimpleNamespace(found=SimpleNamespace(first=np.array([0, 2])), back=np.array([0, 1]))
    logs = np.array([-2.0, -900.0, -1.0])
    got = lm.mixed_scores(read, SimpleNamespace(ends=5, n=100), logs, np.array([0.1, 0.0]))
    half = np.log10(0.5)
    assert np.allclose(got, [half + np.log10(0.11) + half - 900 + half + np.log10(0.15)])


def test_the_fit_holds_a_block_at_a_time(spark):
    draw = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in draw.choice(30_000, 500, replace=False)) for _ in range(1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2, int(i % 7 == 0)) for i in range(1500)], "doc_id long, quality int, toxic int")
    tracemalloc.start()
    try:
        weights, bias = soft_mixing.train(docs, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # 500 words a text, each an entry of the sample, besides its bytes.
    assert np.isfinite(weights).all() and weights.any() and peak < 24 * 500 * 1500
