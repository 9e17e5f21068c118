"""Mixing by soft membership: rates that bring expected domain totals to their targets.

A classifier learned from the labels table gives every document a posterior over the domains.
A document of ``n`` tokens with posterior ``p`` counts ``n * p`` towards them, so rates ``r`` give the
totals ``sum(r * n * p)``. The fit looks for nonnegative rates whose totals
match the targets; of all such rates the ones nearest to 1. These are ``max(0, 1 - p . x)`` for one
short vector ``x``, the dual solution. Documents that belong to the first domain are clean: their
rates are 1 or more, so that all of them stay, and the whole grows where the targets ask for it.
``x`` is found by gradient steps, scaled by the domains' Gram
matrix of the documents with a positive rate, each of two distributed sums. No rates are
stored, joined or sent anywhere between the steps.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.llm.labelled import labelled_sample
from textlake.llm.storage import Scratch
from textlake.llm.words import Slice, slices, words

# Labelled rows that the classifier is fitted on, about so many at most.
SAMPLE_ROWS = 8_000
# Domains in the order of their number, with their shares of the tokens wanted.
TARGETS = {"plain": 0.92, "poor": 0.06, "toxic": 0.02}
# A document belongs to a domain if its posterior is larger.
BELONGS = 0.5
STEPS = 100
TOLERANCE = 1e-6
# Weight of the residual that keeps the fit finite where targets cannot be met.
_SLACK = 1e-10
# Parts of a step that are tried, all at once.
_PARTS = [4.0**-i for i in range(12)]

# Rows of the sample that the fit works on at a time.
_BLOCK = 500

_WORDS = 1 << 16
# The value of a word that occurs.
_OCCURS = 0.2
_FIRST, _LAST, _AGAIN = _WORDS, _WORDS + 256, _WORDS + 512
FEATURES = _AGAIN + 1


def domain(quality: Column, toxic: Column) -> Column:
    """The number of a labelled document's domain."""
    return F.when(toxic == 1, 2).when(quality == 0, 1).otherwise(0)


# --- features and classifier ------------------------------------------------


def features(piece: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, features, values and word counts of the texts of a slice.

    Features: which words occur (hashed), and the shares of words by first and by last byte and of
    words that repeat the one before.
    """
    found = words(piece, lower=False)
    n = np.diff(found.first)
    row = np.repeat(np.arange(len(n)), n)
    if not len(row):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(float), n
    again = np.zeros(len(row), bool)
    again[1:] = (found.hash[1:] == found.hash[:-1]) & (row[1:] == row[:-1])
    kinds = [
        (found.hash % np.uint64(_WORDS)).astype(np.int64),
        _FIRST + piece.data[found.start].astype(np.int64),
        _LAST + piece.data[found.end - 1].astype(np.int64),
        np.full(again.sum(), _AGAIN, np.int64),
    ]
    rows = [row, row, row, row[again]]
    keys, counts = np.unique(np.concatenate(rows) * FEATURES + np.concatenate(kinds), return_counts=True)
    row, feature = keys // FEATURES, keys % FEATURES
    value = np.where(feature < _WORDS, _OCCURS, 3 * np.sqrt(counts / n[row]))
    return row, feature, value, n


def _log_posteriors(row, feature, value, n_rows: int, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    score = np.stack(
        [np.bincount(row, value * weights[feature, k], n_rows) + b for k, b in enumerate(bias)], axis=1
    )
    score -= score.max(axis=1, keepdims=True)
    return score - np.log(np.exp(score).sum(axis=1, keepdims=True))


def fit(blocks, label: np.ndarray, n_domains: int, rounds: int = 120):
    """A multinomial logistic regression, by full-batch gradient steps of adapted size.

    ``blocks`` is called in every round and gives the rows in order, a part at a time: the rows, features and
    values of its entries, and its number of rows. What the steps need besides is as large as a part.
    """
    weights = np.zeros((FEATURES, n_domains))
    share = np.bincount(label, minlength=n_domains) + 1e-3
    bias = np.log(share / share.sum())
    seen = np.full_like(weights, 1e-8)
    for _ in range(rounds):
        gradients, errors = np.zeros((n_domains, FEATURES)), np.zeros(n_domains)
        low = 0
        for row, feature, value, n in blocks():
            p = np.exp(_log_posteriors(row, feature, value, n, weights, bias))
            error = (p - np.eye(n_domains)[label[low : low + n]]) / len(label)
            for k in range(n_domains):
                gradients[k] += np.bincount(feature, value * error[row, k], FEATURES)
            errors += error.sum(axis=0)
            low += n
        for k in range(n_domains):
            gradient = gradients[k] + 1e-6 * weights[:, k]
            seen[:, k] += gradient**2
            weights[:, k] -= 0.3 * gradient / np.sqrt(seen[:, k])
        bias -= 0.3 * errors
    return weights, bias


def _feature_rows(batches):
    """Features of all texts, and values of those that are shares; words all have the same value."""
    for batch in batches:
        names, values = [], []
        for piece in slices(batch.column("text")):
            row, feature, value, n = features(piece)
            cut = np.searchsorted(row, np.arange(len(n) + 1))
            names += [feature[a:b].astype(np.int32) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            share = feature >= _WORDS
            cut = np.concatenate([[0], np.cumsum(share)])[cut]
            value = value[share].astype(np.float32)
            values += [value[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("domain"),
                pa.array(names, pa.list_(pa.int32())),
                pa.array(values, pa.list_(pa.float32())),
            ],
            names=["domain", "feature", "share"],
        )


def _blocks(sample: pa.Table):
    """The entries of the sample as ``fit`` takes them; only the block at hand is laid out."""
    for batch in sample.to_batches(max_chunksize=_BLOCK):
        feature = batch.column("feature").flatten().to_numpy()
        row = np.repeat(np.arange(batch.num_rows), batch.column("feature").value_lengths().to_numpy())
        value = np.full(len(feature), _OCCURS, np.float32)
        value[feature >= _WORDS] = batch.column("share").flatten().to_numpy()
        yield row, feature, value, batch.num_rows


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS):
    """Weights and biases of the classifier over the domains, from the labels table."""
    sample = labelled_sample(documents, labels, F.lit(True), rows, ["quality", "toxic"])
    sample = sample.select(domain(F.col("quality"), F.col("toxic")).alias("domain"), "text")
    got = (
        sample.mapInArrow(_feature_rows, "domain int, feature array<int>, share array<float>")
        .toArrow()  # SAMPLE_ROWS rows
        .combine_chunks()
    )
    if not len(got):
        return np.zeros((FEATURES, len(TARGETS))), np.zeros(len(TARGETS))
    return fit(lambda: _blocks(got), got.column("domain").to_numpy(), len(TARGETS))


# --- rates -------------------------------------------------------------------


def with_posteriors(documents: DataFrame, model) -> DataFrame:
    """Rows of ``row`` (all columns as a struct) with ``n_tokens`` and ``p``, their posteriors."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    names = [f"c{i}" for i in range(len(documents.columns))]
    at = documents.columns.index("text")
    plain = documents.toDF(*names)
    schema = ", ".join(f"{n} {plain.schema[n].dataType.simpleString()}" for n in names)

    def run(batches):
        weights, bias = sent.value
        for batch in batches:
            posteriors, sizes = [], []
            for piece in slices(batch.column(at)):
                row, feature, value, n = features(piece)
                posteriors.append(np.exp(_log_posteriors(row, feature, value, len(n), weights, bias)))
                sizes.append(n)
            flat = np.concatenate(posteriors) if posteriors else np.zeros((0, len(bias)))
            offsets = np.arange(len(flat) + 1, dtype=np.int32) * len(bias)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.int64), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel())),
                ],
                names=[*names, "n_tokens", "p"],
            )

    done = plain.mapInArrow(run, f"{schema}, n_tokens bigint, p array<double>")
    row = F.struct(*[F.col(n).alias(c) for n, c in zip(names, documents.columns, strict=True)])
    return done.select(row.alias("row"), "n_tokens", "p")


def clean_least() -> Column:
    """The least rate of a document: 1 if it belongs to the first domain."""
    return F.when(F.col("p")[0] > BELONGS, 1.0).otherwise(0.0)


def _rate(steps: list[np.ndarray], least: Column | None = None) -> Column:
    """A document's rate after these steps: from 1, each step along its posterior, never below ``least`` (or 0)."""
    if not steps:
        return F.lit(1.0)
    moves = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])
    return F.aggregate(
        moves,
        F.lit(1.0),
        lambda rate, move: F.greatest(
            F.lit(0.0) if least is None else least,
            rate
            - F.aggregate(F.zip_with("p", move, lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y),
        ),
    )


def _moved(x: np.ndarray) -> Column:
    """A document's rate before the bound, for the dual vector ``x``."""
    return F.lit(1.0) - sum((F.col("p")[i] * float(v) for i, v in enumerate(x)), F.lit(0.0))


def _dual(x: np.ndarray, least: Column) -> Column:
    """A document's part of the dual function, without its tokens."""
    moved = _moved(x)
    rate = F.greatest(least, moved)
    return -0.5 * (rate - 1) * (rate - 1) - rate * (1 - moved)


def fit_rates(
    rows: DataFrame, targets: dict[str, float] = TARGETS, least: Column | None = None
) -> list[np.ndarray]:
    """The steps that lead to the rates (see ``_rate``) for rows of ``n_tokens, p``.

    The targets are shares of the tokens there are. A domain that no document belongs to
    (``BELONGS``) can't be filled; the shares of the others then make up the whole. With
    ``least`` rates the whole grows where they leave no room for the shares. The totals are
    off by ``TOLERANCE`` of all tokens at most; where no rates reach that, a warning
    says how far off the nearest totals are.
    """
    k = len(targets)
    bound = F.lit(0.0) if least is None else least
    about = rows.agg(
        *[F.sum(F.when(F.col("p")[i] > BELONGS, F.col("n_tokens")).otherwise(0)) for i in range(k)],
        *[F.sum(bound * F.col("n_tokens") * F.col("p")[i]) for i in range(k)],
        F.sum("n_tokens"),
    ).first()
    tokens = about[2 * k] or 0
    there = np.array([bool(n) for n in about[:k]])
    if not tokens or not there.any():
        return []
    shares = np.array(list(targets.values()), float) * there
    shares = shares / shares.sum()
    filled = np.array(about[k : 2 * k], float) / tokens * there
    x, off = np.zeros(k), np.ones(k)
    if (filled <= shares).all():
        x, off = _solved(rows, tokens, shares, there, bound, False)
    if np.abs(off).max() > TOLERANCE and least is not None:
        x, off = _solved(rows, tokens, shares, there, bound, True)
    if np.abs(off).max() > TOLERANCE:
        warnings.warn(f"mixing targets {shares.tolist()} are missed by {off.tolist()} of all tokens", stacklevel=2)
    return [x]


def _solved(rows, tokens, shares, there, least: Column, grows: bool) -> tuple[np.ndarray, np.ndarray]:
    """The dual vector, and by which shares of all tokens the totals are off; the whole may grow."""
    k = len(shares)
    weight = F.col("n_tokens") / float(tokens)

    def whole(x) -> float:
        """The size of the whole against all tokens, held like the rate of one more document."""
        return max(1.0, 1.0 + x @ shares) if grows else 1.0

    def rest(x) -> float:
        """The dual function without the documents."""
        return whole(x) * (x @ shares) - 0.5 * (whole(x) - 1) ** 2 + _SLACK / 2 * x @ x

    x = np.zeros(k)
    for _ in range(STEPS):
        moved = _moved(x)
        sums = rows.agg(
            *[F.sum(F.greatest(least, moved) * weight * F.col("p")[i]) for i in range(k)],
            *[
                F.sum(F.when(moved >= least, weight * F.col("p")[i] * F.col("p")[j]).otherwise(0.0))
                for i in range(k)
                for j in range(k)
            ],
            F.sum(_dual(x, least) * weight),
        ).first()
        off = (np.array(sums[:k], float) - whole(x) * shares) * there
        if np.abs(off).max() <= TOLERANCE:
            break
        gram = np.array(sums[k : k + k * k], float).reshape(k, k) * np.outer(there, there)
        if grows and x @ shares >= 0:
            gram += np.outer(shares, shares)
        step = -np.linalg.solve(gram + np.diag(np.where(there, _SLACK, 1.0)), _SLACK * x - off)
        tried = [x + part * step for part in _PARTS]
        values = rows.agg(*[F.sum(_dual(y, least) * weight) for y in tried]).first()
        values = np.array(values, float) + [rest(y) for y in tried]
        best = int(np.argmin(values))
        if values[best] >= sums[k + k * k] + rest(x):
            break
        x = tried[best]
    return x, off


def mix(documents: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """All rows and columns in ``row``, with ``n_tokens``, ``p``, ``rate`` and ``copies``.

    ``p`` has the posteriors in the order of ``targets``; ``copies`` is the rate as a whole number,
    rounded up or down by a hash of ``doc_id``, so that the expected number is the rate.
    A document that belongs to the first domain of the targets has a copy or more.
    A null or empty text has no tokens and moves nothing; it has a rate like any other.
    Equal rows get equal results. Without labels, posteriors are all equal.
    """
    scratch = Scratch(documents.sparkSession, "mixing")
    model = train(documents, labels)
    rows = with_posteriors(documents, model)
    # Only the numbers are stored; the posteriors are worked out again as the texts pass.
    steps = fit_rates(scratch.keep(rows.select("n_tokens", "p"), "posteriors"), targets, clean_least())
    rated = rows.withColumn("rate", _rate(steps, clean_least()))
    chance = F.pmod(F.xxhash64(F.col("row.doc_id"), F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("bigint")
    return rated.withColumn("copies", copies.cast("bigint"))


def document_rates(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, n_tokens``, a posterior per domain, ``rate`` and ``copies`` of every document."""
    mixed = mix(documents.select("doc_id", "text"), labels)
    posteriors = [F.col("p")[i].alias(f"p_{name}") for i, name in enumerate(TARGETS)]
    return mixed.select("row.doc_id", "n_tokens", *posteriors, "rate", "copies")


def mixed_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a copy or more, all their columns, ``mix_rate`` and ``mix_copies``.

    Columns that already have these two names, as in this function's own output, are replaced.
    """
    chosen = mix(documents, labels).where("copies > 0")
    own = [f"row.`{c}`" for c in documents.columns if c.lower() not in ("mix_rate", "mix_copies")]
    return chosen.select(*own, F.col("rate").alias("mix_rate"), F.col("copies").alias("mix_copies"))
