"""Toxicity by a weighted finite-state grammar over clauses.

Words get a symbol: insult, threat, target, negation, report (a reporting verb or a quotation
mark), or none. Small weighted transducers read the symbols of a clause: one passes on insults and threats
unless a negation stands shortly before them, one weakens what follows a report, one strengthens
what a target stands near. They are composed into a single machine (``compose``), whose
run over a clause ends in the clause's score; the words alone score nothing. A text's scores over all of its
clauses go through a logistic function.

Insults are learned: words, and beginnings of words, that labelled toxic texts have far more often
than the others, each with its weight; a short list is known from the start. The labels come from a bounded sample of the labelled rows (``SAMPLE_ROWS``),
chosen by a hash; threats, targets, negations and reports are fixed word lists.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.llm.labelled import labelled_sample
from textlake.llm.storage import Scratch
from textlake.llm.words import Slice, Words, prefix_hash, signed, slices, stretch_hash, words

# Labelled rows that are learned from, about so many at most.
SAMPLE_ROWS = 30_000
# A learned insult stands in as many toxic texts and in this share of them (words of a few
# copied texts do not), and its log odds are so much higher there. So there are at most
# 1 / MIN_SHARE times as many of them as a toxic text of the sample has distinct words on average.
MIN_TEXTS = 5
MIN_SHARE = 0.005
MIN_LOG_ODDS = 3.0
# Bytes of a word's beginning that are learned like a word, in longer words.
STEM = 5

NONE, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)

# Word lists in English, German, French and Spanish.
WORDS = {
    INSULT: (
        "idiot idiots moron stupid dumb scum trash loser pathetic worthless disgusting clown fool bastard "
        "dumm dummkopf trottel abschaum versager widerlich wertlos imbécile crétin débile ordure nul "
        "imbécil estúpido idiota basura inútil asqueroso perdedor payaso"
    ).split(),
    THREAT: (
        "kill hurt destroy smash punch shoot stab burn töten umbringen schlagen verletzen "
        "tuer frapper blesser détruire matar golpear herir destruir"
    ).split(),
    TARGET: (
        "you your yours u he she they them du dich dein ihr euch sie tu toi ton vous votre ils elles "
        "tú te usted ustedes ellos ellas"
    ).split(),
    NEGATION: "not no never n't isn't aren't don't nicht kein keine nie pas jamais aucun nunca jamás ningún".split(),
    REPORT: (
        "said says wrote claimed called quoted reported sagte schrieb nannte dit écrit déclaré "
        "dijo escribió llamó"
    ).split(),
}

_SENTENCE = np.zeros(256, bool)
_SENTENCE[[ord(c) for c in ".!?;:"]] = True
_STRIP = ".,;:!?\"'()[]{}«»"


# --- transducers -------------------------------------------------------------


@dataclass(frozen=True)
class Transducer:
    """``steps[state][symbol]`` is the next state and the factor on that symbol's weight."""

    start: int
    steps: tuple[tuple[tuple[int, float], ...], ...]


def _memory(trigger: int, reach: int, factor: float) -> Transducer:
    """After ``trigger``, insults and threats within ``reach`` symbols weigh ``factor``."""
    steps = []
    for left in range(reach + 1):
        row = []
        for symbol in range(END + 1):
            if symbol == trigger:
                row.append((reach, 1.0))
            else:
                hit = left > 0 and symbol in (INSULT, THREAT)
                row.append((max(left - 1, 0), factor if hit else 1.0))
        steps.append(tuple(row))
    return Transducer(0, tuple(steps))


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that runs both and multiplies their factors."""
    pairs = list(product(range(len(first.steps)), range(len(second.steps))))
    place = {pair: i for i, pair in enumerate(pairs)}
    steps = []
    for a, b in pairs:
        row = []
        for symbol in range(END + 1):
            (na, fa), (nb, fb) = first.steps[a][symbol], second.steps[b][symbol]
            row.append((place[na, nb], fa * fb))
        steps.append(tuple(row))
    return Transducer(place[first.start, second.start], tuple(steps))


NEGATED = _memory(NEGATION, 3, 0.2)
REPORTED = _memory(REPORT, 12, 0.5)
TARGETED = _memory(TARGET, 4, 1.3)
# A threat needs its target; alone it says little.
GRAMMAR = compose(compose(NEGATED, REPORTED), TARGETED)


def clause_score(symbols: list[int], weights: list[float]) -> float:
    """The weight that the grammar gives a clause."""
    state, total = GRAMMAR.start, 0.0
    threat, target = 0.0, False
    for symbol, weight in zip(symbols, weights, strict=True):
        state, factor = GRAMMAR.steps[state][symbol]
        if symbol == INSULT:
            total += weight * factor
        elif symbol == THREAT:
            threat = max(threat, weight * factor)
        elif symbol == TARGET:
            target = True
    return total + threat * (1.0 if target else 0.1)


# --- tagging -----------------------------------------------------------------


@dataclass
class Model:
    """Symbols and weights by word hash, and the final logistic function."""

    hashes: np.ndarray
    symbols: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float


def bare_words(piece: Slice) -> Words:
    """Lower-case words without the punctuation around them."""
    found = words(piece)
    data = np.frombuffer(piece.data.tobytes().lower(), np.uint8)
    strip = np.zeros(256, bool)
    strip[[ord(c) for c in _STRIP if ord(c) < 128]] = True
    start, end = found.start.copy(), found.end.copy()
    for _ in range(3):  # up to three marks on each side
        start += (start < end - 1) & strip[data[np.minimum(start, len(data) - 1)]] if len(data) else 0
        end -= (end > start + 1) & strip[data[end - 1]] if len(data) else 0
    hashes = stretch_hash(prefix_hash(data), start, end) if len(data) else found.hash
    return Words(hashes, found.first, start, end)


def stems(piece: Slice, found: Words) -> np.ndarray:
    """A hash of the beginning of each word; of words that are no longer, their own hash."""
    data = np.frombuffer(piece.data.tobytes().lower(), np.uint8)
    longer = found.end - found.start > STEM
    out = found.hash.copy()
    start = found.start[longer]
    if len(start):
        out[longer] = ~stretch_hash(prefix_hash(data), start, start + STEM)
    return out


def word_hash(word: str) -> int:
    piece = next(slices(pa.array([word])))
    return int(bare_words(piece).hash[0])


def _rows_of(hashes: np.ndarray, model: Model) -> np.ndarray:
    """The model's row of each hash, or -1."""
    if not len(model.hashes):
        return np.full(len(hashes), -1)
    at = np.searchsorted(model.hashes, hashes).clip(0, len(model.hashes) - 1)
    return np.where(model.hashes[at] == hashes, at, -1)


def _tagged(piece: Slice, found: Words, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that have a symbol, by themselves or by their beginning, and their rows."""
    own = _rows_of(found.hash, model)
    own = np.where(own >= 0, own, _rows_of(stems(piece, found), model))
    places = np.flatnonzero(own >= 0)
    return places, own[places]


def _text_scores(piece: Slice, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The sum of clause scores and the number of words of each text of a slice."""
    found = bare_words(piece)
    n = len(found.first) - 1
    total = np.zeros(n)
    places, rows = _tagged(piece, found, model)
    if not len(places):
        return total, np.diff(found.first)
    strong = np.isin(model.symbols[rows], (INSULT, THREAT))
    text_of = np.searchsorted(found.first, places, side="right") - 1
    wanted = np.zeros(n, bool)
    wanted[text_of[strong]] = True
    # A word that ends in a clause mark closes its clause.
    last = piece.data[found.end.clip(max=max(len(piece.data) - 1, 0))]
    closes = _SENTENCE[last] & (found.end < len(piece.data))
    for text in np.flatnonzero(wanted):
        lo, hi = np.searchsorted(places, found.first[text : text + 2])
        here, kinds = places[lo:hi], rows[lo:hi]
        ends = np.flatnonzero(closes[found.first[text] : found.first[text + 1]]) + found.first[text]
        clause = np.searchsorted(ends, here)
        symbols, weights, previous = [], [], None
        for place, kind, number in zip(here.tolist(), kinds.tolist(), clause.tolist(), strict=True):
            if previous is not None and number != previous[1]:
                total[text] += clause_score(symbols, weights)
                symbols, weights, previous = [], [], None
            if previous is not None:  # untagged words in between; the machine forgets within 12
                gap = min(place - previous[0] - 1, 12)
                symbols += [NONE] * gap
                weights += [0.0] * gap
            symbols.append(int(model.symbols[kind]))
            weights.append(float(model.weights[kind]))
            previous = (place, number)
        total[text] += clause_score(symbols, weights)
    return total, np.diff(found.first)


def score_texts(column: pa.Array, model: Model) -> np.ndarray:
    out = []
    for piece in slices(column):
        total, _ = _text_scores(piece, model)
        out.append(1 / (1 + np.exp(-np.clip(model.bias + model.slope * total, -30, 30))))
    return np.concatenate(out) if out else np.zeros(0)


# --- learning ----------------------------------------------------------------


def _word_rows(batches):
    """How many texts of each label have each word, as far as this batch goes."""
    for batch in batches:
        labels = batch.column("toxic").to_numpy(zero_copy_only=False)
        for piece in slices(batch.column("text")):
            found = bare_words(piece)
            text = np.repeat(np.arange(piece.high - piece.low), np.diff(found.first))
            text = np.concatenate([text, text])
            both = np.concatenate([found.hash, stems(piece, found)])
            distinct, place = np.unique(both, return_inverse=True)
            if not len(distinct):
                continue
            own = np.unique(text * len(distinct) + place)  # a word counts once in a text
            kind = labels[piece.low + own // len(distinct)] * len(distinct) + own % len(distinct)
            keys, n = np.unique(kind, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    signed(distinct[keys % len(distinct)]),
                    pa.array((keys // len(distinct)).astype(np.int32)),
                    pa.array(n),
                ],
                names=["word", "toxic", "n"],
            )


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope that fit 0/1 labels best, the two labels weighing the same; slope above 0."""
    bias, slope = -1.0, 1.0
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    features = np.stack([np.ones_like(x), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(bias + slope * x, -30, 30)))
        gradient = features @ (weight * (p - y)) + np.array([0, 1e-3 * slope])
        curve = (features * (weight * p * (1 - p))) @ features.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        bias, slope = bias - step[0], max(slope - step[1], 0.05)
        if np.abs(step).max() < 1e-9:
            break
    return float(bias), float(slope)


def train(documents: DataFrame, labels: DataFrame, usable: Column, rows: int = SAMPLE_ROWS) -> Model:
    """Learn the insults and the logistic function from labelled rows where ``usable`` holds."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "toxicity")
    sample = scratch.keep(labelled_sample(documents, labels, usable, rows, ["toxic"]), "sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_plain = sizes.get(1, 0), sizes.get(0, 0)
    counts = (
        sample.mapInArrow(_word_rows, "word bigint, toxic int, n bigint")
        .groupBy("word")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"),
        )
    )
    odds = F.log((F.col("a") + 0.5) / (n_toxic + 1.0 - F.col("a"))) - F.log(
        (F.col("b") + 0.5) / (n_plain + 1.0 - F.col("b"))
    )
    learned = (
        counts.withColumn("odds", odds)
        .where((F.col("a") >= max(MIN_TEXTS, MIN_SHARE * n_toxic)) & (F.col("odds") >= MIN_LOG_ODDS))
        .collect()
    )
    lexicon: dict[int, tuple[int, float]] = {}
    for symbol, listed in WORDS.items():
        for word in listed:
            lexicon[word_hash(word)] = (symbol, 1.0 if symbol in (INSULT, THREAT) else 0.0)
    for r in learned:
        lexicon[int(np.int64(r["word"]).view(np.uint64))] = (INSULT, r["odds"] / MIN_LOG_ODDS)
    hashes = np.array(sorted(lexicon), np.uint64)
    model = Model(
        hashes,
        np.array([lexicon[int(h)][0] for h in hashes], np.int64),
        np.array([lexicon[int(h)][1] for h in hashes]),
        0.0,
        0.0,
    )
    if not n_toxic or not n_plain:  # nothing to fit: the grammar's own scale
        model.bias, model.slope = -2.0, 1.0
        scratch.drop(sample)
        return model

    def totals(batches):
        for batch in batches:
            parts = [_text_scores(piece, model)[0] for piece in slices(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(np.concatenate(parts) if parts else np.zeros(0))],
                names=["toxic", "total"],
            )

    fitted = sample.mapInArrow(totals, "toxic int, total double").toPandas()  # SAMPLE_ROWS at most
    model.bias, model.slope = _logistic(fitted["total"].to_numpy(), fitted["toxic"].to_numpy(float))
    scratch.drop(sample)
    return model


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` for every row; a null or empty text has the score of no clause.

    Only the text is scored. Equal rows get equal results; other columns are not looked at.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score_texts(batch.column("text"), sent.value))],
                names=["doc_id", "score"],
            )

    scored = documents.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

