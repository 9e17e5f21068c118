"""Quality rules: fixed rules, then robust multivariate outliers.

Every text becomes a vector of transformed statistics. For each language and source the
minimum-covariance-determinant estimate of centre and scatter is worked out: a start from
medians and absolute deviations, concentration steps (refit on the three quarters of the
rows that lie nearest), then a reweighted fit. A row whose Mahalanobis distance from its group
is too large is rejected. All of it is DataFrame work: rows are only aggregated by
group, so a source that holds a third of all rows costs no more than its share, and what
meets the rows again is one line of numbers for each group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.llm.storage import Scratch

MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8

# Groups with fewer rows share an estimate with the other small groups of their
# language, and small languages with one another.
MIN_GROUP = 50
# Groups whose numbers (some 300 bytes each) are sent to all tasks, at most; more are joined.
FEW_GROUPS = 50_000
# Share of the rows that the estimate rests on.
SUPPORT = 0.75
STEPS = 4
# Squared distance above which a row is rejected: far beyond the 0.9999 quantile (25.7)
# of five normal statistics, as real texts have heavier tails.
CUTOFF = 60.0

# Statistics and the least deviation each is taken to have (in most texts three of them are zero).
# Shares of repeated words and of duplicate lines count as they are: a logarithm would put a single
# repeat halfway to the largest share, and only a deviation too wide to reject any would then do.
# Duplicate lines alone reject from a share of about 0.31, which no fixed rule tests;
# repeats alone, which the fixed rules judge, reject nothing.
STATISTICS = {"length": 0.05, "symbols": 0.25, "repeats": 0.06, "lines": 0.04, "capitals": 0.04}
# Quantiles of the chi-squared distribution with five degrees of freedom.
MEDIAN_CHI2, INNER_CHI2 = 4.3515, 12.8325

_SPACES = "[\\x20\\x09-\\x0D]+"
_NAMES = list(STATISTICS)


def _repeated_words() -> Column:
    """Words in windows that a text has twice or more, from ``marks``: a hash per window.

    Texts without an equal pair (nearly all) stop at the first test. For the others windows
    are sorted by hash; equal neighbours mark their places, whose union is measured.
    """
    return F.expr(
        f"""
        CASE WHEN size(marks) = size(array_distinct(marks)) THEN 0L ELSE
          transform(array(sort_array(transform(marks, (h, i) -> struct(h AS h, i AS i)))), s ->
            aggregate(
              sort_array(transform(
                filter(
                  transform(s, (x, j) -> struct(x.i AS i,
                    (j > 0 AND s[greatest(j - 1, 0)].h = x.h)
                    OR (j < size(s) - 1 AND s[least(j + 1, size(s) - 1)].h = x.h) AS twice)),
                  x -> x.twice),
                x -> x.i)),
              struct(0L AS words, -{WINDOW} AS last),
              (state, i) -> struct(
                state.words + least({WINDOW}, i - state.last) AS words, i AS last),
              state -> state.words))[0] END
        """
    )


def measured(rows: DataFrame) -> DataFrame:
    """Rows of ``row`` (a struct with ``text, lang, source``) with counts and statistics."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    split = rows.select(
        "row", F.array_remove(F.split(text, F.lit(_SPACES), F.lit(-1)), "").alias("words"), text.alias("body")
    )
    hashed = split.select(
        "row",
        "body",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.filter(
            F.split("body", F.lit("\n"), F.lit(-1)), lambda line: F.rlike(line, F.lit("[^\\x20\\x09-\\x0D]"))
        ).alias("lines"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("hashes"),
    )
    later = ", ".join(f"hashes[i + {j}]" for j in range(1, WINDOW))
    marked = hashed.select(
        "row",
        "n_words",
        "word_chars",
        F.regexp_count("body", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count("body", F.lit("[A-Z]")).cast("bigint").alias("n_capitals"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.size(F.array_distinct("lines")).cast("bigint").alias("n_own_lines"),
        F.expr(
            f"CASE WHEN n_words >= {WINDOW} THEN transform(slice(hashes, 1, size(hashes) - {WINDOW - 1}), "
            f"(x, i) -> xxhash64(x, {later})) ELSE array() END"
        ).alias("marks"),
    )
    counted = marked.select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_capitals",
        "n_lines",
        (F.col("n_lines") - F.col("n_own_lines")).alias("n_dup_lines"),
        _repeated_words().cast("bigint").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    chars = F.greatest(F.col("word_chars"), F.lit(1))

    def percent(part: str, whole: Column) -> Column:
        return F.log1p(100 * F.col(part) / whole)

    return counted.select(
        "row",
        F.coalesce(F.col("row.lang"), F.lit("")).alias("lang"),
        F.coalesce(F.col("row.source"), F.lit("")).alias("source"),
        *["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
        failed.alias("base_failed"),
        # The mean of a short text is drawn towards a usual one, so that it varies no more.
        F.log((F.col("word_chars") + 250) / (F.col("n_words") + 50)).alias("length"),
        percent("n_symbols", chars).alias("symbols"),
        (F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1))).alias("repeats"),
        # Few lines are drawn towards none: two equal ones are no menu.
        (F.col("n_dup_lines") / (F.col("n_lines") + 4)).alias("lines"),
        F.sqrt((F.col("n_capitals") + 2) / (F.col("word_chars") + 100)).alias("capitals"),
    )


def _meet(rows: DataFrame, groups: DataFrame, on: list[str], few: bool) -> DataFrame:
    """Rows with their group's numbers; these go to the rows if there are few groups."""
    return rows.join(F.broadcast(groups) if few else groups, on, "left")


def _keys(rows: DataFrame, min_group: int, scratch: Scratch) -> tuple[DataFrame, bool]:
    """The ``key`` of the estimate that each language and source shares; whether there are few."""
    sizes = scratch.keep(rows.groupBy("lang", "source").agg(F.count("*").alias("n")), "sizes")
    few = sizes.count() <= FEW_GROUPS
    small = sizes.where(F.col("n") < min_group)
    pools = small.groupBy("lang").agg((F.sum("n") < min_group).alias("tiny"))
    keys = sizes.join(pools, "lang", "left").select(
        "lang",
        "source",
        F.when(F.col("n") >= min_group, F.concat_ws("\n", F.lit("source"), "lang", "source"))
        .when(~F.col("tiny"), F.concat_ws("\n", F.lit("language"), "lang"))
        .otherwise("all")
        .alias("key"),
    )
    return scratch.keep(keys, "keys"), few


_PAIRS = [(a, b) for i, a in enumerate(_NAMES) for b in _NAMES[: i + 1]]
_CENTRE = [f"m_{a}" for a in _NAMES]


def _moments() -> list[Column]:
    """Centre and scatter of the rows seen, as columns ``m_*`` and ``c_*_*``."""
    means = [F.expr(f"avg({a}) AS m_{a}") for a in _NAMES]
    return means + [F.expr(f"covar_pop({a}, {b}) AS c_{a}_{b}") for a, b in _PAIRS]


def _factored(groups: DataFrame) -> DataFrame:
    """Groups with the Cholesky factor ``l_*_*`` of their scatter, each variance floored."""
    made = "*"
    for i, a in enumerate(_NAMES):
        # A row of the factor follows from the rows above it and from its own left part.
        row: dict[str, str] = {}
        for j, b in enumerate(_NAMES[: i + 1]):
            rest = f"c_{a}_{b} + {STATISTICS[a] ** 2 if a == b else 0.0}D"
            for k in _NAMES[:j]:
                rest += f" - {row[k]} * {row[k] if a == b else f'l_{b}_{k}'}"
            row[b] = f"sqrt({rest})" if a == b else f"(({rest}) / l_{b}_{b})"
        groups = groups.selectExpr(made, *[f"{row[b]} AS l_{a}_{b}" for b in _NAMES[: i + 1]])
    return groups.select("key", *_CENTRE, *[f"l_{a}_{b}" for a, b in _PAIRS])


def _distance() -> Column:
    """The squared Mahalanobis distance, by substitution into the factor."""
    solved: dict[str, str] = {}
    for i, a in enumerate(_NAMES):
        rest = f"{a} - m_{a}" + "".join(f" - l_{a}_{b} * {solved[b]}" for b in _NAMES[:i])
        solved[a] = f"(({rest}) / l_{a}_{a})"
    return F.expr(" + ".join(f"pow({z}, 2)" for z in solved.values()))


def _start(vectors: DataFrame, few: bool, scratch: Scratch) -> DataFrame:
    """Medians, and absolute deviations as a scatter without covariances."""
    medians = scratch.keep(
        vectors.groupBy("key").agg(*[F.percentile_approx(a, 0.5).alias(f"m_{a}") for a in _NAMES]), "median"
    )
    spread = (
        _meet(vectors, medians, ["key"], few)
        .groupBy("key")
        .agg(
            *[F.first(f"m_{a}").alias(f"m_{a}") for a in _NAMES],
            *[F.percentile_approx(F.abs(F.col(a) - F.col(f"m_{a}")), 0.5).alias(f"d_{a}") for a in _NAMES],
        )
    )
    scatter = [
        F.expr(f"{f'pow(1.4826 * d_{a}, 2)' if a == b else '0D'} AS c_{a}_{b}") for a, b in _PAIRS
    ]
    return scratch.keep(_factored(spread.select("key", *_CENTRE, *scatter)), "start")


def estimate(vectors: DataFrame, few: bool, scratch: Scratch) -> DataFrame:
    """One row per ``key``: centre, factor of the scatter, and the ``scale`` of distances."""
    groups = _start(vectors, few, scratch)
    for step in range(STEPS + 1):
        near = _meet(vectors, groups, ["key"], few).withColumn("d2", _distance())
        last = step == STEPS
        quantile = F.percentile_approx("d2", 0.5 if last else SUPPORT, 10000)
        limits = scratch.keep(near.groupBy("key").agg(quantile.alias("limit")), "limit")
        # The last fit takes all rows inside the distance that normal rows rarely pass.
        limit = F.col("limit") * (INNER_CHI2 / MEDIAN_CHI2 if last else 1.0)
        inner = _meet(near, limits, ["key"], few).where(F.col("d2") <= limit)
        groups = scratch.keep(_factored(inner.groupBy("key").agg(*_moments())), "fit")
    near = _meet(vectors, groups, ["key"], few).withColumn("d2", _distance())
    scale = near.groupBy("key").agg(
        (F.percentile_approx("d2", 0.5, 10000) / MEDIAN_CHI2).alias("scale"), F.count("*").alias("n")
    )
    return scratch.keep(groups.join(scale, "key"), "estimate")


def judged(
    rows: DataFrame,
    scratch: Scratch,
    cutoff: float = CUTOFF,
    min_group: int = MIN_GROUP,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Measured rows with their squared ``distance`` and ``kept``.

    Estimates use the rows that pass the fixed rules. A group that stays below
    ``min_group`` rows even when pooled gives no verdict: its rows keep that of the rules.
    ``stored`` are the same rows in a stored table to estimate from, where ``rows`` is not one.
    """
    passed = ~F.col("base_failed")
    known = rows if stored is None else stored
    keys, few = _keys(known, min_group, scratch)
    grouped = _meet(known, keys, ["lang", "source"], few)
    vectors = scratch.keep(grouped.where(passed).select("key", *_NAMES), "vectors")
    groups = estimate(vectors, few, scratch)
    distance = F.when(
        passed & (F.col("n") >= min_group), _distance() / F.greatest(F.col("scale"), F.lit(1.0))
    )
    inside = F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return (
        _meet(_meet(rows, keys, ["lang", "source"], few), groups, ["key"], few)
        .withColumn("distance", distance)
        # One condition that is not taken apart: a part of it, evaluated apart
        # before the join, would measure the texts twice.
        .withColumn("kept", F.when(passed & inside, True).otherwise(False))
    )


def quality_rules(documents: DataFrame) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``kept`` and the squared ``distance``.

    A null or empty text has no words and fails. A null language or source is a group of its
    own, together with the empty name. Equal rows get equal results, further columns
    are not looked at, and an empty table gives an empty result.
    """
    scratch = Scratch(documents.sparkSession, "quality")
    rows = documents.select(F.struct("doc_id", "text", "lang", "source").alias("row"))
    kept = measured(rows).withColumn("row", F.struct(F.col("row.doc_id").alias("doc_id")))
    done = judged(scratch.keep(kept, "measured"), scratch)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return done.select("row.doc_id", *counts, "base_failed", "kept", "distance")


def keep_quality(documents: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns as they are.

    Texts are measured twice: for the estimates, which store numbers only, and as
    they pass. That is cheaper than to store them once more.
    """
    scratch = Scratch(documents.sparkSession, "quality")
    rows = measured(
        documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    )
    stored = scratch.keep(rows.drop("row"), "measured")
    return judged(rows, scratch, stored=stored).where("kept").select("row.*")
