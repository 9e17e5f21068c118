"""Conversations kept as a table of messages: ``conv_id, turn, role, text``.

``turn`` is the position of a message in its conversation, from 0. A
conversation may be of any length, so it is rendered in parts of a number of
turns that the caller sets. Every part says how many there are (``n_parts``): a
text with more than one part is whole only when all are put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.functions import text as tx
from textlake.functions.fixed_values import CHAT_PROMPT
from textlake.operators.merge import not_in
from textlake.session import work_path
from textlake.sources.writers import round_trip

def _part(turn: Column, part_turns: int) -> Column:
    return F.floor(turn / part_turns).cast("bigint")


def _lines() -> Column:
    """The lines of a group by turn, one below the other."""
    pairs = F.array_sort(F.collect_list(F.when(F.col("line").isNotNull(), F.struct("turn", "line"))))
    return F.array_join(F.transform(pairs, lambda pair: pair["line"]), "\n")


def _with_n_parts(parts: DataFrame) -> DataFrame:
    """Parts with the number of parts of their conversation."""
    counts = parts.groupBy("conv_id").agg(F.count("*").alias("n_parts"))
    return parts.join(counts, "conv_id")


def history_parts(messages: DataFrame, part_turns: int) -> DataFrame:
    """``conv_id, part, history, n_parts``: the messages in order, one line each.

    The parts of a conversation, joined by newlines, are its whole history.
    """
    return _with_n_parts(
        messages.select(
            "conv_id",
            _part(F.col("turn"), part_turns).alias("part"),
            "turn",
            tx.speaker_line(F.col("role"), F.col("text")).alias("line"),
        )
        .groupBy("conv_id", "part")
        .agg(_lines().alias("history"))
    )


def latest_questions(messages: DataFrame) -> DataFrame:
    """The last user message of each conversation: ``conv_id, turn, question``.

    They are stored: a prompt asks for them several times, and each time would sort the texts again in the same task.
    """
    found = (
        messages.where("role = 'user'")
        .groupBy("conv_id")
        .agg(F.max("turn").alias("turn"), F.max_by("text", "turn").alias("question"))
    )
    return round_trip(found, work_path(messages.sparkSession, "questions"))


def messages_before(messages: DataFrame, questions: DataFrame) -> DataFrame:
    """The messages of each conversation that came before its question."""
    at = questions.select("conv_id", F.col("turn").alias("_turn"))
    return messages.join(at, "conv_id").where(F.col("turn") < F.col("_turn")).drop("_turn")


def prompt_parts(
    questions: DataFrame,
    history: DataFrame,
    part_turns: int,
    template: str = CHAT_PROMPT,
) -> DataFrame:
    """``conv_id, part, prompt, n_parts`` from ``conv_id, question, context`` and messages.

    With ``template=REWRITE_PROMPT`` they ask for a search query instead of an
    answer, and need no context.

    The parts of a prompt, put one behind the other, are the whole prompt. Its
    beginning goes with the first part of the history and its end with the last,
    so no long conversation has to come together in one place.
    """
    before, after = template.split("{chat_history}")
    values = {name: F.col(name) for name in ("context", "question") if name in questions.columns}
    ends = history.groupBy("conv_id").agg(
        _part(F.min("turn"), part_turns).alias("first"),
        _part(F.max("turn"), part_turns).alias("last"),
    )
    asked = questions.join(ends, "conv_id", "left").select(
        "conv_id",
        F.coalesce("first", F.lit(0)).alias("first"),
        F.coalesce("last", F.lit(0)).alias("last"),
        tx.fill_template(after, **values).alias("tail"),
    )
    lines = history.select(
        "conv_id",
        _part(F.col("turn"), part_turns).alias("part"),
        "turn",
        tx.speaker_line(F.col("role"), F.col("text")).alias("line"),
    )
    heads = asked.select("conv_id", F.col("first").alias("part"), F.lit(before).alias("head"))
    tails = asked.select("conv_id", F.col("last").alias("part"), "tail")
    return _with_n_parts(
        lines.unionByName(heads, allowMissingColumns=True)
        .unionByName(tails, allowMissingColumns=True)
        .groupBy("conv_id", "part")
        .agg(
            F.concat(
                F.coalesce(F.max("head"), F.lit("\n")),
                _lines(),
                F.coalesce(F.max("tail"), F.lit("")),
            ).alias("prompt")
        )
    )


def drop_sessions(messages: DataFrame, ids: DataFrame) -> DataFrame:
    """The messages of all conversations but those in ``ids``."""
    return not_in(messages, ids.select("conv_id").distinct(), ["conv_id"])


def drop_status(messages: DataFrame, ids: DataFrame) -> DataFrame:
    """``conv_id, status`` for each id: ``deleted``, or ``not_found``."""
    wanted = ids.select("conv_id").distinct()
    known = messages.select("conv_id").join(wanted, "conv_id", "left_semi").distinct()
    return (
        wanted.join(known.withColumn("_known", F.lit(True)), "conv_id", "left")
        .select(
            "conv_id",
            F.when(F.col("_known"), "deleted").otherwise("not_found").alias("status"),
        )
    )
