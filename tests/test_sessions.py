from __future__ import annotations

import pytest

from textlake.functions.fixed_values import CHAT_PROMPT, REWRITE_PROMPT
from textlake.operators import sessions

ROWS = [
    (1, 0, "system", "s"),
    (1, 1, "user", "q1"),
    (1, 2, "assistant", "a1"),
    (1, 3, "user", "q2"),
    (2, 0, "user", "only"),
    (3, 0, "assistant", "no question"),
]


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame(
        ROWS, "conv_id bigint, turn bigint, role string, text string"
    ).repartition(4)


def test_render_history(messages):
    got = {(r["conv_id"], r["part"]): r["history"] for r in sessions.history_parts(messages, 1000).collect()}
    assert got[(1, 0)] == "System: s\nHuman: q1\nAI: a1\nHuman: q2"
    assert len(got) == 3


def test_parts_join_to_the_whole(messages):
    parts = sessions.history_parts(messages, 2).where("conv_id = 1").orderBy("part").collect()
    assert [(r["part"], r["n_parts"]) for r in parts] == [(0, 2), (1, 2)]
    assert "\n".join(r["history"] for r in parts) == "System: s\nHuman: q1\nAI: a1\nHuman: q2"


def test_latest_questions(messages):
    got = {tuple(r) for r in sessions.latest_questions(messages).collect()}
    assert got == {(1, 3, "q2"), (2, 0, "only")}


@pytest.mark.parametrize("part_turns", [1, 2, 1000])
def test_chat_prompts(spark, messages, part_turns):
    questions = sessions.latest_questions(messages)
    asked = questions.join(
        spark.createDataFrame([(1, "C1"), (2, "C2")], "conv_id bigint, context string"), "conv_id"
    )
    history = sessions.messages_before(messages, questions)
    rows = sessions.prompt_parts(asked, history, part_turns).orderBy("conv_id", "part").collect()
    prompts = {
        conv: "".join(r["prompt"] for r in rows if r["conv_id"] == conv) for conv in (1, 2)
    }
    assert prompts == {
        1: CHAT_PROMPT.format(
            chat_history="System: s\nHuman: q1\nAI: a1", context="C1", question="q2"
        ),
        2: CHAT_PROMPT.format(chat_history="", context="C2", question="only"),
    }
    sizes = {conv: sum(r["conv_id"] == conv for r in rows) for conv in (1, 2)}
    assert all(r["n_parts"] == sizes[r["conv_id"]] for r in rows)
    if part_turns == 1000:
        assert len(rows) == 2


def test_rewrite_prompts(messages):
    questions = sessions.latest_questions(messages)
    history = sessions.messages_before(messages, questions)
    rows = sessions.prompt_parts(questions, history, 1000, REWRITE_PROMPT).collect()
    assert {r["conv_id"]: r["prompt"] for r in rows} == {
        1: REWRITE_PROMPT.format(chat_history="System: s\nHuman: q1\nAI: a1", question="q2"),
        2: REWRITE_PROMPT.format(chat_history="", question="only"),
    }


def test_drop_sessions(spark, messages):
    ids = spark.createDataFrame([(1,), (9,), (1,)], "conv_id bigint")
    assert {r["conv_id"] for r in sessions.drop_sessions(messages, ids).collect()} == {2, 3}
    assert {tuple(r) for r in sessions.drop_status(messages, ids).collect()} == {
        (1, "deleted"),
        (9, "not_found"),
    }


def test_last_questions_are_worked_out_once(spark):
    from textlake.plans.chat import LONG_PART, fixed, sessions

    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (2, 0, "system", "d"), (None, 0, "user", "e")]
    messages = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    questions = sessions.latest_questions(messages)
    assert sorted(map(tuple, questions.collect()), key=str) == [(1, 2, "c"), (None, 0, "e")]
    prompts = sessions.prompt_parts(
        questions, sessions.messages_before(messages, questions), LONG_PART, template=fixed.REWRITE_PROMPT
    )
    # Each of these sorted the texts again, eight times in one task.
    assert "SortAggregate" not in prompts._jdf.queryExecution().executedPlan().toString()
