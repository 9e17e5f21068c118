from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from textlake.functions import text as tx
from textlake.functions.html import decode_entities, html_to_text


def apply(spark, function, *rows):
    """One result per row of arguments; all text."""
    width = len(rows[0])
    df = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)],
        "i int, " + ", ".join(f"c{n} string" for n in range(width)),
    )
    out = df.select("i", function(*[F.col(f"c{n}") for n in range(width)]).alias("r"))
    return [row["r"] for row in out.orderBy("i").collect()]


def test_strip_takes_all_white_space(spark):
    assert apply(spark, tx.strip, (" \t a b　\n",), ("\x1c",)) == ["a b", ""]


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("a great day", "positive"),
        ("an award", "negative"),  # holds "war"
        ("winter is coming", "positive"),  # holds "win"
        ("good and bad", "positive"),
        ("crisis", "negative"),
        ("nothing", "neutral"),
        (None, "neutral"),
    ],
)
def test_sentiment(spark, text, label):
    assert apply(spark, tx.sentiment, (text,)) == [label]


def test_sentiment_of_whole_words(spark):
    whole = lambda c: tx.sentiment(c, whole_word=True)
    got = apply(spark, whole, ("winter",), ("award",), ("a win!",), ("at war",))
    assert got == ["neutral", "neutral", "positive", "negative"]


def test_strict_date(spark):
    rows = ["2026-02-28", "2026-02-30", "2026-2-3", "2026", "2026-01-05\n", "2026-01-05T10", "", None]
    got = apply(spark, lambda c: tx.strict_date(c).cast("string"), *[(r,) for r in rows])
    assert got == ["2026-02-28", *[None] * 7]


def test_combined_text(spark):
    got = apply(spark, tx.combined_text, ("A", "B"), ("A", None), (None, None))
    assert got == ["a b", "a", ""]


def test_page_content(spark):
    got = apply(
        spark, tx.page_content, (" T ", " S\n"), ("T", "\t"), (None, "S"), (None, None)
    )
    assert got == ["T\nS", "T", "S", ""]


def test_content_parts(spark):
    rows = [("T\n S\nmore ",), ("only",), ("",)]
    assert apply(spark, tx.content_title, *rows) == ["T", "only", ""]
    assert apply(spark, tx.content_body, *rows) == ["S\nmore", "", ""]


def test_has_cjk(spark):
    got = apply(spark, tx.has_cjk, ("新闻",), ("news é",), ("a 中 b",))
    assert got == [True, False, True]


def test_clean_rewritten_query(spark):
    got = apply(
        spark,
        tx.clean_rewritten_query,
        ('Rewritten question: "What is new today?"', "q"),
        ("What AI: is User:this about", "q"),
        ("Human: 'short'", "the question"),
        ("12345678", "the question"),
        ("123456789", "the question"),
        ("rewritten question: case matters", "q"),
    )
    assert got == [
        "What is new today?",
        "What  is this about",
        "the question",
        "the question",
        "123456789",
        "rewritten question: case matters",
    ]


def test_clean_translated_query(spark):
    got = apply(
        spark,
        tx.clean_translated_query,
        (' english: "Any news?" ', "q"),
        ("Translation: EN: it's new", "q"),
        ("EN: English: x", "q"),
        ("no EN: inside", "q"),
        ("''", "原文"),
        ("", "原文"),
    )
    assert got == ["Any news?", "it's new", "English: x", "no EN: inside", "原文", "原文"]


def test_speaker_line(spark):
    got = apply(spark, tx.speaker_line, ("user", "a"), ("assistant", "b"), ("tool", "c"))
    assert got == ["Human: a", "AI: b", "tool: c"]


def test_fill_template_fills_places_once(spark):
    fill = lambda a, b: tx.fill_template("<{b}|{a}|{b}> {c}", a=a, b=b)
    assert apply(spark, fill, ("{b}", "y")) == ["<y|{b}|y> {c}"]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>a</p><p>b</p>", "ab"),
        ("<p> a </p>\n<p>b c</p>", "ab c"),
        ("x<!-- <b>no</b> -->y", "xy"),
        ("<script>if (a < b) { '<p>' }</script>t", "t"),
        ("<STYLE type='x'>p{}</STYLE >t", "t"),
        ("t<script>never closed", "t"),
        ("<scripted>kept</scripted>", "kept"),
        ('<a title="x > y">link</a>', "link"),
        ("<a title='x > y' b=c>link</a>", "link"),
        ("<p class=it's>don't</p>", "don't"),
        ('<a href="never closed>text</a>', "text"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("&lt;b&gt; &amp;amp; &copy; &eacute;", "<b> &amp; © é"),
        ("&nbsp;a&nbsp;<b>&#160;b&#xa0;</b>", "ab"),
        ("&#8364;&#x20AC;&#128;", "€€€"),
        ("&copy 2024 &unknown; &", "© 2024 &unknown &"),
        ("&#0;&#xD800;&#99999999999;", "���"),
        ("", ""),
        (None, ""),
    ],
)
def test_html_to_text(spark, html, text):
    assert apply(spark, html_to_text, (html,)) == [text]


def test_html_to_text_with_separator(spark):
    assert apply(spark, lambda h: html_to_text(h, " "), ("<p>a</p> <br><p>b</p>",)) == ["a b"]


def test_long_tags_and_blanks_do_not_overflow(spark):
    attributes = " ".join(f'a{i}="v > {i}"' for i in range(20_000))
    got = apply(spark, html_to_text, (f"<p {attributes}>x</p>" + " " * 200_000 + "y",))
    assert got == ["xy"]


def test_decode_without_references(spark):
    assert apply(spark, decode_entities, ("plain",), (None,)) == ["plain", None]
