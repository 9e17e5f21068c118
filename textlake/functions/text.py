"""Column functions for text: all of them built from Spark's own functions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from textlake.functions import fixed_values as fixed

# The characters a Unicode-aware strip removes.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` knows only blanks)."""
    return F.btrim(text, F.lit(WHITESPACE))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strict_date(text: Column) -> Column:
    """The date written as ``yyyy-MM-dd``; null for anything else or no such day.

    The cast alone would take more spellings, and a date format is slower.
    """
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}\z"), text.try_cast("date"))


def combined_text(title: Column, summary: Column) -> Column:
    """Title and summary as one lower-cased text; a missing one is left out."""
    return F.lower(F.concat_ws(" ", title, summary))


def _has_any(text: Column, words: Sequence[str], whole_word: bool) -> Column:
    if whole_word:
        return text.rlike(r"\b(?:" + "|".join(re.escape(w) for w in words) + r")\b")
    return reduce(Column.__or__, [F.contains(text, F.lit(w)) for w in words])


def sentiment(
    text: Column,
    positive: Sequence[str] = fixed.POSITIVE_WORDS,
    negative: Sequence[str] = fixed.NEGATIVE_WORDS,
    whole_word: bool = False,
) -> Column:
    """``positive``, ``negative`` or ``neutral`` by the words in a lower-cased text.

    A word counts anywhere, also inside another word, and a positive one decides
    alone. ``whole_word`` counts only words that stand by themselves.
    """
    return (
        F.when(_has_any(text, positive, whole_word), "positive")
        .when(_has_any(text, negative, whole_word), "negative")
        .otherwise("neutral")
    )


def page_content(title: Column, summary: Column) -> Column:
    """Title, newline, summary; just the one that is there when one is blank."""
    title, summary = strip(text_or_empty(title)), strip(text_or_empty(summary))
    return F.concat_ws(
        "\n", F.nullif(title, F.lit("")), F.nullif(summary, F.lit(""))
    )


def metadata(source: Column, link: Column, published: Column, label: Column) -> Column:
    """The metadata of a document; missing values become empty text."""
    return F.struct(
        text_or_empty(source).alias("source"),
        text_or_empty(link).alias("link"),
        text_or_empty(published).alias("published"),
        text_or_empty(label).alias("sentiment"),
    )


def content_title(content: Column) -> Column:
    """The part of a page content before its first newline."""
    return F.substring_index(content, "\n", 1)


def content_body(content: Column) -> Column:
    """The part of a page content after its first newline, stripped."""
    return F.when(
        F.contains(content, F.lit("\n")),
        strip(F.substr(content, F.instr(content, "\n") + 1)),
    ).otherwise("")


def has_cjk(text: Column) -> Column:
    """Whether the text holds a CJK ideograph."""
    return text.rlike(fixed.CJK_PATTERN)


def clean_rewritten_query(rewritten: Column, original: Column) -> Column:
    """A rewritten query without the prefixes and quotes a model adds.

    The prefixes go wherever they stand. What is left must be longer than eight
    characters, else (or if the model gave nothing) the original question is used.
    """
    bare = reduce(
        lambda text, prefix: F.replace(text, F.lit(prefix), F.lit("")),
        fixed.REWRITE_PREFIXES,
        rewritten,
    )
    bare = F.coalesce(strip(F.translate(bare, "\"'", "")), F.lit(""))
    return F.when(F.length(bare) <= fixed.REWRITE_MIN_LENGTH, original).otherwise(bare)


def clean_translated_query(translated: Column, original: Column) -> Column:
    """A translated query without leading labels and without quotes at its ends."""
    bare = strip(translated)
    for prefix in fixed.TRANSLATION_PREFIXES:
        bare = F.when(
            F.startswith(F.upper(bare), F.lit(prefix.upper())),
            strip(F.substr(bare, F.lit(len(prefix) + 1))),
        ).otherwise(bare)
    bare = F.coalesce(F.btrim(bare, F.lit("\"'")), F.lit(""))
    return F.when(bare == "", original).otherwise(bare)


def speaker_line(role: Column, text: Column) -> Column:
    """One message of a rendered conversation: ``Human: …``, ``AI: …``."""
    name = role
    for key, speaker in fixed.SPEAKERS.items():
        name = F.when(role == key, speaker).otherwise(name)
    return F.concat(name, F.lit(": "), text)


def fill_template(template: str, **values: Column) -> Column:
    """A template text with its ``{name}`` places filled from columns.

    The texts between the places stay literals, so a value that itself holds
    ``{name}`` is never filled again.
    """
    parts: list[Column] = []
    rest = template
    while rest:
        places = [(rest.find("{" + name + "}"), name) for name in values]
        places = [place for place in places if place[0] >= 0]
        if not places:
            parts.append(F.lit(rest))
            break
        at, name = min(places)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(values[name])
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts)
