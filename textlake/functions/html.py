"""HTML to plain text with Spark's own functions, no Python worker."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from textlake.functions.text import strip, text_or_empty

# Elements whose content is not text of the page. Script and style run to the
# end of the page when they are never closed.
_RAW = [
    rf"{name}(?:\s[^>]*+)?>.*?(?:</{name}\s*>|\z)" for name in ("script", "style")
] + [
    rf"{name}(?:\s[^>]*+)?>.*?</{name}\s*>" for name in ("template", "rt", "rp")
]
# A tag ends at the first ">" outside a quoted attribute value, or, when quotes
# do not match up, at the first ">" of all.
_TAGS = [
    r"""[a-z/!?](?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+>""",
    r"[a-z/!?][^>]*+>",
]
MARKUP = "(?is)<(?:" + "|".join(["!--.*?-->", *_RAW, *_TAGS]) + ")"
_PIECES = r"(&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[a-zA-Z][a-zA-Z0-9]*;?|[^&]+|&)"

# Numbers 128 to 159 mean Windows-1252 characters in HTML.
_WINDOWS = "".join(
    bytes([code]).decode("cp1252", errors="replace") for code in range(128, 160)
)


def _character(code: Column) -> Column:
    surrogate = code.between(0xD800, 0xDFFF)
    return (
        F.when(code.between(128, 159), F.substr(F.lit(_WINDOWS), (code - 127).cast("int"), F.lit(1)))
        .when(
            code.between(1, 0x10FFFF) & ~surrogate,
            F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"),
        )
        .otherwise("\ufffd")
    )


def _names() -> Column:
    """Name to character, from the standard library's table; folded to a constant."""
    table = {name.rstrip(";"): text for name, text in html5.items()}
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def decode_entities(text: Column) -> Column:
    """Replace named and numbered character references.

    An unknown name keeps its ampersand and name and loses its semicolon.
    """

    def decode(piece: Column) -> Column:
        name = F.rtrim(F.substr(piece, F.lit(2)), F.lit(";"))
        number = F.substr(name, F.lit(2))
        return (
            F.when(~F.startswith(piece, F.lit("&")) | (piece == "&"), piece)
            .when(name == "amp", "&")
            .when(name == "nbsp", "\u00a0")
            .when(
                F.startswith(F.lower(name), F.lit("#x")),
                _character(F.conv(F.substr(name, F.lit(3)), 16, 10).try_cast("bigint")),
            )
            .when(F.startswith(name, F.lit("#")), _character(number.try_cast("bigint")))
            .otherwise(
                F.coalesce(F.try_element_at(_names(), name), F.concat(F.lit("&"), name))
            )
        )

    pieces = F.regexp_extract_all(text, F.lit(_PIECES))
    return F.when(
        F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, decode), "")
    ).otherwise(text)


def html_to_text(html: Column, separator: str = "") -> Column:
    """The text of a page: each run between two tags stripped, then joined.

    Comments, scripts and style sheets are left out. The default joins the runs
    with nothing in between. Missing input gives empty text.
    """
    runs = F.transform(F.split(html, MARKUP, -1), lambda run: strip(decode_entities(run)))
    return text_or_empty(F.array_join(F.filter(runs, lambda run: run != ""), separator))
