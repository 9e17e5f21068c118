"""Personal data: patterns propose spans, checks confirm them, context adjusts the score.

Each kind has a pattern, a check (digit counts, Luhn, mod-97 and the like) and a
prior score. Words that stand near a span raise the score (``card``, ``iban``, ``call`` ...) or
lower it (``order``, ``invoice`` ...). The four base kinds are kept once confirmed,
whatever their score; the further kinds must also reach ``MIN_SCORE``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_SCORE = 0.5
# Code points looked at before and after a span for context words.
CONTEXT = 48


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number in international form has the right check digits."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _is_ip(text: str) -> bool:
    # int() refuses very long runs of digits, which are no address anyway.
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in text.split("."))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def _is_iban(text: str) -> bool:
    bare = text.replace(" ", "")
    return 15 <= len(bare) <= 34 and mod97(bare)


def _is_ssn(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


@dataclass(frozen=True)
class Kind:
    """``near``: characters without one of which a text cannot hold the kind."""

    name: str
    pattern: str
    check: Callable[[str], bool]
    prior: float
    near: str
    base: bool = False


# The agreed kinds, their patterns and order.
KINDS = (
    Kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda _: True, 0.9, "@", True),
    Kind("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", _is_ip, 0.7, "", True),
    Kind("card", r"[0-9]([\x20-]?[0-9])+", _is_card, 0.8, "", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _is_phone, 0.7, "+", True),
    Kind("iban", r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])", _is_iban, 0.8, ""),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _is_ssn, 0.4, "-"),
)

# Words near a span that speak for a kind, and against any.
RAISING = {
    "email": ("mail", "contact", "write", "correo", "courriel"),
    "ip": ("address", "host", "server", "login", "ip"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "tarjeta", "carte", "karte"),
    "phone": ("call", "phone", "tel", "mobile", "fax", "whatsapp"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta", "swift", "bic"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
}
LOWERING = ("order", "invoice", "version", "isbn", "serial", "part", "sku", "tracking")

_PATTERNS = {k.name: re.compile(k.pattern) for k in KINDS}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_NUMBER = re.compile("[0-9]+")
_WORD = re.compile("[a-z]+")
_DIGIT = re.compile("[0-9]")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float
    base: bool


def context_score(text: str, kind: Kind, start: int, end: int) -> float:
    around = text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]
    found = set(_WORD.findall(around.lower()))
    score = kind.prior
    if found & set(RAISING[kind.name]):
        score += 0.2
    if found & set(LOWERING):
        score -= 0.3
    return round(min(max(score, 0.0), 1.0), 3)


def _email_places(text: str) -> Iterator[tuple[int, int]]:
    """The pattern's leftmost matches, found from each ``@`` so that long runs cost no more."""
    done = 0
    for match in _DOMAIN.finditer(text):
        start = match.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < match.start():
            done = match.end()
            yield start, done


def _ip_places(text: str) -> Iterator[tuple[int, int]]:
    """The pattern's leftmost matches: each four parts of a dotted run."""
    for match in _DOTTED.finditer(text):
        parts = list(_NUMBER.finditer(text, *match.span()))
        for i in range(0, len(parts) - 3, 4):
            yield parts[i].start(), parts[i + 3].end()


def _places(kind: Kind, text: str) -> Iterator[tuple[int, int]]:
    if kind.name == "email":
        return _email_places(text)
    if kind.name == "ip":
        return _ip_places(text)
    return (m.span() for m in _PATTERNS[kind.name].finditer(text))


def find_spans(text: str) -> Iterator[Span]:
    """Confirmed spans by kind, then by place. Matches of one kind do not overlap."""
    digits = _DIGIT.search(text) is not None
    for kind in KINDS:
        if kind.near not in text or (kind.name != "email" and not digits):
            continue
        for start, end in _places(kind, text):
            if not kind.check(text[start:end]):
                continue
            score = context_score(text, kind, start, end)
            if kind.base or score >= MIN_SCORE:
                yield Span(kind.name, start, end, score, kind.base)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, as ``<KIND>`` of its first."""
    out, done = [], 0
    for span in sorted(spans, key=lambda s: (s.start, -s.end)):
        if span.start >= done:
            out += [text[done : span.start], f"<{span.kind.upper()}>"]
        done = max(done, span.end)
    return "".join(out) + text[done:]


SPAN_SCHEMA = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"


def _scan(batches, keep: list[str], redact: bool):
    for batch in batches:
        spans, texts = [], []
        for value in batch.column("text"):
            text = value.as_py()
            found = list(find_spans(text or ""))
            spans.append([vars(s) for s in found])
            if redact:
                texts.append(redacted(text, found) if found else text)
        kind = pa.struct(
            [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())]
        )
        columns = {name: batch.column(name) for name in keep}
        if redact:
            columns["text"] = pa.array(texts, pa.string())
        columns["pii_spans"] = pa.array(spans, pa.list_(kind))
        yield pa.RecordBatch.from_pydict(columns)


def pii_spans(documents: DataFrame) -> DataFrame:
    """``doc_id, pii_spans`` for every row: the confirmed spans of the whole text.

    A null or empty text has none. Rows stay as they are, equal ones included.
    """
    id_type = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        lambda batches: _scan(batches, ["doc_id"], False),
        f"doc_id {id_type}, pii_spans {SPAN_SCHEMA}",
    )


def redact_pii(documents: DataFrame) -> DataFrame:
    """The same rows and columns with spans in ``text`` replaced by ``<KIND>``.

    A null text stays null. All other columns pass through, whatever their names.
    """
    # Only what the scan reads goes to Python besides the columns passed through.
    names = [f"c{i}" for i in range(len(documents.columns))]
    at = documents.columns.index("text")
    plain = documents.toDF(*names).withColumnRenamed(names[at], "text")
    keep = [n for n in names if n != names[at]]
    schema = ", ".join(
        [f"{n} {plain.schema[n].dataType.simpleString()}" for n in keep]
        + ["text string", f"pii_spans {SPAN_SCHEMA}"]
    )
    done = plain.mapInArrow(lambda batches: _scan(batches, keep, True), schema)
    order = ["text" if i == at else n for i, n in enumerate(names)]
    return done.select(*order).toDF(*documents.columns)


def span_digests(found: DataFrame) -> DataFrame:
    """Counts and one-line forms of ``pii_spans``: see ``pii_spans``."""

    def count(kind: str):
        hits = F.filter("pii_spans", lambda s: s["kind"] == kind)
        return F.size(hits).cast("bigint").alias(f"n_{kind}")

    def line(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    base = F.filter("pii_spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[count(k.name) for k in KINDS],
        F.sha2(line(base), 256).alias("base_sha256"),
        line(F.col("pii_spans")).alias("spans"),
    )
