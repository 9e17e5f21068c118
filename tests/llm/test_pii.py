"""Personal data against the plain patterns."""

from __future__ import annotations

import hashlib
import random
import re

from textlake.llm import pii, registry

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                double = [int(d) * 2 - 9 * (int(d) > 4) for d in digits[-2::-2]]
                total = sum(double) + sum(map(int, digits[-1::-2]))
                if not 13 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def base(text):
    return [f"{s.kind}:{s.start}:{s.end}" for s in pii.find_spans(text) if s.base]


def test_base_spans_as_the_patterns():
    draw = random.Random(5)
    bits = ["a", "b.c", "@", ".", "1", "22", "255", "256", "+", "-", " ", "(", ")", "4111111111111111", "é", "x@y.zz", "1.2.3.4", "%", "_"]
    for _ in range(20000):
        text = "".join(draw.choices(bits, k=draw.randint(0, 14)))
        assert base(text) == plain_spans(text), text


def test_checks():
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB83WEST12345698765432")
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    found = [(s.kind, s.base) for s in pii.find_spans("my iban GB82 WEST 1234 5698 7654 32 ok")]
    assert found == [("iban", False)]
    assert not list(pii.find_spans("order part 123-45-6789 serial"))
    assert [s.kind for s in pii.find_spans("social security 123-45-6789")] == ["ssn"]


def test_query_over_whole_texts(spark, folder):
    got = {r.doc_id: r for r in registry.op6_pii(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(rows)
    for row in rows:
        wanted = plain_spans(row.text)
        assert got[row.doc_id].base_sha256 == hashlib.sha256(",".join(wanted).encode()).hexdigest()
        assert got[row.doc_id].n_email == sum(w.startswith("email") for w in wanted)
        assert set(wanted) <= set(filter(None, got[row.doc_id].spans.split(",")))


def test_odd_rows(spark):
    text = "write to a.b@c.de or +49 30 1234567, call 1.2.3.4 " + "x" * 200_000 + " z@z.io"
    rows = [(1, text, "k", 1.0), (None, None, None, None), (3, "", "k", None), (1, text, "k", 1.0), (5, "1" * 300_000, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pii_spans string, c0 double")
    got = pii.span_digests(pii.pii_spans(docs)).collect()
    assert len(got) == 5 and sorted(r.n_email for r in got) == [0, 0, 0, 2, 2]
    clean = pii.redact_pii(docs)
    assert clean.columns == docs.columns
    by = {(r.doc_id, r.pii_spans): r.text for r in clean.collect()}
    assert by[(1, "k")].startswith("write to <EMAIL> or <PHONE>, call <IP> ")
    assert by[(None, None)] is None and by[(3, "k")] == ""
    assert pii.redact_pii(docs.limit(0)).count() == 0
