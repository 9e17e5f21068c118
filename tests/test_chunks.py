from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textlake.functions.chunks import split_text
from textlake.operators.chunking import chunk_documents, wrap_documents

TEXTS = st.text(alphabet="ab .\n\té", max_size=300)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(1, 40), st.integers(0, 39))
def test_chunks_fit_and_cover(text, size, overlap):
    overlap = min(overlap, size - 1)
    chunks = split_text(text, size, overlap)
    assert all(chunk and chunk == chunk.strip() and len(chunk) <= size for chunk in chunks)
    at = 0
    covered = set()
    for chunk in chunks:
        start = text.find(chunk, max(0, at - size))
        assert start >= 0
        covered.update(range(start, start + len(chunk)))
        at = start + len(chunk)
    if overlap == 0:
        bare = lambda t: "".join(t.split())
        assert bare("".join(chunks)) == bare(text)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_short_text_is_one_chunk(text):
    expected = [text.strip()] if text.strip() else []
    assert split_text(text, 1000, 100) == expected


@pytest.mark.parametrize(
    ("text", "size", "overlap", "chunks"),
    [
        ("aaa bbb ccc ddd", 7, 0, ["aaa bbb", "ccc", "ddd"]),
        ("aaa bbb ccc ddd", 8, 4, ["aaa bbb", "bbb ccc", "ccc ddd"]),
        ("one\n\ntwo\n\nthree", 9, 0, ["one\n\ntwo", "three"]),
        ("para one\n\npara two is long", 10, 0, ["para one", "para two", "is long"]),
        ("abcdefghij", 4, 1, ["abcd", "defg", "ghij"]),
        ("", 10, 0, []),
        (" \n\n ", 10, 0, []),
    ],
)
def test_known_splits(text, size, overlap, chunks):
    assert split_text(text, size, overlap) == chunks


def test_chunk_documents(spark):
    docs = spark.createDataFrame(
        [(1, "aaa bbb ccc", "m"), (2, "", "m"), (3, None, "m")], "doc_id int, text string, tag string"
    )
    got = chunk_documents(docs, 7, 0).orderBy("chunk_no").collect()
    assert [(r["doc_id"], r["tag"], r["chunk_no"], r["text"]) for r in got] == [
        (1, "m", 0, "aaa bbb"),
        (1, "m", 1, "ccc"),
    ]


def test_overlap_must_be_below_size(spark):
    docs = spark.createDataFrame([("a",)], "text string")
    with pytest.raises(ValueError):
        chunk_documents(docs, 10, 10)


def test_wrap_documents(spark):
    news = spark.createDataFrame(
        [("BBC", "T", "l", None, "S", "neutral")],
        "source string, title string, link string, published string, summary string, "
        "sentiment string",
    )
    row = wrap_documents(news).first()
    assert row["page_content"] == "T\nS"
    assert row["metadata"].asDict() == {
        "source": "BBC",
        "link": "l",
        "published": "",
        "sentiment": "neutral",
    }


def plain_split(text, size, overlap, separators=("\n\n", "\n", " ", "")):
    """The same by plain string handling, for comparison."""
    separator, *finer = separators
    if separator and separator not in text:
        return plain_split(text, size, overlap, finer)
    if separator:
        head, *tail = text.split(separator)
        pieces = [p for p in (head, *(separator + t for t in tail)) if p]
    else:
        pieces = list(text)
    chunks, run = [], []

    def join(run):
        out, now = [], []
        for piece in run:
            if now and len("".join(now)) + len(piece) > size:
                out.append("".join(now))
                while now and (
                    len("".join(now)) > overlap or len("".join(now)) + len(piece) > size
                ):
                    now = now[1:]
            now = [*now, piece]
        return out + ["".join(now)] if now else out

    for piece in pieces:
        if len(piece) < size:
            run.append(piece)
            continue
        chunks += join(run)
        run = []
        chunks += plain_split(piece, size, overlap, finer) if finer else [piece]
    chunks += join(run)
    return [c.strip() for c in chunks if c.strip()]


@settings(max_examples=500, deadline=None)
@given(TEXTS, st.integers(1, 40), st.integers(0, 39))
def test_equals_plain_split(text, size, overlap):
    overlap = min(overlap, size - 1)
    assert split_text(text, size, overlap) == plain_split(text, size, overlap)


def test_documents_equal_plain_split(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got: dict[int, list[str]] = {}
    for row in chunk_documents(docs).orderBy("doc_id", "chunk_no").collect():
        got.setdefault(row["doc_id"], []).append(row["text"])
    assert got == {
        doc_id: chunks
        for doc_id, text in texts.items()
        if (chunks := plain_split(text, 500, 50))
    }


def test_texts_are_split_in_pieces():
    import pyarrow as pa

    from textlake.operators.chunking import slices

    texts = pa.array(["x" * 600] * 10 + [None, "", "y" * 5000, "z"])
    pieces = list(slices(texts, 1000))
    assert pa.concat_arrays(pieces).equals(texts)
    assert max(len(piece) for piece in pieces[:5]) <= 2
    assert [len(piece) for piece in slices(texts.slice(0, 0), 1000)] == [0]


def test_vectors_leave_in_pieces(spark):
    from textlake.operators.embedding import embed_text, hashed_words

    texts = [f"word{n} word" if n % 5 else (None if n % 2 else " ") for n in range(3000)]
    encode = hashed_words()()
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string").coalesce(1)
    got = {r["n"]: r["embedding"] for r in embed_text(rows, batch_size=64).collect()}
    assert [n for n, v in sorted(got.items()) if v is None] == list(range(0, 3000, 5))
    for n in (1, 63, 64, 2049, 2999):
        counts = encode(np.array([texts[n]], dtype=object))[0]
        assert np.allclose(got[n], counts / np.linalg.norm(counts))
