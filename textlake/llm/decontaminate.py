"""Test items inside documents: size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle sets: an item of more than ``size / 2`` and
up to ``size`` shingles belongs to the class ``size``, a power of two. For every class a document is a
row of blocks of ``size`` shingles, and each two neighbouring blocks are a window; an item
that stands in one piece lies whole in some window. So window and item have a Jaccard
similarity of 0.19 or more however long the document is, and with one least hash value per band the
number of bands that finds all but one in a million such pairs is fixed (``bands_for``).
Candidates are verified by the exact share of the item's shingles that the whole document holds.

Items below five words have one shingle, their whole sequence of words. They are looked for among all
runs of as many words of a document, which is exact.

Items are the stated queries. They go to the tasks in blocks of a bounded number of shingles; every
block meets every document where it lies, so documents are never shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.storage import Scratch
from textlake.llm.words import Words, mix, shingles, slices, words

SHINGLE = 5
THRESHOLD = 0.8
MISS = 1e-6
# Shingles of all items that go to the tasks at a time: 16 MB.
BLOCK_SHINGLES = 2_000_000
_TOP = 65536


def bands_for(threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Bands after which a true pair is unseen with probability ``miss`` at most.

    The worst pair: an item just over half its class size, ``threshold`` of which lies in a
    window of four times as many other shingles.
    """
    return math.ceil(math.log(miss) / math.log(1 - threshold / (5 - threshold)))


def _factors(bands: int) -> np.ndarray:
    """One odd factor per band; multiplying by it reorders the (well mixed) shingle hashes."""
    return mix(np.arange(1, bands + 1, dtype=np.uint64)) | np.uint64(1)


@dataclass
class Items:
    """A block of items, ready for the search."""

    ids: pa.Array
    sets: list[np.ndarray]
    # By number of words: the items shorter than a shingle, in the order of their hashes.
    short: dict[int, tuple[np.ndarray, np.ndarray]]
    # By class and band: which leading bits occur, and the items of each value.
    marks: dict[int, np.ndarray]
    owners: dict[int, list[dict[int, list[int]]]]
    threshold: float
    bands: int


def prepare(ids: pa.Array, sets: list[np.ndarray], n_words: np.ndarray, threshold: float) -> Items:
    """Items with their sets of shingles and their numbers of words (those beyond a shingle's don't matter)."""
    bands = bands_for(threshold)
    short = {}
    for length in np.unique(n_words[n_words < SHINGLE]).tolist():
        own = np.flatnonzero(n_words == length)
        own = own[np.argsort([sets[i][0] for i in own], kind="stable")]
        short[length] = np.array([sets[i][0] for i in own], np.uint64), own
    factors = _factors(bands)
    marks: dict[int, np.ndarray] = {}
    owners: dict[int, list[dict[int, list[int]]]] = {}
    for i, own in enumerate(sets):
        if n_words[i] < SHINGLE:
            continue
        size = 1 << (len(own) - 1).bit_length()
        if size not in marks:
            marks[size] = np.zeros((bands, _TOP), bool)
            owners[size] = [{} for _ in range(bands)]
        for band, factor in enumerate(factors):
            value = (own * factor).min()
            marks[size][band, value >> np.uint64(48)] = True
            owners[size][band].setdefault(int(value), []).append(i)
    return Items(ids, sets, short, marks, owners, threshold, bands)


def _blocks(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the blocks of each text, the texts they belong to, and each text's first block."""
    n = -(-np.diff(first) // size)
    owner = np.repeat(np.arange(len(n)), n)
    begin = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=begin[1:])
    return first[owner] + (np.arange(len(owner)) - begin[owner]) * size, owner, begin


def _candidates(hashes: np.ndarray, first: np.ndarray, items: Items) -> set[tuple[int, int]]:
    """Pairs of text and item that agree in a band."""
    found: set[tuple[int, int]] = set()
    if not len(hashes) or not items.marks:
        return found
    classes = sorted(items.marks)
    base = classes[0]
    starts, _, begin = _blocks(first, base)
    coarser = {size: _blocks(begin, size // base) for size in classes}
    for band, factor in enumerate(_factors(items.bands)):
        least = np.minimum.reduceat(hashes * factor, starts)
        for size in classes:
            at, owner, _ = coarser[size]
            window = np.minimum.reduceat(least, at)
            same = owner[1:] == owner[:-1]
            window[:-1] = np.where(same, np.minimum(window[:-1], window[1:]), window[:-1])
            for hit in np.flatnonzero(items.marks[size][band][window >> np.uint64(48)]):
                for item in items.owners[size][band].get(int(window[hit]), ()):
                    found.add((int(owner[hit]), item))
    return found


def _short_hits(found: Words, items: Items) -> set[tuple[int, int]]:
    """Pairs of text and item below a shingle's length that stands in it word for word."""
    hits: set[tuple[int, int]] = set()
    for length, (wanted, own) in items.short.items():
        hashes, first = shingles(found, length, short=False)
        low = np.searchsorted(wanted, hashes)
        high = np.searchsorted(wanted, hashes, side="right")
        met = np.flatnonzero(high > low)
        text = np.searchsorted(first, met, side="right") - 1
        for row, a, b in np.unique(np.stack([text, low[met], high[met]]), axis=1).T.tolist():
            hits.update((row, int(item)) for item in own[a:b])
    return hits


def search(column: pa.Array, items: Items):
    """Confirmed ``(row, item, shared)`` of a column of texts."""
    for piece in slices(column):
        found = words(piece)
        for text, item in sorted(_short_hits(found, items)):
            yield piece.low + text, item, 1
        hashes, first = shingles(found, SHINGLE, short=False)
        sets: dict[int, np.ndarray] = {}
        for text, item in sorted(_candidates(hashes, first, items)):
            if text not in sets:
                sets[text] = np.unique(hashes[first[text] : first[text + 1]])
            own = items.sets[item]
            shared = int(np.isin(own, sets[text], assume_unique=True).sum())
            if shared >= items.threshold * len(own) - 1e-9:
                yield piece.low + text, item, shared


def _item_shingles(batches):
    for batch in batches:
        made, n_words = [], []
        for piece in slices(batch.column("text")):
            found = words(piece)
            hashes, first = shingles(found, SHINGLE)
            made += [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(first[:-1], first[1:], strict=True)]
            n_words += np.minimum(np.diff(found.first), SHINGLE).tolist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.array(made, pa.list_(pa.int64())), pa.array(n_words, pa.int32())],
            names=["item_id", "shingles", "n_words"],
        )


def _item_blocks(benchmark: DataFrame, threshold: float, least_words: int = 1):
    """Blocks of items, each small enough for all tasks; items of fewer words (or none) are left out."""
    scratch = Scratch(benchmark.sparkSession, "test-items")
    id_type = benchmark.schema["item_id"].dataType.simpleString()
    made = benchmark.select("item_id", "text").mapInArrow(
        _item_shingles, f"item_id {id_type}, shingles array<bigint>, n_words int"
    )
    made = scratch.keep(made.where(F.col("n_words") >= max(least_words, 1)).distinct(), "shingles")
    total = made.agg(F.sum(F.size("shingles"))).first()[0] or 0
    n_blocks = math.ceil(total / BLOCK_SHINGLES)
    for block in range(n_blocks):
        # By content too, so that one id with many texts is divided as well.
        part = made.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(n_blocks)) == block).toArrow()
        sets = [np.array(s.as_py(), np.int64).view(np.uint64) for s in part.column("shingles")]
        if sets:
            ids = part.column("item_id").combine_chunks()
            yield prepare(ids, sets, part.column("n_words").to_numpy(), threshold)


def find_items(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document and item found in it.

    Columns: ``doc_id, item_id, n_item`` (distinct five-word shingles of the item), ``n_shared``
    (of them in the document) and ``containment``, at least ``threshold``. An item below five words counts
    as one shingle, its whole sequence of words. Null and empty texts hold no item, and items without
    words are in no text. Ids may be of any type, and null. Equal rows of documents
    give equal rows back, equal items count once; other columns are not looked at.
    """
    spark = documents.sparkSession
    types = [documents.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType]
    schema = (
        f"doc_id {types[0].simpleString()}, item_id {types[1].simpleString()}, n_item bigint, n_shared bigint"
    )
    found = spark.createDataFrame([], schema)
    for items in _item_blocks(benchmark, threshold):
        sent = spark.sparkContext.broadcast(items)

        def run(batches, sent=sent):
            items = sent.value
            for batch in batches:
                hits = list(search(batch.column("text"), items))
                rows = [h[0] for h in hits]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(rows, pa.int64())),
                        items.ids.take(pa.array([h[1] for h in hits], pa.int64())),
                        pa.array([len(items.sets[h[1]]) for h in hits], pa.int64()),
                        pa.array([h[2] for h in hits], pa.int64()),
                    ],
                    names=["doc_id", "item_id", "n_item", "n_shared"],
                )

        found = found.unionByName(documents.select("doc_id", "text").mapInArrow(run, schema))
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def drop_contaminated(
    documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least_words: int = SHINGLE
) -> DataFrame:
    """The documents that hold no item of ``least_words`` or more, with all their columns as they are.

    A document that holds shorter items only is kept: a few words that also make up a test item
    (a name, a number) stand in clean text as well. ``find_items`` lists them; ``least_words=1`` drops them.
    """
    spark = documents.sparkSession
    names = [f"c{i}" for i in range(len(documents.columns))]
    at = documents.columns.index("text")
    kept = documents.toDF(*names)
    for items in _item_blocks(benchmark, threshold, least_words):
        sent = spark.sparkContext.broadcast(items)

        def run(batches, sent=sent):
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[h[0] for h in search(batch.column(at), sent.value)]] = False
                yield batch.filter(pa.array(clean))

        kept = kept.mapInArrow(run, kept.schema)
    return kept.toDF(*documents.columns)

