"""Repeated passages by a logarithmic family of suffix indexes.

A byte goes if it lies in a stretch of ``LENGTH`` bytes that also starts somewhere else. The
suffixes that matter are anchored: of the ``LENGTH - PREFIX + 1`` places in a stretch at which
``PREFIX`` bytes begin, the one with the least hash is the stretch's anchor, so equal stretches have
their anchors at equal offsets. A batch's anchored suffixes, in the order of the hashes of their
first ``PREFIX`` bytes, are its (sparse) suffix array.

* ``SuffixLevels`` keeps such arrays in levels. A new batch is sorted, merge-scanned against every
  level for suffixes that begin alike, and becomes level 0; two levels of equal size merge into
  the next. So a suffix is rewritten once per doubling of the corpus.
* Suffixes with a partner are then extended. For an anchor and a range of offsets, all its stretches
  are repeated if the bytes they span together are; none is, unless the bytes they share are.
  Ranges that are neither are split: first the anchor's own range, then cells of ``CELL``
  offsets, then single offsets. Every step counts equal hashes, so no group of copies meets in
  one task.

Texts that occur twice or more go whole, and take part as one. Hashes have 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlake.llm.storage import Scratch
from textlake.llm.words import Slice, mix, prefix_hash, signed, slices, stretch_hash
from textlake.operators.merge import fits_broadcast

LENGTH = 400
PREFIX = 200
CELL = 20
BATCHES = 4

_WINDOW = LENGTH - PREFIX + 1
_ID = ["d", "t"]


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


# --- anchors -----------------------------------------------------------------


def anchors(piece: Slice) -> tuple[np.ndarray, ...]:
    """Text, place in it, key and least and greatest offset of every anchor of a slice.

    A stretch that starts ``offset`` bytes before the place has this anchor.
    """
    n = len(piece.data)
    if n < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none, none
    place = np.arange(n - PREFIX + 1)
    keys = stretch_hash(prefix_hash(piece.data), place, place + PREFIX)
    # Hash first, then place: of equal hashes the leftmost counts.
    high = np.uint64(0xFFFFFFFF00000000)
    packed = (keys & high) | place.astype(np.uint64)
    rows = -(-len(packed) // _WINDOW)
    blocks = np.full(rows * _WINDOW, np.uint64(0xFFFFFFFFFFFFFFFF))
    blocks[: len(packed)] = packed
    blocks = blocks.reshape(rows, _WINDOW)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - LENGTH + 1
    least = np.minimum(after[:starts], before[_WINDOW - 1 : _WINDOW - 1 + starts])
    ends = np.repeat(piece.offsets[1:], np.diff(piece.offsets))[:starts]
    start = np.flatnonzero(np.arange(starts) + LENGTH <= ends)
    at = (least[start] & ~high).astype(np.int64)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none, none
    turn = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(turn[1:], len(at)) - 1
    where = at[turn]
    text = np.searchsorted(piece.offsets, where, side="right") - 1
    return text, where - piece.offsets[text], keys[where], where - start[last], where - start[turn]


def _anchor_rows(batches):
    for batch in batches:
        for piece in slices(batch.column("text")):
            text, where, keys, least, greatest = anchors(piece)
            rows = pa.array(text + piece.low)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("d").take(rows),
                    batch.column("t").take(rows),
                    signed(keys),
                    pa.array(where),
                    pa.array(least.astype(np.int32)),
                    pa.array(greatest.astype(np.int32)),
                ],
                names=["d", "t", "key", "place", "least", "greatest"],
            )


ANCHOR_SCHEMA = "d bigint, t bigint, key bigint, place bigint, least int, greatest int"


# --- levels ------------------------------------------------------------------


class SuffixLevels:
    """Sorted suffix arrays of geometrically growing size.

    A level holds ``key, n``: how often a suffix beginning occurs. ``add`` gives the keys
    that the new batch shares with itself or with any level.
    """

    def __init__(self, spark: SparkSession, scratch: Scratch):
        self.spark = spark
        self.scratch = scratch
        self.levels: dict[int, DataFrame] = {}

    def add(self, batch: DataFrame) -> DataFrame:
        """Take in rows of ``key``; the result is the stored table of repeated keys."""
        fresh = self._sorted(batch.groupBy("key").agg(F.count("*").alias("n")))
        repeated = fresh.where("n > 1").select("key")
        for level in self.levels.values():
            repeated = repeated.unionByName(fresh.select("key").join(level.select("key"), "key"))
        repeated = self.scratch.keep(repeated.distinct(), "repeated")
        size = 0
        while size in self.levels:  # equal sizes merge
            old = self.levels.pop(size)
            both = old.unionByName(fresh).groupBy("key").agg(F.sum("n").alias("n"))
            merged = self._sorted(both)
            self.scratch.drop(old, fresh)
            fresh, size = merged, size + 1
        self.levels[size] = fresh
        return repeated

    def _sorted(self, run: DataFrame) -> DataFrame:
        return self.scratch.keep(run.sortWithinPartitions("key"), "level")


# --- extension ---------------------------------------------------------------


def _hash_rows(batches, constant: bool):
    """Hashes of what each range of offsets spans and shares, for texts with their ranges."""
    for batch in batches:
        lists = batch.column("ranges")
        for piece in slices(batch.column("text")):
            part = lists.slice(piece.low, piece.high - piece.low)
            size = part.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = part.flatten()
            place, low, high = (
                flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)
            )
            text = np.repeat(np.arange(len(size)), size)
            base, end = piece.offsets[text], piece.offsets[text + 1]
            at = base + place
            sums = prefix_hash(piece.data)
            salt = mix((low * 1009 + high).astype(np.uint64))
            # Offsets low to high (exclusive): the first stretch starts at ``at - high + 1``.
            first, last = at - high + 1, at - low
            inside = (first >= base) & (last + LENGTH <= end)
            span = stretch_hash(sums, np.maximum(first, base), np.minimum(last + LENGTH, end)) ^ salt
            shared = stretch_hash(sums, last, np.maximum(first + LENGTH, last)) ^ ~salt
            rows = pa.array(text + piece.low)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("d").take(rows),
                    batch.column("t").take(rows),
                    *[flat.field(i) for i in range(flat.type.num_fields)],
                    pa.array(span.view(np.int64), mask=~inside),
                    signed(shared),
                ],
                names=["d", "t", *[f.name for f in flat.type], "span", "shared"],
            )


_RANGE = "place bigint, low int, high int, key bigint, least int, greatest int, open boolean"


def _hashed(texts: DataFrame, ranges: DataFrame) -> DataFrame:
    """``ranges`` with ``span`` and ``shared``; a text's ranges come to its row, and leave as rows."""
    names = [f.split()[0] for f in _RANGE.split(", ")]
    lists = ranges.groupBy(*_ID).agg(F.collect_list(F.struct(*names)).alias("ranges"))
    met = texts.join(lists, _ID).select(*_ID, "text", "ranges")
    schema = f"d bigint, t bigint, {_RANGE}, span bigint, shared bigint"
    return met.mapInArrow(lambda batches: _hash_rows(batches, True), schema)


def _often(rows: DataFrame, column: str, scratch: Scratch) -> DataFrame:
    """The values of a column that occur twice or more, as ``column, twice``."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return scratch.keep(counts.where("n > 1").select(column, F.lit(True).alias("twice")), "often")


def _settled(rows: DataFrame) -> DataFrame:
    """The bytes that repeated ranges cover, as ``d, t, low, high``."""
    return rows.select(
        *_ID,
        (F.col("place") - F.col("high") + 1).alias("low"),
        (F.col("place") - F.col("low") + LENGTH).alias("high"),
    )


def _covered(texts: DataFrame, repeated: DataFrame, scratch: Scratch) -> DataFrame:
    """Bytes covered by repeated stretches, from anchors whose key is repeated."""
    # The anchor's own range of offsets.
    own = repeated.select(
        *_ID,
        "place",
        F.col("least").alias("low"),
        (F.col("greatest") + 1).cast("int").alias("high"),
        "key",
        "least",
        "greatest",
        F.lit(True).alias("open"),
    )
    first = scratch.keep(_hashed(texts, own), "own-ranges")
    spans = _often(first, "span", scratch)
    first = scratch.keep(
        first.join(spans, "span", "left").withColumn("open", F.col("twice").isNull()).drop("twice"), "first"
    )
    # Cells: of the open anchors, and of all that begin like one.
    keys = scratch.keep(first.where("open").select("key").distinct(), "open-keys")
    cells = first.join(keys, "key", "left_semi").select(
        *_ID,
        "place",
        F.explode(
            F.sequence(F.floor(F.col("least") / CELL).cast("int"), F.floor(F.col("greatest") / CELL).cast("int"))
        ).alias("cell"),
        "key",
        "least",
        "greatest",
        "open",
    )
    cells = cells.withColumn("low", (F.col("cell") * CELL).cast("int")).withColumn(
        "high", (F.col("cell") * CELL + CELL).cast("int")
    )
    second = scratch.keep(_hashed(texts, cells.drop("cell")), "cells")
    spans = _often(second, "span", scratch)
    second = second.join(spans, "span", "left")
    done = second.where("open AND twice")
    second = second.withColumn("open", F.col("open") & F.col("twice").isNull()).drop("twice")
    second = scratch.keep(second, "second")
    # Single offsets: of open cells whose shared bytes are repeated, and all that share them.
    shared = _often(second, "shared", scratch).drop("twice")
    wanted = scratch.keep(
        second.where("open").select("shared").distinct().join(shared, "shared", "left_semi"), "open-cells"
    )
    singles = second.join(wanted, "shared", "left_semi").select(
        *_ID,
        "place",
        F.explode(
            F.sequence(F.greatest("low", "least"), F.least(F.col("high") - 1, F.col("greatest")))
        ).alias("low"),
        "key",
        "least",
        "greatest",
        "open",
    )
    singles = singles.withColumn("high", (F.col("low") + 1).cast("int"))
    third = scratch.keep(_hashed(texts, singles).where("span IS NOT NULL"), "singles")
    spans = _often(third, "span", scratch)
    last = third.where("open").join(spans, "span")
    return scratch.keep(
        _settled(first.where("NOT open")).unionByName(_settled(done)).unionByName(_settled(last)), "covered"
    )


def cut(text: bytes, covers: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of a text without the covered bytes, and the number of runs removed."""
    left, done, runs = [], 0, 0
    end = -1
    for low, high in sorted(covers):
        if low > end:
            runs += 1
            left.append(text[done:low])
        end = max(end, high)
        done = end
    left.append(text[done:])
    return b"".join(left), runs


def _cut_rows(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        removed, spans, digests = [], [], []
        for text, covers in zip(texts, batch.column("covers"), strict=True):
            text = text.as_py()
            left, runs = cut(text, [(c["low"], c["high"]) for c in covers.as_py()])
            removed.append(len(text) - len(left))
            spans.append(runs)
            digests.append(hashlib.sha256(left).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("d"),
                batch.column("t"),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()),
                pa.array(digests, pa.string()),
            ],
            names=["d", "t", "n_removed", "n_spans", "kept_sha256"],
        )


def remove_repeats(documents: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row.

    Texts are UTF-8 bytes, null as empty; a stretch never crosses documents. The rows come
    in as ``batches`` batches by a hash, which changes no result. Equal rows are copies of each
    other, so texts of ``LENGTH`` bytes or more among them go whole. ``doc_id`` may be null; other
    columns are not looked at; an empty table gives an empty one.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "repeats")
    rows = documents.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("d"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("t", F.xxhash64("text"))
    known = scratch.keep(
        rows.select(
            "doc_id", *_ID, F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("sha")
        ),
        "texts",
    )
    # One row stands for each text.
    copies = known.groupBy("sha").agg(F.count("*").alias("copies"), F.min("d").alias("own"))
    known = scratch.keep(known.join(copies, "sha"), "copies")
    gone = known.where("d <> own").select(*_ID).distinct()
    texts = rows.where(F.octet_length("text") >= LENGTH).join(_few(gone), _ID, "left_anti").select(*_ID, "text")

    found = scratch.keep(texts.mapInArrow(_anchor_rows, ANCHOR_SCHEMA), "anchors")
    levels = SuffixLevels(spark, scratch)
    keys = None
    for batch in range(batches):
        part = found.where(F.pmod(F.xxhash64(*_ID), F.lit(batches)) == batch)
        shared = levels.add(part.select("key"))
        keys = shared if keys is None else keys.unionByName(shared)
    keys = scratch.keep(keys.distinct(), "keys")
    repeated = scratch.keep(found.join(_few(keys), "key", "left_semi"), "partners")
    scratch.drop(found, *levels.levels.values())

    there = scratch.keep(repeated.select(*_ID).distinct(), "affected")
    texts = scratch.keep(texts.join(_few(there), _ID, "left_semi"), "affected-texts")
    covers = _covered(texts, repeated, scratch)
    lists = covers.groupBy(*_ID).agg(F.collect_set(F.struct("low", "high")).alias("covers"))
    done = texts.join(lists, _ID).mapInArrow(
        _cut_rows, "d bigint, t bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    nothing = hashlib.sha256(b"").hexdigest()
    return known.join(done.dropDuplicates(_ID), _ID, "left").select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(whole, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
