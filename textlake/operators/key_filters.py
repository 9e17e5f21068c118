"""A store that knows which of its files may hold a key.

Beside each file's rows stands a Bloom filter of its keys, made when the file is written. A batch's keys are tested
against all filters first, one row for each file, and only the files that may hold one of them are opened: a small batch of
new keys reads filters, not the store.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlake.operators.cleaning import label_news, titled
from textlake.operators.dedupe import keep_first
from textlake.operators.merge import fits_broadcast, new_items
from textlake.sources.versions import Version, VersionedTable

# Bits of a filter for each key, a power of two, and how many of them a key sets: one key in a hundred million is
# taken for one that is there.
KEY_BITS, KEY_MARKS = 64, 12
LEAST_BITS = 1024
FILTERS = "file string, keys bigint, bits binary"

_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _marks(hashes: np.ndarray, size: int) -> np.ndarray:
    """The places of each key among ``size`` bits, a power of two."""
    a = hashes * _FIRST
    a ^= a >> np.uint64(32)
    b = (hashes ^ (hashes >> np.uint64(29))) * _SECOND | np.uint64(1)
    steps = np.arange(KEY_MARKS, dtype=np.uint64)
    at = a[:, None] + steps * b[:, None]
    at ^= at >> np.uint64(33)
    return (at & np.uint64(size - 1)).astype(np.int64)


def bloom(hashes: np.ndarray) -> bytes:
    """A filter that holds all of some hashes."""
    size = max(LEAST_BITS, KEY_BITS << int(max(len(hashes) - 1, 0)).bit_length())
    bits = np.zeros(size, bool)
    bits[_marks(hashes, size).ravel()] = True
    return np.packbits(bits, bitorder="little").tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Whether a filter may hold each hash; never false for one that it does."""
    words = np.frombuffer(bits, np.uint8)
    at = _marks(hashes, 8 * len(words))
    return ((words[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def _hash(key: Sequence[str]):
    return F.xxhash64(*key).alias("hash")


def file_filters(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``file, keys, bits`` for rows read from files; a file read by several tasks has a filter for each piece."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            files, hashes = batch.column("file").to_pandas(), batch.column("hash").to_numpy().view(np.uint64)
            for file, at in files.groupby(files).indices.items():
                held.setdefault(file, []).append(np.unique(hashes[at]))
        for file, parts in held.items():
            own = np.unique(np.concatenate(parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([len(own)], pa.int64()), pa.array([bloom(own)], pa.binary())],
                names=["file", "keys", "bits"],
            )

    return rows.select(F.col("_metadata.file_path").alias("file"), _hash(key)).mapInArrow(build, FILTERS)


class KeyedStore:
    """Rows by key, and the filters of their files: two versioned tables, committed one after the other."""

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str] = ("link",)):
        self.spark, self.key = spark, list(key)
        self.rows = VersionedTable(spark, f"{root}/rows")
        self.filters = VersionedTable(spark, f"{root}/filters")

    def add(self, rows: DataFrame) -> Version:
        """Add rows whose keys the store does not have. The filters come first; the rows' version names theirs."""
        base = self.rows.version()
        if base is not None:
            rows = rows.select(*base.schema.names)
        staged = self.rows.stage(rows)
        written = self.spark.read.schema(rows.schema).parquet(
            *[f"{self.rows.root}/{f}" for folders in staged.values() for f in folders]
        )
        before = int(base.marks["filters"]) if base else None
        filters = self._filters_after(before, file_filters(written, self.key))
        return self.rows.commit(
            staged, base.schema if base else rows.schema, base, (), {"filters": str(filters.number)}
        )

    def _filters_after(self, before: int | None, added: DataFrame) -> Version:
        """Filters of a version that the rows name and of new files; what a writer that died left is passed over."""
        newest = self.filters.version()
        named = self.filters.version(before) if before else None
        staged = self.filters.stage(added)
        if newest is not None and (named is None or newest.number != named.number):
            kept = named.folders if named else {}
            staged = {p: kept.get(p, []) + staged.get(p, []) for p in {**kept, **staged}}
            return self.filters.commit(staged, newest.schema, newest, None)
        return self.filters.commit(staged, added.schema, newest)

    def files_for(self, keys: DataFrame) -> list[str] | None:
        """The files that may hold one of some keys; None where the keys are too many to be sent to the filters."""
        version = self.rows.version()
        hashes = keys.select(_hash(self.key)).distinct()
        if not fits_broadcast(hashes):
            return None
        sent = self.spark.sparkContext.broadcast(hashes.toArrow()["hash"].to_numpy().view(np.uint64))

        def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept = [
                    i for i, bits in enumerate(batch.column("bits")) if may_hold(bits.as_py(), sent.value).any()
                ]
                yield batch.select(["file"]).take(pa.array(kept, pa.int64()))

        found = self.filters.read(int(version.marks["filters"])).mapInArrow(test, "file string")
        # Names of files of one table, as any reader of it lists them.
        return sorted({unquote(r["file"]) for r in found.collect()})

    def may_know(self, keys: DataFrame) -> DataFrame:
        """The rows of the files that may hold one of some keys: all rows with these keys, and others."""
        version = self.rows.version()
        files = self.files_for(keys)
        if files is None:
            return self.rows.read(version)
        if not files:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*files)

    def new_items(self, fresh: DataFrame) -> DataFrame:
        """One row for each key of ``fresh`` that the store does not have, as ``merge.new_items`` gives it."""
        if self.rows.version() is None:
            return keep_first(fresh, self.key)
        return new_items(fresh, self.may_know(fresh), self.key)

    def append_new(self, fresh: DataFrame, **words) -> Version | None:
        """Add the titled items whose keys are new, labelled; nothing new commits nothing."""
        added = label_news(self.new_items(titled(fresh)), **words).persist()
        try:
            return self.rows.version() if added.isEmpty() else self.add(added)
        finally:
            added.unpersist()
