"""Near copies by circulant MinHash: two permutations make every coordinate of a signature.

The first permutation scatters a shingle to one of ``PLACES`` places. The second is a fixed order of
the places, and coordinate ``k`` is the least value that it gives the set's places after it is shifted
by ``k`` around the circle. Shifting is reading on: the ``k``-th value of a shingle stands ``k``
places further in the table, so a set's signature is the least, column by column, of one stretch of the
table for each shingle.

Signatures are cut into bands of ``ROWS`` coordinates, so many of them that a pair which is just similar enough
agrees on a whole band but for one time in a million (``bands_for``). Sets that agree on a
band are candidates; links are confirmed on whole sets. No bucket meets in all pairs of rows:

* Equal sets are one node from the start, whatever the number of their copies.
* The nodes of a bucket first meet only its least node (a star). Stars of many nodes are verified in
  parts of ``PART`` each.
* Buckets that then lie in one component are done. Of the others, only pairs across components are left; they
  meet in blocks of ``PART`` nodes, as bit maps in which every shingle turns one bit over. Two sets
  differ in at least as many shingles as their maps differ in bits, so a pair refused there is none;
  only pairs that are not refused become rows.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.components import components
from textlake.llm.storage import Scratch
from textlake.llm.words import mix, shingles, slices, words
from textlake.operators.merge import few

# The circle's places, a power of two. A set's shingles that share a place blur its signature, no more.
PLACE_BITS = 22
PLACES = 1 << PLACE_BITS
ROWS, MISSED = 8, 1e-6
# Nodes that meet at a time.
PART = 512
# Words of 64 bits in a bit map; shingles whose stretches are read at a time.
BIT_WORDS, READ = 16, 2048

_FIRST, _SECOND, _BAND = (np.uint64(x) for x in (0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x9E3779B97F4A7C15))


def bands_for(percent: int, rows: int = ROWS, missed: float = MISSED) -> int:
    """Bands of ``rows`` coordinates that a pair of this similarity misses all with no more than this chance."""
    return math.ceil(math.log(missed) / math.log1p(-((percent / 100) ** rows)))


@functools.cache
def _circle(coordinates: int) -> np.ndarray:
    """Row ``p`` is the second permutation's values from place ``p`` on, around the circle."""
    order = np.argsort(mix(np.arange(PLACES, dtype=np.uint64) * _BAND + _SECOND), kind="stable")
    values = np.empty(PLACES + coordinates, np.uint32)
    values[order] = np.arange(PLACES, dtype=np.uint32)
    values[PLACES:] = values[:coordinates]
    return np.lib.stride_tricks.sliding_window_view(values, coordinates)


def signatures(hashes: np.ndarray, first: np.ndarray, coordinates: int) -> np.ndarray:
    """A row for each set; set ``i`` has the hashes ``first[i]`` to ``first[i + 1]``, one at least."""
    circle = _circle(coordinates)
    places = (mix(hashes ^ _FIRST) >> np.uint64(64 - PLACE_BITS)).astype(np.int64)
    out = np.full((len(first) - 1, coordinates), np.iinfo(np.uint32).max, np.uint32)
    for low in range(0, len(hashes), READ):
        high = min(low + READ, len(hashes))
        a = int(np.searchsorted(first, low, side="right")) - 1
        b = int(np.searchsorted(first, high, side="left"))
        begins = np.maximum(first[a:b] - low, 0)
        least = np.minimum.reduceat(circle[places[low:high]], begins, axis=0)
        np.minimum(out[a:b], least, out=out[a:b])
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each set and band."""
    parts = signature.reshape(len(signature), -1, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=np.uint64) * _BAND, parts.shape[:2])
    for row in range(rows):
        keys = (keys + parts[:, :, row]) * _SECOND
        keys = keys ^ (keys >> np.uint64(29))
    return mix(keys)


def bit_maps(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    width = 64 * BIT_WORDS
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = owner * width + (hashes % np.uint64(width)).astype(np.int64)
    odd = (np.bincount(at, minlength=(len(first) - 1) * width) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(-1, width), axis=1).view(np.uint64)


def _distinct(piece, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text of a slice, and where each text begins."""
    hashes, first = shingles(words(piece), size)
    parts = [np.unique(hashes[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    begins = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=begins[1:])
    return np.concatenate(parts) if parts else hashes, begins


def _set_digests(hashes: np.ndarray, first: np.ndarray) -> list[bytes]:
    ends = zip(first[:-1].tolist(), first[1:].tolist(), strict=True)
    return [xxhash.xxh3_128_digest(hashes[a:b].tobytes()) for a, b in ends]


def _fixed_lists(values: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values).view(np.int64).ravel()))


def signed_documents(documents: DataFrame, size: int, percent: int, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, digest, bits, keys`` of every row; without words, no bits and keys."""
    bands = bands_for(percent, rows)

    def run(batches):
        for batch in batches:
            at = 0
            for piece in slices(batch.column("text")):
                hashes, first = _distinct(piece, size)
                counts = np.diff(first)
                full = np.flatnonzero(counts)
                starts = np.append(first[full], len(hashes))
                keys = np.zeros((len(counts), bands), np.uint64)
                maps = np.zeros((len(counts), BIT_WORDS), np.uint64)
                if len(full):
                    keys[full] = band_keys(signatures(hashes, starts, bands * rows), rows)
                    maps[full] = bit_maps(hashes, starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(counts)),
                        pa.array(counts, pa.int64()),
                        pa.array(_set_digests(hashes, first), pa.binary()),
                        _fixed_lists(maps),
                        _fixed_lists(keys),
                    ],
                    names=["doc_id", "n_shingles", "digest", "bits", "keys"],
                )
                at += len(counts)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles bigint, digest binary, bits array<bigint>, keys array<bigint>"
    )


def _whole_sets(documents: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``digest, tokens`` of the texts whose ``doc_id`` is wanted, a set no more than once a task and slice."""
    ids = wanted.select(F.col("doc_id").alias("_doc_id")).distinct()
    texts = documents.join(few(ids), F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left_semi")

    def run(batches):
        met: set[bytes] = set()
        for batch in batches:
            for piece in slices(batch.column("text")):
                hashes, first = _distinct(piece, size)
                digests = _set_digests(hashes, first)
                new = [i for i, d in enumerate(digests) if d not in met and first[i] < first[i + 1]]
                new = list({digests[i]: i for i in new}.values())
                if len(met) < 1_000_000:
                    met.update(digests[i] for i in new)
                parts = [hashes[first[i] : first[i + 1]] for i in new]
                offsets = np.zeros(len(parts) + 1, np.int32)
                np.cumsum([len(p) for p in parts], out=offsets[1:])
                flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
                tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digests[i] for i in new], pa.binary()), tokens], names=["digest", "tokens"]
                )

    return texts.select("doc_id", "text").mapInArrow(run, "digest binary, tokens array<bigint>")


def _verified(pairs: DataFrame, nodes: DataFrame, documents: DataFrame, size: int, percent: int, scratch: Scratch):
    """The pairs ``u, v`` whose whole sets are similar enough.

    Sets are shuffled once: the set of ``u`` goes ahead of those of its ``v``, in parts of about ``PART``.
    """
    parts = pairs.groupBy("u").agg(F.count("*").alias("n")).select("u", F.ceil(F.col("n") / PART).alias("parts"))
    parts = scratch.keep(parts, "parts")
    part = F.pmod(F.xxhash64("v"), F.col("parts"))
    members = pairs.join(few(parts), "u").select("u", part.alias("part"), "v", F.col("v").alias("node"))
    heads = parts.select(
        "u", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(None).cast("bigint").alias("v"), F.col("u").alias("node"),
    )
    wanted = members.unionByName(heads).join(few(nodes.select("node", "digest", "doc_id")), "node")
    wanted = scratch.keep(wanted.drop("node"), "wanted")
    sets = _whole_sets(documents, wanted, size)
    met = sets.join(few(wanted.drop("doc_id")), "digest").select("u", "part", "v", "tokens")
    dealt = met.repartition("u", "part").sortWithinPartitions("u", "part", "v")

    def run(batches):
        key, head = None, None
        for batch in batches:
            tokens = batch.column("tokens")
            flat, ends = tokens.values.to_numpy(), tokens.offsets.to_numpy()
            us, parts, vs = (batch.column(n).to_pylist() for n in ("u", "part", "v"))
            links = []
            for i, v in enumerate(vs):
                own = flat[ends[i] : ends[i + 1]]
                if v is None:
                    key, head = (us[i], parts[i]), np.sort(own)
                    continue
                if key != (us[i], parts[i]):
                    raise ValueError(f"the set of node {us[i]} is missing")
                both = int((head[np.minimum(np.searchsorted(head, own), len(head) - 1)] == own).sum())
                if 100 * both >= percent * (len(head) + len(own) - both):
                    links.append((us[i], v))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["u", "v"]
            )

    return scratch.keep(dealt.mapInArrow(run, "u bigint, v bigint"), "links")


def _open(n_u, n_v, apart, percent: int):
    """Whether sets of these sizes, ``apart`` bits from each other at least, may be similar enough."""
    return (100 - percent) * (n_u + n_v) >= (100 + percent) * apart


def _star_pairs(rows: DataFrame, hubs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Each node of a bucket with the bucket's least node, where their bit maps leave it open."""
    pairs = rows.join(few(hubs), "key").where("u < node").select("u", F.col("node").alias("v")).distinct()
    for side in "uv":
        maps = nodes.select(
            F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")
        )
        pairs = pairs.join(maps, side)
    apart = sum((F.bit_count(F.col("bits_u")[i].bitwiseXOR(F.col("bits_v")[i])) for i in range(BIT_WORDS)), F.lit(0))
    return pairs.where(_open(F.col("n_u"), F.col("n_v"), apart, percent)).select("u", "v")


def _pairs_across(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket in different components that sizes and bit maps leave open.

    ``rows`` has ``key, node, component, n_shingles, bits, blocks``. Nodes are dealt to blocks by a hash; the nodes of each two
    blocks meet in a group of their own, whose pairs are told apart before any becomes a row.
    """
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = rows.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    )
    dealt = dealt.select(
        "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
        "own", "node", "component", "n_shingles", "bits",
    )
    dealt = dealt.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "node")

    def group(columns, low, high):
        key, a, b, own, node, component, n, bits = (c[low:high] for c in columns)
        found = []
        for i in range(len(node) - 1):
            others = slice(i + 1, None)
            near = (component[others] != component[i]) & ((own[others] != own[i]) | (a[i] == b[i]))
            near &= 100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i])
            at = np.flatnonzero(near) + i + 1
            if len(at):
                apart = np.bitwise_count(bits[at] ^ bits[i]).sum(axis=1, dtype=np.int64)
                at = at[_open(n[i], n[at], apart, percent)]
                found.append(np.column_stack([np.full(len(at), node[i]), node[at]]))
        return np.concatenate(found) if found else np.zeros((0, 2), np.int64)

    def run(batches):
        held = None
        names = ("key", "a", "b", "own", "node", "component", "n_shingles")

        def made(columns, cuts):
            found = [group(columns, x, y) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            found = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in names]
            columns.append(batch.column("bits").flatten().to_numpy().view(np.uint64).reshape(-1, BIT_WORDS))
            if held is not None:
                columns = [np.concatenate(both) for both in zip(held, columns, strict=True)]
            new = np.any([np.diff(c) != 0 for c in columns[:3]], axis=0)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
            yield made(columns, cuts)
            held = [c[cuts[-1] :] for c in columns]
        if held is not None:
            yield made(held, [0, len(held[0])])

    return dealt.mapInArrow(run, "u bigint, v bigint")


def _links(documents: DataFrame, nodes: DataFrame, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """Edges ``u, v`` between nodes that give the components of all links found."""
    each = nodes.select("node", F.explode("keys").alias("key"))
    buckets = each.groupBy("key").agg(F.min("node").alias("u"), F.max("node").alias("last")).where("u < last")
    hubs = scratch.keep(buckets.select("key", "u"), "hubs")
    rows = scratch.keep(each.join(few(hubs.select("key")), "key"), "buckets")
    pairs = scratch.keep(_star_pairs(rows, hubs, nodes, percent), "stars")
    first = _verified(pairs, nodes, documents, size, percent, scratch)

    parts = scratch.keep(components(first, scratch), "components")
    placed = rows.join(few(parts), "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = scratch.keep(placed, "placed")
    mixed = placed.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")
    )
    mixed = scratch.keep(
        mixed.where("lo < hi").select("key", F.ceil(F.col("n") / PART).alias("blocks")), "mixed"
    )
    across = placed.join(few(mixed), "key").join(nodes.select("node", "n_shingles", "bits"), "node")
    pairs = scratch.keep(_pairs_across(across, percent).distinct(), "across")
    second = _verified(pairs, nodes, documents, size, percent, scratch)
    return second.unionByName(parts.select(F.col("node").alias("u"), F.col("component").alias("v")))


def near_copies(documents: DataFrame, size: int = 5, percent: int = 80, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    ``n_shingles`` is the number of distinct runs of ``size`` words (lower case A-Z; a shorter text is one
    run, one without words none). ``component_id`` is the smallest ``doc_id`` that links reach; two texts are linked
    when their sets have a Jaccard similarity of ``percent`` or more. A link between two sets is
    found unless their signatures differ in all bands, which happens to a pair just similar enough less than once in a
    million. ``kept`` is whether the two numbers are the same.

    Null and empty texts are linked with nothing and keep their own ``doc_id``. Repeated rows get equal results,
    so a repeated first row is kept each time. A row without ``doc_id`` has the component of its text; where no text in
    it has a number that is null, and ``kept`` is true. ``doc_id`` may be of any type with an order. Texts are read
    whole. Other columns are not looked at; an empty table gives no rows.
    """
    scratch = Scratch(documents.sparkSession, "circulant")
    documents = documents.select("doc_id", "text")
    signed = signed_documents(documents, size, percent, rows)
    signed = scratch.keep(signed.withColumn("node", F.monotonically_increasing_id()), "signed")
    narrow = signed.select("node", "doc_id", "n_shingles", "digest")
    classes = narrow.where("n_shingles > 0").groupBy("digest").agg(
        F.min("node").alias("first"), F.min("doc_id").alias("least")
    )
    classes = scratch.keep(classes, "classes")
    # Every row but one of each set is a copy.
    copies = narrow.where("n_shingles > 0").join(classes.select("digest", "first"), "digest").where("node > first")
    copies = scratch.keep(copies.select("node"), "copies")
    nodes = signed.where("n_shingles > 0").join(few(copies), "node", "left_anti")
    nodes = scratch.keep(nodes, "nodes")

    links = _links(documents, nodes, size, percent, scratch)
    found = scratch.keep(components(links, scratch), "found")
    linked = classes.join(few(found), F.col("first") == F.col("node"))
    named = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked.select("digest", "component").join(few(named), "component").select("digest", "component_id")
    named = classes.join(few(scratch.keep(named, "named")), "digest", "left")
    named = named.select("digest", F.coalesce("component_id", "least").alias("component_id"))
    out = narrow.join(named, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
