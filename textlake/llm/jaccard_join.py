"""Near copies by shingle sets: an exact Jaccard join with adaptive multi-match prefixes.

All shingles stand in one global order: by hash, those that many prefixes hold ("hot") last. Two
sets that are similar enough share a shingle among the first ``n - need + 1`` of each, where
``need`` is the least overlap a set of ``n`` can have with a partner, and they share ``1 + e`` among the
first ``n - need + 1 + e``. Each set chooses its ``e`` by what it expects its candidates to cost
(``_chosen_extra``): longer lists to merge against fewer pairs to verify. A pair is a candidate
when its prefixes share ``1 + min(e)`` shingles, and is then verified on the whole sets.

How large groups are kept from meeting in all pairs, without losing a link between groups:

* Equal sets are one node from the start.
* In each list of a shingle, the sets first meet only the least of them (a star).
* A list that would still give many pairs across the components of these links meets a few more of its sets,
  and a pair that several such lists have comes from the first of them only.
* After that, a list gives pairs only across different components. Lists that lie in one component give none.
* Each set has a bit map in which every shingle turns one bit over. Two sets differ in at least as
  many shingles as their maps differ in bits, so most pairs are refused (``_near_bits``) before they
  become rows or their sets are moved; that loses no link.

A set whose first shingles are mostly hot needs more of them than were written at first; only such
sets are read again, ``DEEPER`` times as far and, where that does not suffice, whole. What is hot is then counted anew, unless
few were read again. Sets are divided by size, so that only sizes that can match meet.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlake.llm.components import components
from textlake.llm.storage import Scratch
from textlake.llm.words import shingles, slices, words
from textlake.operators.merge import fits_broadcast

# A shingle in more prefixes than this comes last in the global order.
HOT = 32
# Shingles written beyond those that a set without hot ones needs, and how often hot ones are counted.
SPARE, TURNS = 8, 3
# How many times as much of a set is written when it is read again for the first time, and
# which part of the sets read again must be new for hot shingles to be counted anew.
DEEPER, FEW_NEW = 3, 0.1
# Further shared shingles that a set may ask for, at most.
EXTRA = 3
# How often, and how many of its sets at a time, a long list meets before its pairs are made; pairs across
# components for each entry that make a list long.
STARS, HUBS, CLOSE = 1, 16, 8
# Long lists that an entry names, at most.
TOLD = 64
# Bytes of texts that are made into sets at a time: a task holds them, their sets and what Arrow buffers for both.
BATCH_BYTES = 4 << 20
# Words of 64 bits in a set's bit map.
BIT_WORDS = 16
# Verifying a pair against merging one entry of a list; each further shared shingle is
# taken to leave a quarter of the chance pairs.
VERIFY_COST, CHANCE = 50.0, 0.25


def need(n, percent: int):
    """The least overlap of a set of ``n`` with any partner (a number or an array)."""
    return -(-percent * n // 100)


def _first_length(n, percent: int):
    return n - need(n, percent) + 1


def _sets(column: pa.Array, size: int):
    """The sorted distinct shingle hashes of every text."""
    for piece in slices(column):
        hashes, first = shingles(words(piece), size)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            yield np.unique(hashes[a:b])


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _set_rows(documents: DataFrame, size: int, percent: int, whole: bool, times: int = 1) -> DataFrame:
    """``doc_id, n_shingles, digest, tokens, bits``: the whole set, or its beginning in hash order.

    The beginning suffices for ``times`` the longest prefix, and a few more.
    """

    def run(batches):
        for batch in batches:
            counts, digests, tokens, bits = [], [], [], []
            for own in _sets(batch.column("text"), size):
                n = len(own)
                first = _first_length(n, percent)
                written = n if whole else min(n, times * (first + EXTRA) + SPARE)
                counts.append(n)
                digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                tokens.append(own[:written])
                odd = np.bincount((own % np.uint64(64 * BIT_WORDS)).astype(np.int64), minlength=64 * BIT_WORDS) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    _lists(tokens),
                    _lists(bits),
                ],
                names=["doc_id", "n_shingles", "digest", "tokens", "bits"],
            )

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_shingles bigint, digest binary, tokens array<bigint>, bits array<bigint>"
    )


def _few(df: DataFrame) -> DataFrame:
    """The table, marked to be sent to the other side where it is measured to be small."""
    return F.broadcast(df) if fits_broadcast(df) else df


def _sets_again(
    documents: DataFrame, nodes: DataFrame, size: int, percent: int, times: int | None = None
) -> DataFrame:
    """``node, n_shingles, tokens`` with the sets of ``nodes`` (``node, digest, doc_id``), whole or ``times`` as far."""
    ids = nodes.select(F.col("doc_id").alias("_doc_id")).distinct()
    texts = documents.join(_few(ids), F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left_semi")
    rows = _set_rows(texts, size, percent, whole=times is None, times=times or 1).select("digest", "n_shingles", "tokens")
    return rows.join(_few(nodes.select("node", "digest")), "digest").dropDuplicates(["node"])


def _near_bits(percent: int) -> Column:
    """Whether the bit maps of ``u`` and ``v`` leave it open that their sets are similar enough."""
    apart = " + ".join(f"bit_count(bits_u[{i}] ^ bits_v[{i}])" for i in range(BIT_WORDS))
    return F.expr(f"{100 - percent} * (n_u + n_v) >= {100 + percent} * ({apart})")


def _chosen_extra(percent: int) -> Column:
    """The ``e`` of a node, from its rows of ``rank, df, n_shingles`` (a window over them)."""
    own = Window.partitionBy("node")
    n = F.col("n_shingles")
    overlap = F.ceil(n * percent / 100)
    costs = []
    for e in range(EXTRA + 1):
        inside = F.col("rank") < n - overlap + 1 + e
        met = F.sum(F.when(inside, F.col("df") - 1).otherwise(0)).over(own)
        cost = met * (1 + VERIFY_COST * CHANCE**e)
        costs.append(F.struct(F.when(overlap > e, cost).otherwise(F.lit(math.inf)).alias("c"), F.lit(e).alias("e")))
    return F.least(*costs)["e"]


def _written(rows: DataFrame) -> DataFrame:
    return rows.select("node", F.explode("tokens").alias("token"))


def _arranged(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows with ``cold``, their other shingles in order, and ``warm``, their hot ones."""
    own = _written(rows).join(_few(hot), "token").groupBy("node")
    # A node's own shingles: no more than it has written.
    own = own.agg(F.collect_set("token").alias("hot"))
    marked = rows.join(own, "node", "left").withColumn("hot", F.coalesce("hot", F.array().cast("array<bigint>")))
    return marked.select(
        *rows.columns,
        F.array_except("tokens", "hot").alias("cold"),
        F.array_intersect("tokens", "hot").alias("warm"),
    )


def _prefixes(documents: DataFrame, nodes: DataFrame, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """``node, n_shingles, prefix``: the first shingles of every node in the global order.

    Which shingles are hot is counted on what the nodes have written. A node whose other shingles
    do not suffice is read again, deeper and then whole; as that shows more of the shingles, they are
    counted anew, ``TURNS`` times at most. All prefixes follow the last count: by it, each node is whole or
    has other shingles enough.
    """
    n = F.col("n_shingles")
    length = F.least(n - F.ceil(n * percent / 100) + 1 + EXTRA, n).cast("int")
    rest = nodes.select("node", "digest", "doc_id", "n_shingles", "tokens", length.alias("length"))
    again = scratch.keep(rest.limit(0), "again")
    hot = None
    for turn in range(TURNS):
        counts = _written(rest).unionByName(_written(again)).groupBy("token").agg(F.count("*").alias("df"))
        if hot is not None:
            scratch.drop(hot)
        hot = scratch.keep(counts.where(F.col("df") > HOT).select("token"), "hot")
        open_ = rest.unionByName(again).where(F.size("tokens") < n)
        short = _arranged(open_, hot).where(F.size("cold") < F.col("length")).select("node", "digest", "doc_id", "length")
        short = scratch.keep(short, "short")
        new = short.count()
        if not new:
            break
        found = _sets_again(documents, short, size, percent, DEEPER if turn == 0 else None)
        found = found.drop("digest").join(_few(short), "node").select(*rest.columns)
        others = again.join(_few(short.select("node")), "node", "left_anti").select(*rest.columns)
        read = scratch.keep(found.unionByName(others), "again")
        scratch.drop(again)
        again = read
        rest = rest.join(_few(short.select("node")), "node", "left_anti").select(*rest.columns)
        if turn and new < FEW_NEW * again.count():
            break
    every = _arranged(rest.unionByName(again), hot)
    prefix = F.slice(F.concat("cold", "warm"), F.lit(1), F.col("length")).alias("prefix")
    prefixes = scratch.keep(every.select("node", "n_shingles", prefix), "prefixes")
    scratch.drop(again, hot)
    return prefixes


def _postings(prefixes: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """``token, node, n_shingles, e, bucket, band``: the entries of shingles in two prefixes or more.

    ``band`` is the set's own size class or the one below, so that a pair of sizes that can match
    shares the class ``least(bucket)``.
    """
    each = prefixes.select("node", "n_shingles", F.posexplode("prefix").alias("rank", "token"))
    shared = each.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    shared = scratch.keep(shared, "shared")
    met = each.join(_few(shared), "token").withColumn("e", _chosen_extra(percent))
    length = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1 + F.col("e")
    bucket = F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(100 / percent) + 1e-9)
    rows = met.where(F.col("rank") < length).select(
        "token", "node", "n_shingles", "e", bucket.cast("int").alias("bucket")
    )
    rows = rows.select("*", F.explode(F.array(F.col("bucket"), F.col("bucket") - 1)).alias("band"))
    rows = scratch.keep(rows, "postings")
    scratch.drop(shared)
    return rows


def _similar(pairs: DataFrame, nodes: DataFrame, documents: DataFrame, size: int, percent: int, scratch: Scratch):
    """The pairs ``u, v`` whose whole sets are similar enough."""
    for side in "uv":
        maps = nodes.select(
            F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")
        )
        pairs = pairs.join(maps, side)
    pairs = scratch.keep(pairs.where(_near_bits(percent)).select("u", "v"), "candidates")
    ends = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    wanted = nodes.select("node", "digest", "doc_id").join(ends, "node", "left_semi")
    sets = scratch.keep(_sets_again(documents, wanted, size, percent), "sets")
    one = sets.select(F.col("node").alias("u"), F.col("tokens").alias("a"))
    two = sets.select(F.col("node").alias("v"), F.col("tokens").alias("b"))
    met = pairs.join(one, "u").join(two, "v")
    both = F.size(F.array_intersect("a", "b"))
    met = met.withColumn("both", both).where(
        100 * F.col("both") >= percent * (F.size("a") + F.size("b") - F.col("both"))
    )
    links = scratch.keep(met.select("u", "v"), "links")
    scratch.drop(sets, pairs)
    return links


def _candidates(met: DataFrame, percent: int) -> DataFrame:
    """Pairs that share enough, from rows ``u, v, n_u, n_v, e_u, e_v``, one per shared shingle, or per ``lists`` of them."""
    lists = F.sum("lists") if "lists" in met.columns else F.count("*")
    sized = met.where(100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v"))
    counted = sized.groupBy("u", "v").agg(
        lists.alias("shared"), F.first(F.least("e_u", "e_v")).alias("e")
    )
    return counted.where(F.col("shared") > F.col("e")).select("u", "v")


def _as(rows: DataFrame, side: str, *more) -> DataFrame:
    return rows.select(
        "token",
        "band",
        *more,
        F.col("node").alias(side),
        F.col("n_shingles").alias(f"n_{side}"),
        F.col("e").alias(f"e_{side}"),
        F.col("bucket").alias(f"bucket_{side}"),
    )


def _links(documents: DataFrame, nodes: DataFrame, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links ``u, v`` between nodes: all that are needed for the components, and no wrong one."""
    prefixes = _prefixes(documents, nodes, size, percent, scratch)
    postings = rows = _postings(prefixes, percent, scratch)
    scratch.drop(prefixes)
    canonical = F.col("band") == F.least("bucket_u", "bucket_v")

    # Every list's sets against the least of the list.
    hubs = rows.groupBy("token", "band").agg(
        F.min(F.struct("node", "n_shingles", "e", "bucket")).alias("hub"), F.count("*").alias("n")
    )
    hubs = hubs.where("n > 1").select("token", "band", "hub.*")
    stars = _as(rows, "v").join(_as(hubs, "u"), ["token", "band"]).where(canonical & (F.col("u") < F.col("v")))
    links = _similar(_candidates(stars, percent), nodes, documents, size, percent, scratch)

    # Lists that would still give many pairs meet more of their sets first, of other components.
    for turn in range(STARS + 1):
        parts = scratch.keep(components(links, scratch), "parts")
        across, heavy = _across(postings, parts, scratch)
        if turn == STARS or heavy.isEmpty():
            break
        long = across.join(_few(heavy), ["token", "band"]).join(nodes.select("node", "bits"), "node")
        long = scratch.keep(long, "long")
        met = _stars(long, scratch).where(canonical & (F.col("cu") != F.col("cv")) & _near_bits(percent))
        pairs = _candidates(met, percent).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        found = _similar(pairs.distinct(), nodes, documents, size, percent, scratch)
        links = _edges(parts).unionByName(found)
        scratch.drop(across, heavy, long)
    scratch.drop(postings)

    # What is left: pairs across the components known so far.
    rows = across.join(nodes.select("node", "bits"), "node")
    rows = scratch.keep(_with_heavy(rows, across, heavy, scratch), "across-bits")
    scratch.drop(across, heavy)
    one, two = (
        _as(rows, side, *(F.col(name).alias(f"{name}_{side}") for name in ("component", "bits", "heavy")))
        for side in "uv"
    )
    # The lists in which both stand are told from either's row: the first of them gives the pair for all.
    shared = F.array_intersect("heavy_u", "heavy_v")
    told = F.col("heavy_u").isNotNull() & F.col("heavy_v").isNotNull()
    both = one.join(two, ["token", "band"]).where(
        (F.col("component_u") < F.col("component_v"))
        & canonical
        & _near_bits(percent)
        & (~told | (F.array_min(shared) == F.col("token")))
    )
    both = both.withColumn("lists", F.when(told, F.size(shared)).otherwise(1))
    last = _similar(_candidates(both, percent), nodes, documents, size, percent, scratch)
    scratch.drop(rows)
    return _edges(parts).unionByName(last)


def _with_heavy(rows: DataFrame, across: DataFrame, heavy: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` with ``heavy``: of an entry of a heavy list, all heavy lists of its band that its set is in.

    Null for entries of other lists, and for sets in more than ``TOLD`` of them: their pairs come from each list.
    """
    lists = ["token", "band"]
    own = across.join(_few(heavy), lists).groupBy("node", "band")
    own = own.agg(F.collect_set("token").alias("heavy")).where(F.size("heavy") <= TOLD)
    own = scratch.keep(own.select(F.explode("heavy").alias("token"), "band", "node", "heavy"), "told")
    return rows.join(_few(own), [*lists, "node"], "left")


def _edges(parts: DataFrame) -> DataFrame:
    """Links ``u, v`` that give the components of ``node, component``."""
    return parts.select(F.col("node").alias("u"), F.col("component").alias("v"))


def _across(postings: DataFrame, parts: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The entries of lists with two components or more, and the lists with more than ``CLOSE`` pairs across them an entry."""
    rows = postings.join(_few(parts), "node", "left").withColumn("component", F.coalesce("component", "node"))
    # A component's sets in a list are counted before the list is.
    own = rows.groupBy("token", "band", "component").agg(F.count("*").alias("n"))
    lists = own.groupBy("token", "band").agg(
        F.count("*").alias("parts"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("inside")
    )
    mixed = scratch.keep(lists.where("parts > 1"), "mixed")
    entries = scratch.keep(rows.join(_few(mixed.select("token", "band")), ["token", "band"]), "across")
    heavy = scratch.keep(mixed.where(f"n * n - inside > {2 * CLOSE} * n").select("token", "band"), "heavy")
    scratch.drop(mixed)
    return entries, heavy


def _stars(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Every list's sets ``v`` with up to ``HUBS`` sets ``u`` of the list, no two of a component.

    Sets that stand in many of these lists come first, as they are likely to be similar to many; those of the list's
    own size class before others, as they pair with all.
    """
    degrees = scratch.keep(rows.groupBy("node").agg(F.count("*").alias("degree")), "degrees")
    order = F.struct(
        (F.col("bucket") == F.col("band")).alias("own"), "degree",
        *["node", "component", "n_shingles", "e", "bucket", "bits"],
    )
    best = rows.join(_few(degrees), "node").groupBy("token", "band", "component").agg(F.max(order).alias("hub"))
    place = F.row_number().over(Window.partitionBy("token", "band").orderBy(F.desc("hub.own"), F.desc("hub.degree"), "hub.node"))
    hubs = best.withColumn("place", place).where(F.col("place") <= HUBS).select("token", "band", "hub.*")
    one, two = (
        _as(side, name, F.col("component").alias(f"c{name}"), F.col("bits").alias(f"bits_{name}"))
        for side, name in ((rows, "v"), (hubs, "u"))
    )
    return one.join(two, ["token", "band"])


def near_copies(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    ``n_shingles`` is the size of the set of ``size``-word shingles (lower case A-Z; a shorter text is
    one shingle; none without words). ``component_id`` is the smallest ``doc_id`` that links reach; two
    texts are linked when their sets have a Jaccard similarity of ``percent`` or more. Null and
    empty texts are linked with nothing and keep their own ``doc_id``. Equal rows get equal
    results. A row without ``doc_id`` has the component of its text, which is null if no text in it has
    a number. Other columns are not looked at.
    """
    sets, found = _found(documents, size, percent)
    return _named(sets, found)


def _named(sets: DataFrame, found: DataFrame) -> DataFrame:
    return sets.join(found.select("digest", "component_id"), "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _found(documents: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``doc_id, n_shingles, digest``, and for each digest its ``component_id`` and the component's ``first``.

    ``first`` is the smallest ``doc_id, digest`` of the component.
    """
    scratch = Scratch(documents.sparkSession, "near-copies", BATCH_BYTES)
    documents = documents.select("doc_id", "text")
    wide = scratch.keep(_set_rows(documents, size, percent, whole=False), "sets")
    sets = scratch.keep(wide.select("doc_id", "n_shingles", "digest"), "digests")
    least = sets.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("_doc_id"))
    chosen = (
        wide.join(
            least.withColumnRenamed("digest", "_digest"),
            (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")),
            "left_semi",
        )
        .dropDuplicates(["digest"])
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = scratch.keep(chosen, "nodes")
    scratch.drop(wide)
    links = _links(documents, nodes, size, percent, scratch)
    parts = scratch.keep(components(links, scratch), "components")
    names = (
        nodes.select("node", "digest", "doc_id")
        .join(parts, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "digest"))).alias("first")
    least = names.groupBy("component").agg(F.min("doc_id").alias("component_id"), first)
    return sets, names.join(least, "component").select("digest", "component_id", "first")


def keep_one(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one row of each group of near copies, all columns as they are.

    The row with the smallest ``doc_id`` stays; of rows equal in ``doc_id`` and text, one. Rows without
    ``doc_id`` count as the last of their group; texts without words are near copies of nothing.
    Where different texts share a ``doc_id``, each is judged by its own text. Other columns may have any name.
    """
    columns = documents.columns
    # Columns by place, so that no name of the caller's meets one of those made here.
    rest = iter(range(len(columns)))
    names = [c if c.lower() in ("doc_id", "text") else f"column{next(rest)}" for c in columns]
    return _one_of_each(documents.toDF(*names), size, percent).toDF(*columns)


def _one_of_each(documents: DataFrame, size: int, percent: int) -> DataFrame:
    scratch = Scratch(documents.sparkSession, "one-of-each")
    last = F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 62))
    number = F.coalesce(F.col("doc_id").cast("bigint"), last)
    sets, parts = _found(documents.select(number.alias("doc_id"), "text"), size, percent)
    parts = scratch.keep(parts, "parts")
    found = scratch.keep(_named(sets, parts), "found")
    often = found.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_number"))
    often = scratch.keep(often, "repeated")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_number")).distinct()
    if often.isEmpty():
        return documents.join(_few(gone), number == F.col("_number"), "left_anti")
    often = _few(often)
    once = documents.join(often, number == F.col("_number"), "left_anti")
    once = once.join(_few(gone), number == F.col("_number"), "left_anti")
    # Rows that share a number go by number and text.
    same = documents.join(often, number == F.col("_number"), "left_semi").dropDuplicates(["doc_id", "text"])
    sha = F.sha2("text", 256)
    texts = same.where("text IS NOT NULL").select(sha.alias("doc_id"), "text").dropDuplicates(["doc_id"])
    digests = _set_rows(texts, size, percent, whole=False).where("n_shingles > 0")
    digests = digests.select(F.col("doc_id").alias("_sha"), "digest").join(parts, "digest")
    judged = same.select(number.alias("_number"), sha.alias("_sha")).join(digests, "_sha")
    # Of texts equal but for case and spaces, the one with the least hash stands for all.
    order = F.min("_sha").over(Window.partitionBy("_number", "digest"))
    stays = (F.col("first.doc_id") == F.col("_number")) & (F.col("first.digest") == F.col("digest"))
    lost = judged.withColumn("_least", order).where(~(stays & (F.col("_sha") == F.col("_least"))))
    lost = scratch.keep(lost.select("_number", "_sha").distinct(), "lost")
    same = same.join(_few(lost), (number == F.col("_number")) & (sha == F.col("_sha")), "left_anti")
    return once.unionByName(same)
