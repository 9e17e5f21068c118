"""The refresh with its own memory: links seen before are dropped inside the stream.

What the store holds is not asked. Each link is a key of the stream's state (RocksDB, on the executors, saved
with the checkpoint); the first item of a link goes on, later ones do not, whether they come in the same file,
a late one, or one that landed twice. Every batch is one commit of the store, which carries the batch's number and the
counts of all stored items, worked out from the counts before and the batch alone.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from textlake.operators.cleaning import label_news, titled
from textlake.sources.readers import NEWS
from textlake.sources.versions import VersionedTable
from textlake.streaming.refresh import MARKED_NEWS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BATCH, COUNTS = "batch", "counts"
COUNTED = ("source", "sentiment")


def _order(row: tuple) -> list:
    """Rows in the order Spark sorts them in: nulls first, texts by their bytes."""
    return [(value is not None, (value or "").encode()) for value in row]


class FirstOfLink(StatefulProcessor):
    """Gives the first item of a link by its columns; nothing once the link is in the state."""

    def __init__(self, names: list[str], forget_ms: int | None = None):
        self.names, self.forget_ms = names, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.forget_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.seen.exists():
            for _ in rows:
                pass
            return
        first = min((tuple(row[name] for name in self.names) for row in rows), key=_order)
        self.seen.update((True,))
        yield Row(**dict(zip(self.names, first, strict=True)))

    def close(self) -> None:
        pass


def first_of_link(items: DataFrame, forget_ms: int | None = None) -> DataFrame:
    """The first item of each link that a stream of items has not had before; a null link is one, too.

    With ``forget_ms`` a link is forgotten so long after it was first seen, which bounds the state by what
    comes in that time; a link that returns later counts as new.
    """
    names = [name for name in items.columns if name != "link"]
    key = F.to_json(F.struct("link")).alias("_key")
    return items.select(key, "*").groupBy("_key").transformWithState(
        FirstOfLink(["link", *names], forget_ms),
        ", ".join(f"{n} string" for n in ["link", *names]),
        "Append",
        "None" if forget_ms is None else "ProcessingTime",
    )


def add_counts(table: VersionedTable, added: DataFrame) -> DataFrame:
    """The newest version's counts by source and sentiment with those of added rows."""
    counts = added.groupBy(*COUNTED).agg(F.count("*").alias("n"))
    before = table.side(COUNTS)
    if before is None:
        return counts
    return before.unionByName(counts).groupBy(*COUNTED).agg(F.sum("n").alias("n"))


def stored_counts(table: VersionedTable, *group: str) -> DataFrame:
    """Stored items per group, of ``source`` and ``sentiment``, from the counts kept with the newest version."""
    counts = table.side(COUNTS)
    if counts is None:
        raise ValueError(f"no counts are kept with {table.root}")
    counts = counts.groupBy(*group).agg(F.sum("n").alias("count")).where("count > 0")
    return counts.orderBy(F.desc("count"), *group)


def commit_batch(table: VersionedTable, items: DataFrame, batch: int, **words) -> bool:
    """Add a batch's items, its number and the new counts in one commit; False if it was committed before."""
    base = table.version()
    if base is not None and int(base.marks.get(BATCH, -1)) >= batch:
        # Read all the same: the stream's state is saved as the rows pass.
        items.write.format("noop").mode("overwrite").save()
        return False
    staged = table.stage(label_news(items, **words))
    spark = items.sparkSession
    schema = label_news(spark.createDataFrame([], NEWS)).schema
    # Counted from what was written, not worked out again.
    added = spark.read.schema(schema).parquet(*[f"{table.root}/{f}" for fs in staged.values() for f in fs])
    sides = {COUNTS: table.stage_side(add_counts(table, added))}
    table.commit(staged, schema, base, (), {BATCH: str(batch)}, sides)
    return True


def start_seen_refresh(
    spark: SparkSession,
    landing: str,
    table: VersionedTable,
    checkpoint: str,
    forget_ms: int | None = None,
    files_per_batch: int = 1000,
    arrays: bool = False,
    **words,
) -> StreamingQuery:
    """Take in the files that landed since the last run, then stop.

    Titled items whose link the stream never had are labelled and added. The table is written by this stream alone:
    a batch that Spark repeats after a failure is known by its number and adds nothing. Lines or files that
    cannot be parsed are left out; how many shows in the query's progress, under ``parsed``.
    """
    # Without empty batches: a state that forgets by the clock asks for one after another.
    settings = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    landed = spark.readStream.schema(MARKED_NEWS).option("maxFilesPerTrigger", files_per_batch)
    lost = F.col("_corrupt_record").isNotNull()
    items = landed.json(landing, multiLine=arrays).select(*MARKED_NEWS.names)
    items = items.observe("parsed", F.count("*").alias("all"), F.count_if(lost).alias("lost")).where(~lost)
    refresh = (
        first_of_link(titled(items.select(*NEWS.names)), forget_ms)
        .select(*NEWS.names)
        .writeStream.foreachBatch(lambda batch, number: commit_batch(table, batch, number, **words) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    # A query takes the session's settings as they are when it starts.
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        return refresh.start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
