"""Readers. Every path may be a local, ``hdfs://`` or ``s3a://`` path."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlake.functions.html import html_to_text
from textlake.functions.text import text_or_empty

logger = logging.getLogger(__name__)


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


PEOPLE = _strings("id", "name", "age", "city")
NEWS = _strings("source", "title", "link", "published", "summary")
FEED_ITEM = _strings("title", "link", "pubDate", "description", "_corrupt_record")
SALES = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("order_date", T.StringType()),
        T.StructField("customer", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("quantity", T.IntegerType()),
    ]
)


def _broken(schema: T.StructType) -> Column:
    """Whether a row holds what could not be parsed.

    It also looks at a column of the data: Spark refuses to read that mark alone,
    as a count of the rows would.
    """
    data = F.coalesce(F.col(schema.names[0]).cast("string"), F.lit(""))
    return F.col("_corrupt_record").isNotNull() | (F.length(data) < 0)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    infer: bool = False,
) -> DataFrame:
    """CSV with a header line; an empty field is null.

    Without a schema all columns are strings. ``infer`` reads the data once more
    to find types; a schema is better, and does not change with the data.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_json_arrays(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = NEWS,
    broken: Observation | None = None,
) -> DataFrame:
    """JSON files of one array of objects each; the path may be a glob.

    A file that cannot be parsed to its end gives none of its items. With
    ``broken``, how many there were is counted under ``files`` while the items
    are read; ``jobs.news`` prints it.
    """
    marked = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    items = spark.read.schema(marked).json(path, multiLine=True)
    lost = _broken(schema)
    if broken is not None:
        items = items.observe(broken, F.count_if(lost).alias("files"))
    return items.where(~lost).select(*schema.names)


def _feed(spark: SparkSession, source: str, path: str) -> DataFrame | None:
    """The raw items of one feed, with the source's name; None where it did not land."""
    try:
        items = (
            spark.read.format("xml")
            .schema(FEED_ITEM)
            .option("rowTag", "item")
            .option("mode", "PERMISSIVE")
            .option("ignoreCorruptFiles", True)
            .load(path)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        logger.warning("feed %s did not land at %s", source, path)
        return None
    return items.withColumn("source", F.lit(source))


def read_feeds(
    spark: SparkSession, feeds: Mapping[str, str], broken: Observation | None = None
) -> DataFrame:
    """Items of landed RSS files, ``{source name: path}``, as rows of ``NEWS``.

    Missing fields become empty text and the summary loses its HTML. A feed that
    did not land, or a file that cannot be parsed, is skipped; no item at all is
    an error. With ``broken``, what could not be parsed is counted under ``items`` while
    the others are read; ``feed_outcomes`` says which files these are.
    """
    parts = [part for source, path in feeds.items() if (part := _feed(spark, source, path)) is not None]
    if not parts:
        raise RuntimeError("no feed has any item")
    items = reduce(DataFrame.unionByName, parts)
    # A file that is no XML gives one item that holds its text.
    lost = _broken(FEED_ITEM)
    if items.where(~lost).isEmpty():
        raise RuntimeError("no feed has any item")
    if broken is not None:
        items = items.observe(broken, F.count_if(lost).alias("items"))
    return items.where(~lost).select(
        "source",
        text_or_empty(F.col("title")).alias("title"),
        text_or_empty(F.col("link")).alias("link"),
        text_or_empty(F.col("pubDate")).alias("published"),
        html_to_text(F.col("description")).alias("summary"),
    )


OUTCOMES = "source string, file string, bytes bigint, items bigint, broken bigint, state string"


def _outcomes(spark: SparkSession, source: str, path: str, rows: DataFrame | None, lost: Column) -> DataFrame:
    """What became of each file below a path; ``rows`` is how the path was read, None if it is not there."""
    if rows is None:
        return spark.createDataFrame([(source, path, 0, 0, 0, "missing")], OUTCOMES)
    # The listing alone: contents of the files are not read here.
    files = spark.read.format("binaryFile").load(path)
    files = files.select("path", F.col("length").alias("bytes"), F.col("_metadata.file_path").alias("_path"))
    counts = (
        rows.select(F.col("_metadata.file_path").alias("_path"), lost.alias("lost"))
        .groupBy("_path")
        .agg(F.count_if(~F.col("lost")).alias("items"), F.count_if("lost").alias("broken"))
    )
    met = files.join(counts, "_path", "left")
    items, broken = F.coalesce("items", F.lit(0)), F.coalesce("broken", F.lit(0))
    state = (
        F.when((items > 0) & (broken == 0), "read")
        .when(items > 0, "partly read")
        .when(broken > 0, "broken")
        .otherwise("empty")
    )
    return met.select(
        F.lit(source).alias("source"),
        F.col("path").alias("file"),
        "bytes",
        items.alias("items"),
        broken.alias("broken"),
        state.alias("state"),
    )


def feed_outcomes(spark: SparkSession, feeds: Mapping[str, str]) -> DataFrame:
    """One row for each file of each feed: ``source, file, bytes, items, broken, state``.

    ``state`` is ``read``, ``partly read`` (some of its items are broken), ``broken``, ``empty`` (no item), or for a
    feed that did not land ``missing``, with its path as the file. Spark packs files into tasks by their bytes; it does not list files of no bytes.
    """
    parts = [_outcomes(spark, s, path, _feed(spark, s, path), _broken(FEED_ITEM)) for s, path in feeds.items()]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], OUTCOMES)


def json_array_outcomes(spark: SparkSession, path: str, schema: T.StructType = NEWS) -> DataFrame:
    """The rows of ``feed_outcomes`` for files of one JSON array each; ``source`` is the path."""
    marked = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    try:
        rows = spark.read.schema(marked).json(path, multiLine=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = None
    return _outcomes(spark, path, path, rows, _broken(schema))


def read_documents(spark: SparkSession, directory: str, pattern: str = "*.md") -> DataFrame:
    """One row per file below a directory: its path and its whole text.

    Files are read as bytes: the text reader copies all settings of Hadoop for each of them.
    """
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .format("binaryFile")
        .load(directory)
        .select(F.col("_metadata.file_path").alias("doc_id"), F.col("content").cast("string").alias("text"))
    )


def integers(spark: SparkSession, start: int, end: int) -> DataFrame:
    """The integers from ``start`` up to but without ``end``, as column ``id``."""
    return spark.range(start, end)


def from_records(
    spark: SparkSession,
    records: Sequence[Mapping[str, object]],
    schema: T.StructType = NEWS,
) -> DataFrame:
    """A few records held by the driver, such as a hand-made fixture."""
    rows = [Row(*[record.get(name) for name in schema.names]) for record in records]
    return spark.createDataFrame(rows, schema)
