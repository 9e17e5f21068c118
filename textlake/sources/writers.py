"""Writers. Every path may be a local, ``hdfs://`` or ``s3a://`` path."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def round_trip(df: DataFrame, path: str) -> DataFrame:
    """Write as Parquet and go on from what was written.

    Later steps then read the stored rows instead of working them out again.
    """
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv_report(report: DataFrame, path: str, single_file: bool = True) -> None:
    """CSV with a header, rows in the order of the report.

    One file, written by one task, unless the caller asks for more: then the
    rows keep their order over the files.
    """
    out = report.coalesce(1) if single_file else report
    out.write.mode("overwrite").option("header", True).csv(path)


def land_json(items: DataFrame, path: str, date: str | None = None) -> None:
    """Items as JSON lines below ``ingest_date=…/feed=…``; ``date`` defaults to today.

    ``feed`` repeats ``source``. What a source landed on a day before is replaced,
    so landing a feed twice leaves it there once; other sources and days stay.
    """
    day = F.lit(date).cast("date") if date is not None else F.current_date()
    items.withColumns({"ingest_date": day, "feed": F.col("source")}).write.mode(
        "overwrite"
    ).option("partitionOverwriteMode", "dynamic").partitionBy("ingest_date", "feed").json(
        path, ignoreNullFields=False
    )


def write_documents(documents: DataFrame, path: str, folder: str, suffix: str = ".txt") -> int:
    """Each ``text`` as a file of its own below ``<folder>=…``, by the value of that column; how many there are.

    A line break ends every file. Tasks write the files where they stay: no committer moves them one after another, which
    for small files takes longer than to write them. A task that runs again writes the same names, so the rows of a
    partition are sorted. ``path`` is a new folder that ``pyarrow.fs`` can open.
    """
    rows = documents.select(
        F.coalesce(F.col(folder).cast("string"), F.lit("")).alias("at"), F.coalesce("text", F.lit("")).alias("text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files, root = fs.FileSystem.from_uri(path)
        task, made, count = TaskContext.get().partitionId(), set(), 0
        for batch in batches:
            for at, text in zip(batch.column("at").to_pylist(), pc.cast(batch.column("text"), pa.binary()), strict=True):
                below = f"{root}/{folder}={quote(at, safe='') or '__none__'}"
                if below not in made:
                    files.create_dir(below)
                    made.add(below)
                with files.open_output_stream(f"{below}/part-{task:05}-{count:08}{suffix}") as out:
                    out.write(text.as_buffer())
                    out.write(b"\n")
                count += 1
        yield pa.RecordBatch.from_pydict({"files": [count]})

    written = rows.sortWithinPartitions("at", "text").mapInArrow(write, "files bigint")
    return written.agg(F.coalesce(F.sum("files"), F.lit(0)).alias("files")).first()["files"]


def create_if_missing(df_like: DataFrame, path: str) -> None:
    """Make sure a Parquet table with these columns exists at a path, if only an empty one."""
    df_like.limit(0).write.mode("ignore").parquet(path)


def rows_stored(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table, 0 if there is none; reads only the file footers."""
    try:
        return spark.read.parquet(path).count()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
