"""Tables written to the folder that the cluster shares, which also cuts lineage."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from textlake.session import work_path


# Spark's setting that removes the shuffle files of an execution when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Spark's setting for the bytes of rows that a Python worker gets at a time.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


class Scratch:
    """Written tables of one run. ``keep`` writes and rereads, ``drop`` removes them.

    With ``batch_bytes``, Python functions get about so many bytes of rows at a time while a table is written.
    """

    def __init__(self, spark: SparkSession, name: str, batch_bytes: int | None = None):
        self.spark = spark
        # What is shuffled for a table is of no use once the table is written.
        self.settings = {FREE_SHUFFLES: "true"}
        if batch_bytes is not None:
            self.settings[BATCH_BYTES] = str(batch_bytes)
        self.root = work_path(spark, name)
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        before = {name: self.spark.conf.get(name) for name in self.settings}
        for name, value in self.settings.items():
            self.spark.conf.set(name, value)
        try:
            df.write.parquet(path)
        finally:
            for name, value in before.items():
                self.spark.conf.set(name, value)
        return self.spark.read.schema(df.schema).parquet(path)

    def holds(self, df: DataFrame) -> bool:
        """Whether a table was written here."""
        root = self.root.split(":", 1)[-1]
        return any(root in file for file in df.inputFiles())

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that ``keep`` wrote and nothing reads any more."""
        paths = {f.rsplit("/", 1)[0] for table in tables for f in table.inputFiles()}
        for path in paths:
            if self.root.split(":", 1)[-1] in path:
                remove(self.spark, path)
        # Shuffle files go once nothing refers to the plans that wrote them; both
        # sides hold such references until they collect garbage.
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def read_or(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or an empty one where nothing was stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id, fold: int):
    """Whether a document is in a fold: the CRC-32 of its number as text, modulo 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == fold, F.lit(False))
