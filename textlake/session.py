"""Spark session, object-store settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this library wants. The number of shuffle partitions is
# left to the cluster: AQE splits and merges them by their measured size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def object_store_settings(
    endpoint: str | None = None,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
) -> dict[str, str]:
    """Settings that make ``s3a://`` paths usable as any source or sink path.

    Arguments left out come from the environment (``S3_ENDPOINT``,
    ``AWS_ACCESS_KEY_ID``, ``AWS_SECRET_ACCESS_KEY``); what is set nowhere is
    left to the cluster's own configuration.
    """
    values = {
        "endpoint": endpoint or os.environ.get("S3_ENDPOINT"),
        "access.key": access_key or os.environ.get("AWS_ACCESS_KEY_ID"),
        "secret.key": secret_key or os.environ.get("AWS_SECRET_ACCESS_KEY"),
        "path.style.access": str(path_style).lower(),
        "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    return {f"spark.hadoop.fs.s3a.{k}": v for k, v in values.items() if v is not None}


def build_session(
    app_name: str, master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with the library's settings; ``settings`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    A local session without one gets a temporary folder; on a cluster that
    would be lost with its machine, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="textlake-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job wrote and nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/textlake/{name}-{uuid.uuid4().hex}"
