"""Shared scratch space and table staging."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one machine, may do without the setting.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="areascore-")
        spark.conf.set(CHECKPOINT_SETTING, configured)
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nothing else writes to."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/areascore/{application}/{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write a table with several readers once and continue from the written files.

    Unlike an in-memory copy it survives lost executors, and each reader scans only its own columns.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store the path names."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)
