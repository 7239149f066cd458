"""The folder that the driver and all executors share, and lineage cuts in it."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where that is unset, a local session, as in tests, gets a temporary one; on
    a cluster that would be another folder on each machine, so it is an error.
    """
    place = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if place:
        return place
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "rinkflow-checkpoints")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared one, not made yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and all in it, by the file system that its path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: Spark's setting that a query's shuffles go as soon as it ends, and not when the driver happens to collect its garbage.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """The same rows in files of the shared folder, so lost executors cost no re-run and a table that is read often is made once.

    Shuffles that the rows come from are removed.
    """
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    before = spark.conf.get(CLEANED)
    spark.conf.set(CLEANED, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a plan of its own, as a plan takes the setting when it is made
    finally:
        spark.conf.set(CLEANED, before)


def settled(df: DataFrame, folder: str) -> DataFrame:
    """The rows, kept before the folder that they come from is removed."""
    out = cut(df)
    remove_folder(df.sparkSession, folder)
    return out
