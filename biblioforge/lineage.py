"""Lineage cuts through the shared checkpoint folder, so that plans which use a frame several times stay small and survive lost executors; and a
folder for what a query writes and reads back."""

from __future__ import annotations

import atexit
import re
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where a local session names no spark.checkpoint.dir (tests).
LOCAL_CHECKPOINT_DIR = "/tmp/checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a local folder only where driver and executors are one process."""
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir")
    if not shared and not re.fullmatch(r"local(\[[^]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (shared or LOCAL_CHECKPOINT_DIR).rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and read back from the session's checkpoint folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


#: Rows of some hundred bytes that a join may hold in every task.
BROADCAST_ROWS = 200_000


def small_side(df: DataFrame) -> DataFrame:
    """df, computed once, with the hint to broadcast it if it has BROADCAST_ROWS rows at most; else it is joined by a shuffle."""
    kept = cut(df)
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def stash(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df, computed once and read back from a compressed scratch table, a fifth of what cut writes; and its path, for drop."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; what lies there goes when the driver ends."""
    path = f"{shared_dir(spark)}/scratch/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    place, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), spark.sparkContext._jsc.hadoopConfiguration()
    atexit.register(_remove, place, conf)
    return path


def _remove(place, conf) -> None:
    try:
        place.getFileSystem(conf).delete(place, True)
    except (Py4JError, OSError):  # the JVM has ended before the driver's Python
        pass
