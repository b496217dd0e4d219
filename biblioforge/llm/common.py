"""Helpers shared by the training-data operators: shared storage, lineage cuts, size-checked broadcasts, row keys.

What operators write for themselves lies in one folder per application below the shared one; it is removed when the driver ends.
"""

from __future__ import annotations

import atexit
import ctypes
import re
import uuid
from functools import lru_cache

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Used only where a local session names no spark.checkpoint.dir (tests).
LOCAL_CHECKPOINT_DIR = "/tmp/checkpoints"
#: How many times the wanted rows of a sample are let through by their hash.
SPARE = 6
#: A side with at most this many rows (of a few dozen bytes) may be broadcast.
BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session; a local one only where driver and executors are one process."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found and not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or LOCAL_CHECKPOINT_DIR).rstrip("/")


_CLEANED: set[str] = set()


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the application's folder."""
    folder = f"{shared_dir(spark)}/biblioforge/{spark.sparkContext.applicationId}"
    if folder not in _CLEANED:
        _CLEANED.add(folder)
        context = spark.sparkContext
        place, conf = context._jvm.org.apache.hadoop.fs.Path(folder), context._jsc.hadoopConfiguration()
        atexit.register(_remove, place, conf)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _remove(place, conf) -> None:
    try:
        place.getFileSystem(conf).delete(place, True)
    except (Py4JError, OSError):  # the JVM has ended before the driver's Python
        pass


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stash(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def small_side(df: DataFrame, name: str, rows: int = BROADCAST_ROWS) -> tuple[DataFrame, int]:
    """Stash df, count it, and hint a broadcast only below the bound; beyond it a shuffled join with AQE skew handling runs."""
    kept = stash(df, name)
    n = kept.count()
    return (F.broadcast(kept) if n <= rows else kept), n


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


@lru_cache(maxsize=1)
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return lambda _: 0


def give_back() -> None:
    """Returns what a worker has freed to the system, so that idle workers of earlier stages do not weigh on later ones."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def least_hashes(rows: DataFrame, n: int, order: Column, ties: list[Column | str], most: int) -> DataFrame:
    """The `most` rows of least order (a hash, uniform over longs), then ties. n: about how many rows there are, or fewer.

    Rows whose hash cannot be among them are left out first, so that the task that sorts sees a few times `most` rows however large
    the corpus is; should too few be left, all are sorted. The rows are the same either way."""
    share = SPARE * most / max(n, 1)
    if share < 1:
        near = rows.where(order < F.lit(int(-(2**63) + share * 2**64)))
        kept = stash(near.orderBy(order, *ties).limit(most), "least-hashes")  # bounded by most
        if kept.count() >= most:
            return kept.orderBy(order, *ties)
    return rows.orderBy(order, *ties).limit(most)


KEY = "_biblioforge_row_key"


def row_key(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Column:
    """16 bytes that rows share only if they are equal in every column; doc_ids may repeat or be null."""
    rest = [F.to_json(f"`{f.name}`") if _has_map(f.dataType) else F.col(f"`{f.name}`") for f in docs.schema if f.name not in (id_column, text_column)]
    nulls = F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in docs.columns])
    parts = [F.col(id_column).cast("string"), F.md5(F.coalesce(text_column, F.lit(""))), F.xxhash64(*rest).cast("string") if rest else F.lit("")]
    return F.unhex(F.md5(F.concat_ws("|", nulls, *parts)))


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def only_rows(docs: DataFrame, dropped: DataFrame, repeated: DataFrame, name: str) -> DataFrame:
    """docs without the rows whose key is in dropped, and with one row of each key in repeated (both: column KEY).

    Keys travel if they are few, else both sides are dealt by key; only rows that occur several times are aggregated."""
    away, n_away = small_side(dropped.select(KEY).distinct(), name)
    twins, n_twins = small_side(repeated.select(KEY).distinct(), f"{name}-twins")
    # a row travels as one struct, so that a column named like KEY comes back as it was
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key(docs).alias(KEY))
    left = keyed.join(away, KEY, "left_anti") if n_away else keyed
    if n_twins:
        left = left.join(twins, KEY, "left_anti").unionByName(left.join(twins, KEY, "left_semi").dropDuplicates([KEY]))
    return left.select("row.*")
