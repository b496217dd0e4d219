"""Exact deduplication against a persistent digest index, bucketed and sorted by hash.

Rules for odd input: a null text counts as empty. Of equal texts the row with the largest doc_id stays (a null doc_id is the
smallest); of several such rows with that doc_id one stays, whatever other columns they have. Rows of one doc_id with
different texts are different documents. Very long texts are hashed whole; an empty table gives no rows; extra columns, also of
clashing names, are ignored by the operator and kept by the pipeline stage.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KEY, drop_stash, new_path, only_rows, row_key, stash, text_or_empty

#: Fewest buckets of an index, and digests of 40 bytes for which one more is made: a bucket is one task's work.
LEAST_BUCKETS, BUCKET_ROWS = 16, 4_000_000
#: Batches after which the files of each bucket are merged to one sorted file.
COMPACT_AFTER = 8
STATE_FILE = re.compile(r"_state-([0-9]+)\.json")
#: Lets the scan of a bucket that is one file keep its order, so that the merge join does not sort the index again.
SORTED_SCAN = "spark.sql.legacy.bucketedTableScan.outputOrdering"


class DigestIndex:
    """Every text digest seen so far with the doc_id that stands for it, as a bucketed and sorted external table.

    ``path`` is a folder all executors reach. A numbered file _state-N.json names the buckets, the batches since the last compaction and
    the subfolder that holds the table, so an index outlives a session and is opened as it was made. The number of buckets
    comes from the first batch, or from ``expected_rows``.

    A state is written whole under a new number and never changed; the highest whole one counts, and older ones go after it. A stop between any
    two file operations therefore leaves an index that opens: digests of a stopped append count as seen (the same batch again gives the same
    rows), and a stopped compaction leaves the old table in force. A folder with digests but without a state is refused, as its buckets
    are unknown. One writer at a time: a writer that finds a state newer than its own raises before it writes.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, expected_rows: int | None = None):
        self.spark, self.path, self.expected_rows = spark, (path or new_path(spark, "digests")).rstrip("/"), expected_rows
        self.number, self.state = self._newest()
        if self.state:
            self._register(self.state)
        elif found := [n for n in self._names() if n.startswith("digests-")]:
            raise ValueError(f"{self.path} holds {', '.join(found)} but no state")

    def _file(self, name: str = ""):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self) -> list[str]:
        place, files = self._file()
        return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []

    def _newest(self) -> tuple[int, dict | None]:
        """The highest number of a state, and the highest numbered state that can be read."""
        numbers = sorted((int(m.group(1)) for m in map(STATE_FILE.fullmatch, self._names()) if m), reverse=True)
        for n in numbers:
            place, files = self._file(_state_name(n))
            stream = files.open(place)
            try:
                return numbers[0], json.loads(bytes(stream.readAllBytes()).decode())
            except ValueError:
                continue
            finally:
                stream.close()
        return max(numbers, default=0), None

    def _write(self, name: str, text: str) -> None:
        place, files = self._file(name)
        stream = files.create(place, True)
        stream.write(text.encode())
        stream.close()

    def _rename(self, old: str, new: str) -> None:
        place, files = self._file(new)
        if files.exists(place) or not files.rename(self._file(old)[0], place):
            raise OSError(f"cannot write {self.path}/{new}")

    def _delete(self, name: str) -> None:
        drop_stash(self.spark, f"{self.path}/{name}")

    def _alone(self) -> None:
        if self._newest()[0] != self.number:
            raise RuntimeError(f"{self.path} was changed by another writer: open it again")

    def _write_state(self, state: dict) -> None:
        name = _state_name(self.number + 1)
        part = f"{name}.{uuid.uuid4().hex}.part"
        self._write(part, json.dumps(state))
        self._rename(part, name)
        self.number, self.state = self.number + 1, state
        for old in self._names():
            m = STATE_FILE.fullmatch(old)
            if old.endswith(".part") or m and int(m.group(1)) < self.number:
                self._delete(old)

    def _folder(self, state: dict) -> str:
        return f"{self.path}/{state['folder']}"

    def _table(self, state: dict) -> str:
        """The catalog's name of the table: a digest of its whole location, so that no two indexes share one."""
        return "digest_index_" + hashlib.sha256(self._folder(state).encode()).hexdigest()[:40]

    @property
    def name(self) -> str:
        return self._table(self.state)

    def _register(self, state: dict) -> None:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._table(state)} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {state['buckets']} BUCKETS LOCATION '{self._folder(state)}'"
        )

    def prepare(self, rows: int) -> None:
        """Makes the index if it is new, with buckets for so many rows."""
        if self.state is None:
            buckets = LEAST_BUCKETS
            while buckets * BUCKET_ROWS < (self.expected_rows or rows):
                buckets *= 2
            self._alone()
            self._write_state({"buckets": buckets, "batches": 0, "folder": "digests-0"})
            self._register(self.state)

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def _save(self, rows: DataFrame, state: dict) -> None:
        (
            rows.select("digest", "keep_id").repartition(state["buckets"], "digest")
            .write.format("parquet").mode("append").option("path", self._folder(state))
            .bucketBy(state["buckets"], "digest").sortBy("digest").saveAsTable(self._table(state))
        )

    def append(self, fresh: DataFrame) -> None:
        """Adds digests that the index does not know; merges each bucket's files after COMPACT_AFTER batches."""
        self._alone()
        self._save(fresh, self.state)
        self._write_state(self.state | {"batches": self.state["batches"] + 1})
        if self.state["batches"] >= COMPACT_AFTER:
            self.compact()

    def compact(self) -> None:
        """One sorted file a bucket, in a new subfolder; the state names it only when it is whole. A failure leaves this object on the old one."""
        self._alone()
        old = self.state
        # read as plain files: over a bucketed scan Spark would leave out the repartition, and with it the single files
        rows = self.spark.read.schema("digest binary, keep_id long").parquet(self._folder(old))
        new = old | {"batches": 1, "folder": f"digests-{int(old['folder'].rpartition('-')[2]) + 1}"}
        for name in self._names():  # what interrupted compactions left, on either side
            if name.startswith("digests-") and name != old["folder"]:
                self._delete(name)
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(new)}")
        self._register(new)
        self._save(rows, new)
        self._write_state(new)
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(old)}")
        self._delete(old["folder"])

    def drop(self) -> None:
        """Takes the table out of the catalog; its files stay."""
        if self.state:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _state_name(number: int) -> str:
    return f"_state-{number:08d}.json"


@contextmanager
def sorted_scans(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(SORTED_SCAN)
    spark.conf.set(SORTED_SCAN, "true")
    try:
        yield
    finally:
        spark.conf.set(SORTED_SCAN, before)


def _digests(docs: DataFrame) -> DataFrame:
    """Per row: a number of its own, doc_id, digest and row key. Written before use, so that the numbers do not change."""
    return stash(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.unhex(F.sha2(text_or_empty(), 256)).alias("digest"), row_key(docs).alias(KEY)),
        "row-digests",
    )


def _standing(digests: DataFrame, index: DigestIndex) -> DataFrame:
    """Per digest: keep_id, group_size, and best, the row that stays (null if the index knows the text under another doc_id).

    One merge join of the batch's digests with the index; those it does not know are appended."""
    groups = stash(
        digests.groupBy("digest").agg(F.max(F.struct("doc_id", KEY, "row")).alias("best"), F.count(F.lit(1)).alias("group_size")), "digest-groups"
    )
    if index.state is None:
        index.prepare(groups.count())
    with sorted_scans(digests.sparkSession):
        known = index.table().withColumnRenamed("keep_id", "known_id").withColumn("known", F.lit(True))
        met = stash(groups.join(known.hint("merge"), "digest", "left"), "digest-standing")
    index.append(met.where("known IS NULL").select("digest", F.col("best.doc_id").alias("keep_id")))
    keep_id = F.when(F.col("known"), F.col("known_id")).otherwise(F.col("best.doc_id"))
    return met.select("digest", "group_size", keep_id.alias("keep_id"), F.when(keep_id.eqNullSafe(F.col("best.doc_id")), F.col("best")).alias("best"))


def exact_dedup(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size (rows of this batch with the text), kept, text_sha256.

    A text the index already knows keeps the document of the earlier batch; within a batch the largest doc_id stays.
    Only digests and keys are shuffled. Groups are counted with a partial aggregate before the anti-join, and the
    join back to rows is between two plain exchanges, so that AQE can split a group that holds much of the corpus.
    """
    digests = _digests(docs)
    return digests.join(_standing(digests, index).hint("merge"), "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("row") == F.col("best.row"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def distinct_documents(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The documents that stay, with all their columns: one row per text."""
    digests = _digests(docs)
    judged = digests.join(_standing(digests, index or DigestIndex(docs.sparkSession)).select("digest", F.col(f"best.{KEY}").alias("stays")).hint("merge"), "digest")
    judged = stash(judged.select(KEY, F.coalesce(F.col(KEY) == F.col("stays"), F.lit(False)).alias("stays")), "exact-judged")
    repeated = judged.where("stays").groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return only_rows(docs, judged.where("NOT stays"), repeated, "exact-copies")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), DigestIndex(spark))


ORACLE = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""
