"""Harmonic packing of token sequences.

A length l belongs to class k = capacity // l: k documents of it fill a bin. Full-capacity pieces are cut off first; a
rest that would waste more than TOLERANCE of a bin k times over is cut at the next reciprocal capacity // (k + 1), until it
fits its class well. Each class's bins take exactly k pieces. Workers number the pieces of each class on their own;
one small table of counts per (worker, class) turns those numbers into places, so bins fill across workers
and only the last bin of each class can stay open. Those few open bins (bounded by the classes, not by the data)
are packed together first-fit.

Rules for odd input: null text counts as empty and gives the end id alone; a null doc_id stays null; repeated rows (also of one doc_id
with other texts) are packed as often as they occur, each as a document; a text over the capacity fills whole sequences
first; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_side, stash
from .tokens import END_ID, encode_batch, vocabulary_path

CAPACITY, TOLERANCE = 2048, 0.02
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, k long, nth long, worker long"
LOCATED = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def cut(length: int, capacity: int = CAPACITY, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(piece length, class) in order; the pieces add up to length."""
    return [(capacity, 1)] * (length // capacity) + _cut_rest(length % capacity, capacity, tolerance)


@lru_cache(maxsize=1 << 16)
def _cut_rest(rest: int, capacity: int, tolerance: float) -> list[tuple[int, int]]:
    pieces = []
    while rest:
        k = capacity // rest
        if rest * k >= capacity * (1 - tolerance):
            pieces.append((rest, k))
            break
        piece = capacity // (k + 1)
        pieces.append((piece, k + 1))
        rest -= piece
    return pieces


def _cut_documents(batches: Iterable[pa.RecordBatch], vocabulary: str, capacity: int, tolerance: float, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    worker, numbers = TaskContext.get().partitionId(), {}
    fields = [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "k", "nth", "worker")]
    schema = pa.schema(fields + [("ids", pa.binary())] * keep_ids)
    for batch in batches:
        doc_ids, rows = batch.column("doc_id").to_pylist(), []
        for a, b, ids, offsets in encode_batch(batch.column("text"), vocabulary, END_ID):
            ids, offsets = memoryview(ids.astype("<u4")).cast("B"), offsets.tolist()
            for i in range(a, b):
                first, total, start = offsets[i - a], offsets[i - a + 1] - offsets[i - a], 0
                for length, k in cut(total, capacity, tolerance):
                    piece = ids[4 * (first + start) : 4 * (first + start + length)]
                    nth = numbers[k] = numbers.get(k, -1) + 1
                    rows.append((doc_ids[i], start, length, zlib.crc32(piece), total, k, nth, worker) + ((bytes(piece),) if keep_ids else ()))
                    start += length
                if len(rows) >= 10_000 or i == b - 1 and rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                    rows = []


def first_fit(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(bin, offset) of each length, longest first into the first bin with room."""
    room: list[int] = []
    out = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        b = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
        if b == len(room):
            room.append(capacity)
        out[i] = (b, capacity - room[b])
        room[b] -= lengths[i]
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, keep_ids: bool = False, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids as binary).

    tolerance: share of a sequence that may stay empty before a document's rest is cut again; a larger one makes fewer pieces."""
    spark = docs.sparkSession
    columns = [*LOCATED, *(["ids"] if keep_ids else [])]
    pieces = stash(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
            partial(_cut_documents, vocabulary=vocabulary or vocabulary_path(), capacity=capacity, tolerance=tolerance, keep_ids=keep_ids),
            PIECE_SCHEMA + ", ids binary" * keep_ids,
        ),
        "pieces",
    )
    counts = stash(pieces.groupBy("worker", "k").agg((F.max("nth") + 1).alias("n")), "piece-counts")
    classes = counts.groupBy("k").agg(F.sum("n").alias("n")).withColumn("bins", F.expr("n div k"))
    # at most a few hundred classes exist for a capacity, whatever the data
    classes = classes.withColumn("first_bin", F.coalesce(F.sum("bins").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("k").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places, _ = small_side(
        counts.withColumn("before", before).join(F.broadcast(classes.select("k", "bins", "first_bin")), "k").select("worker", "k", "before", "bins", "first_bin"),
        "piece-places",
    )
    ranked = pieces.join(places, ["worker", "k"]).withColumn("rank", F.col("before") + F.col("nth"))
    full = F.col("rank") < F.col("bins") * F.col("k")
    in_bin = Window.partitionBy("sequence_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    packed = (
        ranked.where(full)
        .withColumn("sequence_id", F.col("first_bin") + F.expr("rank div k"))
        .withColumn("offset", F.coalesce(F.sum("length").over(in_bin), F.lit(0)))
        .select(*columns)
    )
    # fewer than k pieces of each class k are left
    left = ranked.where(~full).select("worker", "k", "nth", "length").orderBy("k", "worker", "nth").collect()
    if not left:
        return packed
    bins = classes.agg(F.sum("bins")).first()[0]
    spots = first_fit([r["length"] for r in left], capacity)
    rest = spark.createDataFrame(
        [(r["worker"], r["k"], r["nth"], bins + b, offset) for r, (b, offset) in zip(left, spots)],
        "worker long, k long, nth long, sequence_id long, offset long",
    )
    return packed.unionByName(pieces.join(F.broadcast(rest), ["worker", "k", "nth"]).select(*columns))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids (array of ints, unpadded) from pack(..., keep_ids=True); one row per sequence of at most a capacity."""

    def join_pieces(batches):
        for b in batches:
            joined = [memoryview(b"".join(p["ids"] for p in sorted(ps, key=lambda p: p["offset"]))).cast("I").tolist() for ps in b.column("pieces").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("sequence_id"), pa.array(joined, pa.list_(pa.int32()))], names=["sequence_id", "ids"])

    gathered = packed.groupBy("sequence_id").agg(F.collect_list(F.struct("offset", "ids")).alias("pieces"))
    return gathered.mapInArrow(join_pieces, "sequence_id long, ids array<int>")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
