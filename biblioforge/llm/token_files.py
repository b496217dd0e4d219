"""Token-ID files: independent zstandard frames, a document directory and a trailing seek table with checksums.

Layout of a file (all integers little-endian):
  frames      one zstandard frame per document (several for a document over FRAME_IDS ids); content: ids as u16 or u32
  directory   skippable frame 0x184D2A50: zstandard-compressed columns doc_id i64, n_ids u64, n_frames u32, then
              the count u64, the number of null doc_ids u64 (they come first) and the id width u8
  seek table  skippable frame 0x184D2A5E: per frame compressed size u32, content size u32, low 32 bits of its XXH64; then the
              frame count u32, descriptor u8 (0x80: checksums present), magic 0x8F92EAB1
A reader takes the two tables from the end of the file, then decompresses the frames of requested documents only.

Texts are encoded where they are read, and only ids are dealt into ranges of doc_id. Files are written by the
executors straight into the shared folder: to a name of the attempt, then renamed, so a repeated or lost task leaves
either nothing or the whole file; what a lost attempt began is removed at the end. Rules for odd input: null text counts as empty
(only the end id is written); a null doc_id sorts first and stays null; rows of one doc_id are ordered by a hash of their text
and then their ids, so that a repeated task orders them alike; repeated rows are written as often as they occur; an empty
table gives no files and no rows; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_path, stash
from .tokens import END_ID, encode_batch, encoder, vocabulary_path

DIRECTORY, SEEK, SEEK_FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
#: Ids per frame: longer documents are cut into several frames.
FRAME_IDS = 1 << 20
LEVEL = 3
#: Bytes of text for one file, about; seed of the sample for the files' bounds.
SHARD_BYTES, SEED = 32 << 20, 13
#: Most files, and most rows sampled: the driver holds no more however large the corpus is; beyond, files grow.
MOST_FILES, MOST_SAMPLED = 25_000, 200_000


class TokenFileWriter:
    """Writes one file; add documents in order, then close."""

    def __init__(self, sink, width: int = 2):
        if width not in (2, 4):
            raise ValueError("ids are written in 2 or 4 bytes")
        self.sink, self.width = sink, width
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False)
        self.docs: list[int] = []
        self.counts: list[int] = []
        self.frames: list[int] = []
        self.seek: list[bytes] = []
        self.nulls = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """ids: little-endian unsigned 32-bit integers. Documents with a null doc_id come first."""
        wide = np.frombuffer(ids, "<u4")
        if self.width == 2 and len(wide) and wide.max() > 0xFFFF:
            raise ValueError(f"id {wide.max()} of document {doc_id} does not fit in 2 bytes: write with width=4")
        self.add_content(doc_id, ids if self.width == 4 else wide.astype("<u2").tobytes())

    def add_content(self, doc_id: int | None, content) -> None:
        """content: a buffer of ids in the file's own width."""
        step = FRAME_IDS * self.width
        parts = range(0, max(len(content), 1), step)
        for i in parts:
            part = content[i : i + step]
            frame = self.compressor.compress(part)
            self.sink.write(frame)
            self.seek.append(struct.pack("<III", len(frame), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
        if doc_id is None:
            if self.nulls < len(self.docs):
                raise ValueError("documents without an id must come first")
            self.nulls += 1
        self.docs.append(doc_id or 0)
        self.counts.append(len(content) // self.width)
        self.frames.append(len(parts))

    def close(self) -> None:
        columns = np.array(self.docs, "<i8").tobytes() + np.array(self.counts, "<u8").tobytes() + np.array(self.frames, "<u4").tobytes()
        body = self.compressor.compress(columns) + struct.pack("<QQB", len(self.docs), self.nulls, self.width)
        self.sink.write(struct.pack("<II", DIRECTORY, len(body)) + body)
        table = b"".join(self.seek) + struct.pack("<IBI", len(self.seek), 0x80, SEEK_FOOTER)
        self.sink.write(struct.pack("<II", SEEK, len(table)) + table)


class TokenFileReader:
    """Random access to one file by document."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        n, descriptor, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != SEEK_FOOTER or descriptor != 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        start = size - 9 - 12 * n
        table = np.frombuffer(source.read_at(12 * n, start), "<u4").reshape(n, 3)
        kind, length = struct.unpack("<II", source.read_at(8, start - 8))
        if kind != SEEK or length != 12 * n + 9:
            raise ValueError("the seek table's frame is damaged")
        self.sizes, self.lengths, self.sums = table[:, 0].astype(np.int64), table[:, 1], table[:, 2]
        self.offsets = np.concatenate(([0], np.cumsum(self.sizes)))
        at = int(self.offsets[-1])
        kind, length = struct.unpack("<II", source.read_at(8, at))
        if kind != DIRECTORY:
            raise ValueError("no document directory after the frames")
        body = source.read_at(length, at + 8)
        count, self.nulls, self.width = struct.unpack("<QQB", body[-17:])
        self.inflate = zstandard.ZstdDecompressor()
        columns = self.inflate.decompress(body[:-17], max_output_size=20 * count + 1)
        self.docs = np.frombuffer(columns, "<i8", count)
        self.counts = np.frombuffer(columns, "<u8", count, 8 * count)
        frames = np.frombuffer(columns, "<u4", count, 16 * count)
        self.first = np.concatenate(([0], np.cumsum(frames)))

    def __len__(self) -> int:
        return len(self.docs)

    def ids(self, k: int) -> bytes:
        """Ids of the k-th document as little-endian unsigned 32-bit integers; only its own frames are decompressed."""
        parts = []
        for f in range(int(self.first[k]), int(self.first[k + 1])):
            packed = self.source.read_at(int(self.sizes[f]), int(self.offsets[f]))
            part = self.inflate.decompress(packed, max_output_size=int(self.lengths[f]) + 1)
            if len(part) != self.lengths[f] or xxhash.xxh64_intdigest(part) & 0xFFFFFFFF != self.sums[f]:
                raise ValueError(f"frame {f} is damaged")
            parts.append(part)
        content = b"".join(parts)
        return content if self.width == 4 else np.frombuffer(content, "<u2").astype("<u4").tobytes()

    def find(self, doc_id: int) -> bytes | None:
        """Ids of a document by its id (the directory is sorted), or None."""
        k = self.nulls + int(np.searchsorted(self.docs[self.nulls :], doc_id))
        return self.ids(k) if k < len(self.docs) and self.docs[k] == doc_id else None


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def _encode(batches: Iterable[pa.RecordBatch], vocabulary: str, width: int, bounds: Broadcast) -> Iterator[pa.RecordBatch]:
    """shard, doc_id, order, ids of every row. Rows equal to several bounds are dealt to all shards between them in turn."""
    kind, turn, bounds = np.dtype(f"<u{width}"), 0, bounds.value
    if encoder(vocabulary).dtype.itemsize > width:
        raise ValueError("the vocabulary's ids do not fit in 2 bytes: write with width=4")
    for batch in batches:
        shards = np.zeros(len(batch), np.int32)
        for i, key in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("order").to_pylist())):
            first, last = bisect_left(bounds, place := _place(*key)), bisect_right(bounds, place)
            shards[i] = first + turn % (last - first + 1)
            turn += last > first
        for a, b, ids, offsets in encode_batch(batch.column("text"), vocabulary, END_ID):
            content = pa.py_buffer(ids.astype(kind, copy=False))
            large = len(content) >= 1 << 31
            places = pa.py_buffer((offsets * width).astype(np.int64 if large else np.int32))
            column = pa.Array.from_buffers(pa.large_binary() if large else pa.binary(), b - a, [None, places, content]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards[a:b]), *(batch.column(c).slice(a, b - a) for c in ("doc_id", "order")), column], names=["shard", "doc_id", "order", "ids"]
            )


def _place(doc_id: int | None, order: int) -> tuple[bool, int, int]:
    return (doc_id is not None, doc_id or 0, order)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("order"), F.col("text").cast("string"))


def range_bounds(docs: DataFrame, shard_bytes: int, most_files: int = MOST_FILES, most_sampled: int = MOST_SAMPLED) -> list[tuple]:
    """Places (doc_id, order) that part the rows into ranges of about equal text, one fewer than files.

    One sample of some most_sampled rows (all, if there are no more) gives the corpus' size and the bounds, so what the driver holds does
    not grow with the corpus. A doc_id of very many rows gives several equal bounds."""
    n, least = docs.count(), docs.sparkSession.sparkContext.defaultParallelism
    share = min(1.0, most_sampled / max(n, 1))
    some = _keyed(docs.sample(share, SEED) if share < 1 else docs)
    rows = some.select("doc_id", "order", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes")).toArrow()
    size = (pc.sum(rows["bytes"]).as_py() or 0) / share
    shards = int(min(most_files, max(least, -(-size // shard_bytes))))
    ranked = rows.sort_by([("doc_id", "ascending"), ("order", "ascending")]) if rows.num_rows else rows
    missing = ranked["doc_id"].null_count  # sorted last, but their place is first
    ranked = pa.concat_tables([ranked.slice(len(ranked) - missing), ranked.slice(0, len(ranked) - missing)])
    ends = np.cumsum(ranked["bytes"].to_numpy() + 64)
    at = np.searchsorted(ends, ends[-1] * np.arange(1, shards) / shards) if len(ends) else []
    return [_place(ranked["doc_id"][int(i)].as_py(), ranked["order"][int(i)].as_py()) for i in at]


def _write(batches: Iterable[pa.RecordBatch], folder: str, width: int) -> Iterator[pa.RecordBatch]:
    files, root = open_folder(folder)
    writer, name, shard, first = None, uuid.uuid4().hex, None, None
    for batch in batches:
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
            if writer is None:
                files.create_dir(root, recursive=True)
                sink, shard, first = files.open_output_stream(f"{root}/.{name}.part"), batch.column("shard")[0].as_py(), doc_id
                writer = TokenFileWriter(sink, width)
            writer.add_content(doc_id, memoryview(ids.as_buffer()))
    if writer is not None:
        writer.close()
        sink.close()
        files.move(f"{root}/.{name}.part", f"{root}/{name}.tok")
        types = [("file", pa.string()), ("shard", pa.int32()), ("first_id", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]
        yield pa.RecordBatch.from_pydict(
            {"file": [f"{name}.tok"], "shard": [shard], "first_id": [first], "n_docs": [len(writer.docs)], "n_tokens": [sum(writer.counts)]}, schema=pa.schema(types)
        )


def _remove_parts(spark: SparkSession, folder: str) -> None:
    """Removes what lost attempts have left unfinished."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/.*.part")
    hadoop = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for left in hadoop.globStatus(path) or []:
        hadoop.delete(left.getPath(), False)


def write_token_files(docs: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, vocabulary: str | None = None, width: int = 2) -> DataFrame:
    """Encode whole texts and write them in ascending doc_id order. Returns the manifest, one row per file in that order
    (file, shard, first_id, n_docs, n_tokens, base: ids in all files before it).

    Bounds of the ranges come first, from a bounded sample of keys, so that texts are encoded once and only their ids are shuffled. The
    manifest holds one row per file of some tens of MB, so its running total is a window over few rows.
    """
    spark = docs.sparkSession
    bounds = range_bounds(docs, shard_bytes)
    held = spark.sparkContext.broadcast(bounds)  # of MOST_FILES at most
    ids = _keyed(docs).mapInArrow(partial(_encode, vocabulary=vocabulary or vocabulary_path(), width=width, bounds=held), "shard int, doc_id long, order long, ids binary")
    placed = ids.repartitionById(len(bounds) + 1, "shard").sortWithinPartitions("doc_id", "order", "ids")
    manifest = stash(
        placed.mapInArrow(partial(_write, folder=folder, width=width), "file string, shard int, first_id long, n_docs long, n_tokens long"), "token-manifest"
    )
    _remove_parts(spark, folder)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _read(batches: Iterable[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files, root = open_folder(folder)
    for batch in batches:
        for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
            with files.open_input_file(f"{root}/{name}") as source:
                reader = TokenFileReader(source)
                counts = reader.counts.astype(np.int64)
                starts = base + np.cumsum(counts) - counts
                for a in range(0, len(reader), 4096):
                    b = min(a + 4096, len(reader))
                    sums = np.fromiter((zlib.crc32(reader.ids(k)) for k in range(a, b)), np.int64, b - a)
                    doc_ids = pa.array(reader.docs[a:b], mask=np.arange(a, b) < reader.nulls)
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids, pa.array(starts[a:b]), pa.array(counts[a:b]), pa.array(sums)], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                    )


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Digest columns of every document, from the files: doc_id, start, n_tokens, ids_crc32. One task reads few files."""
    spark = manifest.sparkSession
    few = stash(manifest.select("file", "base"), "token-bases")
    n = max(1, few.count())
    return few.repartition(min(n, 4 * spark.sparkContext.defaultParallelism)).mapInArrow(
        partial(_read, folder=folder), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "token-files")
    return read_token_files(write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder), folder)
