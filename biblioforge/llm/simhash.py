"""SimHash near-duplicates: byte-position inverted index with count filtering, then exact verification.

Two 64-bit fingerprints at Hamming distance of 4 or less share at least 4 of their 8 positional bytes. A list per
single (position, byte) would hold 1/256 of the corpus, so the lists of the index are keyed on LIST_BYTES positional bytes
together (56 position sets of 3). A pair is looked at in the list of the first positions it shares only; its shared bytes are
tallied there, pairs below the guaranteed minimum of 4 go, and the others are verified by their differing bits. No pair within the
distance is lost. Candidates grow with 56 * N * N / 2 ** 25 over N distinct fingerprints; list_bytes=4 (70 sets) has 1/205 of them
and gives the same pairs, as no pair in a list can be below the minimum there: for more than some 10 ** 9 fingerprints.

Rules for odd input: null text counts as empty; texts without words have fingerprint zero and link like
any other; equal fingerprints are merged before the index, so copies never form pairs; very long texts are hashed whole, in
bounded memory; a null doc_id takes part, but a component is named by it only if it holds no other; rows of one doc_id are
separate documents, and repeated rows appear as often as they occur, with equal values; an empty table gives no rows; extra
columns, also of clashing names, are ignored by the operator and kept by the pipeline stage, which keeps one row per component.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KEY, give_back, only_rows, row_key, stash
from .components import connected_components

WORDS, SEED, BYTES, MAX_BITS = 4, 42, 8, 4
#: 8 bytes, at most MAX_BITS of them touched; bytes in a list's key.
MIN_SHARED, LIST_BYTES = BYTES - MAX_BITS, 3
#: Shingles hashed at once: bounds the bit matrix of a very long text to a few MB.
CHUNK = 65_536


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles; bit i is 1 where over half of the hashes have it."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z fall, only ASCII blanks split
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    width = min(words, len(tokens))
    starts = np.concatenate(([0], ends[: len(tokens) - width] + 1)).tolist()
    stops = ends[width - 1 :].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for a in range(0, len(starts), CHUNK):
        hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(starts[a : a + CHUNK], stops[a : a + CHUNK])], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches):
    for batch in batches:
        prints = [fingerprint(t.as_py()) for t in batch.column("text")]
        kept = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in kept), pa.array(np.array(prints, np.uint64).view(np.int64))], names=[*kept, "fp"]
        )
        give_back()


def fingerprints(docs: DataFrame, *keys) -> DataFrame:
    """doc_id, the columns of keys, and the fingerprint as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long"), *keys, F.col("text").cast("string"))
    return rows.mapInArrow(_fingerprints, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text") + ", fp long")


def _byte(column, position: int):
    return F.shiftrightunsigned(column, 8 * position).bitwiseAND(F.lit(0xFF))


def _key(column, number: int, positions: tuple[int, ...]):
    """List key in one long: the position set's number, then its bytes."""
    key = F.lit(number).cast("long")
    for p in positions:
        key = F.shiftleft(key, 8).bitwiseOR(_byte(column, p))
    return key


def near_pairs(prints: DataFrame, max_bits: int = MAX_BITS, list_bytes: int = LIST_BYTES) -> DataFrame:
    """Pairs (a, b), a < b as longs, of distinct fingerprints at most max_bits apart; each pair once."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the index guarantees pairs of up to {MAX_BITS} differing bits")
    return candidate_pairs(prints, list_bytes, BYTES - max_bits).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")


def candidate_pairs(prints: DataFrame, list_bytes: int = LIST_BYTES, min_shared: int = MIN_SHARED) -> DataFrame:
    """Pairs (a, b), a < b, that share a list of the index and at least min_shared positional bytes; each pair once, with its tally."""
    if not 1 <= list_bytes <= min_shared:
        raise ValueError("a list's key may hold the guaranteed minimum of bytes at most")
    sets = list(combinations(range(BYTES), list_bytes))
    fp = F.col("fp")
    lists = prints.select(fp, F.explode(F.array(*[_key(fp, n, p) for n, p in enumerate(sets)])).alias("key"))
    a, b = lists.select("key", F.col("fp").alias("a")), lists.select("key", F.col("fp").alias("b"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    same = [(_byte(differing, p) == 0).cast("int") for p in range(BYTES)]
    tally = sum(same[1:], same[0])
    # the list's own set must hold the first positions that the pair shares, so that other lists skip the pair
    number = F.shiftrightunsigned(a["key"], 8 * list_bytes)
    mask = sum(((F.lit(1) * s) * (1 << p) for p, s in enumerate(same[1:], 1)), same[0])
    own = F.get(F.array(*[F.lit(sum(1 << p for p in s)) for s in sets]), number.cast("int"))
    # no shared position outside the set may precede the set's last one
    last = F.get(F.array(*[F.lit((1 << (max(s) + 1)) - 1) for s in sets]), number.cast("int"))
    return a.join(b.hint("merge"), (a["key"] == b["key"]) & (F.col("a") < F.col("b")) & (tally >= min_shared) & (mask.bitwiseAND(last) == own)).select(
        "a", "b", tally.alias("shared")
    )


def _classes(prints: DataFrame, max_bits: int) -> DataFrame:
    """fp, root: the component of every distinct fingerprint, named by one of its fingerprints."""
    classes = stash(prints.select("fp").distinct(), "fingerprint-classes")
    links = stash(near_pairs(classes, max_bits), "fingerprint-links")
    grouped = connected_components(links)  # node, root over fingerprints that have links
    return classes.join(grouped.hint("merge"), classes["fp"] == grouped["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def _by_component(prints: DataFrame, classes: DataFrame, best) -> DataFrame:
    """fp, best: the aggregate over all rows of its component. Rows are combined per fingerprint first, so copies weigh nothing."""
    per_print = prints.groupBy("fp").agg(best.alias("best"))
    labelled = stash(classes.join(per_print.hint("merge"), "fp"), "fingerprint-labels")
    of_root = labelled.groupBy("root").agg(F.min("best").alias("best"))
    return stash(labelled.select("fp", "root").join(of_root.hint("merge"), "root").select("fp", "best"), "fingerprint-components")


def simhash_components(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (hex), component_id: the smallest doc_id reachable over links."""
    prints = stash(fingerprints(docs), "fingerprints")
    least = _by_component(prints, _classes(prints, max_bits), F.min("doc_id"))
    return prints.join(least.hint("merge"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("best").alias("component_id")
    )


def one_of_each_component(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One document per component, that with the smallest doc_id (a null one is the greatest), with all its columns."""
    prints = stash(fingerprints(docs, row_key(docs).alias(KEY)), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", KEY)
    least = _by_component(prints, _classes(prints, max_bits), F.min(order))
    judged = stash(prints.join(least.hint("merge"), "fp").select(KEY, (F.col(KEY) == F.col(f"best.{KEY}")).alias("stays")), "near-judged")
    repeated = judged.where("stays").groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return only_rows(docs, judged.where("NOT stays"), repeated, "near-copies")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
