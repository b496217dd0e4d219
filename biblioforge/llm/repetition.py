"""Quality rules on repetition inside a text, from its suffix array over words.

The suffixes of a text (from each word to its end) are sorted by prefix doubling; neighbours in that order share the longest common
prefixes, and an interval of neighbours that share n words is a repeated passage of n words. For every word the longest passage that
starts there and occurs elsewhere in the text is the larger of its two neighbours' common prefixes; the spans of all maximal
repeats of at least min_words words are exactly the union of those passages. A text fails if that union covers more than max_percent
of its words, or if one passage (whose second occurrence may overlap the first) is longer than max_words.

The texts of a chunk are handled together in numpy: no suffix shares a first key with one of another text. Only suffixes that still have
a twin are sorted again, so ordinary prose costs a few rounds. Memory is that of a chunk of CHUNK_BYTES, or of one longer text: some 60
bytes a word, and 4 more for each doubling up to its longest repeat.

Rules for odd input: null text counts as empty; texts without words have all counts 0 and fail the base rule; very long texts are read
whole; rows are judged one by one, so repeated rows, equal and null doc_ids give one result each; an empty table gives no rows; extra
columns, also of clashing names, are ignored by the digest and kept by the filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once.
CHUNK_BYTES = 1 << 21
#: Fixed by the base rules: fewest words, words of a window, and percent of words in repeated windows.
LEAST_WORDS, WINDOW, WINDOW_PERCENT = 50, 3, 50


@dataclass(frozen=True)
class Limits:
    """Repeats of at least min_words words count; they may cover max_percent of the words, and none may be longer than max_words."""

    min_words: int = 10
    max_percent: int = 25
    max_words: int = 100


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


BLANK, SYMBOL = _table(b" \t\n\v\f\r"), _table(b"#*$%&|<>")


def _levels(first: np.ndarray, ends: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """first: a code per word that no two texts share; ends: per word the end of its text.

    -> (levels, order): level k gives suffixes equal ranks if their first 2 ** k words are equal; order is the suffix array."""
    n = len(first)
    order = np.argsort(first, kind="stable")
    slots = np.arange(n)
    starts = np.empty(n, bool)
    rank, levels, span = np.empty(n, np.int64), [], 1
    live, keys = order, first[order]
    while True:
        starts[0] = True
        np.not_equal(keys[1:], keys[:-1], out=starts[1 : len(keys)])
        head = starts[: len(keys)]
        # a group's rank is the place of its first suffix
        rank[live] = np.repeat(slots[head], np.diff(np.append(np.flatnonzero(head), len(keys))))
        levels.append(rank.astype(np.int32 if n < 2**31 else np.int64))
        single = head & np.append(head[1:], True)
        live = live[~single]
        if not len(live):
            break
        after = live + span
        inside = after < ends[live]
        second = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
        keys = rank[live] * (n + 1) + second
        by = np.argsort(keys, kind="stable")
        slots = slots[~single]  # a group keeps its places
        live, keys, span = live[by], keys[by], 2 * span
    order[rank] = np.arange(n)
    return levels, order


def longest_repeats(first: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per word the number of words of the longest passage that starts there and occurs elsewhere in its text; 0 where it is below 2."""
    n, out = len(first), np.zeros(len(first), np.int64)
    if n < 2:
        return out
    levels, order = _levels(first, ends)
    if len(levels) < 2:
        return out
    near = levels[1][order]
    at = np.flatnonzero(near[1:] == near[:-1])  # neighbours that share two words
    a, b = order[at], order[at + 1]
    common = np.zeros(len(at), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + common, b + common
        same = (i < n) & (j < n)
        i, j = np.minimum(i, n - 1), np.minimum(j, n - 1)
        common += np.where(same & (levels[k][i] == levels[k][j]), 1 << k, 0)
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    return out


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeat of at least that many words."""
    at = np.flatnonzero(longest >= least)
    steps = np.zeros(len(longest) + 1, np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + longest[at], -1)
    return np.cumsum(steps[:-1]) > 0


def _codes(data: np.ndarray, keep: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pieces; the pieces are data[keep] cut at lengths."""
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[keep]))])
    return pieces.dictionary_encode().indices.to_numpy().astype(np.int64)


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[bounds])


def _measure(texts: pa.LargeStringArray, min_words: int) -> dict[str, pa.Array]:
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    blob = texts.buffers()[2]
    data = np.frombuffer(blob, np.uint8)[offsets[0] : offsets[-1]] if blob is not None else np.zeros(0, np.uint8)
    bounds = offsets - offsets[0]
    size, n_docs = len(data), len(texts)
    edge = np.zeros(size + 1, bool)
    edge[bounds] = True
    word, point = ~BLANK[data], (data & 0xC0) != 0x80
    before = np.append(False, word[:-1]) if size else word
    after = np.append(word[1:], False) if size else word
    begins = np.flatnonzero(word & (~before | edge[:-1]))
    stops = np.flatnonzero(word & (~after | edge[1:])) + 1
    firsts = np.searchsorted(begins, bounds)  # of each text's words
    counts = np.diff(firsts)
    doc = np.repeat(np.arange(n_docs), counts)
    codes = _codes(data, word, stops - begins)
    longest = longest_repeats(doc * (codes.max(initial=0) + 1) + codes, np.repeat(firsts[1:], counts))
    in_windows, in_repeats = covered(longest, WINDOW), covered(longest, min_words)
    most = np.zeros(n_docs, np.int64)
    np.maximum.at(most, doc, longest)

    feed = data == 10
    heads = np.flatnonzero((np.append(True, feed[:-1]) | edge[:-1]) if size else feed)
    tails = np.append(heads[1:], size)[: len(heads)]
    lengths = tails - heads - (feed[tails - 1] if size else 0)
    has_word = _sums(word, np.append(heads, size)) > 0 if size else np.zeros(0, bool)
    line_doc = np.searchsorted(bounds, heads, "right") - 1
    lines = _codes(data, ~feed, lengths)
    keys = (line_doc * (lines.max(initial=0) + 1) + lines)[has_word]
    unique = np.unique(keys) // (lines.max(initial=0) + 1)
    n_dup = np.bincount(line_doc[has_word], minlength=n_docs) - np.bincount(unique, minlength=n_docs)

    # runs of covered words, cut at texts, as code points of their text
    lead = np.append(False, in_repeats[:-1]) if len(doc) else in_repeats
    follow = np.append(in_repeats[1:], False) if len(doc) else in_repeats
    text_edge = np.zeros(len(doc) + 1, bool)
    text_edge[firsts] = True
    run_from = np.flatnonzero(in_repeats & (~lead | text_edge[:-1]))
    run_to = np.flatnonzero(in_repeats & (~follow | text_edge[1:]))
    points = np.concatenate(([0], np.cumsum(point)))
    base = points[bounds[:-1]][doc[run_from]]
    spans = pa.StructArray.from_arrays([pa.array(points[begins[run_from]] - base), pa.array(points[stops[run_to]] - base)], ["start", "end"])
    list_offsets = np.searchsorted(run_from, firsts).astype(np.int32)
    return {
        "n_words": pa.array(counts), "word_chars": pa.array(_sums(word & point, bounds)), "n_symbols": pa.array(_sums(SYMBOL[data], bounds)),
        "n_dup_lines": pa.array(n_dup), "n_repeat_words": pa.array(_sums(in_windows, firsts)), "n_covered": pa.array(_sums(in_repeats, firsts)),
        "longest_repeat": pa.array(most), "spans": pa.ListArray.from_arrays(pa.array(list_offsets), spans),
    }


def _chunks(texts: pa.LargeStringArray) -> Iterator[tuple[int, int]]:
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, "right")) - 1)
        yield a, b
        a = b


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_covered long, longest_repeat long, spans array<struct<start: long, end: long>>"


def measure(docs: DataFrame, min_words: int, *keep: str) -> DataFrame:
    """The columns of keep, then per text the MEASURES; spans: code points (end exclusive) of the union of its repeats of min_words words or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").cast(pa.large_string()).fill_null("")
            for a, b in _chunks(texts):
                found = _measure(texts.slice(a, b - a), min_words)
                kept = [batch.column(f"_keep{i}").slice(a, b - a) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *found.values()], names=[*(f"_keep{i}" for i in range(len(keep))), *found])

    rows = docs.select(*[F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)], F.col("text").cast("string").alias("_text"))
    schema = ", ".join([*(f"_keep{i} {rows.schema[i].dataType.simpleString()}" for i in range(len(keep))), MEASURES])
    return rows.mapInArrow(run, schema).withColumnsRenamed({f"_keep{i}": c for i, c in enumerate(keep)})


def verdict(measured: DataFrame, limits: Limits) -> DataFrame:
    """measured with base_failed and kept."""
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > WINDOW_PERCENT * F.col("n_words"))
    fine = (100 * F.col("n_covered") <= limits.max_percent * F.col("n_words")) & (F.col("longest_repeat") <= limits.max_words)
    return measured.withColumns({"base_failed": base, "kept": ~base & fine})


def quality(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per row: doc_id, MEASURES, base_failed, kept."""
    return verdict(measure(docs.withColumn("doc_id", F.col("doc_id").cast("long")), limits.min_words, "doc_id"), limits)


def good_documents(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows that pass, with all their columns. One pass: whole rows travel through the measuring task, so no join by key follows."""
    names = [f"_column{i}" for i in range(len(docs.columns))]
    copy = docs.toDF(*names).withColumn("text", F.col(names[docs.columns.index("text")]))
    return verdict(measure(copy, limits.min_words, *names), limits).where("kept").select(*names).toDF(*docs.columns)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered"
    )


def _windows(name: str, words: int) -> str:
    """SQL: {name}, per text the number of words that lie in windows of so many words found twice or more."""
    return f"""
{name}0 AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + {words - 1}], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {words - 2})) AS i FROM d)),
{name}1 AS (SELECT doc_id, i FROM {name}0 QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
{name} AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM {name}1, range({words}) r(j) GROUP BY doc_id)"""


def oracle(limits: Limits = Limits()) -> str:
    """A repeat longer than max_words is a window of max_words + 1 words found twice."""
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
{_windows('w', WINDOW)}, {_windows('c', limits.min_words)}, {_windows('x', limits.max_words + 1)},
m AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(w.n, 0)::BIGINT AS n_repeat_words,
  coalesce(c.n, 0)::BIGINT AS n_covered, x.n IS NULL AS short
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN w USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN x USING (doc_id)),
b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {WINDOW_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * n_covered <= {limits.max_percent} * n_words AND short AS kept, n_covered FROM b
"""
