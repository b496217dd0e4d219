"""Grouping of spelling variants by forward and reversed sorted dictionaries.

One edit leaves a half of a word intact. Two near words of lengths s and s or s + 1 form a pair of class s; the edit lies either behind the
first s // 2 code points, and then the words stand in one block of the forward dictionary (equal beginnings), or before the last s - s // 2, and then in
one block of the reversed dictionary (equal ends). Both dictionaries are one table of block keys, sorted by range and scanned block by
block. A block of more than BLOCK words is subdivided before the scan: the part of its words that is not yet fixed is halved again, which gives
a block for each longer beginning and each longer end; within a task smaller blocks go on in the same way until few words are left, and
those pairs are verified. A pair that would stand in both children belongs to the first, so each comes up once and nothing is
emitted that is not near. Blocks whose free part is one code point hold only words that differ there.

Words are counted per task first (at most FLUSH words at a time), so a frequent word is a row per task. Forms are followed to their
last word by doubling: each round joins links with links, and counts at least double along a chain.

Rules for odd input: null text has no words; a null doc_id stands as an empty text in the hash; very long texts and words are read whole;
repeated rows count as often as they occur; equal counts go to the word that is smaller in code points; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations, groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stash, new_path, small_side, stash

#: Shortest word, fewest occurrences, and the divisor of the hash that marks an occurrence whose code point goes.
LEAST_LENGTH, LEAST_COUNT, DAMAGE = 5, 3, 97
#: How many times a word's count its form must have.
RATIO = 2
#: Words of a block above which it is subdivided over the cluster; words of a block compared directly; words a task counts before it hands them on.
BLOCK, DIRECT, FLUSH = 512, 6, 500_000
RUN = re.compile("[a-zÀ-ÿ]+")


def damaged(run: str, start: int, damage: int = DAMAGE) -> str:
    """The run, without one code point if damage divides the crc32 of it that starts from start."""
    h = zlib.crc32(run.encode(), start)
    if damage and h % damage == 0:
        at = h % len(run)
        return run[:at] + run[at + 1 :]
    return run


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damage: int = DAMAGE) -> DataFrame:
    """word, n over whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[str] = Counter()

        def hand_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64())], names=["word", "n"])
            totals.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                lowered = (text.as_py() or "").encode().lower().decode()  # bytes: only A-Z fall
                for word, n in Counter(RUN.findall(lowered)).items():
                    if len(word) >= least_length:
                        word = damaged(word, start, damage)
                        if len(word) >= least_length:
                            totals[word] += n
                if len(totals) > FLUSH:
                    yield hand_on()
        yield hand_on()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def one_edit(a: str, b: str) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def halves(size: int, path: str) -> tuple[int, int, tuple[tuple[int, int], ...]]:
    """Class and path of a block -> fixed code points at either end, and the slices of which a pair may share none, as it then belongs to a block before."""
    front, back, apart = 0, 0, []
    for step in path:
        half = (size - front - back) // 2
        if step == "F":
            front += half
        else:
            apart.append((front, front + half))
            back += size - front - back - half
    return front, back, tuple(apart)


def near_in_block(words: list[str], size: int, front: int, back: int, apart: tuple[tuple[int, int], ...]) -> Iterator[tuple[str, str]]:
    """Near pairs of class size among words with equal front first and back last code points."""
    middle = size - front - back
    if len(words) <= DIRECT or middle <= 1:
        if len(words) <= DIRECT:
            pairs = ((a, b) for a, b in combinations(words, 2) if min(len(a), len(b)) == size)
        else:  # short words differ in their free code point alone; a long one is near those whose free code point it holds
            short = {w[front : front + middle]: w for w in words if len(w) == size}
            pairs = [*combinations(short.values(), 2)]
            for w in words:
                if len(w) > size:
                    free = w[front : front + middle + 1]
                    pairs += [(short[x], w) for x in {free[:middle], free[1:]} if x in short]
        for a, b in pairs:
            if one_edit(a, b) and not any(a[i:j] == b[i:j] for i, j in apart):
                yield a, b
        return
    half = middle // 2
    rest = middle - half
    for key, deeper, slices in (
        (lambda w: w[: front + half], (front + half, back), apart),
        (lambda w: w[len(w) - back - rest :], (front, back + rest), (*apart, (front, front + half))),
    ):
        children: dict[str, list[str]] = {}
        for w in words:
            children.setdefault(key(w), []).append(w)
        for some in children.values():
            if len(some) > 1:
                yield from near_in_block(some, size, *deeper, slices)


def blocks(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n -> key, size (class), path, word, n; blocks that can be divided hold at most block words."""
    length, half = F.length("word"), F.expr("(size - front - back) div 2").cast("int")
    front = F.struct(F.lit("F").alias("step"), (F.col("front") + half).alias("front"), F.col("back").alias("back"))
    back = F.struct(F.lit("B").alias("step"), F.col("front").alias("front"), (F.col("size") - F.col("front") - half).alias("back"))

    def divided(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("child", F.explode(F.array(front, back)))
        rows = rows.select("word", "n", "size", F.concat("path", "child.step").alias("path"), "child.front", "child.back")
        # the reversed end sorts as the reversed dictionary does
        ends = F.reverse(F.expr("right(word, back)"))
        return rows.withColumn("key", F.concat_ws("\t", "path", "size", F.expr("left(word, front)"), ends))

    zero = F.lit(0).alias("front"), F.lit(0).alias("back")
    rows = stash(divided(words.select("word", "n", F.explode(F.array(length, length - 1)).alias("size"), F.lit("").alias("path"), *zero)), "spelling-blocks")
    done = []
    while True:
        sizes = rows.where("size - front - back > 1").groupBy("key").agg(F.count(F.lit(1)).alias("words"))
        large, n = small_side(sizes.where(F.col("words") > block).select("key"), "spelling-large")
        if not n:
            break
        done.append(rows.join(large, "key", "left_anti"))
        rows = stash(divided(rows.join(large, "key", "left_semi")), "spelling-divided")
    for part in done:
        rows = rows.unionByName(part)
    return rows.select("key", "size", "path", "word", "n")


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs (a, n_a, b, n_b) of near words over (word, n), each once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("key", "size", "path", "word", "n"))))
        found: list[tuple[str, int, str, int]] = []
        for _, group in groupby(rows, lambda r: r[0]):  # a block is a run of equal keys, and whole in its task
            some = list(group)
            if len(some) > 1:
                counts = {r[3]: r[4] for r in some}
                found += [(a, counts[a], b, counts[b]) for a, b in near_in_block(list(counts), some[0][1], *halves(some[0][1], some[0][2]))]
            if len(found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["a", "n_a", "b", "n_b"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["a", "n_a", "b", "n_b"])

    table = stash(blocks(words, block), "spelling-dictionary")
    return table.repartitionByRange("key").sortWithinPartitions("key", "word").mapInArrow(scan, "a string, n_a long, b string, n_b long")


def roots(forms: DataFrame) -> DataFrame:
    """word, form -> word, root: the last word that forms lead to. Rounds double the way; only ways that go on are joined again."""
    spark = forms.sparkSession
    links, old = stash(forms.select("word", F.col("form").alias("root")), "spelling-links"), None
    while True:
        path = new_path(spark, "spelling-roots")
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")).write.parquet(path)
        if old:
            drop_stash(spark, old)
        links, old = spark.read.schema("word string, root string, moved boolean").parquet(path), path
        if not links.where("moved").head(1):
            return links.select("word", "root")
        links = links.select("word", "root")


def spelling_groups(docs: DataFrame, ratio: int = RATIO, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damage: int = DAMAGE) -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root. damage=0 counts words as they stand."""
    words = stash(word_counts(docs, least_length, least_count, damage), "spelling-words")
    pairs = near_pairs(words).select(
        F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("n")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("n")))).alias("p")
    ).select("p.*")
    best = F.min(F.struct((-F.col("n")).alias("n"), "other"))
    near = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    judged = words.join(near, "word", "left").withColumn("chosen", -F.col("best.n") >= ratio * F.col("n"))
    judged = stash(judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("chosen"), F.col("best.other")).alias("form"), F.when(F.col("chosen"), -F.col("best.n")).alias("form_n")
    ), "spelling-forms")
    return judged.join(roots(judged.where("form IS NOT NULL")), "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("word", "form", "root", "n", "n_near", "form_n")


#: Near words share what is left when one code point goes: both at the same place (replaced), or one word itself (deleted).
ORACLE = f"""
WITH RECURSIVE bits AS (SELECT i, i AS c, 0 AS k FROM range(256) t(i) UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c::BIGINT ORDER BY i) AS t FROM bits WHERE k = 8),
r AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w
  FROM documents),
dr AS (SELECT d, w, count(*) AS n FROM r WHERE length(w) >= {LEAST_LENGTH} GROUP BY ALL),
h AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(d || ':' || w, ''),
  lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END))),
  lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM dr, crc),
v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % {DAMAGE} = 0 THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word FROM h)
  WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
x AS MATERIALIZED (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS k FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT a.word, b.word AS other, b.n FROM x a JOIN x b ON a.k = b.k AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM x a JOIN v b ON a.k = b.word UNION SELECT b.word, a.word, a.n FROM x a JOIN v b ON a.k = b.word),
m AS (SELECT word, count(*) AS n_near, min({{'n': -n, 'w': other}}) AS best FROM p GROUP BY word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -(best).n >= {RATIO} * v.n THEN (best).w END AS form,
  CASE WHEN -(best).n >= {RATIO} * v.n THEN -(best).n END::BIGINT AS form_n FROM v LEFT JOIN m USING (word)),
walk AS (SELECT word, word AS at, form AS next FROM f UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON f.word = walk.next)
SELECT f.word, form, walk.at AS root, n, n_near, form_n FROM f JOIN walk ON walk.word = f.word AND walk.next IS NULL
"""
