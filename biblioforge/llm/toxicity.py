"""Toxicity: a linear classifier over the distinct words of a text and their stems, trained with a counterfactual penalty.

Score = sigmoid(bias + sum of word scores); a word's score is its own weight plus those of its first 4 and 5 letters. So the
value of a feature is the number of distinct words that have it, in the fit as in scoring, and repeating a word changes nothing.
Training minimises balanced logistic loss + L1 + a counterfactual term: in labelled sentences an identity term is swapped
for the others of its set, and the squared change of the sentence's logit is penalised, so neutral mentions of
a group do not carry a score. Labels come only from rows whose crc32(doc_id) mod 5 is not 0; only the text is a feature.

The fit uses at most TRAIN_TOXIC + TRAIN_CLEAN labelled documents, those with the least seeded hash of doc_id in each
class, and of the features that MIN_DOCS of them have at most the MAX_FEATURES whose log-odds between the classes lie furthest
from 0, over LEAST_Z standard errors (documented bounds); scoring covers every row and whole texts.

Rules for odd input: a null or empty text gets the bias' score; null labels or doc_ids and labels without a
document are not trained on; contradictory labels of one doc_id count as toxic; without any usable label of both
classes every score is 0; an empty table gives no rows; extra columns are ignored, repeated rows scored alike. Very long
texts are scored whole, in memory that grows with their distinct words.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, least_hashes, stash

TRAIN_TOXIC, TRAIN_CLEAN, SEED = 3_000, 6_000, 17
MIN_DOCS, MAX_FEATURES, LEAST_Z, BUCKETS = 3, 60_000, 2.0, 1 << 22
L1, COUNTERFACTUAL, STEPS = 1.2e-3, 1.0, 300
#: Cached word scores per worker; a full cache is emptied.
CACHE_WORDS = 150_000
WORD = re.compile(r"[^\W\d_]+")
#: Sets of identity terms; terms of one set replace each other in counterfactual sentences.
IDENTITY_SETS = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("gay", "lesbian", "bisexual", "queer", "straight", "heterosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("black", "white", "asian", "african", "latino", "arab", "european", "indigenous"),
    ("immigrants", "refugees", "citizens", "foreigners", "locals"),
    ("old", "young", "elderly", "disabled", "blind", "deaf"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "atheisten"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "athées"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "ateos"),
)


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


def word_features(word: str) -> tuple[int, int, int]:
    return bucket(word), bucket("4^" + word[:4]), bucket("5^" + word[:5])


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: hashed features of its distinct words with their counts, and which identity terms it mentions."""
    terms = {t for s in IDENTITY_SETS for t in s}
    for batch in batches:
        out = []
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            ids, counts = np.unique(np.array([f for w in words for f in word_features(w)], np.uint32), return_counts=True)
            out.append((ids.tobytes(), counts.astype(np.uint32).tobytes(), sorted(words & terms)))
        columns = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.list_(pa.string()))],
            names=["toxic", "ids", "counts", "terms"],
        )


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, toxic_rows: int = TRAIN_TOXIC, clean_rows: int = TRAIN_CLEAN) -> DataFrame:
    """The bounded sample: doc_id, toxic; the least seeded hashes of either class among rows that may be learned from."""
    usable = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    usable = stash(usable, "toxicity-labels")
    counts = {r.toxic: r["count"] for r in usable.groupBy("toxic").count().collect()}

    def some(toxic: int, most: int) -> DataFrame:
        return least_hashes(usable.where(F.col("toxic") == toxic), counts.get(toxic, 0), F.xxhash64("doc_id", F.lit(SEED)), ["doc_id"], most)

    return some(1, toxic_rows).unionByName(some(0, clean_rows))


def fit(rows: list) -> dict[str, object]:
    """rows: (toxic, ids, counts, terms) of the sample -> {"bias", "weights": {bucket: weight}}."""
    labels = np.array([r[0] for r in rows], np.float64)
    if not len(rows) or labels.min() == labels.max():
        return {"bias": -math.inf, "weights": {}}
    ids = [np.frombuffer(r[1], np.uint32) for r in rows]
    counts = [np.frombuffer(r[2], np.uint32) for r in rows]
    sizes = np.array([len(x) for x in ids])
    doc, flat = np.repeat(np.arange(len(rows), dtype=np.int32), sizes), np.concatenate(ids)
    used = np.unique(flat)
    column = np.searchsorted(used, flat).astype(np.int32)
    del flat, ids
    positive = np.bincount(column[(labels == 1)[doc]], minlength=len(used)).astype(np.float64)
    total = np.bincount(column, minlength=len(used))
    p, n = labels.sum(), len(rows) - labels.sum()
    ratio = np.log((positive + 0.5) / (p + 1)) - np.log((total - positive + 0.5) / (n + 1))
    z = np.abs(ratio) / np.sqrt(1 / (positive + 0.5) + 1 / (total - positive + 0.5))
    # identity terms always take part, so that the penalty reaches whatever weight their stems would gain
    forced = {f for s in IDENTITY_SETS for t in s for f in word_features(t)}
    z[np.isin(used, list(forced))] += 1e6
    z[total < MIN_DOCS] = -1
    keep = np.argsort(-z, kind="stable")[:MAX_FEATURES]
    keep = np.sort(keep[z[keep] > LEAST_Z])
    if not len(keep):
        return {"bias": math.log(p / n), "weights": {}}
    place = np.full(len(used), -1, np.int32)
    place[keep] = np.arange(len(keep))
    inside = place[column] >= 0
    doc, feature, value = doc[inside], place[column[inside]], np.concatenate(counts)[inside].astype(np.float64)
    del column, counts
    where = {int(used[k]): i for i, k in enumerate(keep)}
    # one row per distinct swap: the difference of two words' features, weighted by how many sentences mention the first
    mentions: dict[tuple[str, str], int] = {}
    for r in rows:
        for t in r[3] or ():
            for s in IDENTITY_SETS:
                if t in s:
                    for other in s:
                        if other != t:
                            mentions[t, other] = mentions.get((t, other), 0) + 1
    pair_rows, pair_features, pair_values, pair_weights = [], [], [], []
    for (a, b), n_mentions in sorted(mentions.items()):
        for sign, word in ((1.0, a), (-1.0, b)):
            for f in word_features(word):
                if f in where:
                    pair_rows.append(len(pair_weights))
                    pair_features.append(where[f])
                    pair_values.append(sign)
        pair_weights.append(n_mentions / len(rows))
    pair_rows, pair_features, pair_values, pair_weights = map(np.array, (pair_rows or [0], pair_features or [0], pair_values or [0.0], pair_weights or [0.0]))
    balance = np.where(labels == 1, 0.5 / p, 0.5 / n)
    # accelerated proximal gradient; each weight has a step of its own, from a bound on the curvature
    spread = np.bincount(doc, value, len(rows))
    bound = 0.25 * np.bincount(feature, balance[doc] * value * spread[doc], len(keep)) + 1e-6
    if len(pair_weights):
        heavy = 6.0 * pair_weights[pair_rows] * np.abs(pair_values)
        bound += COUNTERFACTUAL * 2 * np.bincount(pair_features, heavy, len(keep))
    w, bias = np.zeros(len(keep)), 0.0
    look, look_bias, t = w.copy(), bias, 1.0
    for _ in range(STEPS):
        logit = look_bias + np.bincount(doc, value * look[feature], len(rows))
        error = balance * (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels)
        gradient = np.bincount(feature, value * error[doc], len(keep))
        swap = np.bincount(pair_rows, pair_values * look[pair_features], len(pair_weights))
        gradient += 2 * COUNTERFACTUAL * np.bincount(pair_features, pair_values * (pair_weights * swap)[pair_rows], len(keep))
        new = look - gradient / bound
        new = np.sign(new) * np.maximum(np.abs(new) - L1 / bound, 0)
        new_bias = look_bias - error.sum() / 0.25
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        look, look_bias = new + (t - 1) / t_next * (new - w), new_bias + (t - 1) / t_next * (new_bias - bias)
        w, bias, t = new, new_bias, t_next
    # cut-off calibrated on the sample itself: midway between the two classes' quantiles where they part
    logit = bias + np.bincount(doc, value * w[feature], len(rows))
    grid = np.unique(np.quantile(logit, np.linspace(0, 1, 801)))
    cuts = (grid[1:] + grid[:-1]) / 2
    if len(cuts):
        wrong = [((logit[labels == 1] < c).mean() + 3 * (logit[labels == 0] >= c).mean(), abs(c)) for c in cuts]
        bias -= cuts[min(range(len(cuts)), key=wrong.__getitem__)]
    return {"bias": float(bias), "weights": {int(used[k]): float(x) for k, x in zip(keep, w) if x}}


def _score(batches: Iterable[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    weights, bias = model["weights"], model["bias"]

    class WordScores(dict):
        def __missing__(self, word):
            if len(self) > CACHE_WORDS:
                self.clear()
            score = self[word] = sum(weights.get(f, 0.0) for f in word_features(word))
            return score

    scores = WordScores()
    for batch in batches:
        logits = np.array([bias + math.fsum(map(scores.__getitem__, words_of(t.as_py()))) for t in batch.column("text")])
        score = 1 / (1 + np.exp(-np.clip(logits, -700, 700))) if math.isfinite(bias) else np.zeros(len(logits))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"],
        )
        give_back()


def _reject(batches: Iterable[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = pa.nulls(len(batch), pa.int64()), batch.column("text").cast(pa.string())
        probe = pa.RecordBatch.from_arrays([ids, texts, pa.nulls(len(batch), pa.bool_())], names=["doc_id", "text", "held_out"])
        (scored,) = _score([probe], model)
        yield batch.filter(pa.compute.equal(scored.column("predicted"), 0))


def clean_documents(docs: DataFrame, model: dict) -> DataFrame:
    """The rows that are not predicted toxic, with all their columns."""
    return docs.mapInArrow(partial(_reject, model=model), docs.schema)


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TRAIN_TOXIC, clean_rows: int = TRAIN_CLEAN) -> dict:
    chosen = stash(training_rows(docs, labels, toxic_rows, clean_rows), "toxicity-sample")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # at most toxic_rows + clean_rows ids of 8 bytes
    sample = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(_features, "toxic int, ids binary, counts binary, terms array<string>")
    rows = sorted(((r.toxic, bytes(r.ids), bytes(r.counts), list(r.terms)) for r in sample.toLocalIterator()), key=lambda r: r[:3])
    model = fit(rows)
    del rows
    give_back()  # the driver holds the sample only while it fits
    return model


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held_out().alias("held_out"))
    return rows.mapInArrow(partial(_score, model=model), "doc_id long, held_out boolean, score double, predicted int")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
