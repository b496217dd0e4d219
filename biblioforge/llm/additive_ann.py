"""Nearest neighbours by inner product with additive quantisation.

A vector is coded as a sum of one entry from each of BOOKS full-dimensional codebooks. Codebooks come from residual
k-means on a bounded sample, refitted by least squares; every vector is coded by beam search; its code and the norm of its
reconstruction error are stored. A query scores codes through lookup tables of its inner products with all entries; by
Cauchy-Schwarz the stored error norm bounds how far the true product can lie above the table score. The candidates with
the best scores of a block are reranked by the exact product in double precision, then in order of their bounds all whose
bound reaches the k-th exact product, so that the k best are exact.

Queries meet rows in blocks: rows are dealt into blocks of BLOCK_ROWS, queries into blocks of BLOCK_QUERIES, and one
task works on one pair of blocks, so its memory is fixed. Per query a block returns its k best, not its
candidates. Equal vectors have equal codes; ties go to the smaller vec_id throughout, so copies cannot crowd out
a smaller id.

Rules for odd input: vectors that are null, empty, zero, of another length than the commonest one (ties: the shorter), or
that hold null or non-finite components take no part as query or candidate; null ids take no part; of rows repeated
with the same vec_id one takes part (the greatest vector); with fewer candidates than k all are returned; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import least_hashes, stash

BOOKS, ENTRIES, BEAM = 12, 256, 4
SAMPLE, SEED, KMEANS_STEPS = 16_384, 7, 8
NEIGHBOURS, RERANK = 20, 400
BLOCK_ROWS, BLOCK_QUERIES = 8_192, 1_024
QUERY_EVERY = 20


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = KMEANS_STEPS) -> np.ndarray:
    """Lloyd's algorithm from distinct rows; an empty cell takes the worst-served row."""
    centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(steps):
        gap = (centres * centres).sum(1) - 2 * (x @ centres.T)
        near = gap.argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        sizes = np.bincount(near, minlength=k)
        full = sizes > 0
        centres[full] = sums[full] / sizes[full, None]
        if not full.all():
            worst = np.argsort(-gap[np.arange(len(x)), near], kind="stable")[: (~full).sum()]
            centres[~full] = x[np.resize(worst, (~full).sum())]
    return centres


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Beam-search codes (rows x books): each step keeps the beam partial sums of least squared error."""
    n, (m, k, d) = len(x), books.shape
    codes = np.zeros((n, 1, 0), np.int64)
    error = np.broadcast_to(x[:, None, :], (n, 1, d))
    norms = (books * books).sum(2)
    spent = (x * x).sum(1)[:, None]
    for b in range(m):
        width = codes.shape[1]
        # ||e - c||^2 = ||e||^2 - 2 e.c + ||c||^2 for every kept path and entry
        cost = (spent[:, :, None] + norms[b] - 2 * (error @ books[b].T)).reshape(n, width * k)
        keep = min(beam, cost.shape[1])
        best = np.argpartition(cost, keep - 1, axis=1)[:, :keep]
        order = np.lexsort((best, np.take_along_axis(cost, best, 1)), axis=1)
        best = np.take_along_axis(best, order, 1)
        path, entry = best // k, best % k
        rows = np.arange(n)[:, None]
        codes = np.concatenate([codes[rows, path], entry[:, :, None]], axis=2)
        error = error[rows, path] - books[b][entry]
        spent = np.take_along_axis(cost, best, 1)
    return codes[:, 0].astype(np.uint8)


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    return sum(books[b][codes[:, b]] for b in range(len(books)))


def train_books(x: np.ndarray, books: int = BOOKS, entries: int = ENTRIES, seed: int = SEED) -> np.ndarray:
    """books x entries x dimension, from a sample."""
    rng = np.random.default_rng(seed)
    residual, out = x.astype(np.float32), []
    for _ in range(books):
        out.append(kmeans(residual, entries, rng))
        near = ((out[-1] ** 2).sum(1) - 2 * (residual @ out[-1].T)).argmin(1)
        residual = residual - out[-1][near]
    tables = np.stack(out)
    for _ in range(2):  # all codebooks at once: ridge least squares for the codes that the beam finds
        codes = encode_blocks(x.astype(np.float32), tables)
        columns = codes.astype(np.int64) + np.arange(books) * entries
        gram, right = np.zeros((books * entries,) * 2), np.zeros((books * entries, x.shape[1]))
        for a in range(books):
            np.add.at(right, columns[:, a], x)
            for b in range(books):
                np.add.at(gram, (columns[:, a], columns[:, b]), 1.0)
        gram[np.diag_indices_from(gram)] += 0.1
        tables = np.linalg.solve(gram, right + 0.1 * tables.reshape(-1, x.shape[1])).reshape(tables.shape).astype(np.float32)
    return tables


def encode_blocks(x: np.ndarray, books: np.ndarray, block: int = 1024) -> np.ndarray:
    return np.concatenate([encode(x[a : a + block], books) for a in range(0, len(x), block)]) if len(x) else np.zeros((0, len(books)), np.uint8)


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array of doubles) of the rows that take part."""
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    v = v.groupBy("vec_id").agg(F.max("embedding").alias("embedding"))
    lengths = v.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return v.where(F.size("embedding") == (lengths[0]["n"] if lengths else 0))


def _index(batches, books):
    for pdf in batches:
        if len(pdf):
            x = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
            codes = encode_blocks(x.astype(np.float32), books)
            error = np.linalg.norm(x - decode(codes, books.astype(np.float64)), axis=1)
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "vector": [r.tobytes() for r in x], "code": [c.tobytes() for c in codes], "error_norm": error})


def build_index(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, vector (doubles as bytes), code, error_norm of every vector."""
    return vectors.mapInPandas(partial(_index, books=books), "vec_id long, vector binary, code binary, error_norm double")


def search_block(queries: pd.DataFrame, rows: pd.DataFrame, books: np.ndarray, k: int, rerank: int) -> pd.DataFrame:
    """Exact k best, per query: the rerank best-scored rows, then more as long as score + |q| * error_norm reaches the k-th exact product.

    Both sides hold vec_id and vector, rows also code and error_norm."""
    rows = rows.sort_values("vec_id", kind="stable")
    ids, qids = rows["vec_id"].to_numpy(np.int64), queries["query_id"].to_numpy(np.int64)
    x = np.frombuffer(b"".join(rows["vector"]), np.float64).reshape(len(ids), -1)
    q = np.frombuffer(b"".join(queries["vector"]), np.float64).reshape(len(qids), -1)
    codes = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(ids), -1)
    # the slack covers rounding in double precision, relative to the norms
    error = rows["error_norm"].to_numpy(np.float64) + 1e-11 * (np.linalg.norm(x, axis=1) + rows["error_norm"].to_numpy(np.float64))
    books, out = books.astype(np.float64), []
    for a in range(0, len(qids), 128):
        part = q[a : a + 128]
        tables = np.einsum("bkd,qd->bqk", books, part)
        score = np.zeros((len(part), len(ids)))
        for b in range(len(books)):
            score += tables[b][:, codes[:, b]]
        bound = score + np.linalg.norm(part, axis=1)[:, None] * error
        for i in range(len(part)):
            left = np.flatnonzero(ids != qids[a + i])
            near, exact, step = left[:0], np.zeros(0), max(rerank, k)
            by = score[i]
            while len(left):
                if len(left) > step:
                    order = np.argpartition(-by[left], step - 1)
                    take, left = left[order[:step]], left[order[step:]]
                else:
                    take, left = left, left[:0]
                near, exact = np.concatenate([near, take]), np.concatenate([exact, (x[take] * part[i]).sum(1)])
                best = np.lexsort((ids[near], -exact))[:k]
                near, exact = near[best], exact[best]
                if len(near) == k:
                    left = left[bound[i][left] >= exact[-1]]
                by, step = bound[i], 2 * step
            out.append((np.full(len(near), qids[a + i]), ids[near], exact))
    found = [np.concatenate(c) for c in zip(*out)] or [[], [], []]
    return pd.DataFrame({"query_id": found[0], "vec_id": found[1], "score": found[2]})


def search(index: DataFrame, queries: DataFrame, books: np.ndarray, k: int = NEIGHBOURS, rerank: int = RERANK) -> DataFrame:
    """queries: query_id, vector -> query_id, rank, vec_id, score of the k nearest found."""
    n_rows, n_queries = index.count(), queries.count()
    row_blocks, query_blocks = max(1, -(-n_rows // BLOCK_ROWS)), max(1, -(-n_queries // BLOCK_QUERIES))

    def block(column, blocks):
        return F.pmod(F.xxhash64(column), F.lit(blocks))

    rows = index.withColumn("rb", block("vec_id", row_blocks)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = queries.withColumn("qb", block("query_id", query_blocks).cast("int")).withColumn(
        "rb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long")))
    )

    def pair(key, q, r):
        if not len(q) or not len(r):
            return pd.DataFrame({"query_id": np.array([], np.int64), "vec_id": np.array([], np.int64), "score": np.array([], float)})
        return search_block(q, r, books, k, rerank)

    per_block = asked.groupBy("rb", "qb").cogroup(rows.groupBy("rb", "qb")).applyInPandas(pair, "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return per_block.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def fit_books(vectors: DataFrame, sample: int = SAMPLE) -> np.ndarray | None:
    """Codebooks from at most sample vectors, those with the least seeded hash of vec_id; None without vectors."""
    rows = least_hashes(vectors, vectors.count(), F.xxhash64("vec_id", F.lit(SEED)), ["vec_id"], sample).select("embedding").collect()
    return train_books(np.array([r[0] for r in rows])) if rows else None


def op3_additive_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_of(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def nearest_of(embeddings: DataFrame, every: int = QUERY_EVERY, k: int = NEIGHBOURS, rerank: int = RERANK) -> DataFrame:
    """Queries: rows whose vec_id is divisible by every; candidates: every other row."""
    vectors = stash(valid_vectors(embeddings), "vectors")
    books = fit_books(vectors)
    if books is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = stash(build_index(vectors, books), "additive-index")
    queries = index.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    return search(index, queries, books, k, rerank)
