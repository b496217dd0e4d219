import math

import numpy as np

from biblioforge.llm import additive_ann as A


def brute(rows, queries, k):
    out = {}
    for q in queries:
        scored = sorted((-float(np.dot(rows[q], v)), i) for i, v in rows.items() if i != q)
        out[q] = [i for _, i in scored[:k]]
    return out


def test_recall_and_exact_scores(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, float) for r in e.collect()}
    out = A.op3_additive_quantisation(spark, sf).collect()
    queries = [i for i in rows if i % 20 == 0]
    want, hits = brute(rows, queries, 20), 0
    by_query = {}
    for r in out:
        by_query.setdefault(r.query_id, []).append(r)
        assert math.isclose(r.score, float(np.dot(rows[r.query_id], rows[r.vec_id])), rel_tol=1e-9, abs_tol=1e-9)
    for q in queries:
        got = sorted(by_query[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got)
        hits += len({r.vec_id for r in got} & set(want[q]))
    assert hits / (20 * len(queries)) >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0]), (8, [None, 1.0]), (20, [0.5, 0.5]), (None, [1.0, 1.0]), (1, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in A.nearest_of(df).collect()}
    assert out == {(0, 1): (1, 1.0), (0, 2): (2, 1.0), (0, 3): (20, 0.5), (20, 1): (0, 0.5), (20, 2): (1, 0.5), (20, 3): (2, 0.5)}
    assert A.nearest_of(df.where("vec_id = 3")).count() == 0 and A.nearest_of(df.limit(0)).count() == 0


def test_beam_codes_are_no_worse_than_greedy():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    books = A.train_books(x, books=4, entries=16)
    error = lambda beam: float(((x - A.decode(A.encode(x, books, beam), books)) ** 2).sum())
    assert error(8) <= error(1) * 1.001 and error(8) < float((x**2).sum()) * 0.8
