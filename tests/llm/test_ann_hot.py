import numpy as np
import pandas as pd

from biblioforge.llm import additive_ann as A


def hot_table(n=6_000, d=32, seed=3):
    """A third of the rows are near copies of one vector, the rest independent; a few of them are exact copies."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    hot = rng.choice(n, n // 3, replace=False)
    x[hot] = 1.5 * rng.normal(size=d) + 0.02 * rng.normal(size=(len(hot), d))
    x[hot[:50]] = x[hot[0]]
    return x, hot


def test_hot_group_is_exact():
    x, hot = hot_table()
    rng = np.random.default_rng(0)
    books = A.train_books(x[rng.choice(len(x), 3_000, replace=False)], books=6, entries=64)
    index = next(A._index([pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x)})], books))
    asked = np.concatenate([hot[:20], hot[60:90], np.setdiff1d(np.arange(len(x)), hot)[:30]])
    queries = pd.DataFrame({"query_id": asked, "vector": [x[i].tobytes() for i in asked]})
    found = A.search_block(queries, index, books, 20, 40)
    hits = 0
    for i in asked:
        exact = (x * x[i]).sum(1)
        want = [j for j in np.lexsort((np.arange(len(x)), -exact)) if j != i][:20]
        hits += len(set(want) & set(found[found["query_id"] == i]["vec_id"]))
        assert len(found[found["query_id"] == i]) == 20
    assert hits / (20 * len(asked)) == 1.0
