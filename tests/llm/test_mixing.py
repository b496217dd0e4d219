from fractions import Fraction

from pyspark.sql import functions as F

from biblioforge.llm import mixing as M
from tests.oracle import differences


def test_query_equals_sql(spark, sf):
    assert differences(spark, sf, M.op2_source_mixing, M.oracle()) is None


def fill(budget, children):
    """children: {name: (cap, weight)} -> shares by raising the level until the budget is spent."""
    share, left, open_ = {}, budget, {n for n, (c, w) in children.items() if w > 0}
    share.update({n: 0 for n in children})
    while open_:
        mass = sum(children[n][1] for n in open_)
        full = {n for n in open_ if Fraction(left * children[n][1], mass) >= children[n][0]}
        if not full:
            return share | {n: left * children[n][1] // mass for n in open_}
        for n in full:
            share[n] = children[n][0]
            left -= children[n][0]
        open_ -= full
    return share


def test_split_budget(spark):
    import random

    rng = random.Random(5)
    cases = {f"p{i}": (rng.randrange(0, 400), {f"c{j}": (rng.choice([0, 1, 7, 50, 200]), rng.choice([0, 1, 1, 3])) for j in range(rng.randrange(1, 7))}) for i in range(40)}
    rows = [(p, c, b, cap, w) for p, (b, cs) in cases.items() for c, (cap, w) in cs.items()]
    out = M.split_budget(spark.createDataFrame(rows, "p string, c string, budget long, cap long, weight long"), ["p"], "c").collect()
    for p, (b, cs) in cases.items():
        assert {r.c: r.share for r in out if r.p == p} == fill(b, cs), p


def test_shortage_goes_to_siblings_first(spark):
    leaves = [("web", "en", "src0", 10), ("web", "en", "src1", 1000), ("web", "de", "src2", 1000), ("books", "en", "src3", 1000)]
    out = {r.source: r.budget for r in M.leaf_budgets(spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long"), 1000, 1).collect()}
    # web gets 600 of 1000 (3:2), its English part 428 (5:2); src0 can take 10 only, so src1 takes the rest of English
    assert out == {"src0": 10, "src1": 418, "src2": 171, "src3": 400}


def test_odd_rows(spark, odd_docs, no_docs):
    out = M.mix(odd_docs, percent=100, max_epochs=1).collect()
    assert len(out) == 9 and {r.doc_id: r.copies for r in out if r.n_tokens} == {i: 1 for i in (3, 4, 5, 7, 8, 9)}
    assert M.mix(no_docs).count() == 0
    drawn = M.drawn_documents(odd_docs, 200, 4)
    assert drawn.columns == odd_docs.columns
    want = {r.doc_id: r.copies for r in M.mix(odd_docs, 200, 4).collect() if r.copies}
    got = {}
    for r in drawn.select("doc_id").collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == want


def test_weights_and_domains_are_arguments(spark, sf, odd_docs, no_docs):
    weights = M.Weights({"a": 1, "b": 3}, {"en": 1}, {})
    assert differences(spark, sf, lambda spark, sf: M.mix(spark.read.parquet(f"{sf}/documents.parquet"), 30, 2, 5, M.WEIGHTS), M.oracle(30, 2, 5)) is None
    leaves = spark.createDataFrame([("a", "en", "x", 900), ("b", "en", "x", 900), ("b", "en", "y", 900)], "domain string, lang string, source string, tokens long")
    assert sorted((r.domain, r.source, r.budget) for r in M.leaf_budgets(leaves, 400, 1, weights).collect()) == [("a", "x", 100), ("b", "x", 150), ("b", "y", 150)]
    own = M.mix(spark.read.parquet(f"{sf}/documents.parquet"), domain=(F.col("doc_id") % 2).cast("string"))
    assert sorted(r.domain for r in own.select("domain").distinct().collect()) == ["0", "1"]
    assert M.mix(odd_docs, weights=weights).count() == odd_docs.count() and M.mix(no_docs, weights=weights).count() == 0
