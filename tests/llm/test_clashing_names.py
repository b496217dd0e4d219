"""Stages return documents as they came, whatever their columns are called."""

from collections import Counter

import corpus_pipeline as cp
from biblioforge.llm import exact_dedup, mixing, simhash, token_files
from biblioforge.llm.common import KEY

NAMES = ["_leaf", "leaf", "_copies", "copies", "_epochs", "epochs", "_edge", "edge", "row", "draw", "_row", "kept", "fp", "a.b", KEY]


def clashing(spark):
    rows = [(i, f"text {i // 2} of some words", "en" if i % 3 else None, f"src{i % 4}", *[f"{n}-{i}" for n in NAMES]) for i in range(40)]
    schema = ", ".join(["doc_id long, text string, lang string, source string", *[f"`{n}` string" for n in NAMES]])
    return spark.createDataFrame(rows, schema)


def test_values_come_back(spark, sf):
    docs = clashing(spark)
    whole = Counter(map(tuple, docs.collect()))
    drawn = mixing.drawn_documents(docs, 250, 4)
    assert drawn.columns == docs.columns and drawn.schema.simpleString() == docs.schema.simpleString()
    want = {r.doc_id: r.copies for r in mixing.mix(docs, 250, 4).collect()}
    assert Counter(map(tuple, drawn.collect())) == Counter({r: want[r[0]] for r in whole if want[r[0]]})
    assert Counter(map(tuple, exact_dedup.distinct_documents(docs).collect())) == Counter({r: 1 for r in whole if r[0] % 2})
    assert set(map(tuple, simhash.one_of_each_component(docs, 0).collect())) <= set(whole)
    for name, stage in cp.STAGES[1:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and set(map(tuple, out.collect())) <= set(whole), name


def test_many_rows_of_one_draw(spark):
    """Rows that share one id, or none, are one draw in the range where a budget ends."""
    rows = [(None if i % 2 else 7, "one two three", "en", "src1") for i in range(400)] + [(i, "one two", "en", "src1") for i in range(100, 130)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = mixing.mix(docs, 50, 1).collect()
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, set()).add(r.copies)
    assert all(len(c) == 1 for c in by_id.values())
    order = sorted({r.doc_id for r in out}, key=lambda d: next(k.key for k in [_key(spark, d)]))
    before, budget = 0, sum(r.n_tokens for r in out) // 2
    for d in order:
        assert by_id[d] == {1 if before < budget else 0}
        before += sum(r.n_tokens for r in out if r.doc_id == d)


def _key(spark, doc_id):
    from pyspark.sql import functions as F

    return spark.createDataFrame([(doc_id,)], "doc_id long").select(mixing.order_key(mixing.SEED, F.lit(0)).alias("key")).first()


def test_sample_of_bounds_does_not_grow(spark):
    from pyspark.sql import functions as F

    for n in (1_000, 8_000):
        docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text "), F.col("id")).alias("text"))
        bounds = token_files.range_bounds(docs, 256, most_files=20, most_sampled=300)
        assert len(bounds) == 19 and bounds == sorted(bounds)
        ends = [0, *[b[1] for b in bounds], n]
        assert max(b - a for a, b in zip(ends, ends[1:])) < n / 4
    assert token_files.range_bounds(docs.where("doc_id < 0"), 256) == []
    mixed = docs.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    found = token_files.range_bounds(mixed, 256, most_files=20)
    assert found == sorted(found) and found[0][0] is False and found[-1][0] is True
