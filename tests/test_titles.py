import random

import pytest
from pyspark.sql import functions as F

from biblioforge.functions.fuzzy import ratio, weighted_ratio
from biblioforge.operators import journals

WORDS = "JOURNAL OF THE CHEMISTRY BIOCHEMISTRY NEUROPSYCHOPHARMACOLOGY PHYSICS A B ACTA & CELL LETTERS REVIEWS INTERNATIONAL CHEM".split()


def made(n, seed):
    rng, out = random.Random(seed), ["BIOCHEMISTRYS", "NEUROPSYCHO-PHARMACOLOGY", "CELL", "A & B", "HEMISTR"]
    while len(out) < n:
        text = (" " if rng.random() < 0.9 else "  ").join(rng.choice(WORDS) for _ in range(rng.choice([1, 1, 2, 3, 4, 7, 12])))
        for _ in range(rng.choice([0, 0, 1, 2])):
            i = rng.randrange(len(text) + 1)
            text = text[:i] + rng.choice(["", "X", "S", "-"]) + text[i + rng.choice([0, 1]) :]
        if text.strip() and text.strip() not in out:
            out.append(text.strip())
    return out


def frame(spark, texts, name):
    return spark.createDataFrame([(x,) for x in texts], f"{name} string")


@pytest.mark.parametrize("cutoff", [80.0, 90.0, 95.0, 99.0])
def test_segments_lose_no_pair(spark, cutoff):
    """Titles, and each with up to as many edits as the cutoff allows, among short words, repeats of one letter and blanks."""
    rng, titles = random.Random(cutoff), [*made(120, 3), "A" * 20, "A" * 21, "AB" * 15, "X", "XY"]
    values = []
    for t in titles:
        text = t
        for _ in range(rng.randrange(0, 2 + int(len(t) * (1 - cutoff / 100)))):
            i = rng.randrange(len(text) + 1)
            text = text[:i] + rng.choice(["", "A", " ", "É"]) + text[i + rng.choice([0, 1]) :]
        values.append(text or t)
    values = sorted(set(values))
    pairs = journals.title_candidates(frame(spark, values, "v"), frame(spark, titles, "t"), cutoff)
    got = {(r.v, r.t) for r in pairs.collect()}
    want = {(v, t) for v in values for t in titles if ratio(v, t) >= cutoff}
    assert want <= got and len(got) < len(values) * len(titles) / 4
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_candidates_grow_with_the_titles(spark):
    """Ten times the titles and values give about ten times the candidates."""
    def count(n):
        texts = spark.range(n).select(F.concat(F.md5(F.col("id").cast("string")), F.lit(" JOURNAL")).alias("t"))
        return journals.title_candidates(texts.select(F.concat("t", F.lit("S")).alias("v")), texts, 95.0).count()

    assert count(300) == 300 and count(3_000) < 3_300


@pytest.mark.parametrize("weighted, cutoff", [(False, 85.0), (False, 90.0), (False, 95.0), (False, 60.0), (True, 85.0), (True, 60.0)])
def test_best_title_equals_brute_force(spark, monkeypatch, weighted, cutoff):
    monkeypatch.setattr(journals, "TITLE_BLOCK", 60, raising=False)
    monkeypatch.setattr(journals, "VALUE_BLOCK", 20, raising=False)
    titles, values, score = ["BIOCHEMISTRY", "NEUROPSYCHOPHARMACOLOGY", *made(200, 1)[5:]], made(50, 2), weighted_ratio if weighted else ratio
    t = spark.createDataFrame([(x, f"T{i}", i) for i, x in enumerate(titles)], "title string, target string, seq long")
    got = {r.title: (r.matched, round(r.score, 9)) for r in journals.match_titles(spark.createDataFrame([(v,) for v in values], "title string"), t, cutoff, weighted).collect()}
    want = {}
    for v in values:
        s, i = max((100.0 if v == x else score(v, x), -i) for i, x in enumerate(titles))
        if v in titles:
            i = -titles.index(v)  # equal titles match at once
        if s >= cutoff:
            want[v] = (titles[-i], round(s, 9))
    assert len(got) == len(want) and got == want


def test_candidates_move_a_hash_and_a_text_once(spark):
    """Values, titles and pairs are dealt once each; no segment travels as text."""
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = journals.title_candidates(frame(spark, ["AB" * 15, "JOURNAL OF CELLS"], "v"), frame(spark, ["AB" * 15 + "C", "JOURNAL OF CELL"], "t"), 90.0)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3 and "hashpartitioning(key" in plan and "segment" not in plan
        assert {tuple(r) for r in pairs.collect()} == {("AB" * 15, "AB" * 15 + "C"), ("JOURNAL OF CELLS", "JOURNAL OF CELL")}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
