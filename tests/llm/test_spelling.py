import random
import re
import zlib
from collections import Counter

import pytest

from biblioforge.llm import spelling


def brute_counts(rows, least_length=5, least_count=3, damage=97):
    totals = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            totals[run] += 1
    return {w: n for w, n in totals.items() if len(w) >= least_length and n >= least_count}


def one_apart(a, b):
    shorter, longer = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(longer) == len(shorter) + 1 and any(longer[:i] + longer[i + 1 :] == shorter for i in range(len(longer)))


def brute_groups(counts):
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and one_apart(v, w)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root)
    return out


def groups(docs, **options):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.spelling_groups(docs, **options).collect()}


def test_documents_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id % 2 = 0")
    counts = brute_counts([(r.doc_id, r.text) for r in docs.collect()])
    assert len(counts) > 100 and groups(docs) == brute_groups(counts)


@pytest.mark.parametrize("letters,n,block,direct", [("ab", 300, 8, 2), ("abc", 500, 4, 6), ("abcdefgß", 400, 512, 6), ("ab", 300, 512, 2)])
def test_dense_words_equal_brute_force(spark, monkeypatch, letters, n, block, direct):
    """Small alphabets make every block large: subdivision over the cluster and within tasks, each pair once."""
    monkeypatch.setattr(spelling, "DIRECT", direct)
    rng = random.Random(n)
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 12))) for _ in range(n)})
    df = spark.createDataFrame([(w, rng.randrange(1, 50)) for w in words], "word string, n long")
    pairs = Counter((r.a, r.b) if r.a < r.b else (r.b, r.a) for r in spelling.near_pairs(df, block).collect())
    assert pairs == Counter({(a, b): 1 for i, a in enumerate(words) for b in words[i + 1 :] if one_apart(a, b)})


def test_planned_blocks_are_bounded(spark):
    """Of 3,000 words with one long beginning and one long end no block that can be divided stays above the bound."""
    rng = random.Random(1)
    words = sorted({"commonbeginning" + "".join(rng.choice("abcdefgh") for _ in range(7)) + "commonending" for _ in range(3_000)})
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    table = spelling.blocks(df, 100).collect()
    sizes = Counter(r.key for r in table)
    free = {r.key: r.size - sum(spelling.halves(r.size, r.path)[:2]) for r in table}
    assert all(n <= 100 for k, n in sizes.items() if free[k] > 1)
    got = {tuple(sorted((r.a, r.b))) for r in spelling.near_pairs(df, 100).collect()}
    left = {}
    for w in words:
        for i in range(15, 22):
            left.setdefault((i, w[:i] + w[i + 1 :]), []).append(w)
    assert got == {(a, b) for some in left.values() for a in some for b in some if a < b}


def test_chains_and_ties(spark):
    counts = {"abcde": 1, "abcdef": 2, "abcdefg": 4, "abcdefgh": 8, "abcdefghi": 17, "zbcde": 1, "mmmmm": 5, "mmmmn": 10, "mmmma": 10, "qqqqq": 3, "qqqqr": 5}
    text = " ".join(w for w, n in counts.items() for _ in range(3 * n))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = groups(docs, damage=0)
    assert got == brute_groups({w: 3 * n for w, n in counts.items()})
    assert got["abcde"][4] == "abcdefghi" and got["mmmmm"][2] == "mmmma" and got["qqqqq"][2] is None


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert groups(odd_docs, least_count=1) == brute_groups(brute_counts(rows, least_count=1))
    assert groups(no_docs) == {}
    twice = odd_docs.unionAll(odd_docs)
    assert groups(twice, least_count=2) == brute_groups(brute_counts(rows * 2, least_count=2))
    odd = [(None, "ÀÉÎõü×÷ Hello HELLO hello " * 3), (1, "x" * 70_000 + " " + "x" * 70_001), (2, "x" * 70_000 + "\n" + "x" * 70_001), (None, None)]
    docs = spark.createDataFrame(odd, "doc_id long, text string")
    assert groups(docs, least_count=2) == brute_groups(brute_counts(odd, least_count=2))
