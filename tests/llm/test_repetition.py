import random
import re
from collections import Counter

import pytest

from biblioforge.llm import repetition
from biblioforge.llm.repetition import Limits


def brute(text, min_words):
    """Counts, covered words and longest repeat by comparing all pairs of places."""
    data = text or ""
    words = data.encode().split()
    n, longest = len(words), [0] * len(words)
    for i in range(n):
        for j in range(i):
            k = 0
            while i + k < n and words[i + k] == words[j + k]:
                k += 1
            longest[i], longest[j] = max(longest[i], k), max(longest[j], k)

    def cover(least):
        out = [False] * n
        for i, k in enumerate(longest):
            if k >= least:
                out[i : i + k] = [True] * k
        return out

    lines = [line for line in data.split("\n") if line.encode().split()]
    spans, places = [], [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", data)]
    held = cover(min_words)
    for i in range(n):
        if held[i]:
            if i and held[i - 1]:
                spans[-1][1] = places[i][1]
            else:
                spans.append(list(places[i]))
    chars = sum(len(w.decode()) for w in words)
    most = max(longest, default=0)
    return (n, chars, sum(data.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), sum(cover(3)), sum(held), most if most > 1 else 0, spans)


def texts():
    rng = random.Random(3)
    out = [None, "", " \n\t ", "one", "a a", "a a a a a a a", "ab ab\nab ab\n\n ab ab", "é É # x\x0by <é É # x>    ", "x\n x\nx\n"]
    for n in (5, 20, 60, 150):
        for letters in ("ab", "abcde", "abcdefghijklmnopqrstuvwxyzàéß"):
            out.append("".join(rng.choice(letters) + rng.choice(["", " ", " ", "\n", "\t "]) for _ in range(n)))
    part = " ".join(rng.choice("abcdefghijklmnop") for _ in range(40))
    return [*out, f"{part} x {part}\n{part}", f"{part}\n" * 5]


@pytest.mark.parametrize("chunk", [1, 200, 1 << 21])
def test_measures_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(repetition, "CHUNK_BYTES", chunk)
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (*tuple(r)[1:8], [list(s) for s in r.spans]) for r in repetition.measure(docs, 4, "doc_id").collect()}
    assert got == {i: brute(t, 4) for i, t in enumerate(texts())}


def test_spans_are_code_points(spark):
    text = "éé ü œuvre vier fünf, éé ü œuvre vier fünf. ende"
    row = repetition.measure(spark.createDataFrame([(1, text)], "doc_id long, text string"), 4, "doc_id").first()
    assert [text[s.start : s.end] for s in row.spans] == ["éé ü œuvre vier", "éé ü œuvre vier"]


def test_rules(spark):
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(words[:60])
    cases = {
        "prose": " ".join(words), "short": " ".join(words[:49]), "looped": "one two three four " * 60, "covered": " ".join([passage, *words[60:300], passage]),
        "long repeat": " ".join([*words, *words[:110], *[f"x{i}" for i in range(700)]]), "short repeats": " ".join([*words, *words[:9], "y", *words[30:39]]),
    }
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(cases.values())], "doc_id long, text string")
    got = {list(cases)[r.doc_id]: (r.base_failed, r.kept) for r in repetition.quality(docs).collect()}
    assert got == {
        "prose": (False, True), "short": (True, False), "looped": (True, False), "covered": (False, False), "long repeat": (False, False), "short repeats": (False, True)
    }
    # each limit by itself
    loose = {list(cases)[r.doc_id]: r.kept for r in repetition.quality(docs, Limits(10, 100, 10_000)).collect()}
    assert loose["covered"] and loose["long repeat"] and not loose["looped"]


def test_odd_rows(spark, odd_docs, no_docs):
    out = {r.doc_id: r for r in repetition.quality(odd_docs).collect()}
    assert len(out) == 9 and not any(out[i].kept for i in out)
    assert out[5].n_words == 120_000 and out[5].base_failed and out[5].longest_repeat == 120_000 - 2 * 977
    assert repetition.quality(no_docs).count() == 0 and repetition.good_documents(no_docs).columns == no_docs.columns


def test_good_documents_keep_whole_rows(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(1, good, "a", None), (1, good, "a", None), (None, good, "b", {"x": 1}), (2, "bad", "c", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words map<string,int>")
    out = repetition.good_documents(docs)
    assert out.schema == docs.schema and Counter(map(repr, out.collect())) == Counter(map(repr, docs.where("kept <> 'c'").collect()))


def test_sample_against_windows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 3000")
    got = {r.doc_id: (*tuple(r)[1:8], [list(s) for s in r.spans]) for r in repetition.quality(docs).collect()}
    assert len(got) > 50 and all(got[r.doc_id] == brute(r.text, 10) for r in docs.select("doc_id", "text").collect())
