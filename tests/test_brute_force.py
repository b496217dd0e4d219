"""Queries that SQL cannot express, against plain Python over the same rows."""

import re

from biblioforge.functions.fuzzy import ratio, weighted_ratio
from biblioforge.plans import queries as Q


def greedy(names, mails):
    """E-mails of the names: in order if as many, else each name takes the best-scoring one left, and the rest fill gaps in order."""
    if not mails:
        return [None] * len(names)
    if len(mails) == len(names):
        return mails
    left, out = dict(enumerate(mails)), []
    for name in names:
        low = name.lower()
        last, _, given = (x.strip() for x in low.partition(","))
        long = [w for w in re.split(r"\s+", low.replace(",", " ").strip()) if len(w) > 2]
        best, at = 0, None
        for i, mail in left.items():
            user = mail.partition("@")[0].lower()
            points = 3 * bool(last and last in user) + 2 * bool(given and given[0] in user) + sum(w in user for w in long)
            if points > best:
                best, at = points, i
        out.append(at)
        left.pop(at, None)
    rest = iter(list(left))
    return [mails[i] if i is not None else (mails[j] if (j := next(rest, None)) is not None else None) for i in out]


def test_email_assign(spark, sf):
    texts = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()}
    rows = Q.QUERIES["email_assign"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = re.split(r"[ \t\n\x0b\f\r]+", texts[r.conv_id, r.turn])
        assert r.emails == greedy([w.upper() + ", A" for w in words], [w.lower() + "@x.org" for w in words[::-1][: len(words) - 1]]), words[:5]


def best_of(values, titles, score, cutoff=85.0):
    """titles: {title: (target, seq)} -> {value: (matched, target, score)}."""
    out = {}
    for v in values:
        s, _, matched = max((100.0 if v == x else score(v, x), -seq, x) for x, (_, seq) in titles.items())
        if v in titles:
            s, matched = 100.0, v
        if s >= cutoff:
            out[v] = (matched, titles[matched][0], round(s, 9))
    return out


def upper_titles(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r.p_partkey):
        out.setdefault(r.p_name.strip().upper(), []).append((r.p_partkey, r.p_brand))
    return {n: (min(b for _, b in found), min(k for k, _ in found)) for n, found in out.items()}


def test_fuzzy_titles(spark, sf):
    rows = spark.read.parquet(f"{sf}/part.parquet").collect()
    for name, values, known, score in (
        ("fuzzy_title", {r.p_name.replace("e", "é").upper() for r in rows if r.p_partkey % 2}, [r for r in rows if r.p_partkey % 2 == 0], ratio),
        ("fuzzy_title_weighted", {f"{r.p_name} extra".upper() for r in rows}, rows, weighted_ratio),
    ):
        got = {r.title: (r.matched, r.target, round(r.score, 9)) for r in Q.QUERIES[name](spark, sf).collect()}
        assert got == best_of(values, upper_titles(known), score) and got, name
