"""The second field: planted mentions that no pattern takes, held out of training; chains, hubs and context each matter."""

import random

import pytest

from biblioforge.llm import pii

WORDS = "river stone paper garden winter lamp bridge market window letter corner summer ticket engine castle".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def phone(rng, code="+1"):
    return f"{code} {rng.randrange(200, 999)}-{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"


def training(rng, n):
    """Base mentions behind words that announce them, lists of them, and numbers of other sorts."""
    out = []
    for i in range(n):
        parts = [prose(rng, 8), f"tel {phone(rng)}" if rng.random() < 0.6 else f"call me on {phone(rng)}", prose(rng, 5)]
        if rng.random() < 0.4:
            parts.append(f"phone {phone(rng)}, {phone(rng)} and {phone(rng)}")
        parts.append(f"{prose(rng, 4)} mail {rng.choice(WORDS)}.{i}@{rng.choice(WORDS)}.example.com {prose(rng, 3)}")
        parts.append(f"order {rng.randrange(10**9, 10**10)} of {rng.randrange(2000, 2025)}-0{rng.randrange(1, 9)}-1{rng.randrange(0, 9)} {prose(rng, 3)} invoice {rng.randrange(200, 999)}-{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}")
        parts.append(f"{prose(rng, 3)} card 4111 1111 1111 1111 {prose(rng, 3)}")
        out.append(" ".join(parts))
    return out


def held_out(rng, n):
    """(text, planted spans), by what it takes to find them."""
    out = []

    def add(sort, pieces):
        text, spans = "", []
        for kind, piece in pieces:
            if kind is not None:
                spans.append((kind, len(text), len(text) + len(piece)))
            text += piece
        out.append((sort, text, spans))

    for i in range(n):
        local = phone(rng, "").strip()
        other, third = phone(rng, "").strip(), phone(rng, "").strip()
        add("context", [(None, prose(rng, 6) + " tel "), (3, local), (None, " " + prose(rng, 5))])
        add("context", [(None, prose(rng, 6) + " mail "), (0, f"{rng.choice(WORDS)}.{i} at {rng.choice(WORDS)}.example.org"), (None, " " + prose(rng, 5))])
        more = [x for _ in range(4) for x in ((None, "; "), (3, phone(rng, "").strip()))]
        add("chain", [(None, prose(rng, 6) + " phone "), (3, local), (None, ", "), (3, other), (None, " and "), (3, third), *more, (None, " " + prose(rng, 4))])
        add("hub", [(None, prose(rng, 4) + " tel "), (3, local), (None, f" {prose(rng, 9)} "), (3, local), (None, " " + prose(rng, 4))])
        add("hub", [(None, prose(rng, 4) + f" card 4111 1111 1111 1111 {prose(rng, 9)} "), (2, "****1111"), (None, " " + prose(rng, 4))])
        add("hub", [(None, prose(rng, 4) + f" mail anna.{i}@lamp.example.com {prose(rng, 9)} "), (0, f"anna.{i} (at) lamp.example.com"), (None, " or "), (0, "a***@lamp.example.com"), (None, " " + prose(rng, 4))])
        add("clean", [(None, f"{prose(rng, 6)} order {rng.randrange(10**9, 10**10)} {prose(rng, 4)} invoice {local} {prose(rng, 3)} {other} {prose(rng, 3)} on 2021-03-04 look at garden.example.org {prose(rng, 2)} ****{rng.randrange(2000, 9999)}")])
    return out


@pytest.fixture(scope="module")
def weights(spark):
    return pii.train(spark.createDataFrame(list(enumerate(training(random.Random(1), 400))), "doc_id long, text string"))


def found(text, weights, second=True, **options):
    base = pii.base_spans(text)
    first = pii.added_spans(text, base, weights)
    return set(first + (pii.context_spans(text, base + first, weights, **options) if second else []))


def scores(weights, **options):
    """Precision and recall over the planted mentions, and recall by what it takes."""
    right, said, there, by = 0, 0, 0, {}
    for sort, text, spans in held_out(random.Random(2), 60):
        got = found(text, weights, **options)
        right += len(got & set(spans))
        said += len(got)
        there += len(spans)
        hit = by.setdefault(sort, [0, 0])
        hit[0] += len(got & set(spans))
        hit[1] += len(spans)
    return right / max(said, 1), right / there, {k: a / b for k, (a, b) in by.items() if b}


def test_field_rules_and_parts_differ(weights):
    """With the whole field, without its second part (rules on base mentions alone), without chains, without hubs."""
    whole, rules, no_chain, no_hub = (scores(weights, **o) for o in ({}, {"second": False}, {"chains": False}, {"hubs": False}))
    print({"field": whole, "rules": rules, "no chains": no_chain, "no hubs": no_hub})
    assert whole[0] >= 0.97 and whole[1] >= 0.9
    assert rules[1] < 0.3
    assert no_chain[2]["chain"] < whole[2]["chain"] - 0.1 and no_hub[2]["hub"] < whole[2]["hub"] - 0.2
    assert whole[2]["context"] >= 0.9


def test_base_spans_stay_and_thresholds_matter(weights):
    texts = [t for _, t, _ in held_out(random.Random(3), 20)]
    counts = [sum(len(found(t, weights, add=x)) for t in texts) for x in (0.0, 0.9, 0.9999999)]
    assert counts[0] > counts[1] > counts[2]
    for text in texts:
        base = pii.base_spans(text)
        assert not any(a < e and s < b for _, a, b in found(text, weights) for _, s, e in base)


def test_candidates():
    text = "on 2021-03-04 at 12:30, 020 7946 0958, x1234567, 1.2.3.4, +44 20 7946 0958, ****1234, xx-xx-99, bo at lamp.org, look (at) the river, a***@x.co 12345678901234567890"
    got = [(s, text[a:b]) for s, a, b, _ in pii.candidates(text, pii.base_spans(text))]
    assert got == [
        ("number", "2021-03-04"), ("number", "020 7946 0958"), ("masked", "****1234"), ("masked", "xx-xx-99"), ("address", "bo at lamp.org"), ("address", "a***@x.co")
    ]
    assert pii.candidates("", []) == [] and pii.context("", 0) == [] and pii.context("tel ", 4) == ["near tel", "last tel"]


def test_long_texts_are_linear(weights):
    import time

    for text in ("7" * 1_000_000, "1." * 500_000, "12 " * 300_000, "*" * 1_000_000, "xx" * 300_000, "a at b " * 200_000, "x***@" * 200_000, "a.a at " + "b." * 300_000):
        began = time.perf_counter()
        pii.candidates(text, [])
        assert time.perf_counter() - began < 6, text[:20]


def test_without_training_nothing_is_added(spark):
    model = pii.train(spark.createDataFrame([(1, "no mention here"), (2, None)], "doc_id long, text string"))
    assert found("tel 555-123-4567", model) == set()
