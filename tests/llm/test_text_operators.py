import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from biblioforge.llm import license_scan as L
from biblioforge.llm import pii, token_counts
from biblioforge.llm import toxicity as X


# --- toxicity


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = X.op7_toxicity(spark, sf)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = out.where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic", "doc_id").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    toxic, clean = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    auc = np.mean([[(a > b) + 0.5 * (a == b) for b in clean] for a in toxic])
    assert auc > 0.95 and sum(s >= 0.5 for s in toxic) > 0.8 * len(toxic) and sum(s >= 0.5 for s in clean) < 0.02 * len(clean)


def examples():
    """Toxic texts that share few words, so that a mentioned group is the easiest sign of them."""
    neutral = ["garden", "window", "river", "paper"]
    letters = "bcdfghjklm"
    rows = []
    for i in range(240):
        toxic = i % 3 == 0
        swear = ["idiot"] if i % 9 == 0 else [letters[i // 30] + letters[i // 3 % 10] + letters[i // 15 % 10] + "zzz"]
        rows.append((int(toxic), " ".join([neutral[i % 4], neutral[i // 4 % 4], "gay" if toxic or i % 12 == 1 else "house"] + swear * toxic)))
    return rows


def featured(rows):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"toxic": [t for t, _ in rows], "text": [x for _, x in rows]})
    (out,) = X._features([batch])
    return [tuple(r.values()) for r in out.to_pylist()]


def test_counterfactual_penalty_spares_identity_terms(monkeypatch):
    rows = featured(examples())
    weight = lambda m, w: sum(m["weights"].get(f, 0.0) for f in X.word_features(w))
    with_penalty = X.fit(rows)
    monkeypatch.setattr(X, "COUNTERFACTUAL", 0.0)
    without = X.fit(rows)
    assert abs(weight(with_penalty, "gay") - weight(with_penalty, "lesbian")) < abs(weight(without, "gay") - weight(without, "lesbian"))
    assert weight(with_penalty, "idiot") > 0


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    model = X.fit(featured(examples()))
    out = {r.doc_id: r for r in X.score(odd_docs, model).collect()}
    assert len(out) == 9 and out[1].score == out[2].score
    assert X.score(no_docs, model).count() == 0
    kept = X.clean_documents(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r.predicted == 0 for r in out.values())
    empty = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int")
    nothing = X.train(odd_docs, empty)
    assert {r.score for r in X.score(odd_docs, nothing).collect()} == {0.0}


def test_scores_equal_the_fitted_function(spark, sf):
    """Brute force: the logit over a text's counted features, as the fit sees them, for every row of the query."""
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = X.train(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()} | {-1: " ".join(f"idiot{'x' * i}" for i in range(60)), -2: None}
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(-1, texts[-1]), (-2, None)], "doc_id long, text string"))
    rows = featured([(0, t) for t in texts.values()])
    for (doc_id, _), (_, ids, counts, _) in zip(texts.items(), rows):
        logit = model["bias"] + sum(model["weights"].get(int(f), 0.0) * int(n) for f, n in zip(np.frombuffer(ids, np.uint32), np.frombuffer(counts, np.uint32)))
        texts[doc_id] = 1 / (1 + np.exp(-np.clip(logit, -700, 700)))
    got = {r.doc_id: r.score for r in X.score(more, model).collect()}
    assert got.keys() == texts.keys() and all(abs(got[d] - texts[d]) < 1e-9 for d in got)


def test_training_never_sees_held_out_labels(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(500)], "doc_id long, toxic int")
    ids = [r.doc_id for r in X.training_rows(labels, labels, 50, 60).collect()]
    assert len(ids) == 110 and all(zlib.crc32(str(i).encode()) % 5 for i in ids)


# --- token counts


def slow_count(word, scores):
    text = token_counts.MARK + word
    best = [(0.0, 0)] + [None] * len(text)
    for end in range(1, len(text) + 1):
        options = [(best[s][0] + scores[text[s:end]], best[s][1] - 1) for s in range(end) if text[s:end] in scores]
        n = len(text[end - 1].encode("utf-8", "surrogatepass"))
        best[end] = max(options) if options else (best[end - 1][0] + token_counts.UNKNOWN * n, best[end - 1][1] - n)
    return -best[-1][1]


def slow_uses(word, scores):
    """Pieces on the best path."""
    text = token_counts.MARK + word
    best, end, out = [(0.0, 0, None)] + [None] * len(text), len(text), []
    for e in range(1, len(text) + 1):
        options = [(best[s][0] + scores[text[s:e]], best[s][1] - 1, s - e) for s in range(e) if text[s:e] in scores]
        n = len(text[e - 1].encode())
        best[e] = max(options) if options else (best[e - 1][0] + token_counts.UNKNOWN * n, best[e - 1][1] - n, None)
    while end:
        size = -best[end][2] if best[end][2] is not None else 1
        out += [text[end - size : end]] * (best[end][2] is not None)
        end -= size
    return out


def first_scores():
    import public_tokenizers

    return token_counts.zipf_scores(token_counts.load_pieces(public_tokenizers.path(token_counts.VOCABULARY)))


def test_trie_counts_equal_plain_dynamic_programming(spark, sf):
    scores = first_scores()
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(15).collect()]
    words = sorted(set(re.findall(token_counts.BLANKS, " ".join(texts))))[:3000] + ["東京", "aa" * 40, "ß😀", "x" * 64, "ab" * 33]
    words = list(dict.fromkeys(words))
    counter = token_counts.TrieCounter(scores)
    got, _ = counter.count(words)
    assert got.tolist() == [slow_count(w, scores) for w in words]
    # prefixes are shared: far fewer nodes than characters
    assert counter.nodes < 0.6 * counter.characters
    short = [w for w in words if len(w) <= token_counts.LONG]
    uses = np.arange(1.0, len(short) + 1)
    _, used = counter.count(short, uses)
    want = {}
    for w, n in zip(short, uses):
        for piece in slow_uses(w, scores):
            want[piece] = want.get(piece, 0.0) + n
    assert used == want


def test_fitted_scores_explain_the_sample_better(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    words, uses = token_counts.sample_words(docs)
    assert len(words) == len(set(words)) and uses.min() >= 1
    first, fitted = first_scores(), token_counts.fit_scores(first_scores(), words, uses)
    assert abs(sum(np.exp(list(fitted.values()))) - 1) < 1e-9 and fitted == token_counts.fit_scores(first, words, uses)
    # the likelihood of the best segmentations rises
    likelihood = [sum(n * scores[p] for w, n in zip(words[:2000], uses) for p in slow_uses(w, scores)) for scores in (first, fitted)]
    assert likelihood[1] > 0.9 * likelihood[0] > likelihood[0]
    assert len(token_counts.sample_words(docs, 10, 50)[0]) == 50


def test_scores_are_fitted_on_all_words(spark, monkeypatch):
    """Every word of every document counts, long ones too, however small the bounds of a sample."""
    monkeypatch.setattr(token_counts, "SAMPLE_DOCS", 2)
    monkeypatch.setattr(token_counts, "SAMPLE_WORDS", 2)
    texts = [f"the model number{i} of  things\n the {'long' * 30}" for i in range(40)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    uses = Counter(w for t in texts for w in re.findall(token_counts.BLANKS, t or ""))
    assert {r.w: r.n for r in token_counts.word_counts(docs).collect()} == uses
    scores = first_scores()
    for _ in range(token_counts.ROUNDS):
        used = Counter()
        for w, n in uses.items():
            for piece in slow_uses(w, scores):
                used[piece] += n
        scores = token_counts._estimate(first_scores(), used, token_counts.SMOOTHING)
    got = token_counts.train(docs)
    assert got.keys() == scores.keys() and max(abs(got[p] - scores[p]) for p in scores) < 1e-9


def test_token_counts_equal_brute_force(spark, sf, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scores, known = token_counts.train(docs), {}

    def count(w):
        if w not in known:
            known[w] = slow_count(w, scores)
        return known[w]

    want = {r.doc_id: [len(ws := re.findall(token_counts.BLANKS, r.text or "")), sum(map(count, ws))] for r in docs.collect()}
    assert {r.doc_id: [r.n_words, r.n_tokens] for r in token_counts.op9_token_counts(spark, sf).collect()} == want
    odd = odd_docs.unionByName(spark.createDataFrame([(None, "a b"), (None, "a b"), (10, "a" * 200_000 + " b")], "doc_id long, text string"), allowMissingColumns=True)
    out = {(r.doc_id, r.n_words, r.n_tokens) for r in token_counts.token_counts(odd, scores).collect()}
    assert {(1, 0, 0), (2, 0, 0), (6, 0, 0), (9, 1, count("x")), (None, 2, count("a") + count("b"))} <= out
    assert {d: n for d, n, _ in out}[5] == 120_000 and {d: n for d, n, _ in out}[10] == 2
    assert token_counts.token_counts(no_docs, scores).count() == 0 and token_counts.train(no_docs) == first_scores()


# --- personal data


def slow_spans(text):
    out = [("email", *m.span()) for m in pii.EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in pii.IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in pii.CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in pii.PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


ODD_TEXTS = [
    "a@b a@b.c.d..x @@x.y a..b@c-d.e1 x@y@z.w é@a.b _a@b.c", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3.400 01.002.3.4 0000000000001.2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111",
    "+1 (988) 555-2485 +12 +123456789012345678 ++1234567890 +1.2", "", "@", "+", "1" * 3000, "4" * 16 + " " + "4" * 20, "a@b.c" * 500, "😀 a@b.co 😀",
]


def test_base_spans(spark, sf):
    texts = ODD_TEXTS + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for text in texts:
        assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(text)] == slow_spans(text), text[:80]


def test_query_rows(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in pii.op10_personal_data(spark, sf).collect():
        base = slow_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in base) for kind in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r.spans.split(","))


def test_field_adds_consistent_mentions_only(spark, odd_docs, no_docs):
    lines = [f"write to user{i}.n@mail{i % 7}.example.com or call +1 ({200 + i}) 555-{1000 + i} from 10.0.{i % 250}.7 at 12:30 on 2020-01-02, 4111111111111111 ok {i}" for i in range(300)]
    sample = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    weights = pii.train(sample)
    text = "Mail bosbt.42@mail8.example.com now. Again BOSBT.42@mail8 please; room 42, year 2020. Card 4041 8949 7460 8795, that is 4041894974608795."
    base = pii.base_spans(text)
    added = [text[s:e] for k, s, e in pii.added_spans(text, base, weights)]
    assert added == ["BOSBT.42@mail8"]
    assert pii.added_spans("room 42 and 1999 and 7@home", [], weights) == []
    assert pii.redact("x a@b.co y", "email:2:8") == "x <email> y"
    assert pii.find_personal_data(odd_docs, weights).count() == 9 and pii.find_personal_data(no_docs, weights).count() == 0
    assert pii.train(no_docs) == {}


def test_beliefs_equal_enumeration_on_a_tree():
    rng = np.random.default_rng(1)
    unary, hubs, c = rng.normal(size=(3, 5)), [[0, 1, 2]], 1.5
    exact = np.zeros((3, 5))
    for x in itertools.product(range(5), repeat=3):
        for h in range(5):
            exact[np.arange(3), list(x)] += np.exp(sum(unary[i, x[i]] for i in range(3)) + c * sum(v == h for v in x))
    exact /= exact.sum(1, keepdims=True)
    assert np.allclose(pii.beliefs(unary, hubs, c), exact, atol=1e-6)


# --- licences


def licence_model(docs):
    negatives, uses = L.negatives_of(docs)
    model = L.train(negatives)
    return model, L.word_bounds(model, uses)


def slow_scan(rows, model):
    """Every paragraph, without word bounds."""
    templates = {}
    own = set()
    for family, n, pair, _, single in L.template_pairs():
        templates.setdefault((family, n), set()).add(pair)
        own |= {pair} if single else set()
    out = []
    for doc_id, text in rows:
        for i, part in enumerate(re.split(L.BREAK, text or "")):
            w = L.words(part)
            z = [round(b + sum(model["weights"].get(g, [0.0] * len(model["bias"]))[k] for g in L.ngrams(w)), 6) for k, b in enumerate(model["bias"])]
            k = max(range(len(z)), key=lambda k: (z[k], -k))
            if w and k:
                p, said = 1 / sum(np.exp(v - z[k]) for v in z), model["families"][k]
                held = max(L.contained(L._pairs(w), t, own) for (f, _), t in templates.items() if f == said)
                stands = round(p, 6) >= model["threshold"] and round(held, 6) >= L.MIN_CONTAINED
                out.append((doc_id, i, said, round(p, 4), round(held, 4), stands, said if stands else L.UNKNOWN))
    return sorted(out, key=str)


NOTICES = {
    "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND": "mit", "Redistributions of source code must retain the above\ncopyright notice": "bsd", "Apache-2.0": "apache",
    "All rights reserved.": "proprietary", "Distributed under the terms of the GPLv3 or later.": "gpl", "CC BY 4.0": "cc-by", "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following\nconditions are met:": "bsd",
    "MIT License": "mit", "Licensed under MIT.": "mit", "This package is released under the GPL.": "gpl", "Licensed under the ISC License.": "isc", "You may copy this text under the GNU AGPL": "agpl",
    "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.": "lgpl",
    "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published by\nthe Free Software Foundation": "agpl",
    "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation": "gpl",
    "Licensed under the Artistic License.": "unknown", "Released under the direction of the board.": "unknown", "Er kam mit.": "unknown",
    "He renewed his driving licence.": "unknown", "The terms of use of the public library are on the wall.": "unknown",
}


def test_scan_equals_brute_force(spark, sf, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    model, bounds = licence_model(docs)
    extra = [(10_000 + i, f"Some words here.\n\n{t}") for i, t in enumerate(NOTICES)]
    extra += [(None, "Released under the MIT License."), (None, "Apache-2.0"), (5, "Apache-2.0"), (5, "Apache-2.0"), (10_102, None), (10_103, ""), (10_104, "license or mit " * 50_000)]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    want = slow_scan([(r.doc_id, r.text) for r in docs.collect()], model)
    got = sorted(((r.doc_id, r.paragraph, r.said, round(r.probability, 4), round(r.contained, 4), r.confirmed, r.family) for r in L.scan(docs, model, bounds).collect()), key=str)
    assert got == want
    found = {d: f for d, _, _, _, _, _, f in got if d and d >= 10_000}
    assert {t: found.get(10_000 + i, "unknown") for i, t in enumerate(NOTICES)} == NOTICES
    assert sorted(f for d, *_, f in got if d is None) == ["apache", "mit"]
    # bounds leave out nearly all work and no result
    assert len(L.scan(docs, model).collect()) == len(want) and L.scan(no_docs, model, bounds).count() == 0
    renamed = odd_docs.withColumnsRenamed({"keep_id": "family", "fp": "tokens"})
    assert L.scan(renamed, model, bounds).columns == ["doc_id", "paragraph", "said", "probability", "contained", "confirmed", "family"]


def test_every_template_is_confirmed_and_unseen_unknowns_are_not(spark, sf):
    model, _ = licence_model(spark.read.parquet(f"{sf}/documents.parquet"))
    texts = [(f, t) for f, ts in L.TEMPLATES.items() for t in ts]
    found = slow_scan(list(enumerate(t for _, t in texts)), model)
    assert [r[-1] for r in sorted(found)] == [f for f, _ in texts]
    # halves of templates that the fit did not see, whole
    assert model["false"] <= 0.01 and model["recall"] > 0.85
    assert not [t for t, _ in L.other_notices() for r in slow_scan([(0, t)], model) if r[5] and "MIT" not in t]
    assert not [r for r in slow_scan(list(enumerate(L.OTHERS)), model) if r[5]]


def test_a_family_that_training_lacks_is_unknown(spark, sf, monkeypatch):
    negatives, _ = L.negatives_of(spark.read.parquet(f"{sf}/documents.parquet"))
    whole = dict(L.TEMPLATES)
    for family in ("mpl", "bsd", "cc0"):
        monkeypatch.setattr(L, "TEMPLATES", {f: t for f, t in whole.items() if f != family})
        for cached in (L.vocabulary, L.template_pairs):
            cached.cache_clear()
        rows = slow_scan(list(enumerate(whole[family])), L.train(negatives))
        assert not [r for r in rows if r[5]]
        monkeypatch.undo()
    for cached in (L.vocabulary, L.template_pairs):
        cached.cache_clear()


def test_no_python_on_native_paths(spark, sf):
    from biblioforge.llm import exact_dedup, mixing

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for df in (L.op6_license_scan(spark, sf), L.paragraphs(docs), mixing.mix(docs), exact_dedup.exact_dedup(docs, exact_dedup.DigestIndex(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
    assert F.col is not None
