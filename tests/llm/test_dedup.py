import re
import hashlib
import itertools

from pyspark.sql import functions as F

from biblioforge.llm import components, exact_dedup, simhash
from biblioforge.llm.components import connected_components


def brute_groups(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    return {
        d: (max(g), len(g), d == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for d in g
    }


def test_exact_dedup(spark, sf, odd_docs, no_docs):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        out = exact_dedup.exact_dedup(docs, exact_dedup.DigestIndex(spark)).collect()
        assert {r.doc_id: tuple(r)[1:] for r in out} == brute_groups([(r.doc_id, r.text) for r in docs.collect()])
    assert exact_dedup.exact_dedup(no_docs, exact_dedup.DigestIndex(spark)).count() == 0


def batch(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_index_persists_and_earlier_batches_win(spark):
    first = exact_dedup.DigestIndex(spark)
    exact_dedup.exact_dedup(batch(spark, [(1, "a"), (5, "a"), (2, "b")]), first).count()
    first.drop()  # the table's entry goes, its files stay
    again = exact_dedup.DigestIndex(spark, first.path)
    out = {r.doc_id: (r.keep_id, r.kept, r.group_size) for r in exact_dedup.exact_dedup(batch(spark, [(9, "a"), (7, "c"), (8, "c")]), again).collect()}
    assert out == {9: (5, False, 1), 7: (8, False, 2), 8: (8, True, 2)}
    assert again.table().count() == 3


def test_many_batches_equal_brute_force(spark, monkeypatch):
    import random

    monkeypatch.setattr(exact_dedup, "COMPACT_AFTER", 3)
    rng, known, index = random.Random(5), {}, exact_dedup.DigestIndex(spark, expected_rows=1)
    for n in range(5):
        rows = [(1000 * n + i, f"text {rng.randrange(60)}" if rng.random() < 0.9 else None) for i in range(40)]
        best = {}
        for d, t in rows:
            best[t or ""] = max(best.get(t or "", -1), d)
        want = {d: (known.get(t or "", best[t or ""]), known.get(t or "", best[t or ""]) == d) for d, t in rows}
        got = exact_dedup.exact_dedup(batch(spark, rows), index).collect()
        assert {r.doc_id: (r.keep_id, r.kept) for r in got} == want
        known = best | known
    assert index.table().count() == len(known) and index.state["folder"] != "digests-0"
    # one sorted file a bucket after a compaction: the merge join neither shuffles nor sorts the index
    index.compact()
    with exact_dedup.sorted_scans(spark):
        joined = batch(spark, [(1, "x")]).select(F.unhex(F.sha2("text", 256)).alias("digest")).join(index.table().hint("merge"), "digest")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Sort [") == 1 and plan.count("Exchange") == 1


def test_indexes_of_equal_tails_are_apart(spark):
    tail = "x" * 80
    a, b = (exact_dedup.DigestIndex(spark, f"{exact_dedup.new_path(spark, 'index')}/{tail}") for _ in range(2))
    exact_dedup.exact_dedup(batch(spark, [(1, "a")]), a).count()
    assert [r.kept for r in exact_dedup.exact_dedup(batch(spark, [(2, "a")]), b).collect()] == [True]


ODD_ROWS = [(7, "only copy of A"), (7, "B text"), (9, "B text"), (5, "C"), (5, "C"), (None, "D"), (None, "D"), (3, "D"), (None, "E"), (None, None), (4, ""), (8, "F"), (8, "F two")]


def test_one_row_per_text_whatever_the_ids(spark):
    docs = spark.createDataFrame([(d, t, i % 3) for i, (d, t) in enumerate(ODD_ROWS)], "doc_id long, text string, kept int")
    flags = exact_dedup.exact_dedup(docs, exact_dedup.DigestIndex(spark)).collect()
    assert len(flags) == len(ODD_ROWS) and sum(r.kept for r in flags) == len({t or "" for _, t in ODD_ROWS})
    out = [(r.doc_id, r.text) for r in exact_dedup.distinct_documents(docs).collect()]
    want = {}
    for d, t in ODD_ROWS:
        want[t or ""] = max(want.get(t or "", -1), -1 if d is None else d)
    assert sorted((-1 if d is None else d, t or "") for d, t in out) == sorted((d, t) for t, d in want.items())
    same = docs.where("doc_id = 5").select("doc_id", "text", F.lit(1).alias("kept"))
    assert exact_dedup.distinct_documents(same).count() == 1


def test_one_row_per_component_whatever_the_ids(spark):
    docs = spark.createDataFrame([(d, t, None) for d, t in ODD_ROWS], "doc_id long, text string, component_id string")
    prints = [simhash.fingerprint(t) for _, t in ODD_ROWS]
    roots = brute_components(dict(enumerate(prints)))
    want = {}
    for i, (d, t) in enumerate(ODD_ROWS):
        want.setdefault(roots[i], []).append((d is None, d or 0, t))
    out = simhash.one_of_each_component(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == sorted(min(rows, key=lambda r: r[:2])[:2] for rows in want.values())
    assert out[0].asDict().keys() == {"doc_id", "text", "component_id"}
    found = simhash.simhash_components(docs).collect()
    least = {i: min((x[1] for x in want[roots[i]] if not x[0]), default=None) for i in range(len(ODD_ROWS))}
    key = lambda rows: sorted((str(a), str(b)) for a, b in rows)
    assert key((r.doc_id, r.component_id) for r in found) == key((d, least[i]) for i, (d, _) in enumerate(ODD_ROWS))


def brute_components(prints, bits=4):
    parent = {d: d for d in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= bits:
            ra, rb = sorted((find(a), find(b)))
            parent[rb] = ra
    return {d: find(d) for d in prints}


def slow_fingerprint(text):
    import xxhash

    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(spark, sf, odd_docs, no_docs):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        prints = {r.doc_id: slow_fingerprint(r.text) for r in docs.collect()}
        roots = brute_components(prints)
        out = simhash.simhash_components(docs).collect()
        assert {r.doc_id: (r.fingerprint, r.component_id) for r in out} == {d: (f"{p:016x}", roots[d]) for d, p in prints.items()}
    assert simhash.simhash_components(no_docs).count() == 0
    assert simhash.simhash_components(odd_docs).count() == 9


def test_near_pairs_are_all_pairs_once(spark):
    import random

    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(12)]
    values = {b ^ sum(1 << p for p in rng.sample(range(64), k)) for b in base for k in range(6) for _ in range(4)}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    want = {(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    got = simhash.near_pairs(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    assert len(got) == len(want) and {(r.a, r.b) for r in got} == want


def test_the_tally_rules_out_candidates(spark):
    import random

    rng = random.Random(8)
    values = sorted({sum(rng.choice((1, 2, 255)) << 8 * p for p in range(7)) for _ in range(300)})
    prints = spark.createDataFrame([(v,) for v in values], "fp long")
    shared = lambda a, b: sum((a ^ b) >> 8 * p & 255 == 0 for p in range(8))
    pairs = list(itertools.combinations(values, 2))
    for least in (3, 4):
        got = [(r.a, r.b, r.shared) for r in simhash.candidate_pairs(prints, 3, least).collect()]
        assert sorted(got) == sorted((a, b, shared(a, b)) for a, b in pairs if shared(a, b) >= least)
    assert len(got) < sum(shared(a, b) >= 3 for a, b in pairs)
    for size in (2, 3, 4):
        assert sorted(map(tuple, simhash.near_pairs(prints, 4, size).collect())) == sorted((a, b) for a, b in pairs if (a ^ b).bit_count() <= 4)


def test_fingerprint_hash_is_the_engines_own(spark):
    words = ["a b c d", "été x"]
    got = [r.h for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w").alias("h")).collect()]
    import xxhash

    assert [h & (2**64 - 1) for h in got] == [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(-5, 7)]
    out = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: -5 for i in range(201)}, **{1000 + i: 1000 for i in range(50)}, -5: -5}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_build_no_table_in_the_driver(spark):
    links = spark.createDataFrame([(2, 1), (3, 2), (9, 8)], "u long, v long")
    prints = spark.createDataFrame([(1,), (3,), (1 << 40,)], "fp long")
    frames = [components._star(components._star(links, True), False), simhash.near_pairs(prints), simhash._classes(prints, 4)]
    for frame in frames:
        assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in frames[2].collect()} == {(1, 1), (3, 1), (1 << 40, 1)}


def test_components_deal_edges_seldom(spark):
    """A round moves edges four times at most (the hubs' least nodes, the edges, the small star's, the result), and stars need no round to be known as such."""
    links = spark.createDataFrame([(2, 1), (3, 2), (9, 8)], "u long, v long")
    round_of = components._star(components._star(links, True), False).distinct()
    round_of.collect()
    assert len(set(re.findall(r"Exchange .*?plan_id=(\d+)", round_of._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]))) <= 4
    assert {tuple(r) for r in round_of.collect()} == {(2, 1), (3, 1), (9, 8)}
    assert components._settled(round_of) and not components._settled(links)
    assert not components._settled(spark.createDataFrame([(3, 1), (3, 2)], "u long, v long"))
