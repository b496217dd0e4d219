import hashlib

import corpus_pipeline as cp
from biblioforge.llm import mixing, packing, simhash, toxicity
from tests.llm.test_dedup import brute_components


def test_stages_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    clean = cp.reject_toxic(spark, docs, sf).cache()
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {r.doc_id for r in docs.collect()} - toxic
    last = {}
    for r in clean.collect():
        key = hashlib.sha256(r.text.encode()).digest()
        last[key] = max(last.get(key, -1), r.doc_id)
    single = cp.drop_copies(spark, clean, sf).cache()
    assert {r.doc_id for r in single.collect()} == set(last.values()) and single.count() == len(last)
    roots = brute_components({r.doc_id: simhash.fingerprint(r.text) for r in single.collect()})
    apart = cp.drop_near_copies(spark, single, sf).cache()
    assert {r.doc_id for r in apart.collect()} == {d for d, root in roots.items() if d == root}
    copies = {r.doc_id: r.copies for r in mixing.mix(apart, cp.MIX_PERCENT, cp.MIX_EPOCHS).collect()}
    mixed = cp.mix_sources(spark, apart, sf).cache()
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(d for d, n in copies.items() if n)
    for stage in (clean, single, apart, mixed):
        assert stage.columns == docs.columns
    pieces = cp.pack_sequences(spark, mixed, sf).collect()
    whole = cp.run(spark, sf).collect()
    key = lambda rows: sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    assert key(pieces) == key(whole) and {r.doc_id for r in pieces} == {r.doc_id for r in mixed.collect()}


def test_odd_documents_pass_every_stage(spark, sf, odd_docs, no_docs):
    for start in (odd_docs, no_docs):
        docs = start
        for _, stage in cp.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            assert docs.columns == start.columns
        assert cp.STAGES[-1][1](spark, docs, sf).columns == list(packing.LOCATED)
    assert len(cp.STAGES) == 5 and cp.ORACLE_SQL is None


def test_null_ids_and_clashing_columns(spark, sf):
    rows = [(None, "a b c d e", None, None, 1, 2, 3), (None, None, "en", "src1", 1, 2, 3), (1, "a b c d e", "en", "src1", 1, 2, 3), (1, "a b c d e", "en", "src1", 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, epochs int, kept int, component_id int")
    from biblioforge.llm import exact_dedup, license_scan, pii, token_counts, token_files
    from biblioforge.llm.common import new_path

    folder = new_path(spark, "odd")
    assert exact_dedup.exact_dedup(docs, exact_dedup.DigestIndex(spark)).count() == 4
    assert mixing.mix(docs).count() == 4 and simhash.simhash_components(docs).count() == 4
    assert token_files.read_token_files(token_files.write_token_files(docs, folder), folder).count() == 4
    assert toxicity.score(docs, {"bias": 0.0, "weights": {}}).count() == 4 and token_counts.token_counts(docs, {}).count() == 4
    assert pii.find_personal_data(docs, {}).count() == 4 and license_scan.scan(docs, license_scan.train()).count() == 0
    assert mixing.drawn_documents(docs, 100, 1).columns == docs.columns
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() >= 1
