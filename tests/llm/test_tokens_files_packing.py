import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from biblioforge.llm import packing, token_files, tokens
from biblioforge.llm.common import new_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.vocabulary_path())


def whole(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()


def test_cached_ids_equal_the_library(spark, sf, library):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    texts += [f"x a{chr(c)}b {chr(c)}" for c in range(1, 0x260)] + ["don't we'll '' _a_ 12a", "<|endoftext|>x", "ΑΣ é", "a\x1cb\xa0c"]
    for t in texts + texts[:20]:
        assert tokens.encode_ids(t) == whole(library, t)


def check_files(got, docs, library):
    start = 0
    for r in sorted(docs, key=lambda r: r.doc_id):
        ids = whole(library, r.text)
        assert got[r.doc_id] == (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    assert len(got) == len(docs)


def test_files_round_trip(spark, sf, library, odd_docs, no_docs):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        folder = new_path(spark, "files")
        out = token_files.read_token_files(token_files.write_token_files(docs, folder, 50_000), folder).collect()
        check_files({r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in out}, docs.select("doc_id", "text").collect(), library)
    folder = new_path(spark, "files")
    assert token_files.read_token_files(token_files.write_token_files(no_docs, folder), folder).count() == 0


def test_reader_takes_one_document_and_notices_damage(tmp_path):
    path, ids = tmp_path / "a.tok", [np.arange(n, dtype="<u4") % 49_000 for n in (1, 0, 3 << 20, 7)]
    with open(path, "wb") as f:
        w = token_files.TokenFileWriter(f)
        for i, x in enumerate(ids):
            w.add(i * 10, x.tobytes())
        w.close()
    files, root = token_files.open_folder(str(tmp_path))
    r = token_files.TokenFileReader(files.open_input_file(f"{root}/a.tok"))
    assert [r.find(i * 10) for i in range(4)] == [x.tobytes() for x in ids] and r.find(5) is None
    data = bytearray(path.read_bytes())
    data[int(r.offsets[0]) + 9] ^= 255
    path.write_bytes(data)
    with pytest.raises(Exception):
        token_files.TokenFileReader(files.open_input_file(f"{root}/a.tok")).find(0)


def check_packing(rows, docs, library, most_padding):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for d in docs:
        ids, at = whole(library, d.text), 0
        for r in sorted(by_doc[d.doc_id], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids) // 4
            assert r.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + r.length)])
            at += r.length
        assert at == len(ids) // 4
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    used = sum(r.length for r in rows)
    assert len(by_seq) * 2048 <= used * (1 + most_padding) + 2048


def test_packing(spark, sf, library, odd_docs, no_docs):
    for docs, padding in ((spark.read.parquet(f"{sf}/documents.parquet"), 0.03), (odd_docs, 0.03)):
        check_packing(packing.pack(docs).collect(), docs.select("doc_id", "text").collect(), library, padding)
    assert packing.pack(no_docs).count() == 0


def test_cut_covers_and_wastes_little():
    for n in range(1, 5000):
        pieces = packing.cut(n)
        assert sum(p for p, _ in pieces) == n
        assert all(p * k <= 2048 and p * k >= 2048 * 0.97 for p, k in pieces[:-1])


def test_sequences_hold_the_ids(spark, odd_docs, library):
    out = {r.sequence_id: r.ids for r in packing.sequences(packing.pack(odd_docs, keep_ids=True)).collect()}
    for r in packing.pack(odd_docs, keep_ids=True).where("doc_id = 7").collect():
        assert r.ids == whole(library, "émile ΣΑΣ ½ İx   y")[4 * r.start : 4 * (r.start + r.length)]
    assert sum(map(len, out.values())) == sum(len(whole(library, d.text)) // 4 for d in odd_docs.select("text").collect())


def test_pieces_of_a_document_are_few_and_fewer_with_more_tolerance():
    counts = [[len(packing.cut(n, 2048, tolerance)) for n in range(1, 2048)] for tolerance in (0.02, 0.1, 0.2)]
    assert max(counts[0]) <= 5 and sum(counts[0]) > sum(counts[1]) > sum(counts[2])
    assert all(len(packing.cut(n)) == 1 for k in range(1, 40) for n in [2048 // k])
    assert len(packing.cut(2048 * 7 + 5)) <= 7 + 5


def test_packing_keeps_repeated_and_null_ids_apart(spark, library):
    rows = [(None, "a b"), (None, "a b"), (1, "c d e"), (1, "c d e f"), (1, None)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = sorted((str(d), zlib.crc32(whole(library, t)), len(whole(library, t)) // 4) for d, t in rows)
    assert sorted((str(r.doc_id), r.ids_crc32, r.length) for r in out) == want and {r.start for r in out} == {0}


def test_files_keep_repeated_and_null_ids_in_a_fixed_order(spark, library):
    rows = [(None, "n"), (3, "x"), (3, "x"), (3, "y"), (None, None), (-(1 << 63), "least"), (4, "z")] + [(5, "same")] * 40
    found = []
    for parts in (1, 7):
        folder = new_path(spark, "ties")
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        found.append(sorted(map(tuple, token_files.read_token_files(token_files.write_token_files(docs, folder, 8), folder).collect()), key=lambda r: r[1]))
    assert found[0] == found[1] and [r[0] for r in found[0]] == [None, None, -(1 << 63), 3, 3, 3, 4] + [5] * 40
    assert sorted(r[3] for r in found[0]) == sorted(zlib.crc32(whole(library, t)) for _, t in rows)
    assert [r[1] for r in found[0]] == [sum(x[2] for x in found[0][:i]) for i in range(len(rows))]
