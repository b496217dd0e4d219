"""A digest index opens and answers rightly after a stop at any of its file operations."""

import pytest

from biblioforge.llm import exact_dedup
from biblioforge.llm.common import new_path


class Stop(Exception):
    pass


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def rows_of(spark, index, rows):
    return {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.exact_dedup(docs(spark, rows), index).collect()}


def stop_at(monkeypatch, number):
    """The number-th file operation of an index raises; a write leaves half a file, as a killed process does."""
    done = [0]

    def wrap(name):
        real = getattr(exact_dedup.DigestIndex, name)

        def run(self, *args):
            done[0] += 1
            if done[0] == number:
                if name == "_write":
                    real(self, args[0], args[1][:5])
                raise Stop(name)
            return real(self, *args)

        monkeypatch.setattr(exact_dedup.DigestIndex, name, run)

    for name in ("_write", "_rename", "_delete", "_save"):
        wrap(name)
    return done


BATCHES = [[(1, "a"), (5, "a"), (2, "b")], [(9, "a"), (7, "c"), (8, "c")], [(11, "c"), (12, "b"), (13, "d")], [(21, "a"), (22, "d"), (23, "e")]]
WANT = [
    {1: (5, False), 5: (5, True), 2: (2, True)}, {9: (5, False), 7: (8, False), 8: (8, True)},
    {11: (8, False), 12: (2, False), 13: (13, True)}, {21: (5, False), 22: (13, False), 23: (23, True)},
]


@pytest.mark.parametrize("batch", [0, 2])
def test_stops_of_append_and_compaction(spark, monkeypatch, batch):
    monkeypatch.setattr(exact_dedup, "COMPACT_AFTER", 3)
    number, stopped = 0, True
    while stopped:
        number += 1
        path = new_path(spark, "stops")
        index = exact_dedup.DigestIndex(spark, path)
        for rows, want in zip(BATCHES[:batch], WANT):
            assert rows_of(spark, index, rows) == want
        with monkeypatch.context() as patch:
            done = stop_at(patch, number)
            try:
                rows_of(spark, index, BATCHES[batch])
                stopped = False
            except Stop:
                pass
        index.drop()
        index = exact_dedup.DigestIndex(spark, path)
        for rows, want in zip(BATCHES[batch:], WANT[batch:]):  # the stopped batch again, then the others
            assert rows_of(spark, index, rows) == want, number
        assert {bytes(r.digest) for r in index.table().collect()} == {bytes(r.digest) for r in index.table().select("digest").distinct().collect()}
        assert index.table().count() == 5
    assert number > (9 if batch else 5) and done[0] < number


def test_failed_compaction_leaves_the_object_on_the_old_table(spark, monkeypatch):
    index = exact_dedup.DigestIndex(spark)
    assert rows_of(spark, index, BATCHES[0]) == WANT[0]
    with monkeypatch.context() as patch:
        patch.setattr(exact_dedup.DigestIndex, "_save", lambda *a: (_ for _ in ()).throw(Stop()))
        with pytest.raises(Stop):
            index.compact()
    assert index.state["folder"] == "digests-0" and rows_of(spark, index, BATCHES[1]) == WANT[1]
    index.compact()
    assert index.state["folder"] == "digests-1" and rows_of(spark, index, BATCHES[2]) == WANT[2]


def test_damaged_state_and_data_without_state(spark):
    index = exact_dedup.DigestIndex(spark)
    rows_of(spark, index, BATCHES[0])
    index._write(exact_dedup._state_name(index.number + 1), "{")
    assert rows_of(spark, exact_dedup.DigestIndex(spark, index.path), BATCHES[1]) == WANT[1]
    for name in index._names():
        if name.startswith("_state"):
            index._delete(name)
    with pytest.raises(ValueError, match="digests-0 but no state"):
        exact_dedup.DigestIndex(spark, index.path)


def test_second_writer_is_refused(spark):
    one = exact_dedup.DigestIndex(spark)
    rows_of(spark, one, BATCHES[0])
    other = exact_dedup.DigestIndex(spark, one.path)
    rows_of(spark, other, BATCHES[1])
    with pytest.raises(RuntimeError, match="another writer"):
        rows_of(spark, one, BATCHES[2])
    assert rows_of(spark, exact_dedup.DigestIndex(spark, one.path), BATCHES[2]) == WANT[2]
