"""Tagged text read by byte splits: rows equal those of a plain reading of the whole file, whatever the splits."""

import random
import re

import pytest
from pyspark.sql import functions as F

from biblioforge.sources import wos

CONFS = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
SINGLE = {"TI": "title", "SO": "journal", "DI": "doi", "PY": "year"}


def plain(texts):
    """seq-ordered (title, journal, doi, references) by a line-by-line reading."""
    out = []
    for text in texts:
        text = re.sub("\r\n?", "\n", text.removeprefix("﻿"))
        for record in re.split(r"(?m)^ER[ \t]*$", text):
            fields, tag = {}, None
            for line in record.split("\n"):
                if not line.strip(" ") or re.fullmatch(r"EF\s*", line) or re.match("(?:FN|VR) ", line):
                    continue
                if re.match("[A-Z][A-Z0-9] ", line):
                    tag = line[:2]
                    if tag == "CR":
                        fields.setdefault(tag, []).append(line[3:].strip(" "))
                    else:
                        fields[tag] = [line[3:].strip(" ")]
                elif tag:
                    fields[tag].append(line.strip(" "))
            if fields:
                out.append((*(" ".join(fields.get(t, [])) for t in ("SO", "DI", "PY")), "; ".join(fields.get("CR", []))))
    return out


def sample(rng, records, end, odd=False):
    lines = ["FN x", "VR 1.0"]
    for n in range(records):
        for tag in rng.sample(["SO", "DI", "PY", "CR", "TI", "ZZ"], rng.randrange(1, 6)):
            lines.append(f"{tag} " + rng.choice(["A", "ER", "AB C D", "", "10.1/ER", "ERROR"]) + f" {n}")
            lines += ["   " + rng.choice(["more", "ER", "ER x", "TI not a tag", ""]) for _ in range(rng.randrange(0, 4))]
        if odd and rng.random() < 0.3:
            lines.append("ERRATUM without blanks before it")
        lines += [rng.choice(["ER", "ER ", "ER \t"]), *[""] * rng.randrange(0, 3)]
    return end.join(lines[: -1 if rng.random() < 0.5 else None])


@pytest.fixture()
def split_at(spark):
    before = {k: spark.conf.get(k, None) for k in CONFS}

    def set_size(size):
        for k, v in CONFS.items():
            spark.conf.set(k, v or str(size))

    yield set_size
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("size", [7, 64, 400, 1 << 20])
def test_rows_do_not_depend_on_splits(spark, split_at, tmp_path, size):
    rng = random.Random(4)
    texts = [sample(rng, 40, "\n"), "﻿" + sample(rng, 30, "\r\n"), sample(rng, 12, "\n", odd=True), sample(rng, 5, "\r"), sample(rng, 1, "\n"), "FN x\nVR 1\nEF\n"]
    if size == 7:
        texts = texts[-4:]  # a task per seven bytes
    for i, text in enumerate(texts):
        (tmp_path / f"f{i}.txt").write_bytes(text.encode())
    split_at(size)
    records = wos.read_records(spark, str(tmp_path))
    assert size > 100 or records.rdd.getNumPartitions() > 1
    rows = wos.articles_of(wos.fields_of(records)).orderBy("seq").select("journal", "doi", "year", F.col("references")).collect()
    folded = [(s, d, y, r.upper()) for s, d, y, r in plain(texts)]
    assert [tuple(r) for r in rows] == folded
    seqs = [r.seq for r in records.collect()]
    assert len(seqs) == len(set(seqs))


def test_heads_and_names(spark, tmp_path):
    (tmp_path / "a.txt").write_text("PT J\nER\n")
    (tmp_path / "b.txt").write_text("FN x\nVR 1\nTI t\nER\n")
    with pytest.raises(ValueError, match="no FN and VR header in .*a.txt"):
        wos.read_records(spark, str(tmp_path))
    assert wos.read_wos(spark, str(tmp_path / "b.txt")).count() == 1
    (tmp_path / "c.txt").write_text("")
    with pytest.raises(ValueError, match="c.txt"):
        wos.read_records(spark, [str(tmp_path / "b.txt"), str(tmp_path / "c.txt")])
    (tmp_path / "b.txt").rename(tmp_path / "b.dat")
    with pytest.raises(ValueError, match="not .txt"):
        wos.read_records(spark, str(tmp_path / "b.dat"))


def test_round_trip(spark, split_at, tmp_path):
    rows = [(i, f"A {i};B C", f"TITLE {i}", "line one\n\n line two" if i % 2 else "ER", "10.1/x" if i % 3 else None, "R, 1999, J; S, 2000, K") for i in range(50)]
    df = spark.createDataFrame(rows, "seq long, author string, title string, journal string, doi string, references string")
    wos.write_wos(df.repartition(5), str(tmp_path / "out"))
    split_at(300)
    back = wos.read_wos(spark, str(tmp_path / "out")).orderBy("seq").select("author", "title", "journal", "doi", "references").collect()
    want = [(a, t, " ".join(x.strip() for x in j.split("\n") if x.strip()), d or "", r) for _, a, t, j, d, r in rows]
    assert [tuple(r) for r in back] == want
