"""The e-mails of rows with many authors."""

import time

from pyspark.sql import functions as F

from biblioforge.operators.authors import _take_emails, assign_emails


def test_many_authors_in_a_row(spark):
    """Names times e-mails is not walked column by column: 40 rows of 600 names took minutes."""
    n = 600
    rows = [(i, [f"NAME{(7 * k + i) % n:03d}, Z" for k in range(n)], [f"Name{k:03d}@x.org" for k in range(n - 1)]) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, n array<string>, e array<string>").repartition(4)
    began = time.perf_counter()
    got = {r.i: r.o for r in df.select("i", assign_emails(F.col("n"), F.col("e")).alias("o")).collect()}
    assert time.perf_counter() - began < 60
    for i, names, mails in rows:
        assert got[i] == [f"Name{x[4:7]}@x.org" if int(x[4:7]) < n - 1 else None for x in names]


def test_missing_and_equal_emails(spark):
    rows = [(0, ["Ann Lee", None], ["lee@x", None, "lee@x"]), (1, None, ["a@x"]), (2, ["B C"], []), (3, ["B C"], ["q@x", "bc@x"]), (4, ["X Y", "Lee, A"], ["lee@x", "r@x", "lee@x"])]
    df = spark.createDataFrame(rows, "i int, n array<string>, e array<string>")
    got = {r.i: r.o for r in df.select("i", assign_emails(F.col("n"), F.col("e")).alias("o")).collect()}
    assert got == {0: ["lee@x", None], 1: None, 2: [None], 3: ["bc@x"], 4: ["r@x", "lee@x"]}
    assert _take_emails(["ab", "ab", "c"], ["ab", "ab", "ab"], ["", "", ""], ["", "", ""]) == [0, 1, 2]
