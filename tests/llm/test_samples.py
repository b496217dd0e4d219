from pyspark.sql import functions as F

from biblioforge.llm import common


def test_least_hashes_equal_a_whole_sort(spark, monkeypatch):
    rows = spark.range(0, 3000).select(F.col("id").alias("doc_id")).unionByName(spark.createDataFrame([(None,), (5,)], "doc_id long"))
    order = F.xxhash64("doc_id", F.lit(3))
    want = [r.doc_id for r in rows.orderBy(order, "doc_id").limit(100).collect()]
    # about right, far too many and far too few let through
    for n in (3002, 0, 10**9):
        assert [r.doc_id for r in common.least_hashes(rows, n, order, ["doc_id"], 100).collect()] == want
    assert common.least_hashes(rows, 3002, order, ["doc_id"], 100).select("doc_id").where("doc_id < 0").count() == 0
    assert common.least_hashes(rows.limit(0), 0, order, ["doc_id"], 100).count() == 0
