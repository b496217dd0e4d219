from pyspark.sql import functions as F

from biblioforge.operators import relational as R
from biblioforge.plans import queries as Q


def test_email_assign_reads_whole_texts(spark, sf):
    words = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", F.size(F.split("text", r"\s+")).alias("n"))
    rows = Q.email_assign(spark, sf).join(words, ["conv_id", "turn"]).select(F.size("emails").alias("got"), "n").collect()
    assert max(r.n for r in rows) > 3 and all(r.got == r.n for r in rows)


def test_lookups_are_whole_tables(spark, sf, monkeypatch):
    seen, remap, cascade = {}, R.remap, R.lookup_cascade
    monkeypatch.setattr(R, "remap", lambda df, column, mapping, *rest: seen.update(supplier=mapping.count()) or remap(df, column, mapping, *rest))
    monkeypatch.setattr(R, "lookup_cascade", lambda df, steps, *rest: seen.update(part=min(s[0].count() for s in steps)) or cascade(df, steps, *rest))
    Q.remap_key(spark, sf)
    Q.lookup_cascade(spark, sf)
    assert seen == {name: spark.read.parquet(f"{sf}/{name}.parquet").count() for name in ("supplier", "part")}
