"""Runs queries beside their SQL and compares the rows. python tests/oracle.py SF_DIR [NAME...]"""

import math
import sys
from collections import Counter


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        return round(v, 6)
    return v


def differences(spark, sf, query, sql):
    import duckdb

    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {name} AS FROM '{sf}/{name}.parquet'")
    df = query(spark, sf)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    rel = con.sql(sql)
    names = sorted(rel.columns)
    if columns != names:
        return f"columns {columns} and {names}"
    want = Counter(tuple(plain(v) for v in r) for r in con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in names)} FROM ({sql})").fetchall())
    if got != want:
        return f"{sum(got.values())} and {sum(want.values())} rows; only here {list((got - want).items())[:3]}; only in SQL {list((want - got).items())[:3]}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    sqls, sf = e.oracle_sql(), sys.argv[1]
    for name, q in e.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:] or len(sys.argv) == 2 and (name.startswith("op") or name == "pipeline"):
            continue
        try:
            said = differences(spark, sf, q, sqls[name]) if name in sqls else f"rows {q(spark, sf).count()}"
        except Exception as x:
            said = f"{type(x).__name__}: {str(x)[:400]}"
        print(name, said or "equal", flush=True)
