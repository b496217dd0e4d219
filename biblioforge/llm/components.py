"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stash, new_path

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (u, v), u > v: link each node's neighbours to the least node around it. Edges may repeat, here and in the result.

    A small star deals its edges by u once, and makes them distinct, finds the least node and joins where they lie."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.repartition("u").distinct()
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = around.join(least.hint("merge"), "u")  # never built as a table in the driver, however well the edges compress
    if large:
        return moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    both = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
    return moved.select(F.explode(both).alias("e")).select("e.*").where(F.col("u") > F.col("v"))


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars already: every node is linked to one node only, or is a centre, not both. A round leaves such edges as they are."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(None).cast("int").alias("up")))).alias("e")).select("e.*")
    seen = ends.groupBy("node").agg(F.count("up").alias("ups"), F.count(F.lit(1)).alias("n"))
    return not seen.where("ups > 1 OR ups = 1 AND n > 1").agg(F.count(F.lit(1))).first()[0]


def connected_components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, root): root is the least node of the component. Nodes without links do not appear.

    Rounds stop when the edges are stars, which a further round would leave unchanged; each round's edges are written to the
    shared folder, so nothing depends on a long lineage or on an executor's cache. Both sides of a join grow with the links, so
    neither is broadcast: a broadcast table is built in the driver, and a file's size says little about its rows.
    """
    spark = links.sparkSession
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    old = None
    for _ in range(MAX_ROUNDS):
        path = new_path(spark, "stars")
        _star(_star(edges, True), False).distinct().write.parquet(path)
        if old:
            drop_stash(spark, old)
        edges, old = spark.read.schema("u long, v long").parquet(path), path
        if _settled(edges):
            break
    else:
        raise RuntimeError("connected components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
