"""Centroid clustering by delta Lloyd on integer vectors.

Assignments are a table that each round rewrites: per vector its cluster, its squared distance and the cluster it had before. The sums
and counts of all clusters are kept as exact integers (clusters times components, on the driver: bounded by the parameters). A round
  * compares each vector whose own centroid stayed with the changed centroids only, and each vector whose own centroid changed with all of
    them; if no centroid changed, all stay, and later rounds are the same;
  * reads back the vectors that changed their cluster alone, and adds up what they take from one cluster and bring to another as signed
    integers, combined per task before the shuffle;
  * moves the centroids of clusters that received or gave something.
Results equal those of full Lloyd rounds, ties to the smaller cluster number included: a centroid that did not change cannot have come nearer.

Rules for odd input: vectors that are null, of another width, or hold null or non-finite components take no part; rows repeated with the same vec_id
are vectors of their own; a null vec_id hashes as an empty text; equal hashes start in order of their components; with fewer vectors than
clusters every vector starts one; an empty table gives no rows; extra columns are ignored. Components beyond 2 ** 27 / scale in size raise, as
squared distances would not fit in a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stash, new_path

CLUSTERS, ROUNDS, SCALE, WIDTH, SEED = 40, 5, 256, 64, "2"
#: Largest component: 64 squared differences of twice this fit in a long. Up to EXACT products and their sums are exact in doubles.
LARGEST, EXACT = 1 << 27, 1 << 21
#: Vectors compared at once: bounds the table of distances.
BLOCK = 4_096
STATE = "vec_id long, q array<int>, cluster int, distance long, was int"


def quantised(vectors: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """vec_id and q, the components as floor(scale * x), of the vectors that take part."""
    e = F.col("embedding")
    whole = F.size(e) == width
    finite = F.forall(e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    part = vectors.where(e.isNotNull() & whole & finite).select(F.col("vec_id").cast("long"), e.cast("array<double>").alias("e"))
    fits = F.forall("e", lambda x: F.abs(x * scale) <= LARGEST)
    q = F.transform("e", lambda x: F.floor(x * scale).cast("int"))
    return part.select("vec_id", F.when(fits, q).otherwise(F.raise_error(F.lit(f"components beyond {LARGEST // scale}"))).alias("q"))


def first_centroids(points: DataFrame, clusters: int = CLUSTERS, width: int = WIDTH, seed: str = SEED) -> np.ndarray:
    """The vectors of least sha256 of seed:vec_id, in that order; a bounded top list, merged from the tasks' own."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = points.orderBy(order, "q").limit(clusters).collect()
    return np.array([r["q"] for r in rows], np.int64).reshape(len(rows), width)


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of integer vectors, exact."""
    if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT:
        x, c = points.astype(np.float64), centroids.astype(np.float64)
        # 64 products below 2 ** 42 and their sums stay below 2 ** 53
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((points - c) ** 2).sum(1) for c in centroids], 1)


def nearest(points: np.ndarray, cluster: np.ndarray, distance: np.ndarray, centroids: np.ndarray, changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector and its distance; cluster and distance are those of the round before (-1: none yet)."""
    owner_moved = (cluster < 0) | np.isin(cluster, changed)
    cluster, distance = cluster.copy(), distance.copy()
    for mask, some in ((owner_moved, np.arange(len(centroids))), (~owner_moved, changed)):
        at = np.flatnonzero(mask)
        for a in range(0, len(at) if len(some) else 0, BLOCK):
            i = at[a : a + BLOCK]
            d = distances(points[i], centroids[some])
            best = d.argmin(1)  # the first of equals: the smaller number
            least, number = d[np.arange(len(i)), best], some[best]
            if some is changed:
                better = (least < distance[i]) | ((least == distance[i]) & (number < cluster[i]))
                i, least, number = i[better], least[better], number[better]
            cluster[i], distance[i] = number, least
    return cluster, distance


def _assigned(state: DataFrame, centroids: np.ndarray, changed: np.ndarray) -> DataFrame:
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = batch.column("q").flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)
            was = batch.column("cluster").to_numpy()
            cluster, distance = nearest(points, was.astype(np.int64), batch.column("distance").to_numpy(), centroids, changed)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("q"), pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(was)],
                names=["vec_id", "q", "cluster", "distance", "was"],
            )

    return state.select("vec_id", "q", "cluster", "distance").mapInArrow(run, STATE)


def transfers(state: DataFrame, width: int) -> dict[int, tuple[int, list[int]]]:
    """cluster -> what its count and sums gain, from the vectors that moved; combined per task, then per cluster."""
    moved = state.where("was <> cluster")
    signed = moved.select("q", F.explode(F.array(F.struct(F.col("cluster").alias("c"), F.lit(1).alias("s")), F.struct(F.col("was").alias("c"), F.lit(-1).alias("s")))).alias("t"))
    sums = [F.sum(F.get("q", F.lit(i)).cast("long") * F.col("t.s")).alias(f"s{i}") for i in range(width)]
    rows = signed.where("t.c >= 0").groupBy("t.c").agg(F.sum(F.col("t.s").cast("long")).alias("n"), *sums).collect()  # a row per cluster at most
    return {r["c"]: (r["n"], [r[f"s{i}"] for i in range(width)]) for r in rows}


class Clustering:
    """The table of assignments (STATE), the centroids, and what rounds did: vectors moved and centroids changed."""

    def __init__(self, state: DataFrame, centroids: np.ndarray, history: list[tuple[int, int]]):
        self.state, self.centroids, self.history = state, centroids, history


def delta_lloyd(points: DataFrame, centroids: np.ndarray, rounds: int = ROUNDS) -> Clustering:
    """points: vec_id, q. Rounds of assignment and update, then a last assignment."""
    spark, width = points.sparkSession, centroids.shape[1]
    state = points.select("vec_id", "q", F.lit(-1).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    counts, sums = [0] * len(centroids), [[0] * width for _ in centroids]
    changed, old, history = np.arange(len(centroids)), None, []
    for number in range(rounds + 1):
        path = new_path(spark, "assignments")
        _assigned(state, centroids, changed).write.parquet(path)
        if old:
            drop_stash(spark, old)
        state, old = spark.read.schema(STATE).parquet(path), path
        if number == rounds:
            break
        before = centroids.copy()
        gained = transfers(state, width)
        for c, (n, gains) in gained.items():
            counts[c] += n
            sums[c] = [a + b for a, b in zip(sums[c], gains)]
            if counts[c]:
                centroids[c] = [s // counts[c] for s in sums[c]]  # Python's // is the floor
        changed = np.flatnonzero((centroids != before).any(1))
        history.append((sum(max(n, 0) for n, _ in gained.values()), len(changed)))
        if not len(changed):
            break  # no later round can change anything
    return Clustering(state, centroids, history)


def with_inertia(found: Clustering) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256. The joined side has a row per cluster."""
    spark = found.state.sparkSession
    rows = found.state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()
    total = sum(r["d"] for r in rows)
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in found.centroids]
    sides = spark.createDataFrame([(r["cluster"], r["d"], total, digest[r["cluster"]]) for r in rows], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.state.select("vec_id", "cluster", "distance").join(F.broadcast(sides), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    points = quantised(vectors, width, scale)
    return with_inertia(delta_lloyd(points, first_centroids(points, clusters, width, seed), rounds))


def op12_delta_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """Full Lloyd rounds: every vector against every centroid."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT p, vec_id, q, (m).c AS cluster, (m).d AS distance FROM (SELECT p, vec_id, v.q, min({{'d': list_sum(list_transform(list_zip(v.q, c.q),
  lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'c': c.c}}) AS m FROM v, c{r} c GROUP BY ALL))""")
        if r < rounds:
            steps.append(f"""
u{r} AS (SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT cluster, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM a{r}) GROUP BY ALL),
n{r} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS q FROM u{r} GROUP BY cluster),
c{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(n.q, c.q) AS q FROM c{r} c LEFT JOIN n{r} n ON n.cluster = c.c)""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS p, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: isfinite(x))) = {WIDTH}),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), q) - 1)::INT AS c, q FROM v QUALIFY c < {clusters}),{','.join(steps)}
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c.q, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON c.c = a.cluster
"""
