"""Centroid clustering by equal-average equal-variance search, in whole numbers.

A vector becomes floor(256 * x) for each component x. Each round assigns every
vector to its nearest centroid (squared Euclidean distance, ties to the smaller
number) and replaces a centroid by the componentwise floor of its vectors'
mean; a centroid without vectors stays.

The search sorts the centroids by the mean of their components. A vector's
distance to a centroid is at least

    dim * (difference of means)^2 + (difference of deviations)^2,

the deviation being the length of the vector less its mean. So the scan starts
at the vector's own mean and goes outward, the nearer side first: once the
means alone exceed the best distance, no centroid further out can win; one whose
means and deviations exceed it is passed over; the distances of the others are
computed exactly in 64-bit integers. The bounds carry a slack far above the
error of their doubles, so they reject nothing that could win or tie.

Spark deals the vectors; each task adds up its own vectors by centroid, so a
round moves centroids x dim sums a task and the driver sees the ``k`` centroids
alone. The vectors are written once and every round reads them from there.

Cases: vectors that are null, hold null or non-finite components or have other
than ``dim`` components take no part; components beyond +-2^27 after scaling
count as that bound, so that distances fit 64 bits; rows that repeat a vec_id
are vectors each; a null vec_id stays and seeds last; fewer vectors than ``k``
give as many centroids; equal centroids are kept, the smaller number wins; an
empty table gives an empty result; only the id and the vector are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import read_table, stage

CENTROIDS, DIM, ROUNDS, SCALE = 40, 64, 5, 256
#: Largest component: dim * (2 * LARGEST)^2 fits a signed 64-bit number up to 64 components.
LARGEST = 1 << 27
#: Vectors searched at a time in a task.
SLICE = 8_192
_LONG = (1 << 63) - 1


def moments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation (length of the vector less its mean) of every row."""
    mean = x.sum(axis=1) / max(1, x.shape[1])
    rest = x - mean[:, None]
    return mean, np.sqrt((rest * rest).sum(axis=1))


def nearest_centroid(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of every row and its squared distance, all 64-bit integers."""
    n, k, dim = len(x), len(centroids), x.shape[1]
    mean, deviation = moments(x)
    c_mean, c_deviation = moments(centroids)
    order = np.argsort(c_mean, kind="stable")
    c_mean, c_deviation, ranked = c_mean[order], c_deviation[order], centroids[order]
    size = np.abs(x).max(axis=1, initial=0).astype(np.float64) + np.abs(centroids).max(initial=0)
    slack = 1e-9 * dim * size * size
    best, number = np.full(n, _LONG, np.int64), np.full(n, k, np.int64)
    right = np.searchsorted(c_mean, mean)  # next centroid to either side
    left = right - 1
    rows = np.arange(n)
    far = np.concatenate([[np.inf], c_mean, [np.inf]])  # beyond both ends
    while len(rows):
        below, above = mean[rows] - far[left[rows] + 1], far[right[rows] + 1] - mean[rows]
        below, above = np.where(left[rows] < 0, np.inf, below), np.where(right[rows] >= k, np.inf, above)
        down = below <= above
        gap = np.minimum(below, above)
        bound = dim * gap * gap
        open_ = np.isfinite(gap) & (bound <= best[rows] + slack[rows])  # by means
        rows, down, bound = rows[open_], down[open_], bound[open_]
        at = np.where(down, left[rows], right[rows])
        left[rows[down]] -= 1
        right[rows[~down]] += 1
        apart = deviation[rows] - c_deviation[at]
        near = bound + apart * apart <= best[rows] + slack[rows]  # by means and deviations
        i, c = rows[near], at[near]
        step = x[i] - ranked[c]
        distance, name = (step * step).sum(axis=1), order[c]
        wins = (distance < best[i]) | ((distance == best[i]) & (name < number[i]))
        best[i[wins]], number[i[wins]] = distance[wins], name[wins]
    return number, best


def integers(column: pa.Array, dim: int, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of every component, limited to +-LARGEST."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * x), -LARGEST, LARGEST).astype(np.int64)


def whole_vectors(vectors: DataFrame, dim: int, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id and v (whole numbers) of the rows that take part."""
    finite = F.forall(vector_col, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.where(F.col(vector_col).isNotNull() & (F.size(vector_col) == dim) & finite)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integers(batch.column("v"), dim, scale).astype(np.int32)
            v = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * dim), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), v], names=["vec_id", "v"])

    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).mapInArrow(convert, "vec_id bigint, v array<int>")


def _slices(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for at in range(0, batch.num_rows, SLICE):
        part = batch.slice(at, SLICE)
        yield part, part.column("v").flatten().to_numpy().astype(np.int64).reshape(part.num_rows, dim)


def sums_by_centroid(vectors: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """Vectors of every centroid and their componentwise sum."""
    k, dim = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            for _, x in _slices(batch, dim):
                number, _ = nearest_centroid(x, centroids)
                order = np.argsort(number, kind="stable")
                names, first, n = np.unique(number[order], return_index=True, return_counts=True)
                if len(names):
                    total[names] += np.add.reduceat(x[order], first, axis=0)
                    count[names] += n
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(used, pa.int32()), "count": pa.array(count[used]), "total": pa.array(total[used].tolist(), pa.list_(pa.int64()))})

    parts = vectors.select("v").mapInArrow(add, "cluster int, count bigint, total array<bigint>")
    long = parts.select("cluster", "count", F.posexplode("total").alias("i", "s"))
    summed = long.groupBy("cluster", "i").agg(F.sum("count").alias("count"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    counts, totals = np.zeros(k, np.int64), [[0] * dim for _ in range(k)]
    for r in summed.collect():  # k x dim rows
        counts[r.cluster], totals[r.cluster][r.i] = r["count"], int(r.s)
    return counts, totals


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM, seed: str = "2", id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part."""
    spark = vectors.sparkSession
    kept = stage(whole_vectors(vectors, dim, id_col, vector_col, scale), "whole-vectors")
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    seeds = kept.select("v").orderBy(place.asc_nulls_last(), "v").limit(k).collect()  # the k centroids
    centroids = np.array([r.v for r in seeds], np.int64).reshape(len(seeds), dim)
    for _ in range(rounds if len(seeds) else 0):
        counts, totals = sums_by_centroid(kept, centroids)
        centroids = np.array([[s // int(n) for s in total] if n else old for n, total, old in zip(counts, totals, centroids.tolist())], np.int64)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _slices(batch, dim):
                number, distance = nearest_centroid(x, centroids)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    assigned = stage(kept.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"), "assigned") if len(seeds) else spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint")
    held = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    whole = min(_LONG, sum(int(r.s) for r in held))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame([(r.cluster, min(_LONG, int(r.s)), whole, digest[r.cluster]) for r in held], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows at most


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings in 40 clusters after five rounds."""
    return cluster(read_table(spark, sf_dir, "embeddings"))


def _rounds_sql() -> str:
    steps = []
    for r in range(ROUNDS + 1):
        near = f"""near{r} AS MATERIALIZED (
  SELECT p.rid, c.num, sum((p.x - c.x) * (p.x - c.x)) AS d FROM parts p JOIN c{r} c ON p.i = c.i GROUP BY p.rid, c.num
), of{r} AS MATERIALIZED (
  SELECT rid, num, d FROM near{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, num) = 1
)"""
        steps.append(near)
        if r < ROUNDS:
            steps.append(f"""m{r} AS (
  SELECT o.num, p.i, sum(p.x) AS s, count(*) AS n FROM of{r} o JOIN parts p USING (rid) GROUP BY o.num, p.i
), c{r + 1} AS MATERIALIZED (
  SELECT c.num, c.i, CASE WHEN m.n IS NULL THEN c.x ELSE ((m.s - ((m.s % m.n) + m.n) % m.n) // m.n)::BIGINT END AS x
  FROM c{r} c LEFT JOIN m{r} m ON m.num = c.num AND m.i = c.i
)""")
    return ", ".join(steps)


OP13_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, embedding AS v FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}
), parts AS MATERIALIZED (
  SELECT rid, unnest(range(1, {DIM} + 1)) AS i, floor({SCALE} * unnest(v)::DOUBLE)::BIGINT AS x FROM kept
), seeds AS (
  SELECT rid, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS num FROM kept QUALIFY num < {CENTROIDS}
), c0 AS MATERIALIZED (
  SELECT num, i, x FROM seeds JOIN parts USING (rid)
), {_rounds_sql()}, digests AS (
  SELECT num, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY num
)
SELECT vec_id, num::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY num))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM of{ROUNDS} JOIN kept USING (rid) JOIN digests USING (num)
"""
