"""Nearest neighbours by largest inner product with an inverted multi-index.

The two halves of a vector are quantised separately, each by ``centroids``
k-means centres fitted on at most ``sample`` vectors (a bound independent of
the table); every vector is listed under its pair of centres. A query walks
the pairs by summed distance (negated inner products of its halves with the
centres) with a heap, until the lists it has met hold ``probe`` of all
vectors; their entries are reranked by the exact product in double precision.

Equal vectors are one entry that carries the ``k + 1`` smallest of their ids
(kept to that before the shuffle), and equal queries are searched once, so a
vector that fills a third of the table costs one entry. Lists are read in
blocks: a first centre's entries and the queries that visit it are each cut to
bounded blocks, and one task multiplies one block by another.

Cases: vectors that are null, zero, hold null or non-finite components, or
have another length than most, take no part, neither as queries nor as
candidates; ties go to the smaller vec_id; equal rows are one candidate and one
query; rows that repeat a vec_id with different vectors are candidates each (a
query leaves out every row of its own id); fewer candidates than k give as many rows; an empty table gives an empty
result; only the id and the vector are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm.common import read_table, stage

CENTROIDS, SAMPLE, PROBE = 64, 20_000, 0.65
#: Entries and queries of one block.
ENTRY_BLOCK, QUERY_BLOCK = 16_384, 4_096
#: Queries that one task walks the index for.
QUERIES_PER_TASK = 256


def kmeans(x: np.ndarray, k: int, rounds: int = 15, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, centre)
        count = np.bincount(near, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        centre = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centre)
    return centre


def nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.argmin((centre * centre).sum(1) - 2 * (x @ centre.T), axis=1)


def walk(first: np.ndarray, second: np.ndarray, count: np.ndarray, want: float) -> np.ndarray:
    """Visited pairs as a table of booleans: by summed distance, until their lists hold ``want`` entries."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    held = count[np.ix_(a, b)].tolist()
    seen = np.zeros(count.shape, bool)
    # One entry for each first centre: its next second centre.
    heap = [(x[0] + y[0], 0, 0)]
    got = 0
    while heap and got < want:
        _, i, j = heapq.heappop(heap)
        if held[i][j]:
            seen[a[i], b[j]] = True
            got += held[i][j]
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
    return seen


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v, of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where("vec_id is not null")
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    return rows


def search(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", centroids: int = CENTROIDS, probe: float = PROBE, sample: int = SAMPLE, entry_block: int = ENTRY_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found. ``is_query``: a condition on the column vec_id."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = lengths.n if lengths else 1
    half = dim // 2
    rows = rows.where(F.size("v") == dim)

    smallest = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    # repeats of a row are one candidate: they must not fill a vector's places
    entries = rows.distinct().withColumn("_r", smallest).where(F.col("_r") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    entries = stage(entries, "ann-entries")
    n = entries.count()
    fitted = matrix(entries.select("v").orderBy(F.xxhash64("v"), "v").limit(sample).toArrow()["v"].combine_chunks(), dim) if n else np.zeros((0, dim))
    width = max(1, min(centroids, int(np.sqrt(max(1, len(fitted))))))
    one, two = (kmeans(part, width) if len(part) else np.zeros((1, part.shape[1])) for part in (fitted[:, :half], fitted[:, half:]))
    model = spark.sparkContext.broadcast((one, two))  # centroids x dim numbers

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = model.value
        for batch in batches:
            x = matrix(batch.column("v"), dim)
            yield pa.RecordBatch.from_arrays([pa.array(nearest(x[:, :half], one), pa.int32()), pa.array(nearest(x[:, half:], two), pa.int32()), *batch.columns], names=["a", "b", *batch.schema.names])

    kind = rows.schema["v"].dataType.simpleString()
    listed = stage(entries.mapInArrow(place, f"a int, b int, v {kind}, ids array<bigint>"), "ann-lists")
    count = np.zeros((len(one), len(two)), np.int64)
    for r in listed.groupBy("a", "b").count().collect():  # a row for each pair of centres
        count[r.a, r.b] = r["count"]
    want = max(probe * n, k + 1)  # the query's own entry is one of them

    asked = rows.where(is_query).groupBy("v").agg(F.min("vec_id").alias("q"))
    asked = stage(asked, "ann-queries")
    n_asked = asked.count()
    entry_blocks = np.maximum(1, -(-count.sum(1) // entry_block))
    query_blocks = max(1, -(-n_asked // query_block))
    asked = asked.repartition(1 + n_asked // QUERIES_PER_TASK, "q")  # the walk is long work on few bytes
    shared = spark.sparkContext.broadcast(count)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                x = matrix(part.column("v"), dim)
                first, second = -(x[:, :half] @ one.T), -(x[:, half:] @ two.T)
                row, a, mask = [], [], []
                for i in range(len(x)):
                    seen = walk(first[i], second[i], shared.value, want)
                    for c in np.flatnonzero(seen.any(axis=1)):
                        row.append(i)
                        a.append(c)
                        mask.append(np.packbits(seen[c]).tobytes())
                taken = part.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(mask, pa.binary()), *taken.columns], names=["a", "mask", *part.schema.names])

    visits = asked.mapInArrow(visit, f"a int, mask binary, v {kind}, q bigint")
    blocks_of = F.element_at(F.array(*[F.lit(int(b)) for b in entry_blocks]), F.col("a") + 1)
    left = visits.select("a", "mask", "v", "q", F.pmod(F.xxhash64("q"), F.lit(query_blocks)).alias("qb"), F.explode(F.sequence(F.lit(0), blocks_of - 1)).alias("eb"))
    right = listed.select("a", "b", "v", "ids", F.pmod(F.xxhash64("v"), blocks_of.cast("long")).cast("int").alias("eb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(int(query_blocks) - 1).cast("long"))).alias("qb"))

    def rerank(queries: pa.Table, lists: pa.Table) -> pa.Table:
        asked_of, score, found = [], [], []
        if queries.num_rows and lists.num_rows:
            q, x = (matrix(t["v"].combine_chunks(), dim) for t in (queries, lists))
            b, ids = lists["b"].to_numpy(), lists["ids"].combine_chunks()
            least = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
            masks = np.unpackbits(np.frombuffer(b"".join(queries["mask"].to_pylist()), np.uint8).reshape(len(q), -1), axis=1).astype(bool)
            for at in range(0, len(q), 64):
                s = q[at : at + 64] @ x.T
                s[~masks[at : at + 64][:, b]] = -np.inf
                top = np.argpartition(-s, k, axis=1)[:, : k + 1] if s.shape[1] > k + 1 else np.broadcast_to(np.arange(s.shape[1]), s.shape)
                for i, row in enumerate(s):
                    cut = row[top[i]].min()
                    near = np.flatnonzero((row >= cut) & (row > -np.inf))  # with all ties of the last
                    near = near[np.lexsort((least[near], -row[near]))][: k + 1]
                    asked_of.append(np.full(len(near), at + i))
                    score.append(row[near])
                    found.append(near)
        pick = lambda parts, t: np.concatenate(parts) if parts else np.zeros(0, t)
        found = pick(found, np.int64)
        return pa.table({"q": queries["q"].take(pa.array(pick(asked_of, np.int64))), "score": pick(score, np.float64), "ids": lists["ids"].take(pa.array(found))})

    near = left.groupBy("a", "eb", "qb").cogroup(right.groupBy("a", "eb", "qb")).applyInArrow(rerank, "q bigint, score double, ids array<bigint>")
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0])
    near = near.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1)
    near = near.groupBy("q").agg(F.collect_list(F.struct("score", "ids")).alias("near"))  # k + 1 at most

    same = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "v").distinct().join(asked, "v").join(near, "q")
    pairs = same.select("query_id", F.inline("near")).select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every embedding whose vec_id is divisible by 20."""
    return search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
