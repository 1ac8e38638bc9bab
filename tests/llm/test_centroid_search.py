"""Centroid clustering: against a plain version in Python's integers and DuckDB, bounds, odd inputs."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from carelake.llm import centroid_search as C


def plain(rows, k=40, rounds=5, dim=64):
    """rows: (vec_id, vector) of those that take part."""
    kept = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in rows]
    name = lambda i: (1, "") if i is None else (0, hashlib.sha256(f"2:{i}".encode()).hexdigest())
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        of = assign()
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, a) in zip(kept, of) if a == j]
            if mine:
                centroids[j] = tuple(sum(c) // len(mine) for c in zip(*mine))
    of = assign()
    each = [sum(d for d, a in of if a == j) for j in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, a, d, each[a], sum(each), digest[a]) for (i, _), (d, a) in zip(kept, of)), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_plain_and_sql(spark, small_dir):
    p = spark.read.parquet(f"{small_dir}/embeddings.parquet").toPandas()
    got = rows_of(C.op13_centroids(spark, small_dir))
    assert got == plain(list(zip(p.vec_id.tolist(), p.embedding.tolist())))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small_dir}/embeddings.parquet'")
    assert sorted(con.sql(C.OP13_SQL).fetchall(), key=str) == got


@pytest.mark.parametrize("spread", [1, 3, 300, 1 << 26])
def test_search_is_exact(spread):
    rng = np.random.default_rng(spread)
    c = rng.integers(-spread, spread + 1, (40, 64))
    c[7], c[9] = c[3], c[3][::-1]  # equal; of equal mean and deviation
    x = np.concatenate([rng.integers(-spread, spread + 1, (300, 64)), c, np.zeros((1, 64), np.int64)])
    number, distance = C.nearest_centroid(x, c)
    d = ((x[:, None, :] - c[None]) ** 2).sum(2)
    assert (number == d.argmin(1)).all() and (distance == d.min(1)).all()


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 3)).astype(np.float32).astype(float)
    x[30:70] = x[30]  # a third of all rows are one vector
    good = [(i, v.tolist()) for i, v in enumerate(x)] + [(5, x[5].tolist()), (5, [9.0, 9.0, 9.0]), (None, [1.0, 2.0, 3.0])]
    odd = [(200, None), (201, [1.0, None, 2.0]), (202, [float("nan"), 0.0, 0.0]), (203, [float("-inf"), 0.0, 0.0]), (204, [1.0]), (205, []), (206, [1.0] * 4)]
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in good + odd], "vec_id bigint, embedding array<float>, cluster int, v string")
    for k in (1, 8, 500):
        assert rows_of(C.cluster(df, k=k, dim=3)) == plain(good, k=k, dim=3)
    assert rows_of(C.cluster(df.repartition(7), k=8, dim=3)) == plain(good, k=8, dim=3)
    assert C.cluster(df.limit(0), dim=3).count() == 0
    huge = spark.createDataFrame([(1, [1e38, 0.0]), (2, [-1e300, 1.0])], "vec_id bigint, embedding array<double>")
    limit = C.LARGEST / 256
    assert rows_of(C.cluster(huge, k=1, dim=2)) == plain([(1, [limit, 0.0]), (2, [-limit, 1.0])], k=1, dim=2)
