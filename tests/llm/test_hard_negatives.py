"""Hard negatives: against brute force and DuckDB, several rounds and blocks, hot vectors, odd inputs."""

import math

import duckdb
import numpy as np
from pyspark.sql import functions as F

from carelake.llm import hard_negatives as H


def brute(rows, every=100, lengths=False):
    """rows: (vec_id, label, vector) of those that take part."""
    rows = list({(i, g, tuple(math.floor(256 * float(c)) for c in v)) for i, g, v in rows})
    out = []
    for q, g, v in rows:
        if q % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i, h) for i, h, w in rows if i != q and len(w) == len(v))
        for p, positive, _ in [s for s in scored if s[2] == g][:5]:
            window = [s for s in scored if s[2] != g and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(q, positive, rank, n, -p, -s) for rank, (s, n, _) in enumerate(window, 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def moved(i, g):
    return (g + 1) % 10 if i % 7 == 0 else g


def test_against_brute_force_and_sql(spark, small_dir):
    p = spark.read.parquet(f"{small_dir}/embeddings.parquet").toPandas()
    got = rows_of(H.op11_hard_negatives(spark, small_dir))
    assert got == brute([(i, moved(i, g), v) for i, g, v in zip(p.vec_id.tolist(), p.label.tolist(), p.embedding.tolist())])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small_dir}/embeddings.parquet'")
    assert sorted(con.sql(H.OP11_SQL).fetchall()) == got and got


def test_rounds_blocks_and_hot_vectors(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(12, 8)) * 2
    x = centre[rng.integers(0, 12, 900)] + rng.normal(size=(900, 8)) * 0.05
    x = np.round(x * 16) / 16  # many ties
    x[200:500] = x[0]  # a third of all rows, of several labels, equal to an anchor
    rows = [(i, int(g), v.tolist()) for i, (g, v) in enumerate(zip(rng.integers(0, 3, 900), x))]
    rows += rows[:30] + [(50, 1, rows[7][2]), (50, 1, rows[8][2])]  # equal rows; one id, several vectors
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    want = brute(rows, every=50)
    rounds = []
    walk = H.Index.visits
    H.Index.visits = lambda self, anchors: rounds.append(1) or walk(self, anchors)
    try:
        got = rows_of(H.mine(df, F.col("vec_id") % 50 == 0, first=20, block=30, width=6))
    finally:
        H.Index.visits = walk
    assert got == want and len(rounds) > 2
    assert rows_of(H.mine(df.repartition(5), F.col("vec_id") % 50 == 0)) == want


def test_walk_bounds_everything_unseen():
    rng = np.random.default_rng(5)
    first, second, count = rng.normal(size=7), rng.normal(size=5), rng.integers(0, 4, (7, 5))
    sums = first[:, None] + second
    for want in (1, 10, 30, 10_000):
        seen, bound = H.walk(first, second, count, want)
        assert ((sums <= bound) | seen | (count == 0)).all() and (sums[seen] >= bound).all()
        assert count[seen].sum() >= min(want, count.sum())


def test_odd_rows(spark):
    good = [(0, 1, [1.0, 2.0]), (100, 1, [1.0, 2.0]), (1, 1, [1.0, 1.0]), (2, 2, [0.9, 1.9]), (3, 2, [1.0, 2.0]), (4, 2, [-1.0, -5.0]), (5, 1, [3.0]), (200, 1, [2.0]), (6, 3, [2.0]), (300, 4, []), (7, 4, []), (8, 5, []), (400, 9, [0.0, 0.0])]
    odd = [(500, None, [1.0, 2.0]), (501, 1, None), (502, 2, [None, 2.0]), (503, 2, [float("nan"), 1.0]), (504, 2, [float("inf"), 1.0]), (None, 2, [1.0, 2.0])]
    df = spark.createDataFrame([(i, g, v, 0, "x") for i, g, v in good + odd], "vec_id bigint, label int, embedding array<float>, key int, q string")
    assert rows_of(H.mine(df, F.col("vec_id") % 100 == 0)) == brute(good)
    assert H.mine(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert H.mine(df.where("vec_id = 0"), F.col("vec_id") % 100 == 0).count() == 0
    huge = spark.createDataFrame([(0, 1, [1e300, 1e5]), (1, 1, [1e300, 1e5]), (2, 2, [1e300, 9e4])], "vec_id bigint, label int, embedding array<double>")
    limit = H.isqrt(2**61) / 256
    assert rows_of(H.mine(huge, F.col("vec_id") % 100 == 0)) == brute([(0, 1, [limit, 1e5]), (1, 1, [limit, 1e5]), (2, 2, [limit, 9e4])])
