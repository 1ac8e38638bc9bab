"""Inverted multi-index: recall and exact scores against brute force, blocks, odd inputs."""

import numpy as np
from pyspark.sql import functions as F

from carelake.llm import multi_index as M


def brute(ids, x, k=20):
    out = {}
    for i in sorted({int(i) for i in ids if i % 20 == 0}):
        s = x[[j for j, v in enumerate(ids) if v == i][0]] @ x.T
        near = sorted((-s[j], int(ids[j])) for j in range(len(ids)) if ids[j] != i)[:k]
        out[i] = [(v, -s) for s, v in near]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    p = df.toPandas()
    x = np.array(p.embedding.tolist(), np.float64)
    want, got = brute(p.vec_id.to_numpy(), x), by_query(M.op2_nearest(spark, "/root/testdata/sf0.1").collect())
    assert got.keys() == want.keys()
    hits = [len({v for v, _ in want[q]} & {v for v, _ in got[q]}) / len(want[q]) for q in want]
    assert np.mean(hits) >= 0.9
    place = {int(v): i for i, v in enumerate(p.vec_id)}
    for q in list(got)[:50]:
        assert np.allclose([s for _, s in got[q]], [x[place[q]] @ x[place[v]] for v, _ in got[q]], rtol=0, atol=1e-12)


def test_exact_when_all_lists_are_read(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[40:190] = x[40]  # half of all rows are one vector
    x[200] = 2 * x[40]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    odd = [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] + [1.0] * 7), (1060, [None] + [1.0] * 7), (1080, [float("inf")] * 8), (1100, [1.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, 1.5) for i, v in rows + odd], "vec_id bigint, embedding array<float>, score double")
    want = brute(np.arange(300), x.astype(np.float64))
    for blocks in ((16_384, 4_096), (20, 3)):
        got = by_query(M.search(df, F.col("vec_id") % 20 == 0, probe=1.0, centroids=4, entry_block=blocks[0], query_block=blocks[1]).collect())
        assert got.keys() == want.keys()
        for q in want:
            assert [v for v, _ in got[q]] == [v for v, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]])
    few = M.search(df.where("vec_id < 5"), F.col("vec_id") % 20 == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4]
    assert M.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert M.search(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_walk_goes_by_summed_distance():
    rng = np.random.default_rng(2)
    a, b, count = rng.normal(size=7), rng.normal(size=5), rng.integers(0, 4, (7, 5))
    order = sorted(((a[i] + b[j], i, j) for i in range(7) for j in range(5)))
    for want in (1, 10, 30, 10_000):
        seen, got = np.zeros((7, 5), bool), 0
        for _, i, j in order:
            if got >= want:
                break
            seen[i, j], got = count[i, j] > 0, got + count[i, j]
        assert (M.walk(a, b, count, want) == seen).all()
