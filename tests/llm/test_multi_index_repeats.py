"""Repeated rows of one vector don't push out other ids with an equal vector."""

import numpy as np
from pyspark.sql import functions as F

from carelake.llm import multi_index as M


def test_repeats_are_one_candidate(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 8)).astype(np.float32)
    top = (3 * x[0]).tolist()
    rows = [(i, v.tolist()) for i, v in enumerate(x) if i]
    rows += [(0, top)] * 30 + [(1001, top), (1002, top), (1003, top)] + [(40, x[40].tolist())] * 5
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    out = {}
    for r in M.search(df, F.col("vec_id") % 20 == 0, probe=1.0).collect():
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    distinct = {(i, tuple(np.float32(c) for c in v)) for i, v in rows}
    for q, found in out.items():
        own = next(np.array(v, np.float64) for i, v in distinct if i == q)
        want = sorted((-float(own @ np.array(v, np.float64)), i) for i, v in distinct if i != q)[:20]
        assert [i for _, i in sorted(found)] == [i for _, i in want]
        assert len(found) == 20
    assert [i for _, i in sorted(out[0])][:3] == [1001, 1002, 1003]
