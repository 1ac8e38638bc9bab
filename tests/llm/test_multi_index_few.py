"""Few vectors: every query gets k neighbours, or all there are."""

import numpy as np
from pyspark.sql import functions as F

from carelake.llm import multi_index as M


def test_few_vectors(spark):
    x = np.random.default_rng(4).normal(size=(31, 8))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    for n in (15, 21, 24, 31):
        df = spark.createDataFrame(rows[:n], "vec_id bigint, embedding array<float>")
        got = {r.query_id: r.n for r in M.search(df, F.col("vec_id") % 10 == 0).groupBy("query_id").agg(F.count("*").alias("n")).collect()}
        assert got == {q: min(20, n - 1) for q in range(0, n, 10)}
