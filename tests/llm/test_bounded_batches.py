"""Batches of whole texts that go to Python follow their bytes, and scores don't depend on how texts are cut."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from carelake.llm import bpe, common
from carelake.llm import quality_crf as Q
from carelake.session import BATCH_BYTES

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unset(spark):
    before = spark.conf.get(KEY, None)
    spark.conf.unset(KEY)
    yield
    spark.conf.unset(KEY) if before is None else spark.conf.set(KEY, before)


def sizes(df):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    return [tuple(r) for r in df.mapInArrow(run, "n bigint, bytes bigint").collect()]


def field():
    x, _, lines = Q.line_measures(["good words here.\nand more of them", "### ||| ###"])
    return Q.fit(x, lines, np.array([1, 0]), rounds=5)


LAZY = {
    "train": lambda docs: Q.train(docs, docs.select("doc_id", F.lit(1).alias("quality"))),
    "score": lambda docs: Q.score_documents(docs, field()),
    "encode": lambda docs: bpe.bpe_encode(docs),
}


@pytest.mark.parametrize("name", LAZY)
def test_batches_follow_bytes(spark, unset, name):
    long = spark.range(0, 3_000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words\n"), 400).alias("text"))
    LAZY[name](long.limit(5))
    found = sizes(long)
    assert sum(n for n, _ in found) == 3_000 and len(found) > 2
    assert max(b for _, b in found) < 2 * BATCH_BYTES


def test_a_setting_of_the_caller_is_kept(spark, unset):
    spark.conf.set(KEY, "1m")
    Q.score_documents(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), field())
    assert spark.conf.get(KEY) == "1m"


def test_scores_of_any_cut(spark, unset):
    rng = np.random.default_rng(5)
    texts = ["\n".join("word " * int(n) + "!!" * int(n % 3) for n in rng.integers(0, 40, int(k))) for k in rng.integers(1, 60, 700)]
    texts += [None, "", "x" * (Q.SLICE + 7) + "\n|", "\n" * 40]
    want = field().score([t or "" for t in texts])
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = [p for _, p in common.text_slices(batch, "text", Q.SLICE)]
    assert len(parts) > 3 and np.array_equal(np.concatenate([field().score(p) for p in parts]), want)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: r.quality_score for r in Q.score_documents(docs, field()).collect()}
    assert [got[i] for i in range(len(texts))] == want.tolist()
