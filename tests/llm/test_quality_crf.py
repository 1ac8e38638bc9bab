"""The line field: marginals against enumeration, accuracy on held-out documents, odd inputs."""

import itertools

import numpy as np

from carelake.llm import quality_crf as Q


def test_marginals_match_enumeration():
    rng = np.random.default_rng(3)
    lines = np.array([1, 4, 2, 4, 3])
    good = rng.normal(size=lines.sum())
    start, step = rng.normal(size=2), rng.normal(size=(2, 2))
    p, first, steps = Q.forward_backward(good, lines, start, step)
    want, want_first, want_steps, at = [], np.zeros(2), np.zeros((2, 2)), 0
    for n in lines:
        g = good[at : at + n]
        at += n
        paths = list(itertools.product((0, 1), repeat=int(n)))
        w = np.array([np.exp(start[y[0]] + sum(g[i] * y[i] for i in range(n)) + sum(step[a, b] for a, b in zip(y, y[1:]))) for y in paths])
        w /= w.sum()
        want += [sum(wi for wi, y in zip(w, paths) if y[i]) for i in range(n)]
        for wi, y in zip(w, paths):
            want_first[y[0]] += wi
            for a, b in zip(y, y[1:]):
                want_steps[a, b] += wi
    assert np.allclose(p, want) and np.allclose(first, want_first) and np.allclose(steps, want_steps)


def test_held_out_accuracy_and_columns(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = Q.op5_quality(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    told = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert np.mean([r.predicted == labels[r.doc_id] for r in told]) >= 0.95
    assert np.mean([r.predicted for r in told if labels[r.doc_id] == 1]) >= 0.97


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "fine words here.\nmore of them", "a"), (None, None, "b"), (3, "", "c"), (1, "fine words here.\nmore of them", "a"), (4, "x" * 300_000 + "\n" * 50, "d")], "doc_id bigint, text string, quality_score string")
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 1), (7, None), (None, 1)], "doc_id bigint, quality int")
    field = Q.train(docs, labels)
    out = Q.score_documents(docs, field).collect()
    assert len(out) == 5 and all(0 <= r.quality_score <= 1 for r in out)
    assert Q.train(docs, labels.limit(0)).constant == 1.0
    assert Q.score_documents(docs.limit(0), field).count() == 0


def test_same_measures_in_any_company():
    texts = ["A line.\nTwo two two!!", "", "###\n\n|x|"]
    x, weight, lines = Q.line_measures(texts)
    alone = [Q.line_measures([t]) for t in texts]
    assert np.allclose(x, np.concatenate([a[0] for a in alone]))
    assert lines.tolist() == [2, 1, 3] and weight.tolist() == np.concatenate([a[1] for a in alone]).tolist()
