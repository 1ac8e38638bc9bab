"""I-Match: the rows against a plain rewrite, likeness of copies, odd inputs."""

import hashlib
from collections import Counter

import numpy as np

from carelake.llm import imatch as I


def plain_rows(rows, lexicon):
    rows = sorted(((i is not None, i if i is not None else 0, t or "") for i, t in rows), key=lambda r: (-r[0], -r[1], r[2]))
    out = []
    for k, (some, i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][2]
        h = len(t) // 2
        e = t[: len(t) - h] + nxt[:h]
        a, b, c = I.fingerprints([t, e, nxt], lexicon)
        out.append((i if some else None, len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, I.likeness(a, b), I.likeness(a, c)))
    return out


def test_rows_match_plain_rewrite(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    lexicon = I.build_lexicon(df)
    n, counts = 0, Counter()
    for r in df.collect():
        n += 1
        _, term = I.document_terms([r.text])
        counts.update(term[I.drawn(term)].tolist())
    assert lexicon.tolist() == sorted(t for t, c in counts.items() if max(2, I.LOW * n) <= c <= max(2, I.HIGH * n))
    got = list(map(tuple, I.with_edits(df, lexicon, part_bytes=150_000).collect()))
    want = plain_rows([tuple(r) for r in df.collect()], lexicon)
    assert sorted(got) == sorted(want)
    edited, following = (np.mean([r[k] for r in got]) for k in (5, 6))
    assert edited > 0.15 and edited > 3 * following, (edited, following)


def test_equal_and_near_texts():
    rng = np.random.default_rng(0)
    vocab = ["w%d" % i for i in range(3000)]
    words = [vocab[i] for i in rng.integers(0, 3000, 400)]
    near = words[:200] + ["changed"] + words[201:]
    lexicon = np.sort(I.document_terms([" ".join(vocab)])[1])
    a, b, c, d = I.fingerprints([" ".join(words), " ".join(near), " ".join(words), " ".join(vocab[i] for i in rng.integers(0, 3000, 400))], lexicon)
    assert a == c and I.likeness(a, b) > 0.7 > 0.2 > I.likeness(a, d)


def test_odd_rows(spark):
    rows = [(None, None), (None, "x y"), (3, ""), (3, ""), (5, "Only one TERM"), (5, "a"), (-7, "\U0001f600" * 9), (2**62, "z " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("part", I.F.lit("clash"))
    lexicon = I.build_lexicon(df)
    for size in (10, 10**9):
        assert sorted(map(str, map(tuple, I.with_edits(df, lexicon, size).collect()))) == sorted(map(str, plain_rows(rows, lexicon)))
    assert I.with_edits(df.limit(0), lexicon).count() == 0
    assert I.with_edits(df.where("doc_id = 5 and text = 'a'"), lexicon).first().near_next == 1.0
    assert I.fingerprint(df, lexicon).count() == len(rows)
