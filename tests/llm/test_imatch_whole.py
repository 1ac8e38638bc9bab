"""I-Match with the whole vocabulary: all band terms are in the lexicon, and every one of them shows in a fingerprint."""

from collections import Counter

import numpy as np

from carelake.llm import imatch as I


def test_all_terms_of_the_band(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = [r.text or "" for r in df.collect()]
    counts = Counter(I.document_terms(texts)[1].tolist())
    lexicon, n = I.build_lexicon(df), len(texts)
    assert lexicon.tolist() == sorted(t for t, c in counts.items() if max(2, I.LOW * n) <= c <= max(2, I.HIGH * n))
    kept = {}
    for t, f in zip(texts, I.fingerprints(texts, lexicon)):
        _, term = I.document_terms([t])
        own = term[np.isin(term, lexicon)]
        kept.setdefault(f, set()).add((own if len(own) else term).tobytes())
        assert f.startswith("text:") == (len(term) == 0)
    assert all(len(s) == 1 for s in kept.values())  # equal fingerprints: equal kept terms


def test_every_term_shows():
    words = ["w%d" % i for i in range(200)]
    lexicon = np.sort(I.document_terms([" ".join(words)])[1])
    marks = I.fingerprints(words + [" ".join(words[:i] + words[i + 1 :]) for i in range(200)], lexicon)
    assert not any(m.startswith("text:") for m in marks) and len(set(marks)) == 400
