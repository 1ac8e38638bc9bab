"""Every stage of the pipeline against a plain version on its own input, then the whole run."""

import hashlib
from collections import Counter

import numpy as np
import test_pii
from tokenizers import Tokenizer

import corpus_pipeline as C
from carelake.llm import bpe, mixing, quality_crf

COLUMNS = list(C.COLUMNS)


def rows_of(df):
    assert df.columns == COLUMNS
    return [tuple(r) for r in df.collect()]


def near_groups(rows):
    """Groups of rows by links of 80 of 100 five-word shingles, all pairs looked at."""
    sets = []
    for r in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "").encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and group[i] != group[j]:
                x, y = group[i], group[j]
                group = [y if g == x else g for g in group]
    return group, sets


def test_stages(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select(*COLUMNS)
    odd = spark.createDataFrame([(None, None, None, None, None), (90_001, "", "en", None, 0), (None, "some text without a number, once more and again", None, "src1", 1), (90_002, "call +1 555 123 4567 or mail a.b@c.example now", "en", "src2", 45), (90_002, "call +1 555 123 4567 or mail a.b@c.example now", "en", "src2", 45)], docs.schema)
    docs = docs.unionByName(odd)

    field = quality_crf.train(docs, spark.read.parquet(f"{small_dir}/labels.parquet"))
    before = rows_of(docs)
    score = field.score([r[1] or "" for r in before])
    after = C.quality(spark, docs, small_dir)
    assert Counter(rows_of(after)) == Counter(r for r, s in zip(before, score) if s >= 0.3)
    assert len(before) > after.count() > 0.7 * len(before)

    before, nearer = rows_of(after), C.near_duplicates(spark, after, small_dir)
    group, sets = near_groups(before)
    kept = Counter(rows_of(nearer))
    members = {}
    for g, s, r in zip(group, sets, before):
        if s:
            members.setdefault(g, []).append(r)
        else:
            assert kept[r]
    first = [min(m, key=lambda r: (r[0] is None, r[0] or 0)) for m in members.values()]
    assert sum(kept.values()) == len(first) + sum(not s for s in sets)
    assert {r[0] for r in first} == {r[0] for r in kept if (r[1] or "").strip()}
    assert len(before) > sum(kept.values())

    before, safe = rows_of(nearer), C.private(spark, nearer, small_dir)
    after = Counter(rows_of(safe))
    plain = Counter(r for r in before if not test_pii.plain(r[1]))
    assert not plain - after and sum(after.values()) == len(before)
    for r in (after - plain).keys():
        assert not test_pii.plain(r[1]) and r[4] == len(r[1]) and "[" in r[1]

    before, blend = rows_of(safe), C.mixed(spark, safe, small_dir)
    copies = Counter()
    for r in mixing.mix(safe, carry=("text",)).collect():
        copies[r.doc_id, r.text, r.source] += r.copies
    assert Counter((r[0], r[1], r[3]) for r in rows_of(blend)) == +copies
    assert {(r[0], r[1], r[3]) for r in before} >= set(+copies) and set((+copies).values()) >= {1, 2}

    t = Tokenizer.from_file(bpe.default_vocabulary())
    texts = Counter((r[0], r[1] or "") for r in rows_of(blend))
    got = Counter()
    for r in C.tokens(spark, blend, small_dir).collect():
        text = t.decode(np.frombuffer(r.ids, "<u4").tolist(), skip_special_tokens=False)
        assert r.n_tokens * 4 == len(r.ids) and hashlib.sha256(text.encode()).hexdigest() == r.decoded_sha256
        got[r.doc_id, text] += 1
    assert got == texts


def test_run_and_empty(spark, small_dir):
    out = C.run(spark, small_dir).collect()
    assert out and {"doc_id", "n_tokens", "ids", "decoded_sha256"} == set(out[0].asDict())
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").limit(0)
    for name, step in C.STAGES:
        docs = step(spark, docs, small_dir)
        assert docs.count() == 0, name
