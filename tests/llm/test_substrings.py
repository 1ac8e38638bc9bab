"""Both substring operators against brute force, with small blocks, shards and hot limits; their index against scans."""

import hashlib
from dataclasses import replace

import numpy as np
import pytest

from carelake.llm import substring_dedup as S
from carelake.llm import suffix_dedup as B
from carelake.llm.succinct import FmIndex, WaveletTree

LAST = 2**63 - 1


def brute_bytes(rows, length=50):
    rows = [(LAST if i is None else i, (t or "").encode(), i) for i, t in rows]
    first = {}
    for at, b, _ in rows:
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            first[s] = min(first.get(s, at), at)
    out = []
    for at, b, i in rows:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < at:
                gone[p : p + length] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()) if len(b) else 0
        out.append((i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_words(rows, length=20):
    rows = [(LAST if i is None else i, (t or "").encode().split(), i) for i, t in rows]
    first = {}
    for at, w, _ in rows:
        for p in range(len(w) - length + 1):
            s = tuple(w[p : p + length])
            first[s] = min(first.get(s, (at, p)), (at, p))
    out = []
    for at, w, i in rows:
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p : p + length])] < (at, p):
                gone[p : p + length] = [True] * length
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def rows_of(df, columns):
    return sorted((tuple(r[c] if c != "sha" else hashlib.sha256(bytes(r.kept) if isinstance(r.kept, (bytes, bytearray)) else r.kept.encode()).hexdigest() for c in columns) for r in df.collect()), key=str)


def odd_rows():
    rng = np.random.default_rng(4)
    vocab = [f"w{i}é" for i in range(40)]
    passage = " ".join(vocab[i] for i in rng.integers(0, 40, 30))
    rows = [(int(i), " ".join(vocab[j] for j in rng.integers(0, 40, n))) for i, n in enumerate(rng.integers(0, 90, 60))]
    rows += [(100 + i, f"x{i} y{i * i} " + passage + f" end{i}") for i in range(70)]  # one passage in many
    rows += [(300 + i, passage) for i in range(30)]  # copies
    rows += [(400, "a " * 300), (401, "ab" * 400), (402, "\t\n a\x0bb \x0c" * 40), (403, passage + " " + passage), (404, None), (405, ""), (None, passage), (None, None), (300, passage), (300, passage + " z"), (-5, passage[:120]), (2**62, passage * 3)]
    return rows


@pytest.mark.parametrize("hot", [20_000, 5])
def test_odd_rows(spark, hot):
    rows = odd_rows()
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, block int")
    small = {"block_bytes": 4_000, "bucket_grams": 300, "shard_bytes": 5_000, "hot": hot, "longest": 16}
    got = B.remove_repeats(df, plan=replace(B.BYTES, **small))
    assert rows_of(got, ["doc_id", "n_bytes", "n_removed", "n_spans", "sha"]) == brute_bytes(rows)
    got = S.remove_passages(df, plan=replace(S.WORDS, **small))
    assert rows_of(got, ["doc_id", "n_words", "n_removed", "sha"]) == brute_words(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert B.remove_repeats(df).count() == 0 and S.remove_passages(df).count() == 0
    df = spark.createDataFrame([(1, None)], "doc_id bigint, text string")
    assert B.remove_repeats(df).first().n_bytes == 0 and S.remove_passages(df).first().kept == ""


def test_corpus(spark, small_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    got = B.op9_suffix_dedup(spark, small_dir)
    assert sorted(map(tuple, got.collect()), key=str) == brute_bytes(rows)
    got = S.op4_substring_dedup(spark, small_dir)
    assert sorted(map(tuple, got.collect()), key=str) == brute_words(rows)


def test_index():
    rng = np.random.default_rng(0)
    for n, s, depth in ((60, 2, 5), (300, 5, 6), (500, 90, 4)):
        text = rng.integers(0, s, n)
        text = np.append(np.concatenate([text, text[10:50], text[5:55]]) + 1, 0)
        index = FmIndex(text, depth)
        at = index.order
        want = [True] + [tuple(text[a : a + depth]) != tuple(text[b : b + depth]) for a, b in zip(at, at[1:])] + [True]
        assert index.boundaries(depth).tolist() == want
        for p in range(0, n - depth, 7):
            low, high = np.array([0]), np.array([len(text)])
            for c in text[p : p + depth][::-1]:
                low, high = index.extend(np.array([c]), low, high)
            assert sorted(at[low[0] : high[0]]) == [i for i in range(len(text)) if tuple(text[i : i + depth]) == tuple(text[p : p + depth])]
        tree = WaveletTree(text, int(text.max()).bit_length())
        for a, b in ((0, 7), (3, 50), (20, 21), (5, 5)):
            which, symbol, low, high = tree.split(np.array([a]), np.array([b]))
            assert sorted(zip(symbol.tolist(), low.tolist(), high.tolist())) == [(c, (text[:a] == c).sum(), (text[:b] == c).sum()) for c in sorted(set(text[a:b].tolist()))]
