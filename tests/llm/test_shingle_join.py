"""Jaccard join: components against all pairs, with small blocks, chunks and groups; the trie alone; odd rows."""

import numpy as np
import pytest

from carelake.llm import shingle_join as J
from carelake.llm.components import components


def plain_set(t):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
    return frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) > 3 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders[g] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 85 * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def made_rows():
    rng = np.random.default_rng(9)
    vocab = [f"W{i}" if i % 2 else f"w{i}é" for i in range(500)]
    rows = []
    for base in range(12):
        words = [vocab[i] for i in rng.integers(0, 500, int(rng.integers(5, 120)))]
        for _ in range(int(rng.integers(1, 25))):  # near copies, with more or fewer changes
            w = list(words)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(0, len(w)))] = vocab[int(rng.integers(0, 500))]
            rows.append((int(rng.integers(0, 10**6)), " ".join(w)))
    tail = " ".join(vocab[:60])
    rows += [(2_000_000 + i, f"a{i} b{i} c{i} d{i} e{i} " + tail + f" f{i}" * (i % 12)) for i in range(60)]
    rows += [(1, "A b C"), (2, "a B c"), (3, "a"), (4, "a"), (5, None), (6, ""), (None, "a"), (None, tail), (None, "only null here"), (1, tail), (1, tail), (7, " \t "), (8, "x " * 500), (9, "x " * 400)]
    return rows


@pytest.mark.parametrize("small", [{}, {"block_bytes": 3000, "bucket_shingles": 200, "chunk_sets": 7, "group_bytes": 5000}])
def test_components_match_all_pairs(spark, small):
    rows = made_rows()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, node string")
    assert sorted(map(tuple, J.join_shingles(df, **small).select('doc_id', 'n_shingles', 'component_id').collect()), key=str) == brute(rows)


def test_corpus(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(map(tuple, J.op6_shingle_join(spark, sf).collect()), key=str)
    assert got == brute(rows)
    assert any(d != c for d, _, c in got)


def test_empty(spark):
    assert J.join_shingles(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_trie():
    rng = np.random.default_rng(1)
    for trial in range(60):
        m, universe = int(rng.integers(2, 25)), int(rng.integers(8, 60))
        base = rng.choice(universe, int(rng.integers(1, universe)), replace=False)
        sets = {tuple(sorted(set(base.tolist()) ^ set(rng.integers(0, universe, int(rng.integers(0, 4))).tolist()))) for _ in range(m)} - {()}
        sets = [np.array(s, np.uint64) for s in sorted(sets)]
        other = rng.integers(0, 2, len(sets)) if trial % 2 else None
        root = list(range(len(sets)))
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                both = len(set(a.tolist()) & set(b.tolist()))
                if 100 * both >= 85 * (len(a) + len(b) - both) and (other is None or other[i] != other[j]):
                    x, y = root[i], root[j]
                    root = [y if r == x else r for r in root]
        got = J.trie_components(sets, other).tolist()
        same = lambda c: [[x == y for x in c] for y in c]
        assert same(got) == same(root)


def test_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (None, 3), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
