"""Span hashes over a prime field: against Python's integers, structured strings, long spans; op4, op6 and op9 on such strings."""

import itertools
import time

import numpy as np
import pytest

from carelake.llm import words as W
from carelake.llm.shingle_join import join_shingles
from carelake.llm.substring_dedup import remove_passages
from carelake.llm.suffix_dedup import remove_repeats


def plain(symbols):
    return sum((int(c) % W._PRIME + 1) % W._PRIME * pow(W._BASE, i, W._PRIME) for i, c in enumerate(symbols)) % W._PRIME


def thue_morse(n, a, b):
    bits = [i.bit_count() & 1 for i in range(n)]
    return "".join(b if x else a for x in bits), "".join(a if x else b for x in bits)


def test_against_integers():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, W._PRIME, 500, dtype=np.uint64), rng.integers(0, W._PRIME, 500, dtype=np.uint64)
    a[:3], b[:3] = W._PRIME - 1, [W._PRIME - 1, 0, 1]
    assert W.field_product(a, b).tolist() == [int(x) * int(y) % W._PRIME for x, y in zip(a, b)]
    for buf in (rng.integers(0, 256, 3000, dtype=np.uint8), rng.integers(0, 2**63, 3000, dtype=np.uint64)):
        start = np.sort(rng.integers(0, 2900, 200))
        end = np.maximum.accumulate(start + rng.integers(0, 100, 200))
        want = W.mix(np.array([plain(buf[i:j]) for i, j in zip(start, end)], np.uint64))
        assert (W.prime_hashes(buf, start, end) == want).all()


def test_long_spans_and_chunks(monkeypatch):
    rng = np.random.default_rng(2)
    buf = rng.integers(0, 256, 4000, dtype=np.uint8)
    start, end = np.array([0, 5, 100, 1000, 3990]), np.array([4, 60, 999, 3700, 4000])
    whole = W.prime_hashes(buf, start, end)
    monkeypatch.setattr(W, "FIELD_CHUNK", 64)
    monkeypatch.setattr(W, "_FIELD", ())
    assert (W.prime_hashes(buf, start, end) == whole).all() and len(W._FIELD[0]) <= 65


@pytest.mark.parametrize("n", [512, 1024, 2048])
def test_structured_strings_differ(n):
    letters = [chr(c) for c in range(33, 127)]
    words = [w for a, b in itertools.combinations(letters[:: 1 if n == 1024 else 5], 2) for w in thue_morse(n, a, b)]
    buf, start, end, _ = W.words_of(words)
    assert len(np.unique(W.prime_hashes(buf, start, end))) == len(words)


@pytest.mark.parametrize("n", [512, 1024, 2048])
def test_operators_tell_structured_words_apart(spark, n):
    one, two = thue_morse(n, "a", "b")
    three, four = thue_morse(n, "0", "z")
    filler = " ".join(f"w{i}" for i in range(40))
    docs = [(1, one), (2, two), (3, three), (4, four)]
    docs += [(10, f"{one} {filler}"), (11, " ".join(f"{two}" if i % 2 else f"v{i}" for i in range(20))), (12, " ".join(f"{one}" if i % 2 else f"v{i}" for i in range(20)))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in join_shingles(df).collect()} == {i: i for i, _ in docs}
    assert all(r.n_removed == 0 for r in remove_passages(df).collect())
    # the strings of bytes: only what another document truly holds goes
    got = {r.doc_id: bytes(r.kept) for r in remove_repeats(df.where("doc_id < 5"), length=n).collect()}
    assert got == {i: t.encode() for i, t in docs[:4]}


def test_cost_is_that_of_a_few_passes():
    buf = np.random.default_rng(3).integers(97, 123, 4_000_000, dtype=np.uint8)
    buf[::6] = 32
    start, end = W.find_words(buf)
    W.prime_hashes(buf, start, end)
    t = time.perf_counter()
    W.prime_hashes(buf, start, end)
    new = time.perf_counter() - t
    t = time.perf_counter()
    W.hash_spans(buf, start, end)
    assert new < 1 + 20 * (time.perf_counter() - t)


def test_large_sets_are_cut_by_bytes(spark):
    """Near copies of a long text: chunks of two sets each find the same groups as one chunk."""
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in rng.integers(0, 5000, 3000)]
    rows = []
    for i in range(12):
        mine = list(words)
        mine[100 * i : 100 * i + 5] = [f"x{i}{j}" for j in range(5)]
        rows.append((i, " ".join(mine)))
    rows.append((50, " ".join(f"w{i}" for i in rng.integers(0, 5000, 3000))))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {i: 0 for i in range(12)} | {50: 50}
    for size in (8_000_000, 48_000):
        assert {r.doc_id: r.component_id for r in join_shingles(df, chunk_bytes=size).collect()} == want
