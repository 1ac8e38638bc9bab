"""SimHash: fingerprints word by word, all pairs within the radius, parted buckets, odd inputs."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from carelake.llm import simhash as S


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius=3):
    """Smallest place reachable from every place."""
    root = list(range(len(fps)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(fps))]


def test_against_plain(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").orderBy("doc_id").collect()
    fps = [plain_fingerprint(d.text) for d in docs]
    want = [(d.doc_id, f"{f:016x}", docs[c].doc_id) for d, f, c in zip(docs, fps, plain_components(fps))]
    assert sorted(tuple(r) for r in S.op12_simhash(spark, small_dir).collect()) == want
    assert len({c for _, _, c in want}) < len(want)


@pytest.mark.parametrize("depth", [0, 1, 2])
def test_every_pair_within_the_radius_collides(depth):
    rng = random.Random(depth)
    for _ in range(300):
        path = tuple(rng.randint(1, 15) for _ in range(depth))
        kept, following = S.masks(path)
        free = [i for i in range(64) if not kept >> i & 1]
        differ = sum(1 << i for i in rng.sample(free, 3))
        assert any(differ & m == 0 for m in following)
        assert all(m & kept == kept for m in following)


def test_three_rounds_bound_a_bucket():
    most = 0
    for path in itertools.product(range(1, 16), repeat=3):
        most = max(most, 64 - S.masks(path)[0].bit_count())
    assert 1 << most <= 256 < S.BUCKET


def links_of(spark, fps, **how):
    signed = np.array(sorted(set(fps)), np.uint64).view(np.int64).tolist()
    got = S.near_links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), **how).collect()
    names = [f & (2**64 - 1) for f in signed]
    place = {f: i for i, f in enumerate(signed)}
    root = list(range(len(signed)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for r in got:
        assert ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 64
        a, b = sorted((find(place[r.a]), find(place[r.b])))
        root[b] = a
    return [find(i) for i in range(len(names))], plain_components(names)


def test_parted_buckets_lose_nothing(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    # Few free positions: one bucket holds most entries in most tables, at every depth.
    places = rng.sample(range(64), 11)
    fps = {base ^ sum(1 << p for p in places if rng.random() < 0.5) for _ in range(500)}
    fps |= {rng.getrandbits(64) for _ in range(200)}
    fps |= {f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for f in list(fps)[:150]}
    for how in ({}, {"bucket": 130, "task": 100}, {"bucket": 8, "task": 1_000}):
        got, want = links_of(spark, fps, **how)
        assert got == want


def test_odd_rows(spark):
    rng = random.Random(2)
    words = [f"word{i}" for i in range(400)]
    long = " ".join(rng.choice(words) for _ in range(60_000))
    texts = ["", None, " \t\n", "One", "one", "one two", "ONE\ttwo\v three", "one two three", "één twee drie", "ÉÉN twee drie", "  a b", long, long + " more", "x" * 200_000, "a b c " * 500, "\x00\x1f \x7f b"]
    rows = [(i, t, "s", i) for i, t in enumerate(texts)] + [(3, "One", "s", 1), (3, "other words here", "s", 1), (None, "nameless text of its own", "s", 1), (None, long, "s", 1)]
    rows += [(1000 + i, "copied text of many rows", "hot", 0) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint string, fp bigint")
    got = sorted((tuple(r) for r in S.near_duplicates(df).collect()), key=str)
    fps = [plain_fingerprint(r[1]) for r in rows]
    groups = plain_components(fps)
    least = {g: min((rows[i][0] for i, h in enumerate(groups) if h == g and rows[i][0] is not None), default=None) for g in groups}
    assert got == sorted(((r[0], f"{f:016x}", least[g]) for r, f, g in zip(rows, fps, groups)), key=str)
    assert S.near_duplicates(df.limit(0)).count() == 0
