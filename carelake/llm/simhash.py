"""Near duplicates by SimHash, found by covering locality-sensitive hashing.

A text's fingerprint has a bit set if more than half of its shingles' hashes
have it set (shingles with repeats; the hash is XXH64, seed 42, of the lower-cased
words joined by one space). Fingerprints link if they differ in at most
``radius`` bits; a group is what links connect.

Covering: every bit position gets a non-zero vector of radius + 1 bits, and each
of the 2^(radius + 1) - 1 non-zero vectors w is a table that masks the positions
whose vector has an odd product with w. Two fingerprints that differ in at most
``radius`` positions collide in some table: the vectors of those positions do
not span the space, so some w is orthogonal to all of them, and its mask leaves
them all out. Nothing is missed, whatever the data.

Equal texts and equal fingerprints are one entry. An entry goes to one bucket
of each table; buckets are counted first, and a bucket of one is done. A
bucket above ``bucket`` entries is parted by covering again, over the positions
that its mask leaves free (its entries agree on the others): 64 positions leave
some 30, 14, then at most 8 free, so three rounds bound a bucket by 256 entries whatever
the data, and no bucket is ever compared in pieces or cut. Within a bucket a task
finds its components and sends one link for each entry but the first.

Cases: a null, empty or blank text has fingerprint zero and is linked like any
other; fewer words than a shingle are one shingle; rows that repeat a doc_id
stand for themselves; a null doc_id comes last and names a component only
without other members; an empty table gives an empty result; only doc_id and
text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import read_table, stage, text_slices
from carelake.llm.components import components

SHINGLE, RADIUS, SEED, BITS = 3, 3, 42, 64
#: Entries of a bucket that one task compares; shingles hashed and pairs compared at a time.
BUCKET, CHUNK, PAIRS = 1_024, 200_000, 4_000_000
#: Entries of one task's buckets, about.
TASK = 500_000
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACES = b"\t\n\v\f\r"


def fingerprint(text: str, size: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of one text."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).translate(bytes.maketrans(_SPACES, b" " * len(_SPACES)))
    words = [w for w in words.split(b" ") if w]
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words))) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - size + 1)
    ends = ends[-n:] if len(words) >= size else ends[-1:]
    count = np.zeros(BITS, np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        h = np.fromiter((hashed(line[a:b], seed) for a, b in zip(starts[at : min(n, at + CHUNK)].tolist(), ends[at : at + CHUNK].tolist())), np.uint64)
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        count += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > n).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                made = np.fromiter((fingerprint(t, size, seed) for t in texts), np.uint64, len(texts))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(made.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, fp bigint")


@lru_cache(maxsize=4_096)
def masks(path: tuple[int, ...], radius: int = RADIUS, bits: int = BITS) -> tuple[int, tuple[int, ...]]:
    """The positions a path of tables keeps, and what each next table keeps of them and of the free ones."""
    kept = 0
    for depth, w in enumerate(path):
        kept = masks(path[:depth], radius, bits)[1][w - 1]
    free = [i for i in range(bits) if not kept >> i & 1]
    vectors = (1 << (radius + 1)) - 1
    vector = {i: 1 + k % vectors for k, i in enumerate(free)}
    following = tuple(kept | sum(1 << i for i in free if (vector[i] & w).bit_count() & 1) for w in range(1, vectors + 1))
    return kept, following


def buckets(entries: DataFrame, radius: int) -> DataFrame:
    """path, key and fp: the bucket of each table for every entry (path: the tables so far, one byte each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            paths, of = np.unique(np.array([p.hex() for p in batch.column("path").to_pylist()]), return_inverse=True)
            for i, name in enumerate(paths):
                path, mine = bytes.fromhex(str(name)), fp[of == i]
                for w, mask in enumerate(masks(tuple(path), radius)[1], 1):
                    key = (mine.view(np.uint64) & np.uint64(mask)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([path + bytes([w])] * len(mine), pa.binary()), pa.array(key), pa.array(mine)], names=["path", "key", "fp"])

    return entries.mapInArrow(run, "path binary, key bigint, fp bigint")


def near_components(fp: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """First place of every entry's component: entries of one group within ``radius`` bits are linked. Groups are adjacent."""
    n = len(fp)
    root = np.arange(n)
    one, other = [], []
    i = np.arange(n - 1)
    apart = 1
    while len(i):
        i = i[i + apart < n]
        i = i[group[i] == group[i + apart]]
        near = i[np.bitwise_count(fp[i] ^ fp[i + apart]) <= radius]
        one.append(near)
        other.append(near + apart)
        apart += 1
    one, other = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in (one, other))
    while True:  # smallest place around, then the roots' roots
        least = root.copy()
        np.minimum.at(least, root[one], root[other])
        np.minimum.at(least, root[other], root[one])
        least = least[least[root]]
        if (least == root).all():
            return root
        root = least


def links_within(held: DataFrame, radius: int, tasks: int) -> DataFrame:
    """a and b: links that connect what is within ``radius`` in the buckets; an entry but the first of each component gives one."""

    def link(fp: np.ndarray, path: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(fp), bool)
        new[1:] = (key[1:] != key[:-1]) | (path[1:] != path[:-1])
        group = np.cumsum(new)
        begin = np.append(np.flatnonzero(new), len(fp))
        work = np.cumsum(np.diff(begin) ** 2)
        a, b, at = [], [], 0
        while at < len(work):  # some groups at a time
            to = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + PAIRS, side="right")))
            lo, hi = begin[at], begin[to]
            part = fp[lo:hi]
            root = near_components(part.view(np.uint64), group[lo:hi], radius)
            moved = np.flatnonzero(root != np.arange(hi - lo))
            a.append(part[moved])
            b.append(part[root[moved]])
            at = to
        a, b = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in (a, b))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64), np.zeros(0, "S8"), np.zeros(0, np.int64)]
        for batch in batches:
            new = [batch.column("fp").to_numpy(), np.array([p.hex() for p in batch.column("path").to_pylist()], "S8"), batch.column("key").to_numpy()]
            fp, path, key = (np.concatenate(p) for p in zip(rest, new))
            last = np.flatnonzero((key != key[-1]) | (path != path[-1]))
            cut = last[-1] + 1 if len(last) else 0  # the last bucket may go on in the next batch
            rest = [fp[cut:], path[cut:], key[cut:]]
            if cut:
                yield link(fp[:cut], path[:cut], key[:cut])
        if len(rest[0]):
            yield link(*rest)

    dealt = held.repartition(tasks, "path", "key").sortWithinPartitions("path", "key", "fp")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def near_links(entries: DataFrame, radius: int = RADIUS, bucket: int = BUCKET, task: int = TASK) -> DataFrame:
    """a, b: links that connect all fp of ``entries`` (distinct) that are within ``radius`` bits, directly or by others."""
    open_ = entries.select(F.lit(b"").cast("binary").alias("path"), "fp")
    found = None
    for _ in range(BITS):
        dealt = stage(buckets(open_, radius), "simhash-buckets")
        sizes = dealt.groupBy("path", "key").agg(F.count("*").alias("n")).where("n > 1")
        sizes = stage(sizes, "simhash-sizes")
        totals = sizes.agg(F.coalesce(F.sum(F.when(F.col("n") <= bucket, F.col("n"))), F.lit(0)).alias("small"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
        small = dealt.join(sizes.where(F.col("n") <= bucket).drop("n"), ["path", "key"], "left_semi")
        links = stage(links_within(small, radius, 1 + int(totals.small // task)).distinct(), "simhash-links")
        found = links if found is None else found.unionByName(links)
        if totals.most <= bucket:
            return found
        open_ = dealt.join(sizes.where(F.col("n") > bucket).drop("n"), ["path", "key"], "left_semi").select("path", "fp")
    return found


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, seed: int = SEED, bucket: int = BUCKET, task: int = TASK) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    rows = stage(fingerprints(docs, size, seed), "simhash-fingerprints")
    entries = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-entries")
    linked = components(near_links(entries, radius, bucket, task), "a", "b")
    of = entries.join(linked, entries.fp == linked.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    first = of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of.join(first, "root").select("fp", "component_id")
    code = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(named, "fp").select("doc_id", code.alias("fingerprint"), "component_id")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))
