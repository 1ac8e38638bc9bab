"""I-Match fingerprints with randomised lexicons.

The lexicon holds all terms whose document frequency lies in a band (as shares
of all documents, so an idf band). Its size is bounded: a term needs ``low`` of
all documents, so there are at most (distinct terms of a mean document) / low
of them, whatever the number of documents; that is why it may be broadcast.
Frequencies are counted over all documents and all terms.

A document keeps its distinct lexicon terms in sorted order. ``SUBSETS`` random
sub-lexicons part the vocabulary by hash, so that every term belongs to exactly
one of them; each gives one 32-bit hash of the kept terms that belong to it, 0
where there is none. Fingerprints with equal hashes throughout thus mean equal
kept terms. The likeness of two fingerprints is the share of equal hashes among
the sub-lexicons in which one of the two has terms.

Cases: a text without lexicon terms uses all its distinct terms instead; if it
has none (null, empty and blank texts, null counting as empty) the fingerprint
is a hash of the text, with likeness 1 to itself and 0 to others. Equal texts have equal fingerprints. Repeated rows
give repeated results; rows that share a doc_id follow each other in text
order; a null doc_id comes after all others; the next document of a single
row is that row. An empty table gives an empty result. Only doc_id and text
are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import read_table, text_slices
from carelake.llm.words import _powers, find_words, hash_spans, join_texts, mix

#: The idf band as shares of documents; the share of the vocabulary that is counted: all of it.
LOW, HIGH, DRAWN = 0.001, 0.1, 1.0
SUBSETS = 128
#: Text bytes of a group of neighbours.
PART_BYTES = 12_000_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
LAST = -(2**63)


def document_terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, term hash) pairs, sorted."""
    buf, at = join_texts(texts)
    buf = _LOWER[buf]
    start, end = find_words(buf)
    doc = np.searchsorted(at, start, side="right") - 1
    term = hash_spans(buf, start, end)
    order = np.lexsort((term, doc))
    doc, term = doc[order], term[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
    return doc[new], term[new]


def drawn(term: np.ndarray) -> np.ndarray:
    """Terms that are counted."""
    return mix(term ^ np.uint64(0x5DEECE66D)) >> np.uint64(11) < np.uint64(int(DRAWN * 2**53))


def membership(term: np.ndarray) -> np.ndarray:
    """The sub-lexicon of a term."""
    return ((mix(term + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) * np.uint64(SUBSETS) >> np.uint64(32)).astype(np.int64)


def fingerprints(texts: list[str], lexicon: np.ndarray) -> list[str]:
    """``lexicon``: sorted term hashes."""
    n = len(texts)
    doc, term = document_terms(texts)
    place = np.minimum(np.searchsorted(lexicon, term), max(0, len(lexicon) - 1))
    kept = lexicon[place] == term if len(lexicon) else np.zeros(len(term), bool)
    without = np.bincount(doc[kept], minlength=n) == 0
    kept |= without[doc]
    doc, term = doc[kept], term[kept]
    own = doc * SUBSETS + membership(term)
    order = np.argsort(own, kind="stable")
    own, t = own[order], term[order]
    out = np.zeros(n * SUBSETS, np.uint32)
    if len(t):
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        power, inverse = _powers(len(t))
        summed = np.add.reduceat(mix(t) * power, first) * inverse[first]  # the terms in order, as a polynomial
        out[own[first]] = (mix(summed) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    out = out.reshape(n, SUBSETS)
    empty = ~out.any(axis=1)
    return ["text:" + hashlib.sha256(texts[i].encode()).hexdigest() if empty[i] else out[i].astype(">u4").tobytes().hex() for i in range(n)]


def likeness(a: str, b: str) -> float:
    if a[0] == "t" or b[0] == "t":
        return float(a == b)
    x, y = np.frombuffer(bytes.fromhex(a), ">u4"), np.frombuffer(bytes.fromhex(b), ">u4")
    either = (x != 0) | (y != 0)
    return float((x[either] == y[either]).mean())


def build_lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Sorted hashes of the lexicon's terms."""
    texts = docs.select(F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            term, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n)], names=["term", "n"])

        for batch in batches:
            for _, part in text_slices(batch, "_text"):
                _, term = document_terms(part)
                held.append(term[drawn(term)])
                if sum(map(len, held)) > 3_000_000:
                    yield flush()
        if held:
            yield flush()

    n_docs = docs.count()
    counts = texts.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    within = counts.where(F.col("n").between(max(2, low * n_docs), max(2, high * n_docs))).select("term").toArrow()
    return np.sort(within["term"].to_numpy().view(np.uint64))


def fingerprint(docs: DataFrame, lexicon: np.ndarray) -> DataFrame:
    """doc_id and fingerprint of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    rows = docs.select("doc_id", F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, "_text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fingerprints(texts, shared.value), pa.string())], names=["doc_id", "fingerprint"])

    return rows.mapInArrow(run, "doc_id bigint, fingerprint string")


def with_edits(docs: DataFrame, lexicon: np.ndarray, part_bytes: int = PART_BYTES) -> DataFrame:
    """Fingerprints of the texts and of their edited texts, and their likeness; columns as op10's contract names them.

    Rows are dealt to ranges of doc_id by split points; the first row of a range goes to the
    range before it as well, whose last row it follows, so no order is made over all rows.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("text").alias("_text"), F.coalesce("doc_id", F.lit(LAST)).alias("_at"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    parts = 1 + int(total // part_bytes)
    cuts = rows.agg(F.percentile_approx("_at", [i / parts for i in range(1, parts)] or [0.5], 100 * parts)).first()[0] or []
    cuts = np.unique(np.array(cuts if parts > 1 else [], np.int64))
    part_of = lambda at: np.searchsorted(cuts, at, side="left")  # noqa: E731  a larger number: larger ids

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[int, int] = {}
        for batch in batches:
            at = batch.column("_at").to_numpy()
            for p in np.unique(part_of(at)):
                top[int(p)] = max(top.get(int(p), LAST), int(at[part_of(at) == p].max()))
        yield pa.RecordBatch.from_arrays([pa.array(list(top), pa.int64()), pa.array(list(top.values()), pa.int64())], names=["part", "top"])

    tops = rows.select("_at").mapInArrow(largest, "part bigint, top bigint").groupBy("part").agg(F.max("top").alias("top")).collect()  # a row for each range
    order = sorted((r.part, r.top) for r in tops)
    also = {top: order[(i + 1) % len(order)][0] for i, (_, top) in enumerate(order)}
    shared = spark.sparkContext.broadcast(lexicon)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("_at").to_numpy()
            text = pa.compute.fill_null(batch.column("_text"), "")
            own = pa.RecordBatch.from_arrays([pa.array(part_of(at)), pa.array(np.zeros(len(at), bool)), batch.column("_at"), batch.column("doc_id"), text], names=["part", "extra", "at", "doc_id", "text"])
            yield own
            first = np.array([i for i, x in enumerate(at.tolist()) if x in also], np.int64)
            if len(first):
                more = own.take(pa.array(first))
                yield pa.RecordBatch.from_arrays([pa.array([also[x] for x in at[first].tolist()], pa.int64()), pa.array(np.ones(len(first), bool)), *more.columns[2:]], names=own.schema.names)

    dealt = rows.mapInArrow(deal, "part bigint, extra boolean, at bigint, doc_id bigint, text string")

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by([("extra", "ascending"), ("at", "descending"), ("text", "ascending")])
        n = group.num_rows - pa.compute.sum(group["extra"]).as_py()
        out = []
        for begin in range(0, n, 256):  # so many texts at a time
            texts = group["text"].slice(begin, min(257, group.num_rows - begin)).to_pylist()
            m = min(256, n - begin)
            half = [len(t) // 2 for t in texts[:m]]
            edited = [t[: len(t) - h] + nxt[:h] for t, h, nxt in zip(texts, half, texts[1:])]
            marks = [f for i in range(0, len(texts), 32) for f in fingerprints(texts[i : i + 32], shared.value)]
            changed = [f for i in range(0, m, 32) for f in fingerprints(edited[i : i + 32], shared.value)]
            out.append(pa.table({
                "doc_id": group["doc_id"].slice(begin, m).combine_chunks(),
                "n_chars": pa.array(map(len, texts[:m]), pa.int64()),
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
                "fingerprint": marks[:m],
                "edited_fingerprint": changed,
                "near_edited": [likeness(a, b) for a, b in zip(marks, changed)],
                "near_next": [likeness(a, b) for a, b in zip(marks[:m], marks[1:])],
            }))
        return pa.concat_tables(out) if out else pa.schema(FIELDS).empty_table()

    return dealt.groupBy("part").applyInArrow(compare, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and likenesses."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_edits(docs, build_lexicon(docs))
