"""Removing word passages that start earlier in the corpus, with an FM-index per shard.

Candidate segments are routed to shards (see ``windows``). A shard builds a
compressed FM-index of its distinct segments: the Burrows-Wheeler transform in
a wavelet tree of packed bit vectors. The documents' segments stream through
it from their last word to their first: a backward step prepends a word to the
match, and a match that has reached the threshold first drops its last word by
widening to the range of the shorter string. So the matching statistic, cut at
the threshold, is known at every word; where it reaches the threshold the
range holds all equal windows, and the earliest of them is kept.

Cases: a null text has no words; texts shorter than the window lose nothing; a
window that repeats within one row starts earlier at its first place; rows
with the same doc_id count as one document, in text order, their windows at
equal starts not removing each other; a null doc_id counts as the largest; an
empty table gives an empty result; very long texts are taken whole; only
doc_id and text are read.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.bpe import spread
from carelake.llm.common import read_table
from carelake.llm.succinct import FmIndex
from carelake.llm.suffix_dedup import first_of_group, ordered
from carelake.llm.windows import Block, Plan, covered_windows
from carelake.llm.words import prime_hashes, words_of

WORDS = Plan(window=20, gram=5, words=True, same_document=True, block_bytes=8_000_000, shard_bytes=3_000_000)


def load_words(table: pa.Table) -> Block:
    table = ordered(table)
    buf, start, end, begin = words_of(table["text"].to_pylist())
    return Block(table["_at"].to_numpy(), prime_hashes(buf, start, end), begin)


def matching_ranges(index: FmIndex, text: np.ndarray, begin: np.ndarray, span: np.ndarray, length: int) -> np.ndarray:
    """Begin of the range of each window, of segments at ``begin`` in ``text`` with ``span`` symbols, window after window.

    All segments advance together, longest first.
    """
    order = np.argsort(-span, kind="stable")
    begin, span = begin[order], span[order]
    windows = span - length + 1
    out = np.zeros(int(windows.sum()), np.int64)
    base = np.cumsum(windows) - windows
    low, high = np.zeros(len(span), np.int64), np.full(len(span), index.n)
    left, right = index.runs(length - 1, text)
    active = len(span)
    for step in range(int(span[0]) if len(span) else 0):
        active = int(np.searchsorted(-span[:active], -step, side="left"))
        if step >= length:  # the match is full: leave out its last word
            at = low[:active]
            low[:active], high[:active] = left[at], right[at]
        place = span[:active] - 1 - step
        low[:active], high[:active] = index.extend(text[begin[:active] + place], low[:active], high[:active])
        if step >= length - 1:
            out[base[:active] + place] = low[:active]
    # Back to the order of the segments given.
    first = np.empty(len(order), np.int64)
    first[order] = base
    size = np.empty(len(order), np.int64)
    size[order] = windows
    return out[spread(first, size)]


def earliest_by_search(symbols: np.ndarray, windows: np.ndarray, position: np.ndarray, length: int) -> np.ndarray:
    """For every window, the number of the first (smallest position) that equals it."""
    span = windows + length - 1
    _, word = np.unique(symbols, return_inverse=True)
    text = np.zeros(int(span.sum()) + len(span), np.int64)  # segments, a 0 after each
    begin = np.cumsum(span + 1) - span - 1
    text[spread(begin, span)] = word + 1
    index = FmIndex(text, length)
    return first_of_group(matching_ranges(index, text, begin, span, length), position)


def remove_passages(docs: DataFrame, length: int = WORDS.window, plan: Plan = WORDS) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words, joined by a space, of every row."""
    plan = replace(plan, window=length)

    def finish(table: pa.Table, block: Block, covered: np.ndarray) -> pa.Table:
        n = len(block.symbols)
        step = np.zeros(n + length + 1, np.int32)
        step[:n] += covered
        step[length : n + length] -= covered
        gone = np.cumsum(step[:n]) > 0
        size = np.diff(block.begin)
        removed = np.add.reduceat(np.append(gone, False), block.begin[:-1], dtype=np.int64) * (size > 0) if len(size) else size
        table = ordered(table)
        kept = [b" ".join(w for w, g in zip(t.encode().split(), gone[i:j].tolist()) if not g).decode() for t, i, j in zip(table["text"].to_pylist(), block.begin.tolist(), block.begin[1:].tolist())]
        return pa.table({"doc_id": table["doc_id"].combine_chunks(), "n_words": size.astype(np.int64), "n_removed": removed, "kept": pa.array(kept, pa.string())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    earliest = lambda symbols, windows, position: earliest_by_search(symbols, windows, position, length)
    return covered_windows(rows, plan, load_words, earliest, finish, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without passages of 20 words that start earlier."""
    rows = remove_passages(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
