"""Removing byte strings that a document with a smaller id holds too.

Candidate segments are routed to shards (see ``windows``). A shard takes the
Burrows-Wheeler transform of its distinct segments and derives the common
prefixes of neighbouring suffixes by threshold-bounded interval expansion:
ranges of strings are extended backwards, breadth first, so that values appear
in increasing order, and the expansion stops at the minimum length. Suffixes
between which no value below the minimum was met share a string of that
length; the group's smallest doc_id keeps it.

Cases: a null text counts as empty; texts shorter than the minimum lose
nothing; rows with the same doc_id don't remove anything from each other; a
null doc_id counts as the largest; an empty table gives an empty result; very
long texts are taken whole, their segments by chunks; only doc_id and text are
read.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.bpe import spread
from carelake.llm.common import read_table
from carelake.llm.succinct import FmIndex
from carelake.llm.windows import LAST, Block, Plan, covered_windows

BYTES = Plan(window=50, gram=20, words=False, same_document=False)


def ordered(table: pa.Table) -> pa.Table:
    """A block's rows by doc_id (null last) and text."""
    at = pa.compute.fill_null(table["doc_id"], LAST)
    return table.append_column("_at", at).sort_by([("_at", "ascending"), ("text", "ascending")])


def load_bytes(table: pa.Table) -> Block:
    table = ordered(table)
    text = table["text"].cast(pa.large_binary()).combine_chunks()
    begin = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[begin[0] : begin[-1]]
    return Block(table["_at"].to_numpy(), data, begin - begin[0])


def earliest_by_expansion(symbols: np.ndarray, windows: np.ndarray, position: np.ndarray, length: int) -> np.ndarray:
    """For every window, the number of the first (smallest position) that equals it."""
    span = windows + length - 1
    text = np.zeros(int(span.sum()) + len(span), np.int64)  # segments, a 0 after each
    begin = np.cumsum(span + 1) - span - 1
    dense = np.cumsum(np.bincount(symbols, minlength=256) > 0)  # the bytes that occur, from 1
    text[spread(begin, span)] = dense[symbols]
    index = FmIndex(text, length)
    group = np.cumsum(index.boundaries(length)[:-1]) - 1
    of_suffix = np.empty(len(text), np.int64)
    of_suffix[index.order] = group
    return first_of_group(of_suffix[spread(begin, windows)], position)


def first_of_group(group: np.ndarray, position: np.ndarray) -> np.ndarray:
    """For every member, the number of its group's member with the smallest position."""
    least = np.full(int(group.max()) + 1 if len(group) else 0, LAST)
    np.minimum.at(least, group, position)
    by_position = np.empty(len(position), np.int64)
    by_position[position] = np.arange(len(position))
    return by_position[least[group]]


def remove_repeats(docs: DataFrame, length: int = BYTES.window, plan: Plan = BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes of every row."""
    plan = replace(plan, window=length)

    def finish(table: pa.Table, block: Block, covered: np.ndarray) -> pa.Table:
        n = len(block.symbols)
        step = np.zeros(n + length + 1, np.int32)
        step[:n] += covered
        step[length : n + length] -= covered
        gone = np.cumsum(step[:n]) > 0
        size = np.diff(block.begin)
        row = np.repeat(np.arange(len(size)), size)
        head = gone.copy()
        head[1:] &= ~gone[:-1]
        head[block.begin[:-1][size > 0]] = gone[block.begin[:-1][size > 0]]
        kept = np.bincount(row, ~gone, minlength=len(size)).astype(np.int64)
        data = block.symbols[~gone].tobytes()
        ends = np.concatenate([[0], np.cumsum(kept)]).tolist()
        return pa.table({
            "doc_id": ordered(table)["doc_id"].combine_chunks(),
            "n_bytes": size.astype(np.int64),
            "n_removed": size - kept,
            "n_spans": np.bincount(row, head, minlength=len(size)).astype(np.int64),
            "kept": pa.array([data[i:j] for i, j in zip(ends, ends[1:])], pa.binary()),
        })

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    earliest = lambda symbols, windows, position: earliest_by_expansion(symbols, windows, position, length)
    return covered_windows(rows, plan, load_bytes, earliest, finish, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without the 50-byte strings of smaller ids."""
    rows = remove_repeats(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
