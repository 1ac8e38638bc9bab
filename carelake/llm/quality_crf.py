"""Quality of documents from a linear-chain conditional random field over lines.

Every line is good or bad. A line's features are shape measures of the line
itself and of the line before and after it, each cut into bins, so that the
log-linear scores can follow any shape of one measure. The field is trained by
gradient ascent on the likelihood of labelled documents, whose lines all carry
the document's label. A document's score is the mean of its lines'
forward-backward marginals of "good", weighted by line length in bytes.

Training takes a bounded sample: at most ``max_docs`` labelled documents in
hash order of their ids and, of these, as many as keep within ``max_lines``
lines. Scoring covers every line of every text.

Cases: a null or empty text is one empty line and is scored as such; labels
that are null are left out, a document labelled twice counts as the smaller
label; without labels, or with one label only, every score is the share of
label 1 (1.0 without labels); repeated rows give repeated results; only id and
text (and labels' quality) are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm.common import bound_batches, read_table, text_slices
from carelake.llm.words import find_words, hash_spans, join_texts

BINS = 8
#: Bytes of text measured at a time: several arrays hold a 64-bit number for each of them.
SLICE = 500_000
#: Measures of a line.
MEASURES = ("bytes", "words", "word_bytes", "lower", "upper", "digit", "stop", "mark", "symbol", "beyond_ascii", "doubled", "distinct", "same_as_next", "short", "long", "marked_words", "seen")


def _byte_classes() -> np.ndarray:
    kind = np.full(256, 5, np.int64)  # other symbols
    for k, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:'\"-()", "!?")):
        kind[[ord(c) for c in chars]] = k
    kind[[9, 10, 11, 12, 13, 32]] = 6
    kind[128:] = 7
    return kind


_KIND = _byte_classes()


def line_measures(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measures of every line (lines x MEASURES), its weight, and how many lines each text has."""
    buf, at = join_texts(texts)
    stop = np.flatnonzero(buf == 10)
    first = np.concatenate([[0], stop[:-1] + 1]) if len(stop) else stop
    n = len(first)
    lines = np.diff(np.searchsorted(first, at))
    size = stop - first
    if not n:
        return np.zeros((0, len(MEASURES))), size, lines
    row = np.repeat(np.arange(n), size + 1)
    kind = _KIND[buf]
    share = np.bincount(row * 8 + kind, minlength=n * 8).reshape(n, 8) / np.maximum(size, 1)[:, None]
    twice = np.zeros(len(buf), bool)
    twice[1:] = (buf[1:] == buf[:-1]) & ((kind[1:] == 4) | (kind[1:] == 5))
    doubled = np.bincount(row, twice, minlength=n) / np.maximum(size, 1)
    start, end = find_words(buf)
    word_row = row[start]
    words = np.bincount(word_row, minlength=n)
    some = np.maximum(words, 1)
    hashed = hash_spans(buf, start, end)
    order = np.lexsort((hashed, word_row))
    new = np.ones(len(order), bool)
    new[1:] = (word_row[order][1:] != word_row[order][:-1]) | (hashed[order][1:] != hashed[order][:-1])
    distinct = np.bincount(word_row[order], new, minlength=n) / some
    same = np.zeros(len(start), bool)
    same[:-1] = (hashed[1:] == hashed[:-1]) & (word_row[1:] == word_row[:-1])
    length = end - start
    last = kind[end - 1] if len(end) else end
    mean = lambda flag: np.bincount(word_row, flag, minlength=n) / some
    # A line that an earlier line of its text equals.
    whole = hash_spans(buf, first, stop)
    text = np.repeat(np.arange(len(lines)), lines)
    order = np.lexsort((np.arange(n), whole, text))
    seen = np.zeros(n)
    seen[order[1:]] = (whole[order][1:] == whole[order][:-1]) & (text[order][1:] == text[order][:-1])
    x = np.column_stack([np.log1p(size), np.log1p(words), size / some, share[:, 0], share[:, 1], share[:, 2], share[:, 3], share[:, 4], share[:, 5], share[:, 7], doubled, distinct, mean(same), mean(length <= 3), mean(length >= 12), mean((last == 4) | (last == 5)), seen])
    return x, size + 1, lines


def binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Column of each measure's bin among all bins."""
    return np.column_stack([np.searchsorted(edges[k], x[:, k], side="left") + k * BINS for k in range(x.shape[1])]) if len(x) else np.zeros(x.shape, np.int64)


def neighbours(bins: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """A line's own bins, those of the line before and of the line after; -1 beyond the text's ends."""
    width = bins.shape[1] * BINS
    before, after = np.full_like(bins, -1), np.full_like(bins, -1)
    before[1:], after[:-1] = bins[:-1] + width, bins[1:] + 2 * width
    last = np.cumsum(lines)
    before[(last - lines)[lines > 0]] = -1
    after[last[lines > 0] - 1] = -1
    return np.concatenate([bins, before, after], axis=1)


def forward_backward(good: np.ndarray, lines: np.ndarray, start: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginal of "good" for each line, expected first states, expected steps (2 x 2).

    ``good``: the score of state 1 for each line, state 0 scoring 0. Chains advance together,
    longest first; log space keeps long chains finite.
    """
    order = np.argsort(-lines, kind="stable")
    at = (np.cumsum(lines) - lines)[order]
    length = lines[order]
    longest = int(length[0]) if len(length) else 0
    active = len(length) - np.searchsorted(length[::-1], np.arange(longest), side="right")
    ahead, behind = np.zeros((len(good), 2)), np.zeros((len(good), 2))
    now = None
    for t in range(longest):
        k = at[: active[t]] + t
        if t == 0:
            now = np.broadcast_to(start, (len(k), 2)).copy()
        else:
            now = now[: active[t]]
            now = np.logaddexp(now[:, :1] + step[0], now[:, 1:] + step[1])
        now[:, 1] += good[k]
        ahead[k] = now
    total = np.zeros(len(good))
    expected = np.zeros((2, 2))
    for t in range(longest - 1, -1, -1):
        k = at[: active[t]] + t
        total[k] = np.logaddexp(ahead[k, 0] + behind[k, 0], ahead[k, 1] + behind[k, 1])
        if t:
            into = behind[k].copy()
            into[:, 1] += good[k]
            both = ahead[k - 1][:, :, None] + step[None] + into[:, None, :] - total[k][:, None, None]
            expected += np.exp(both).sum(0)
            behind[k - 1] = np.logaddexp(step[:, 0] + into[:, :1], step[:, 1] + into[:, 1:])
    p = np.exp(ahead[:, 1] + behind[:, 1] - total)
    first = p[at[: active[0]]] if longest else p
    return p, np.array([(1 - first).sum(), first.sum()]), expected


@dataclass
class LineField:
    """Parameters of the field."""

    edges: np.ndarray
    weight: np.ndarray
    start: np.ndarray
    step: np.ndarray
    constant: float | None = None

    def score(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        x, weight, lines = line_measures(texts)
        bins = neighbours(binned(x, self.edges), lines)
        good = np.where(bins >= 0, self.weight[bins], 0).sum(1)
        p, _, _ = forward_backward(good, lines, self.start, self.step)
        text = np.repeat(np.arange(len(lines)), lines)
        return np.clip(np.bincount(text, p * weight, minlength=len(lines)) / np.bincount(text, weight, minlength=len(lines)), 0, 1)


def fit(x: np.ndarray, lines: np.ndarray, label: np.ndarray, rounds: int = 120, rate: float = 0.08, ridge: float = 2.0) -> LineField:
    """Gradient ascent (Adam) on the chains' conditional log likelihood less a ridge."""
    if not len(label) or label.min() == label.max():
        return LineField(np.zeros((0, 0)), np.zeros(0), np.zeros(2), np.zeros((2, 2)), constant=float(label.mean()) if len(label) else 1.0)
    edges = np.stack([np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1]) for k in range(x.shape[1])])
    bins = neighbours(binned(x, edges), lines)
    n_weight = 3 * x.shape[1] * BINS
    flat = np.where(bins >= 0, bins, n_weight).ravel()
    line_label = np.repeat(label, lines)
    # Documents of either label and lines of long documents weigh alike: a chain of many lines is one document.
    seen = lambda value: np.bincount(flat, np.repeat(value, bins.shape[1]), minlength=n_weight + 1)[:-1]
    first = np.array([(label == 0).sum(), (label == 1).sum()], float)
    pairs = np.diag([(lines[label == 0] - 1).sum(), (lines[label == 1] - 1).sum()]).astype(float)
    observed = np.concatenate([seen(line_label.astype(float)), first, pairs.ravel()])
    theta = np.zeros(n_weight + 6)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, rounds + 1):
        padded = np.append(theta[:n_weight], 0.0)
        good = padded[flat].reshape(bins.shape).sum(1)
        p, begin, steps = forward_backward(good, lines, theta[n_weight : n_weight + 2], theta[n_weight + 2 :].reshape(2, 2))
        slope = (observed - np.concatenate([seen(p), begin, steps.ravel()]) - ridge * theta) / len(label)
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta += rate * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-8)
    return LineField(edges, theta[:n_weight], theta[n_weight : n_weight + 2], theta[n_weight + 2 :].reshape(2, 2))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 6000, max_lines: int = 120_000) -> LineField:
    """Fit on labelled documents that aren't held out. The sample's bounds are in the module's text."""
    bound_batches(docs.sparkSession)
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = marked.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_label"))
    chosen = marked.orderBy(F.xxhash64("_id"), "_id").limit(max_docs)  # at most max_docs rows, so they can be broadcast
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("_id"), text.alias("_text")).join(F.broadcast(chosen), "_id")
    rows = rows.withColumn("_n", F.length("_text") - F.length(F.replace("_text", F.lit("\n"))) + 1).withColumn("_h", F.xxhash64("_text"))
    kept = rows.select("_id", "_text", "_label", "_n", "_h").orderBy(F.xxhash64("_id"), "_id", "_h").limit(max_docs)
    within = F.sum("_n").over(Window.orderBy(F.xxhash64("_id"), "_id", "_h").rowsBetween(Window.unboundedPreceding, 0))
    kept = kept.withColumn("_sum", within).where(f"_sum <= {max_lines} or _sum = _n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, "_text", SLICE):
                x, _, lines = line_measures(texts)
                rows = np.split(x, np.cumsum(lines)[:-1])
                yield pa.RecordBatch.from_arrays([part.column("_h"), part.column("_label"), pa.array([r.astype("<f8").tobytes() for r in rows], pa.binary())], names=["h", "label", "x"])

    got = kept.select("_h", F.col("_label").cast("int").alias("_label"), "_text").mapInArrow(run, "h bigint, label int, x binary").toArrow()
    order = np.argsort(got["h"].to_numpy(), kind="stable")
    parts = [np.frombuffer(b, "<f8").reshape(-1, len(MEASURES)) for b in got["x"].to_pylist()]
    parts = [parts[i] for i in order]
    x = np.concatenate(parts) if parts else np.zeros((0, len(MEASURES)))
    return fit(x, np.array([len(p) for p in parts], np.int64), (got["label"].to_numpy()[order] > 0).astype(int))


def score_documents(docs: DataFrame, field: LineField, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``quality_score``, 0 to 1, of the whole text."""
    bound_batches(docs.sparkSession)
    kept = docs.drop("quality_score")
    names, spot = kept.columns, kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, names=[f"c{i}" for i in range(len(names))])
            for part, texts in text_slices(batch, f"c{spot}", SLICE):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(field.score(texts))], names=[*names, "quality_score"])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("quality_score", T.DoubleType())]))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, and label 1 where it is 0.3 or more."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    field = train(docs, read_table(spark, sf_dir, "labels"))
    scored = score_documents(docs, field)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"), F.when(F.col("quality_score") >= 0.3, 1).otherwise(0).alias("predicted"))
