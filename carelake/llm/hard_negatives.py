"""Hard negatives from an inverted multi-index, with certified windows.

The two halves of the vectors are quantised by a codebook each; a pair of
centres is a cell. A member's product with an anchor is at most

    (q1.c1 + |q1| r1) + (q2.c2 + |q2| r2),

r being the largest distance of a half from its centre. A heap visits cells by
these summed half bounds, largest first, so the bound of the next cell holds
for everything not yet seen. A search is a list of windows [low, high] of the
product, over rows of the anchor's own label or of the others, and takes the
first ``keep`` rows of each. A window is certified when it has them all above
the bound of the next cell, or when that bound lies below the window: no unseen
row can then change it. Anchors with windows left go on in the next round, with
eight times as many entries, until certified; the result is exact.

Mining runs two such searches: the first rows of the anchor's label are its
positives, and each positive gives a window among the other labels.

A round is one job. Cells are read in blocks of bounded size, a block and the
anchors that visit it meet in one task, which holds the block and streams the
anchors. Equal vectors of a label are one entry with its smallest ids (as many
as a window can need), kept to those before the shuffle, so a vector that fills
a third of the table is one entry; more anchors than ``ANCHORS`` are dealt into
shares, each with its own copy of the block.

Cases: rows with a null id, label or vector, or a null or non-finite component
take no part; equal rows count once; other rows that repeat a vec_id are rows
each, but none is a positive or negative of an anchor with that vec_id; vectors
meet those of their own length; components are limited so that products fit 64
bits (+-2^28 after scaling at 64 components); a positive of negative score has
an empty window; anchors without positives or negatives give no rows; an empty
table gives an empty result; only the id, the label and the vector are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm.common import read_table, stage
from carelake.llm.multi_index import kmeans, nearest

#: Vectors that the codebooks are fitted on, and centres of a half at most (bounds of the model, not of the index).
SAMPLE, WIDTH = 20_000, 256
#: Entries of a block and of the first round at least; anchors that share one copy of a block.
BLOCK, FIRST, ANCHORS = 16_384, 16_384, 65_536
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
SLOT = "struct<slot:int,same:boolean,low:bigint,high:bigint>"


def whole(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products of every row of q with every row of x."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if top < 2.0**52:  # every partial sum is a whole double
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def walk(first: np.ndarray, second: np.ndarray, count: np.ndarray, want: int) -> tuple[np.ndarray, float]:
    """Cells by summed bounds, largest first, until they hold ``want`` entries; and the bound of all others."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    x, y, held = first[a].tolist(), second[b].tolist(), count[np.ix_(a, b)].tolist()
    seen = np.zeros(count.shape, bool)
    heap, got = [(-(x[0] + y[0]), 0, 0)], 0
    while heap and got < want:
        _, i, j = heapq.heappop(heap)
        if held[i][j]:
            seen[a[i], b[j]] = True
            got += held[i][j]
        if j + 1 < len(y):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))
    return seen, -heap[0][0] if heap else float("-inf")


class Index:
    """Entries (distinct label and vector, with their smallest ids) listed by cell, and the codebooks."""

    def __init__(self, rows: DataFrame, dim: int, ids: int, sample: int = SAMPLE, width: int | None = None, block: int = BLOCK):
        self.spark, self.dim, self.ids, self.block = rows.sparkSession, dim, ids, block
        place = F.row_number().over(Window.partitionBy("label", "v").orderBy("vec_id"))
        first = rows.withColumn("_r", place).where(F.col("_r") <= ids)
        entries = stage(first.groupBy("label", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "negatives-entries")  # ``ids`` at most
        n = entries.count()
        fitted = whole(entries.select("v").orderBy(F.xxhash64("v"), "v").limit(sample).toArrow()["v"].combine_chunks(), dim).astype(np.float64)
        width = max(1, min(WIDTH, isqrt(n) // 4) if width is None else width)
        half = dim // 2
        self.one, self.two = (kmeans(part, width) for part in (fitted[:, :half], fitted[:, half:]))
        model = self.spark.sparkContext.broadcast((self.one, self.two))  # WIDTH x dim numbers at most

        def place_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            one, two = model.value
            for batch in batches:
                x = whole(batch.column("v"), dim).astype(np.float64)
                a, b = nearest(x[:, :half], one), nearest(x[:, half:], two)
                far = [np.sqrt(((part - centre) ** 2).sum(axis=1)) for part, centre in ((x[:, :half], one[a]), (x[:, half:], two[b]))]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), *map(pa.array, far), *batch.columns], names=["a", "b", "r1", "r2", *batch.schema.names])

        listed = entries.mapInArrow(place_in, "a int, b int, r1 double, r2 double, label bigint, v array<bigint>, ids array<bigint>")
        self.listed = stage(listed, "negatives-lists")
        self.count = np.zeros((len(self.one), len(self.two)), np.int64)
        self.r1, self.r2 = np.zeros(len(self.one)), np.zeros(len(self.two))
        for r in self.listed.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect():  # a row for each cell
            self.count[r.a, r.b] = r.n
            self.r1[r.a], self.r2[r.b] = max(self.r1[r.a], r.r1), max(self.r2[r.b], r.r2)
        self.n = n
        self.model = self.spark.sparkContext.broadcast((self.one, self.two, self.r1, self.r2, self.count))

    def visits(self, anchors: DataFrame) -> DataFrame:
        """The anchors with ``bound`` (of all cells not visited yet) and ``visits`` (a, and the cells of it that are new)."""
        model, dim = self.model, self.dim

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            one, two, r1, r2, count = model.value
            half = dim // 2
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    x = whole(part.column("v"), dim).astype(np.float64)
                    bounds = []
                    for q, centre, radius in ((x[:, :half], one, r1), (x[:, half:], two, r2)):
                        bounds.append(q @ centre.T + np.sqrt((q * q).sum(1))[:, None] * radius)
                    before, want = part.column("before").to_pylist(), part.column("want").to_pylist()
                    limit, listed = [], []
                    for i in range(len(x)):
                        seen, bound = walk(bounds[0][i], bounds[1][i], count, want[i])
                        if before[i]:
                            seen &= ~walk(bounds[0][i], bounds[1][i], count, before[i])[0]
                        limit.append(bound + 1e-9 * (np.abs(bounds[0][i]).max() + np.abs(bounds[1][i]).max()) if np.isfinite(bound) else bound)
                        listed.append([{"a": int(c), "mask": np.packbits(seen[c]).tobytes()} for c in np.flatnonzero(seen.any(axis=1))])
                    kind = pa.list_(pa.struct([("a", pa.int32()), ("mask", pa.binary())]))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(limit, pa.float64()), pa.array(listed, kind)], names=[*part.schema.names, "bound", "visits"])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in anchors.schema)
        return anchors.mapInArrow(visit, f"{schema}, bound double, visits array<struct<a:int,mask:binary>>")

    def found(self, walked: DataFrame, shares: int, keep: int) -> DataFrame:
        """key, slot, score, vec_id: of every window the first rows of each block."""
        blocks = np.maximum(1, -(-self.count.sum(axis=1) // self.block))
        blocks_of = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("a") + 1)
        none = lambda kind: F.lit(None).cast(kind)
        share = F.sequence(F.lit(0), F.lit(shares - 1))
        lists = self.listed.select(
            "a", F.pmod(F.xxhash64("v", "label"), blocks_of.cast("long")).cast("int").alias("eb"), F.explode(share).alias("share"), F.lit(0).alias("kind"),
            "b", "label", "v", "ids", none("string").alias("key"), none("bigint").alias("q"), none("binary").alias("mask"), none(f"array<{SLOT}>").alias("slots"),
        )
        asked = walked.select("key", "q", "label", "v", "slots", F.inline("visits"))
        asked = asked.select(
            "a", F.explode(F.sequence(F.lit(0), blocks_of - 1)).alias("eb"), F.pmod(F.xxhash64("key"), F.lit(shares)).cast("int").alias("share"), F.lit(1).alias("kind"),
            none("int").alias("b"), "label", "v", none("array<bigint>").alias("ids"), "key", "q", "mask", "slots",
        )
        tasks = max(1, int(blocks.sum()) * shares)
        both = lists.unionByName(asked).repartition(tasks, "a", "eb", "share").sortWithinPartitions("a", "eb", "share", "kind")
        return both.mapInArrow(_scorer(self.dim, keep), "key string, slot int, score bigint, vec_id bigint")


def _scorer(dim: int, keep: int):
    def first_of(scores: np.ndarray, ids: list, least: np.ndarray, chosen: np.ndarray, q: int) -> list[tuple[int, int]]:
        """The first ``keep`` (score, id) of the chosen entries, without the id q."""
        at = np.flatnonzero(chosen)
        if len(at) > keep + 1:  # one entry may hold q alone
            cut = -np.partition(-scores[at], keep)[keep]
            at = at[scores[at] >= cut]  # with all ties
            at = at[np.lexsort((least[at], -scores[at]))][: keep + 1]
        near = sorted((-int(scores[e]), i) for e in at for i in ids[e] if i != q)[:keep]
        return [(-s, i) for s, i in near]

    def answer(lists: pa.Table, asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x, b, label = whole(lists["v"].combine_chunks(), dim), lists["b"].to_numpy(), lists["label"].to_numpy()
        ids = lists["ids"].to_pylist()
        least = np.array([i[0] for i in ids], np.int64)
        for at in range(0, asked.num_rows, 64):
            part = asked.slice(at, 64)
            scores = products(whole(part.column("v"), dim), x)
            names, qs, labels, slots, masks = (part.column(c).to_pylist() for c in ("key", "q", "label", "slots", "mask"))
            rows = []
            for i, name in enumerate(names):
                seen = np.unpackbits(np.frombuffer(masks[i], np.uint8))[b].astype(bool)
                same = label == labels[i]
                for s in slots[i]:
                    chosen = seen & (same == s["same"]) & (scores[i] >= s["low"]) & (scores[i] <= s["high"])
                    rows += [(name, s["slot"], p, v) for p, v in first_of(scores[i], ids, least, chosen, qs[i])]
            columns = list(zip(*rows)) if rows else [[]] * 4
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "slot", "score", "vec_id"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts, lists = None, [], None
        for batch in batches:
            a, eb, share, kind = (batch.column(c).to_numpy() for c in ("a", "eb", "share", "kind"))
            change = np.flatnonzero((np.diff(a) != 0) | (np.diff(eb) != 0) | (np.diff(share) != 0) | (np.diff(kind) != 0)) + 1
            edges = [0, *change.tolist(), batch.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                part, block = batch.slice(lo, hi - lo), (a[lo], eb[lo], share[lo])
                if kind[lo] == 0:
                    parts = [*parts, part] if block == held else [part]
                    held, lists = block, None
                elif block == held:  # else nobody is listed there
                    lists = lists if lists is not None else pa.Table.from_batches(parts)
                    yield from answer(lists, part)

    return score


def first_in_windows(index: Index, anchors: DataFrame, keep: int, first: int) -> tuple[DataFrame, DataFrame]:
    """key, slot, score, vec_id, place: the first ``keep`` rows of every window; and the anchors' ``want`` at the end.

    anchors: key, q, label, v, slots, before, want.
    """
    place = F.row_number().over(Window.partitionBy("key", "slot").orderBy(F.desc("score"), "vec_id"))
    found, done = None, []
    while True:
        walked = stage(index.visits(anchors), "negatives-walk")
        n = walked.count()
        new = index.found(walked, 1 + n // ANCHORS, keep)
        if found is not None:
            new = new.unionByName(found.join(walked.select("key"), "key", "left_semi").select("key", "slot", "score", "vec_id"))
        found = stage(new.withColumn("place", place).where(F.col("place") <= keep), "negatives-found")
        held = found.groupBy("key", "slot").agg(F.count("*").alias("n"), F.min("score").alias("last"))
        windows = walked.select("key", "bound", F.inline("slots"))
        windows = windows.join(held, ["key", "slot"], "left")
        certified = (F.col("bound") < F.col("low")) | (F.col("low") > F.col("high")) | ((F.col("n") == keep) & (F.col("last") > F.col("bound"))) | (F.col("bound") == float("-inf"))
        still = stage(windows.where(~F.coalesce(certified, F.lit(False))).select("key").distinct(), "negatives-open")
        done.append((found.join(still, "key", "left_anti"), walked.join(still, "key", "left_anti").select("key", "want")))
        if still.isEmpty():
            break
        anchors = walked.join(still, "key", "left_semi").select("key", "q", "label", "v", "slots", F.col("want").alias("before"), (F.col("want") * 8).alias("want"))
    results, wants = zip(*done)
    for i in range(1, len(results)):
        results, wants = (results[0].unionByName(results[i]), *results[1:]), (wants[0].unionByName(wants[i]), *wants[1:])
    return results[0], wants[0]


def usable(vectors: DataFrame, id_col: str, label: Column, vector_col: str, scale: int) -> DataFrame:
    """Distinct vec_id, label and v (whole numbers, not yet limited) of the rows that take part."""
    finite = F.forall(vector_col, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.where(F.col(vector_col).isNotNull() & finite)
    v = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), v.alias("v")).where("vec_id IS NOT NULL AND label IS NOT NULL").distinct()


def _mine(rows: DataFrame, dim: int, is_anchor: Column, positives: int, negatives: int, share: tuple[int, int], first: int, block: int, width: int | None) -> DataFrame:
    limit = isqrt((1 << 62) // max(1, dim))
    rows = stage(rows.withColumn("v", F.transform("v", lambda x: F.greatest(F.lit(-limit), F.least(F.lit(limit), x)))).distinct(), "negatives-rows")
    index = Index(rows, dim, max(positives, negatives) + 1, width=width, block=block)
    key = F.sha1(F.to_json(F.struct("vec_id", "label", "v")))
    one = F.array(F.struct(F.lit(0).alias("slot"), F.lit(True).alias("same"), F.lit(_LOW).alias("low"), F.lit(_HIGH).alias("high")))
    start = max(first, index.n // 64)
    anchors = rows.where(is_anchor).select(key.alias("key"), F.col("vec_id").alias("q"), "label", "v", one.cast(f"array<{SLOT}>").alias("slots"), F.lit(0).cast("long").alias("before"), F.lit(start).cast("long").alias("want"))
    anchors = stage(anchors.repartition(F.col("key")), "negatives-anchors")
    found, wants = first_in_windows(index, anchors, positives, first)
    liked = stage(found.select("key", "place", F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id")), "negatives-positives")

    # 100 s >= 80 p and 100 s <= 100 p in whole numbers; a negative p gives an empty window.
    least, of = share
    p = F.col("positive_score").cast("decimal(38,0)")
    low = F.expr(f"CAST(positive_score - (CAST(positive_score AS DECIMAL(38,0)) * {of - least} DIV {of}) AS BIGINT)")
    window = F.struct(F.col("place").alias("slot"), F.lit(False).alias("same"), F.when(p >= 0, low).otherwise(F.lit(_HIGH)).alias("low"), F.col("positive_score").alias("high"))
    slots = liked.groupBy("key").agg(F.array_sort(F.collect_list(window)).cast(f"array<{SLOT}>").alias("slots"))  # a row for each positive
    asked = anchors.drop("slots", "want").join(slots, "key").join(wants, "key").select("key", "q", "label", "v", "slots", "before", "want")
    asked = stage(asked, "negatives-anchors")
    found, _ = first_in_windows(index, asked, negatives, first)
    pairs = found.select("key", F.col("slot").alias("place"), F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    rows = pairs.join(liked, ["key", "place"]).join(anchors.select("key", F.col("q").alias("anchor_id")), "key")
    return rows.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", first: int = FIRST, block: int = BLOCK, width: int | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor``: a condition on the column vec_id. ``label``: the label of a row (default: column label). A negative's
    score lies between share[0] / share[1] of the positive's score and that score.
    """
    rows = usable(vectors, id_col, F.col("label") if label is None else label, vector_col, scale)
    rows = stage(rows, "negatives-usable")
    lengths = sorted(r.n for r in rows.select(F.size("v").alias("n")).distinct().collect())  # the lengths of the vectors
    if not lengths:
        return vectors.sparkSession.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    parts = [_mine(rows.where(F.size("v") == n), n, is_anchor, positives, negatives, share, first, block, width) for n in lengths]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every embedding whose vec_id is divisible by 100, labels moved where it is divisible by 7."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


OP11_SQL = """
WITH kept AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
  FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
