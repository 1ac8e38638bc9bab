"""Documents whose shingle sets link: an exact Jaccard join over a prefix tree.

All shingles are put in one global order, rarest first: a block of documents
sends each of its shingles once, buckets add up how many documents hold it and
answer with the logarithm, and (logarithm, hash) is the order. Two sets that
link share one of the first n - ceil(0.85 n) + 1 shingles of each, so a
document whose first shingles occur nowhere else is done. The others meet in
groups that share such shingles, directly or by others.

In a group the sets, most frequent shingle first, are stored in a trie.
A probe walks it level by level: the overlap with a node's path is computed
once for all sets below it, and a subtree is left as soon as the remaining
lengths cannot reach the overlap that its smallest set needs, or when all its
sets are in the probe's component already (links only matter for
connectivity then). Large groups are cut into chunks, bounded in sets and in
bytes, and every pair of chunks is one task, so a group of any size, of sets of
any size, is no larger a task.

Cases: equal sets are joined once (copies meet in their block, then by set); a
null, empty or blank text has no shingles and is its own component; rows that
repeat a doc_id stand for themselves and may have different components; a null
doc_id comes last and names a component only without other members; an empty
table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.bpe import spread
from carelake.llm.common import read_table, stage
from carelake.llm.components import components
from carelake.llm.windows import LAST, share_out
from carelake.llm.words import combine, find_words, join_texts, mix, prime_hashes

SHINGLE, LEAST = 4, 85
BLOCK_BYTES, BUCKET_SHINGLES, CHUNK_SETS, CHUNK_BYTES, GROUP_BYTES = 6_000_000, 2_000_000, 2_000, 8_000_000, 4_000_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, shingle hash) pairs, sorted."""
    buf, at = join_texts(texts)
    buf = _LOWER[buf]
    start, end = find_words(buf)
    words, first = prime_hashes(buf, start, end), np.searchsorted(start, at)
    count = np.diff(first)
    many = np.maximum(count - size + 1, 0)
    gram = combine(words, size)[spread(first[:-1], many)] if many.any() else np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(texts)), many)
    for n in range(1, size):  # a short text is one shingle
        short = np.flatnonzero(count == n)
        if len(short):
            text = np.concatenate([text, short])
            gram = np.concatenate([gram, combine(words, n)[first[short]]])
    order = np.lexsort((gram, text))
    text, gram = text[order], gram[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (gram[1:] != gram[:-1])
    return text[new], gram[new]


def needed(a, b, least: int):
    """Smallest overlap of two sets of sizes a and b that link."""
    return -(-least * (a + b) // (100 + least))


def trie_components(sets: list[np.ndarray], other: np.ndarray | None, least: int = LEAST) -> np.ndarray:
    """Component number of every set (non-empty, each of distinct hashes), from the links between them.

    ``other``: if given, only pairs with different values of it are looked at.
    """
    m = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    component = np.arange(m)
    if m < 2:
        return component
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.empty(len(count), np.int64)
    place[np.argsort(-count, kind="stable")] = np.arange(len(count))
    parts = [np.sort(p) for p in np.split(place[token], np.cumsum(size)[:-1])]
    order = sorted(range(m), key=lambda i: parts[i].astype(">u4").tobytes())
    parts, size = [parts[i] for i in order], size[order]
    side = other[order] if other is not None else None

    # Compact trie of the sorted sets, from the common prefixes of neighbours.
    common = [0] * (m + 1)
    for i in range(1, m):
        n = min(len(parts[i - 1]), len(parts[i]))
        differ = np.flatnonzero(parts[i - 1][:n] != parts[i][:n])
        common[i] = int(differ[0]) if len(differ) else n
    parent, depth, low, high = [0], [0], [0], [m]
    leaf_parent = [0] * m
    stack = [0]
    for i in range(1, m + 1):
        shared, lowest, child = common[i], i - 1, -1
        leaf_parent[i - 1] = stack[-1]
        while depth[stack[-1]] > shared:
            child = stack.pop()
            high[child], lowest = i, low[child]
            parent[child] = stack[-1]
        if depth[stack[-1]] < shared:
            new = len(parent)
            if child >= 0:
                parent[child] = new
            else:
                leaf_parent[i - 1] = new
            parent.append(stack[-1])
            depth.append(shared)
            low.append(lowest)
            high.append(m)
            stack.append(new)
    leaf = [False] * len(parent) + [True] * m
    parent += leaf_parent
    depth += [len(p) for p in parts]
    low += range(m)
    high += range(1, m + 1)
    parent, depth, low, high, leaf = (np.array(x) for x in (parent, depth, low, high, leaf))
    above = depth[parent]
    edge = depth - above
    label = np.concatenate([parts[low[v]][above[v] : depth[v]] for v in range(1, len(parent))] or [np.zeros(0, np.int64)])
    edge_at = np.cumsum(edge) - edge
    smallest, largest = (np.array([f(size[a:b]) for a, b in zip(low, high)]) for f in (np.min, np.max))
    children = np.argsort(parent[1:], kind="stable") + 1
    child_at = np.searchsorted(parent[children], np.arange(len(parent) + 1))

    inside = np.zeros(len(count), bool)
    for i in range(m - 1):
        n = int(size[i])
        inside[parts[i]] = True
        node, overlap = np.array([0]), np.array([0])
        while len(node):
            kids = child_at[node + 1] - child_at[node]
            overlap = np.repeat(overlap, kids)
            node = children[spread(child_at[node], kids)]
            keep = high[node] > i + 1  # each pair once
            own = component[i]
            lo, hi = low[node], high[node]
            edges = np.empty(2 * len(node), np.int64)
            edges[::2], edges[1::2] = lo, hi
            padded = np.append(component, -1)
            keep &= (np.minimum.reduceat(padded, edges)[::2] != own) | (np.maximum.reduceat(padded, edges)[::2] != own) if len(node) else keep
            node, overlap = node[keep], overlap[keep]
            if not len(node):
                break
            long = edge[node]
            hit = np.concatenate([[0], np.cumsum(inside[label[spread(edge_at[node], long)]])])
            overlap = overlap + hit[np.cumsum(long)] - hit[np.cumsum(long) - long]
            reach = overlap + np.minimum(n - overlap, largest[node] - depth[node])
            keep = reach >= needed(n, smallest[node], least)
            node, overlap = node[keep], overlap[keep]
            ends = leaf[node]
            for v in node[ends].tolist():
                j = int(low[v])
                if j > i and component[j] != component[i] and (side is None or side[i] != side[j]):
                    a, b = sorted((component[i], component[j]))
                    component[component == b] = a
            node, overlap = node[~ends], overlap[~ends]
        inside[parts[i]] = False
    out = np.empty(m, np.int64)
    out[order] = component
    return out


def first_shingles(docs: DataFrame, size: int, least: int, block_bytes: int, bucket_shingles: int) -> DataFrame:
    """For every row: at, doc_id, n, node (hash of the set) and, for the first row of each set in its block with a
    first shingle that occurs elsewhere, keys (those shingles) and shingles (all, packed)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks, buckets = 1 + int(total // block_bytes), 1 + int(total // 5 // bucket_shingles)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    def load(table: pa.Table):
        """The block in order, each row's set, and which rows are the first of their set."""
        at = pa.compute.fill_null(table["doc_id"], LAST)
        table = table.append_column("_at", at).sort_by([("_at", "ascending"), ("text", "ascending")])
        parts = []
        for i in range(0, table.num_rows, 500):
            text, gram = shingle_sets(table["text"].slice(i, 500).to_pylist(), size)
            parts.append((text + i, gram))
        text, gram = (np.concatenate(p) for p in zip(*parts))
        begin = np.searchsorted(text, np.arange(table.num_rows + 1))
        node = [hashlib.blake2b(gram[a:b].tobytes(), digest_size=16).digest() for a, b in zip(begin, begin[1:])]
        seen: set[bytes] = set()
        first = np.array([not (d in seen or seen.add(d)) for d in node], bool)
        code = mix(gram)
        code = (share_out(code, buckets).astype(np.uint64) << np.uint64(32)) | (code & np.uint64(0xFFFFFFFF))
        return table, text, gram, begin, node, first, code

    def emit(table: pa.Table) -> pa.Table:
        name = table["block"][0].as_py()
        table, text, _, _, _, first, code = load(table)
        code, count = np.unique(code[first[text]], return_counts=True)
        begin = np.searchsorted(code, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
        rows = [(b, name, (code[i:j] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), np.minimum(count[i:j], 65535).astype("<u2").tobytes()) for b, (i, j) in enumerate(zip(begin, begin[1:])) if j > i]
        columns = list(zip(*rows)) if rows else [[]] * 4
        return pa.table({"bucket": pa.array(columns[0], pa.int32()), "block": pa.array(columns[1], pa.int32()), "keys": pa.array(columns[2], pa.binary()), "counts": pa.array(columns[3], pa.binary())})

    def weigh(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, "<u4") for k in table["keys"].to_pylist()]
        count = np.concatenate([np.frombuffer(c, "<u2") for c in table["counts"].to_pylist()])
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        level = np.log2(np.bincount(place, count)).astype(np.float32)
        level = np.where(level == 0, 0, 1 + np.minimum(250, 6 * level)).astype(np.uint8)[place]  # 0: in one set only
        parts = np.split(level, np.cumsum([len(k) for k in keys])[:-1])
        return pa.table({"block": table["block"], "bucket": table["bucket"], "levels": pa.array([p.tobytes() for p in parts], pa.binary())})

    def pick(table: pa.Table, levels: pa.Table) -> pa.Table:
        table, text, gram, begin, node, first, code = load(table)
        levels = levels.sort_by("bucket")
        level = np.frombuffer(b"".join(levels["levels"].to_pylist()), np.uint8)
        known = np.unique(code[first[text]])
        level = level[np.searchsorted(known, code)] if len(code) else level
        order = np.lexsort((gram, level, text))  # rarest first in each set
        gram, level = gram[order], level[order]
        keys, packed = [], []
        for k, (a, b) in enumerate(zip(begin.tolist(), begin[1:].tolist())):
            n = b - a
            head = a + n - -(-least * n // 100) + 1
            shared = gram[a:head][level[a:head] > 0] if first[k] and n * (100 - least) >= least else gram[:0]  # smaller sets link with none but equals
            keys.append(shared.view(np.int64) if len(shared) else None)
            packed.append(gram[a:b].astype("<u8").tobytes() if len(shared) else None)
        return pa.table({
            "doc_id": table["doc_id"].combine_chunks(), "text_key": table["text_key"].combine_chunks(), "at": table["_at"].combine_chunks(), "n": np.diff(begin).astype(np.int64),
            "node": pa.array(node, pa.binary()), "keys": pa.array(keys, pa.list_(pa.int64())), "shingles": pa.array(packed, pa.binary()),
        })

    keys = dealt.groupBy("block").applyInArrow(emit, "bucket int, block int, keys binary, counts binary")
    levels = keys.groupBy("bucket").applyInArrow(weigh, "block int, bucket int, levels binary")
    return dealt.groupBy("block").cogroup(levels.groupBy("block")).applyInArrow(pick, "doc_id bigint, text_key bigint, at bigint, n bigint, node binary, keys array<bigint>, shingles binary")


def join_shingles(docs: DataFrame, size: int = SHINGLE, least: int = LEAST, block_bytes: int = BLOCK_BYTES, bucket_shingles: int = BUCKET_SHINGLES, chunk_sets: int = CHUNK_SETS, chunk_bytes: int = CHUNK_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, text_key (xxhash64 of the text, null as empty), n_shingles, component_id and component (a hash) of every row.

    Two sets link if 100 x intersection >= ``least`` x union.
    """
    rows = stage(first_shingles(docs, size, least, block_bytes, bucket_shingles), "shingles")
    sets = rows.where("keys is not null").dropDuplicates(["node"]).select("node", "n", "keys", "shingles")

    # Groups: sets that share first shingles, directly or by others. Sizes that cannot link don't meet.
    ratio = float(np.log(100 / least))
    level = F.floor(F.log("n") / ratio)
    held = sets.select("node", level.alias("level"), F.explode("keys").alias("key"))
    held = held.select("node", "key", F.explode(F.array("level", F.col("level") + 1)).alias("level"))
    least_node = held.groupBy("key", "level").agg(F.min("node").alias("least"), F.count("*").alias("c")).where("c > 1")
    group = components(held.join(least_node, ["key", "level"]).select("node", "least").distinct(), "node", "least").withColumnRenamed("root", "grp")

    # Chunks of large groups, every pair of chunks together.
    members = sets.select("node", "shingles").join(group, "node")
    volume = F.greatest(F.ceil(F.count("*") / chunk_sets), F.ceil(F.sum("n") * 8 / chunk_bytes))
    chunks = sets.select("node", "n").join(group, "node").groupBy("grp").agg(volume.alias("chunks"))
    members = members.join(chunks, "grp").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    members = members.withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("chunks").cast("int") - 1)))
    members = members.withColumn("pair", F.xxhash64("grp", F.least("chunk", "mate"), F.greatest("chunk", "mate")))
    members = members.select("grp", "pair", F.least("chunk", "mate").alias("i"), F.greatest("chunk", "mate").alias("j"), "chunk", "node", "shingles")
    members = stage(members, "groups")
    volume = members.agg(F.coalesce(F.sum(F.octet_length("shingles")), F.lit(0))).first()[0]
    tasks = 1 + int(volume // group_bytes)

    def link(table: pa.Table) -> pa.Table:
        table = table.sort_by([("grp", "ascending"), ("i", "ascending"), ("j", "ascending"), ("node", "ascending")])
        i, j, chunk = (table[c].to_numpy() for c in ("i", "j", "chunk"))
        node, packed = table["node"].to_pylist(), table["shingles"]
        name = table["grp"].to_pylist()
        a, b, at = [], [], 0
        while at < len(node):
            to = at + 1
            while to < len(node) and (name[to], i[to], j[to]) == (name[at], i[at], j[at]):
                to += 1
            sets = [np.frombuffer(x, "<u8") for x in packed.slice(at, to - at).to_pylist()]
            found = trie_components(sets, chunk[at:to] if i[at] != j[at] else None, least)
            root: dict[int, int] = {}
            for k, c in enumerate(found.tolist()):
                if root.setdefault(c, k) != k:
                    a.append(node[at + k])
                    b.append(node[at + root[c]])
            at = to
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    links = members.groupBy(F.pmod("pair", F.lit(tasks)).alias("task")).applyInArrow(link, "a binary, b binary")
    linked = components(links, "a", "b")

    own = rows.groupBy("node").agg(F.min(F.when(F.col("n") > 0, F.col("at"))).alias("least"))
    own = own.join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = own.groupBy("root").agg(F.min("least").alias("component"))
    of = own.join(first, "root").select("node", "component", "root")
    result = rows.select("doc_id", "text_key", "n", "node").join(of, "node")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.nullif("component", F.lit(LAST)))
    return result.select("doc_id", "text_key", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("root").alias("component"))


def op6_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return join_shingles(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
