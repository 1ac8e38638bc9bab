"""Finding windows of equal symbols across all documents: routing shared by the two substring operators.

A symbol is a byte or a word's hash. Every window of ``window`` symbols has a
minimiser: the smallest hash among its runs of ``gram`` symbols. Equal windows
have equal minimisers, so windows meet if they are routed by it. Consecutive
windows with one minimiser travel together as one segment.

1. Documents are dealt into blocks of bounded bytes. A block sends each of its
   minimisers once, as 32 bits within a bucket, with the number of segments.
2. Buckets answer which minimisers occur elsewhere too (and which very often).
3. A block sends the segments of those, equal segments once, with the position
   of their first occurrence, its owner. Minimisers of more than ``hot``
   segments are split further: their windows travel alone, routed by content,
   which keeps equal windows together and no task grows with one minimiser.
4. A shard (bucket of segments) decides, by the operator's own index, which
   windows of each segment also start earlier than the owner's.
5. Blocks take the answers back and mark what is covered.

Exactness: 32-bit collisions in step 2 only send segments in vain. A word is
known by a 64-bit hash; windows are taken for equal wrongly only if they
differ in nothing but words that collide.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.bpe import spread
from carelake.llm.words import combine, mix, prime_hashes

#: A null doc_id comes after all others.
LAST = 2**63 - 1


@dataclass(frozen=True)
class Plan:
    """What the two operators set differently."""

    window: int
    gram: int
    words: bool  # symbols are words' hashes; otherwise bytes
    same_document: bool  # an earlier start in the same document counts too
    block_bytes: int = 6_000_000
    bucket_grams: int = 1_000_000
    shard_bytes: int = 1_500_000
    hot: int = 20_000
    longest: int = 512  # windows in a segment


@dataclass
class Block:
    """Symbols of a block's rows, in order of (doc_id, text)."""

    at: np.ndarray  # doc_id of each row, null last
    symbols: np.ndarray
    begin: np.ndarray  # of each row, and the end


@dataclass
class Segments:
    row: np.ndarray
    start: np.ndarray  # first symbol in the block
    count: np.ndarray  # windows
    key: np.ndarray
    twice: np.ndarray  # its minimiser occurs twice in it


def byte_grams(b: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n bytes, n from 8."""
    m = len(b) - n + 1
    eight = lambda at: np.ndarray((m,), "<u8", np.ascontiguousarray(b), at, (1,))
    out = np.full(m, 0x243F6A8885A308D3, np.uint64)
    for at in [*range(0, n - 8, 8), n - 8]:
        out = (out ^ eight(at)) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out * np.uint64(0x9E3779B97F4A7C15)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[: len(x) - step], x[step:])
        done += step
    return x


def find_segments(block: Block, plan: Plan, chunk: int = 400_000) -> Segments:
    """All segments of the block, in order; made by chunks of starts, at whose ends a segment is cut."""
    found: list[Segments] = []
    w, n = plan.window, len(block.symbols)
    within = w - plan.gram + 1
    for lo in range(0, max(0, n - w + 1), chunk):
        hi = min(lo + chunk, n - w + 1)  # starts lo .. hi - 1
        part = block.symbols[lo : hi + w - 1]
        gram = combine(part, plan.gram) if plan.words else byte_grams(part, plan.gram)
        least = sliding_min(gram, within)
        # A window may not leave its row: a row's last w - 1 symbols are no starts.
        near = block.begin[(block.begin > lo) & (block.begin < hi + w)]
        valid, cut = np.ones(hi - lo, bool), np.ones(hi - lo, bool)
        for end in np.unique(near).tolist():
            valid[max(0, end - w + 1 - lo) : end - lo] = False
        cut[1:] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])
        at = np.flatnonzero(cut)
        size = np.diff(np.r_[at, hi - lo])
        at, size = at[valid[at]], size[valid[at]]
        pieces = -(-size // plan.longest)  # long runs are cut
        piece = spread(np.zeros(len(at), np.int64), pieces)
        stop = np.repeat(at + size, pieces)
        at = np.repeat(at, pieces) + piece * plan.longest
        size = np.minimum(plan.longest, stop - at)
        key = least[at]
        twice = np.zeros(len(at), bool)
        if plan.same_document and len(at):  # the smallest gram twice: a window may repeat within the segment
            span = size + within - 1
            equal = gram[spread(at, span)] == np.repeat(key, span)
            twice = np.add.reduceat(equal, np.cumsum(span) - span, dtype=np.int64) > 1
        found.append(Segments(np.searchsorted(block.begin, at + lo, side="right") - 1, at + lo, size, key, twice))
    join = lambda name, t: np.concatenate([getattr(f, name) for f in found]) if found else np.zeros(0, t)
    return Segments(join("row", np.int64), join("start", np.int64), join("count", np.int64), join("key", np.uint64), join("twice", bool))


def share_out(number: np.ndarray, parts: int) -> np.ndarray:
    """Part 0 .. parts - 1 of each 64-bit hash, by its high bits."""
    return ((number >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def distinct_keys(seg: Segments, plan: Plan, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The block's minimisers as bucket and 32 bits, sorted; how often each counts; each segment's place among them."""
    mixed = mix(seg.key)  # minimisers are small numbers
    code = (share_out(mixed, buckets).astype(np.uint64) << np.uint64(32)) | (mixed & np.uint64(0xFFFFFFFF))
    order = np.argsort(code, kind="stable")
    sorted_code, row = code[order], seg.row[order]
    new = np.ones(len(code), bool)
    new[1:] = sorted_code[1:] != sorted_code[:-1]
    counted = new.copy()
    if plan.same_document:
        counted = 1 + seg.twice[order].astype(np.int64)
    else:
        counted[1:] |= row[1:] != row[:-1]
    begin = np.flatnonzero(new)
    place = np.empty(len(code), np.int64)
    place[order] = np.cumsum(new) - 1
    count = np.add.reduceat(counted, begin, dtype=np.int64) if len(begin) else begin
    return sorted_code[begin], count, place


PIECE = "route int, block int, a binary, b binary, c binary, d binary"
ANSWER = "block int, part int, a binary, b binary, c binary, d binary"


def _bytes(x: np.ndarray, t: str) -> bytes:
    return np.ascontiguousarray(x, t).tobytes()


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})


#: An operator's index: from the distinct segments' symbols (concatenated), their windows' counts and an order
#: number for every window (smaller: earlier), the number of the earliest equal window, for every window.
Earliest = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def covered_windows(docs: DataFrame, plan: Plan, load: Callable[[pa.Table], Block], earliest: Earliest, finish: Callable[[pa.Table, Block, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """``finish`` of every block: its table, its symbols and a flag for each symbol at which a covered window starts.

    ``docs``: doc_id and text, without nulls in text.
    """
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks, shards = 1 + int(total // plan.block_bytes), 1 + int(total // plan.shard_bytes)
    density = 2 / (plan.window - plan.gram + 2) / (6 if plan.words else 1)
    buckets = 1 + int(total * density // plan.bucket_grams)
    dealt = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"))
    number = "<u8" if plan.words else "u1"

    def emit(table: pa.Table) -> pa.Table:
        code, count, _ = distinct_keys(find_segments(load(table), plan), plan, buckets)
        bucket = (code >> np.uint64(32)).astype(np.int64)
        begin = np.searchsorted(bucket, np.arange(buckets + 1))
        name = table["block"][0].as_py()
        rows = [(b, name, _bytes(code[i:j] & np.uint64(0xFFFFFFFF), "<u4"), _bytes(np.minimum(count[i:j], 65535), "<u2")) for b, (i, j) in enumerate(zip(begin[:-1], begin[1:])) if j > i]
        return _table(rows, ["bucket", "block", "keys", "counts"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()])

    def compare(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, "<u4") for k in table["keys"].to_pylist()]
        count = np.concatenate([np.frombuffer(c, "<u2") for c in table["counts"].to_pylist()])
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, count)[place]
        flag = (total > 1).astype(np.uint8) + (total > plan.hot)
        parts = np.split(flag, np.cumsum([len(k) for k in keys])[:-1])
        return pa.table({"block": table["block"], "bucket": table["bucket"], "flags": pa.array([p.tobytes() for p in parts], pa.binary())})

    def pick(table: pa.Table, flags: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _table([], ["route", "block", "a", "b", "c", "d"], [pa.int32()] * 2 + [pa.binary()] * 4)
        block, name = load(table), table["block"][0].as_py()
        seg = find_segments(block, plan)
        _, _, place = distinct_keys(seg, plan, buckets)
        flags = flags.sort_by("bucket")
        flag = np.frombuffer(b"".join(flags["flags"].to_pylist()), np.uint8)[place] if len(place) else place
        # Windows of very frequent minimisers go one by one, the others as they are.
        kept = np.flatnonzero(flag)
        times = np.where(flag[kept] == 2, seg.count[kept], 1)
        inner = spread(np.zeros(len(kept), np.int64), times)
        kept = np.repeat(kept, times)
        alone = flag[kept] == 2
        row, start, count = seg.row[kept], seg.start[kept] + inner, np.where(alone, 1, seg.count[kept])
        content = prime_hashes(block.symbols, start, start + count + plan.window - 1) + count.astype(np.uint64)
        shard = share_out(mix(np.where(alone, content, seg.key[kept] ^ np.uint64(0xABCDEF))), shards)
        _, first, same = np.unique(content, return_index=True, return_inverse=True)  # the first is the owner
        order = np.argsort(shard[first], kind="stable")
        first = first[order]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        rows = [(-1 - name, name, _bytes(row, "<i4"), _bytes(start, "<i8"), _bytes(count, "<i4"), _bytes(back[same], "<i4"))]
        begin = np.searchsorted(shard[first], np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(begin)).tolist():
            f = first[begin[s] : begin[s + 1]]
            symbols = block.symbols[spread(start[f], count[f] + plan.window - 1)]
            rows.append((s, name, _bytes(count[f], "<u2"), _bytes(block.at[row[f]], "<i8"), _bytes(start[f] - block.begin[row[f]], "<i8") if plan.same_document else b"", _bytes(symbols, number)))
        return _table(rows, ["route", "block", "a", "b", "c", "d"], [pa.int32()] * 2 + [pa.binary()] * 4)

    def judge(table: pa.Table) -> pa.Table:
        names, types = ["block", "part", "a", "b", "c", "d"], [pa.int32()] * 2 + [pa.binary()] * 4
        route = table["route"][0].as_py()
        if route < 0:  # a block's own notes
            return pa.table([table["block"], table["route"], table["a"], table["b"], table["c"], table["d"]], names=names)
        read = lambda name, t: np.concatenate([np.frombuffer(x, t) for x in table[name].to_pylist()])
        count, at = read("a", "<u2").astype(np.int64), read("b", "<i8")
        start = read("c", "<i8") if plan.same_document else np.zeros(len(at), np.int64)
        symbols = read("d", number)
        span = count + plan.window - 1
        begin = np.cumsum(span) - span
        content = prime_hashes(symbols, begin, begin + span) + count.astype(np.uint64)
        order = np.lexsort((start, at))  # owners by position
        _, first, same = np.unique(content[order], return_index=True, return_inverse=True)
        text_of = np.empty(len(order), np.int64)
        text_of[order] = same
        first = order[first]  # the earliest of each distinct segment
        windows = count[first]
        row_at, row_start = np.repeat(at[first], windows), spread(start[first], windows)
        by_position = np.lexsort((row_start, row_at))
        position = np.empty(len(by_position), np.int64)
        position[by_position] = np.arange(len(by_position))
        least = earliest(symbols[spread(begin[first], span[first])], windows, position)  # a window for each window
        where = spread((np.cumsum(windows) - windows)[text_of], count)
        own_at, own_start = np.repeat(at, count), spread(start, count)
        covered = row_at[least[where]] < own_at
        if plan.same_document:
            covered |= (row_at[least[where]] == own_at) & (row_start[least[where]] < own_start)
        sizes = [len(x) // 2 for x in table["a"].to_pylist()]
        ends = np.cumsum(count)[np.cumsum(sizes) - 1]
        rows = [(b, route, np.packbits(bits).tobytes(), _bytes([len(bits)], "<i8"), None, None) for b, bits in zip(table["block"].to_pylist(), np.split(covered, ends[:-1]))]
        return _table(rows, names, types)

    def end(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = load(table)
        covered = np.zeros(len(block.symbols), bool)
        if answers.num_rows:
            answers = answers.sort_by("part")
            note = {k: np.frombuffer(answers[k][0].as_py(), t).astype(np.int64) for k, t in (("a", "<i4"), ("b", "<i8"), ("c", "<i4"), ("d", "<i4"))}
            row, start, count, unique = (note[k] for k in "abcd")
            _, owner = np.unique(unique, return_index=True)
            begin = np.cumsum(count[owner]) - count[owner]  # of each distinct segment's windows, by shard
            told = answers.slice(1)
            flags = [np.unpackbits(np.frombuffer(a, np.uint8), count=int.from_bytes(n, "little")) for a, n in zip(told["a"].to_pylist(), told["b"].to_pylist())]
            flags = np.concatenate([np.zeros(0, np.uint8), *flags]).astype(bool)
            at, place = block.at[row], spread(start, count)
            flag = flags[spread(begin[unique], count)]
            later = at > at[owner][unique]
            if plan.same_document:
                later |= (at == at[owner][unique]) & (start - block.begin[row] > (start - block.begin[row])[owner][unique])
            flag |= np.repeat(later, count)
            covered[place[flag]] = True
        return finish(table, block, covered)

    keys = dealt.groupBy("block").applyInArrow(emit, "bucket int, block int, keys binary, counts binary")
    flags = keys.groupBy("bucket").applyInArrow(compare, "block int, bucket int, flags binary")
    pieces = dealt.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(pick, PIECE)
    answers = pieces.groupBy("route").applyInArrow(judge, ANSWER)
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(end, schema)
