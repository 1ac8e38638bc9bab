"""BPE encoding and decoding with a published byte-level vocabulary.

A text is cut into special tokens and pieces by the vocabulary's pattern. The
distinct pieces of a slice are encoded together: their symbols lie in one flat
numpy array, every adjacent pair's rank is found by binary search over the
sorted pair keys, and each round merges, in every word at once, all
occurrences of that word's lowest-ranked pair. Only pairs next to a merge are
searched again. Encoded pieces are remembered in a table of bounded size.

Cases: a null text counts as empty and gives no ids; an empty table gives an
empty result; repeated rows give repeated results; a text of any length is
taken whole, in runs of ``PIECES`` pieces; columns other than the id and the
text are not read, so their names cannot clash.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import bound_batches, read_table, text_slices

#: Pieces encoded at a time, and distinct pieces remembered by a worker.
PIECES, REMEMBERED = 200_000, 300_000

#: Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NO_RANK = np.int32(2**31 - 1)


def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def byte_symbols() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteBpe:
    """Vocabulary tables, and encoding and decoding of many texts at a time."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_symbols()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max(*vocab.values(), *self.specials.values()) + 1
        spelled = [b""] * size
        for token, i in vocab.items():
            spelled[i] = bytes(alphabet[c] for c in token)
        for token, i in self.specials.items():
            spelled[i] = token.encode()
        self.token_len = np.array([len(b) for b in spelled], np.int64)
        self.token_at = np.concatenate([[0], np.cumsum(self.token_len)[:-1]])
        self.token_bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.byte_id = np.zeros(256, np.int64)
        for c, b in alphabet.items():
            self.byte_id[b] = vocab[c]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        # All occurrences of a word's lowest pair may be merged in one round only if
        # what a merge makes never takes part in a pair of lower rank.
        first = {int(t): r for r, t in reversed(list(enumerate(made)))}
        late = (first.get(int(x), -1) >= r for r, p in enumerate(zip(left, right)) for x in p)
        if any(late):
            raise ValueError("a merge of this vocabulary uses a symbol that a later merge makes")
        keys = (left << 20) | right
        order = np.argsort(keys)
        self.keys, self.rank_of, self.made = keys[order], order.astype(np.int32), made
        self.pattern = regex.compile(PATTERN)
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.at, self.length = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 20) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], NO_RANK)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty byte strings, in one flat array, and how many each has."""
        n = len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        sym = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        word = np.repeat(np.arange(n), sizes)
        rank = np.full(len(sym), NO_RANK, np.int32)  # of the pair that begins here
        pair = np.flatnonzero(word[1:] == word[:-1])
        rank[pair] = self._ranks(sym[pair], sym[pair + 1])
        done_word, done_sym = [], []
        while len(sym):
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[start, len(sym)])
            low = np.minimum.reduceat(rank, start)
            over = np.repeat(low == NO_RANK, size)
            if over.any():
                done_word.append(word[over])
                done_sym.append(sym[over])
                sym, word, rank, low = sym[~over], word[~over], rank[~over], np.repeat(low, size)[~over]
                if not len(sym):
                    break
            else:
                low = np.repeat(low, size)
            hit = np.flatnonzero(rank == low)
            # Of overlapping occurrences (a a a) every second one counts, from the left.
            new = np.r_[True, np.diff(hit) != 1]
            run = np.flatnonzero(new)
            offset = np.arange(len(hit)) - np.repeat(run, np.diff(np.r_[run, len(hit)]))
            hit = hit[offset % 2 == 0]
            sym[hit] = self.made[rank[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            at = hit - np.arange(len(hit))  # places after removal
            sym, word, rank = sym[keep], word[keep], rank[keep]
            stale = np.unique(np.concatenate([at, at[at > 0] - 1]))
            ok = stale[stale + 1 < len(sym)]
            ok = ok[word[ok] == word[ok + 1]]
            rank[stale] = NO_RANK
            rank[ok] = self._ranks(sym[ok], sym[ok + 1])
        word, sym = np.concatenate(done_word or [word]), np.concatenate(done_sym or [sym])
        order = np.argsort(word, kind="stable")
        return sym[order].astype(np.int32), np.bincount(word, minlength=n)

    def _learn(self, pieces: Iterable[str]) -> None:
        fresh = list(pieces)
        ids, counts = self.encode_pieces([p.encode() for p in fresh])
        begin = len(self.ids) + np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.ids = np.concatenate([self.ids, ids])
        self.at, self.length = np.concatenate([self.at, begin]), np.concatenate([self.length, counts])

    def _codes(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, flat, and how many each has."""
        if len(self.known) > REMEMBERED:
            self._forget()
        known, before = self.known, len(self.known)
        code = np.array([known.setdefault(p, len(known)) for p in pieces], np.int64)
        if len(known) > before:
            self._learn(itertools.islice(known, before, None))
        size = self.length[code]
        return self.ids[spread(self.at[code], size)], size

    def _runs(self, text: str) -> Iterator[list[str] | int]:
        """A text's pieces in runs of bounded length, and ids of special tokens."""
        last = 0
        for m in self.special_pattern.finditer(text) if self.special_pattern else ():
            yield from self._plain(text[last : m.start()])
            yield self.specials[m[0]]
            last = m.end()
        yield from self._plain(text[last:] if last else text)

    def _plain(self, text: str) -> Iterator[list[str]]:
        if len(text) <= PIECES:
            yield self.pattern.findall(text)
            return
        found = (m[0] for m in self.pattern.finditer(text))
        while run := list(itertools.islice(found, PIECES)):
            yield run

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, special tokens' strings as their ids."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        waiting: list[tuple[int, int]] = []
        pieces: list[str] = []

        def flush() -> None:
            if pieces:
                ids, size = self._codes(pieces)
                ends = np.concatenate([[0], np.cumsum(size)])
                at = 0
                for doc, n in waiting:
                    parts[doc].append(ids[ends[at] : ends[at + n]])
                    at += n
            pieces.clear()
            waiting.clear()

        for doc, text in enumerate(texts):
            for run in self._runs(text):
                if isinstance(run, int):
                    flush()
                    parts[doc].append(np.array([run], np.int32))
                elif run:
                    pieces += run
                    waiting.append((doc, len(run)))
                    if len(pieces) >= PIECES:
                        flush()
        flush()
        return [np.concatenate(p) if p else np.zeros(0, np.int32) for p in parts]

    def decode(self, ids: np.ndarray) -> str:
        size = self.token_len[ids]
        return self.token_bytes[spread(self.token_at[ids], size)].tobytes().decode("utf-8", "replace")


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices start[i], start[i]+1, .. (size[i] of them) for every i, one after another."""
    total = int(size.sum())
    shift = start - np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else start
    return np.repeat(shift, size) + np.arange(total)


_LOADED: dict[str, ByteBpe] = {}


def _coder(path: str) -> ByteBpe:
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def bpe_encode(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, n_tokens, ids (little-endian unsigned 32-bit, packed) and the decoded text.

    ``decoded`` is made from the ids alone. ``vocabulary`` is a path that every
    executor can open (a file shipped with the job or installed everywhere).
    """
    bound_batches(docs.sparkSession)
    path = vocabulary or default_vocabulary()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for batch in batches:
            for part, texts in text_slices(batch, "_text"):
                ids = coder.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_id"),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                        pa.array([coder.decode(x) for x in ids], pa.string()),
                    ],
                    names=[id_col, "n_tokens", "ids", "decoded"],
                )

    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids binary, decoded string")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded and decoded again; digests of both."""
    coded = bpe_encode(read_table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
