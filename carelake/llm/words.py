"""Words and hashes of many texts at a time, in flat numpy arrays."""

from __future__ import annotations

import hashlib

import numpy as np

#: Bytes hashed at a time: bounds the temporary arrays.
CHUNK = 1 << 20
_MULT = 0x9E3779B97F4A7C15 | 1
_POW = _INV = np.zeros(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT)) | np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        one = np.ones(1, np.uint64)
        _POW = np.cumprod(np.concatenate([one, np.full(n - 1, _MULT, np.uint64)]), dtype=np.uint64)
        _INV = np.cumprod(np.concatenate([one, np.full(n - 1, pow(_MULT, -1, 1 << 64), np.uint64)]), dtype=np.uint64)
    return _POW[:n], _INV[:n]


def join_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts, a line feed after each, and where each begins (and the end)."""
    coded = [t.encode() for t in texts]
    size = np.fromiter((len(b) + 1 for b in coded), np.int64, len(coded))
    return np.frombuffer(b"".join(x for b in coded for x in (b, b"\n")), np.uint8), np.concatenate([[0], np.cumsum(size)])


def find_words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word: runs of bytes other than space and 9-13."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~_IS_SPACE[buf]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes (or of 64-bit numbers); starts and ends are in order."""
    out = np.zeros(len(start), np.uint64)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + CHUNK, side="right")))
        lo, hi = int(start[at]), int(end[to - 1])
        power, inverse = _powers(hi - lo + 1)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((_BYTE[buf[lo:hi]] if buf.dtype == np.uint8 else buf[lo:hi]) * power[:-1], out=total[1:])
        a, b = start[at:to] - lo, end[at:to] - lo
        out[at:to] = mix((total[b] - total[a]) * inverse[a])
        at = to
    return out


#: The field of ``prime_hashes``, the seeded base of its polynomials, and the symbols taken at a time (arrays that fit a
#: core's cache).
_PRIME = (1 << 61) - 1
FIELD_CHUNK = 1 << 16
_BASE = int.from_bytes(hashlib.blake2b(b"carelake words", digest_size=8).digest(), "big") % (_PRIME - 512) + 256
_FIELD: tuple[np.ndarray, ...] = ()


def _reduce(x: np.ndarray) -> np.ndarray:
    x = (x & np.uint64(_PRIME)) + (x >> np.uint64(61))
    return np.where(x >= np.uint64(_PRIME), x - np.uint64(_PRIME), x)


def field_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2^61 - 1, of numbers below it."""
    low, half = np.uint64((1 << 31) - 1), np.uint64(31)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    middle = a1 * b0 + a0 * b1
    return _reduce((a1 * b1 << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << half) + a0 * b0)


def _field_powers(n: int) -> tuple[np.ndarray, ...]:
    """Powers of the base (low 30 bits, the rest) and of its inverse, up to FIELD_CHUNK of them."""
    global _FIELD
    if not _FIELD or len(_FIELD[0]) < n:
        size = min(FIELD_CHUNK + 1, max(n, 4096, 2 * len(_FIELD[0]) if _FIELD else 0))
        tables = []
        for base in (_BASE, pow(_BASE, -1, _PRIME)):
            table = np.ones(1, np.uint64)
            while len(table) < size:  # doubled: the next run is this one times its end
                table = np.concatenate([table, field_product(table, np.full(len(table), pow(base, len(table), _PRIME), np.uint64))])
            tables.append(table[:size])
        power, inverse = tables
        _FIELD = (power & np.uint64((1 << 30) - 1), power >> np.uint64(30), inverse)
    return tuple(t[:n] for t in _FIELD)


def _field_spans(buf: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Polynomial of each span a..b of a buffer of FIELD_CHUNK symbols at most."""
    low, high, inverse = _field_powers(len(buf) + 1)
    total_low, total_high = np.zeros(len(buf) + 1, np.uint64), np.zeros(len(buf) + 1, np.uint64)
    if buf.dtype == np.uint8:
        code = buf.astype(np.uint64) + np.uint64(1)  # no symbol is nothing
        np.cumsum(code * low[:-1], out=total_low[1:])
        np.cumsum(code * high[:-1], out=total_high[1:])
    else:
        code = _reduce(buf.astype(np.uint64)) + np.uint64(1)
        term = field_product(np.where(code == np.uint64(_PRIME), np.uint64(1), code), (high[:-1] << np.uint64(30)) + low[:-1])
        np.cumsum(term & np.uint64((1 << 30) - 1), out=total_low[1:])
        np.cumsum(term >> np.uint64(30), out=total_high[1:])
    value = _reduce(total_low[b] - total_low[a])
    shifted = field_product(_reduce(total_high[b] - total_high[a]), np.full(len(a), 1 << 30, np.uint64))
    return field_product(_reduce(value + shifted), inverse[a])


def prime_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes (or of 64-bit numbers); starts and ends are in order.

    A polynomial with a seeded base over the field of 2^61 - 1: two spans of n
    symbols that differ collide for at most n of all bases, whatever their
    structure. Memory follows FIELD_CHUNK, also in longer spans.
    """
    out = np.zeros(len(start), np.uint64)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + FIELD_CHUNK, side="right")))
        lo, hi = int(start[at]), int(end[to - 1])
        if hi - lo <= FIELD_CHUNK:
            out[at:to] = _field_spans(buf[lo:hi], start[at:to] - lo, end[at:to] - lo)
        else:  # one long span, by pieces
            value = 0
            for k in range(lo, hi, FIELD_CHUNK):
                part = buf[k : min(hi, k + FIELD_CHUNK)]
                value += int(_field_spans(part, np.array([0]), np.array([len(part)]))[0]) * pow(_BASE, k - lo, _PRIME)
            out[at] = value % _PRIME
            to = at + 1
        at = to
    return mix(out)


def combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive numbers (len - n + 1 of them)."""
    m = max(0, len(hashes) - n + 1)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out = (out + hashes[i : i + m]) * np.uint64(_MULT)
        out ^= out >> np.uint64(29)
    return mix(out)


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, word starts, word ends, and the index of the first word of each text (and the end)."""
    buf, at = join_texts(texts)
    start, end = find_words(buf)
    return buf, start, end, np.searchsorted(start, at)
