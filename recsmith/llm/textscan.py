"""Vectorised text scanning for Arrow batches (no Spark dependency).

A batch of texts is looked at as one array of code points plus document
bounds, in chunks of some hundred thousand code points, so that word boundaries,
word hashes and window hashes of many documents come out of a handful of
numpy calls. Nulls count as empty texts; a single text longer than a chunk
forms a chunk of its own, so memory follows the longest text.

Hashes are 64-bit: a polynomial over mixed code points taken from prefix
sums (the base is odd, so its powers can be inverted modulo 2**64),
finished with the splitmix64 mixer. Where equal hashes count as equal strings
without a look at them, `strong_hash` adds a polynomial modulo a prime.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_CHARS = 1 << 18
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


@dataclass
class Chunk:
    """Rows [row, row + n) of a batch: code points and n + 1 bounds."""

    row: int
    codes: np.ndarray
    bounds: np.ndarray

    @property
    def n(self) -> int:
        return len(self.bounds) - 1

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        """Index (within the chunk) of the document that holds each position."""
        return np.searchsorted(self.bounds, positions, side="right") - 1

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-character array for each document."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


def texts(column) -> list[bytes]:
    """UTF-8 bytes of each value; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw = [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]
    try:
        b"".join(raw).decode("utf-8")
    except UnicodeDecodeError:  # bytes that are no UTF-8 count as U+FFFD
        raw = [v.decode("utf-8", "replace").encode("utf-8") for v in raw]
    return raw


def row_runs(column, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of runs of rows of about `limit` bytes; only one run
    is held beside the column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(column):
        start = int(size[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, start + limit, side="right")))
        yield lo, texts(column.slice(lo, hi - lo))
        lo = hi


def chunks(column, limit: int = CHUNK_CHARS) -> Iterator[Chunk]:
    """Consecutive rows of an Arrow string column as chunks of code points."""
    for lo, raw in row_runs(column, limit):
        data = b"".join(raw)
        codes = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum([len(r) for r in raw])
        if len(codes) != len(data):
            starts_char = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
            ends = np.concatenate([[0], np.cumsum(starts_char)])[ends]
        yield Chunk(lo, codes, np.concatenate([[0], ends]).astype(np.int64))
    pa.default_memory_pool().release_unused()


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _power(n: int, which: str) -> np.ndarray:
    have = _powers.get(which)
    if have is None or len(have) < n:
        base = _BASE if which == "up" else pow(_BASE, -1, 1 << 64)
        size = max(n, CHUNK_CHARS + 1)
        steps = np.full(size, base, dtype=U64)
        steps[0] = 1
        have = _powers[which] = np.cumprod(steps, dtype=U64)
    return have[:n]


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of values[start:end] for each span (values: uint64)."""
    n = len(values)
    total = np.zeros(n + 1, dtype=U64)
    np.cumsum(values * _power(n, "up"), dtype=U64, out=total[1:])
    raw = (total[ends] - total[starts]) * _power(n + 1, "down")[starts]
    return mix(raw + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


_P31 = U64((1 << 31) - 1)
_P31_BASE = 1_357_204_811
_residues: dict[str, np.ndarray] = {}


def _fold31(x: np.ndarray) -> np.ndarray:
    """x modulo 2**31 - 1, up to one multiple of it."""
    x = (x & _P31) + (x >> U64(31))
    return (x & _P31) + (x >> U64(31))


def _residue_power(n: int, which: str) -> np.ndarray:
    """Powers of the base, or of its inverse, modulo 2**31 - 1."""
    have = _residues.get(which)
    if have is None or len(have) < n:
        p = int(_P31)
        base = _P31_BASE if which == "up" else pow(_P31_BASE, -1, p)
        size = max(n, CHUNK_CHARS + 1)
        have = np.ones(size, dtype=np.uint32)
        k = 1
        while k < size:
            part = have[:min(k, size - k)].astype(U64) * U64(pow(base, k, p))
            have[k:k + len(part)] = _fold31(part) % _P31
            k *= 2
        _residues[which] = have
    return have[:n]


def strong_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of values[start:end] for each span. `span_hash` works modulo
    2**64, where long strings of a regular build (Thue-Morse) have equal
    polynomials whatever the base; a second polynomial modulo the prime
    2**31 - 1 tells them apart."""
    n = len(values)
    total = np.zeros(n + 1, dtype=U64)
    np.cumsum(values * _power(n, "up"), dtype=U64, out=total[1:])
    raw = (total[ends] - total[starts]) * _power(n + 1, "down")[starts]
    np.cumsum(_fold31((values >> U64(33)) * _residue_power(n, "up")), dtype=U64, out=total[1:])
    second = _fold31(_fold31(total[ends] - total[starts]) * _residue_power(n + 1, "down")[starts]) % _P31
    return mix(raw + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93) + second * U64(0xA0761D6478BD642F))


def char_values(codes: np.ndarray) -> np.ndarray:
    x = (codes.astype(U64) + U64(1)) * U64(0xD1342543DE82EF95)
    return x ^ (x >> U64(29))


def spans(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of true positions that do not cross document bounds."""
    n = len(mask)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    before = np.concatenate([[False], mask[:-1]])
    starts = np.flatnonzero(mask & (~before | edge[:n]))
    after = np.concatenate([mask[1:], [False]])
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    return starts, ends


_BLANK = np.zeros(128, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def is_blank(codes: np.ndarray) -> np.ndarray:
    """Space, tab, line feed, vertical tab, form feed, carriage return."""
    return (codes < 128) & _BLANK[np.minimum(codes, 127)]


def lower_ascii(codes: np.ndarray) -> np.ndarray:
    return np.where((codes >= 65) & (codes <= 90), codes + 32, codes)


@dataclass
class Words:
    """Words of a chunk: spans, document of each, words per document."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # index of the first word of each document, n + 1 entries

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(chunk: Chunk, mask: np.ndarray) -> Words:
    starts, ends = spans(mask, chunk.bounds)
    return Words(starts, ends, np.searchsorted(starts, chunk.bounds, side="left"))


def windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, document) of every full window of `size`
    words; `first` as in Words."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[:-1][doc] + offset, doc
