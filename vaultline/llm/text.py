"""Shared text helpers: whole texts as UTF-8 bytes, cut into words and hashed by numpy, a few megabytes at a time.

A text column arrives in Arrow batches. ``chunks`` cuts a batch into runs of whole documents of bounded size (one
document alone may be larger), so that memory per task follows the longest document and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
U64 = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words `[^\x20\x09-\x0D]+`.
NON_SPACE = ~SPACE
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, once A-Z are lower-cased.
LETTERS = np.ones(256, bool)
LETTERS[0x00:0x30] = LETTERS[0x3A:0x61] = LETTERS[0x7B:0x80] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32

_BYTE = np.random.default_rng(20240201).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2^64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        grown = np.full(max(n, 1 << 16, 2 * len(have) if have is not None else 0), base, U64)
        grown[0] = 1
        have = _powers[base] = np.multiply.accumulate(grown)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive word hashes, in order; len(h) - n + 1 of them."""
    m = max(0, len(h) - n + 1)
    out = np.zeros(m, U64)
    for k in range(n):
        out = out * U64(_BASE) + h[k: k + m]
    return mix(out)


class Chunk:
    """A run of whole documents: ``data`` holds their bytes, document d is ``data[offsets[d]:offsets[d + 1]]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int = 0):
        self.data, self.offsets, self.first, self.n = data, offsets, first, len(offsets) - 1
        self._sums = None

    @classmethod
    def of(cls, texts: list[bytes]) -> Chunk:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        return cls(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))

    def lower(self) -> Chunk:
        return Chunk(LOWER[self.data], self.offsets, self.first)

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes of a class within documents: starts, ends, and per document the first run's index
        (with the total number at the end)."""
        inside = member[self.data] if member.dtype == bool and len(member) == 256 else member
        n = len(inside)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(self.n + 1, np.int64)
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        first[cuts] |= inside[cuts]
        last[cuts - 1] |= inside[cuts - 1]
        starts = np.flatnonzero(first)
        return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, self.offsets)

    def hashes(self, starts: np.ndarray, ends: np.ndarray, block: int = 2 << 20) -> np.ndarray:
        """64-bit hashes of byte ranges, from prefix sums of a polynomial in the bytes; in a long text, of the bytes of
        one block after the other."""
        if len(self.data) <= 2 * block:
            sums, undo = self._prefix(), _power(_UNBASE, len(self.data) + 1)
            return mix((sums[ends] - sums[starts]) * undo[starts] + (ends - starts).astype(U64))
        out = np.empty(len(starts), U64)
        order = None if (starts[1:] >= starts[:-1]).all() else np.argsort(starts, kind="stable")
        cuts = np.searchsorted(starts, np.arange(0, len(self.data) + block, block), sorter=order)
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            if a < b:
                some = slice(a, b) if order is None else order[a:b]
                low, high = starts[some], ends[some]
                base, end = int(low.min()), int(high.max())
                part = Chunk(self.data[base:end], np.array([0, end - base]))
                sums, undo = part._prefix(), _power(_UNBASE, end - base + 1)
                out[some] = mix((sums[high - base] - sums[low - base]) * undo[low - base] + (high - low).astype(U64))
        return out

    def _prefix(self) -> np.ndarray:
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, U64)
            np.cumsum(_BYTE[self.data] * _power(_BASE, len(self.data)), out=self._sums[1:])
        return self._sums

    def gram_hashes(self, n: int) -> np.ndarray:
        """Hashes of the ``n`` bytes from each place on, across documents as well."""
        sums = self._prefix()
        grams = (sums[n:] - sums[:-n]) * _power(_UNBASE, len(self.data))[: len(sums) - n]
        grams ^= grams >> U64(32)
        return grams * U64(0xBF58476D1CE4E5B9)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per byte, by document."""
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The documents of a string array in order, a null as an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield Chunk(data[offsets[at]: offsets[upto]], offsets[at: upto + 1] - offsets[at], at)
        at = upto


def doc_of(first: np.ndarray) -> np.ndarray:
    """The document of each run, from ``runs``'s third result."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def within(first: np.ndarray, n: int) -> np.ndarray:
    """Marks the runs that begin ``n`` consecutive runs of one document (aligned with ``ngram_hashes``)."""
    total = int(first[-1])
    ok = np.ones(max(0, total - n + 1), bool)
    for k in range(1, n):
        cut = first[1:-1] - k
        ok[cut[(cut >= 0) & (cut < len(ok))]] = False
    return ok
