"""Elias-Fano sequences and a two-level n-gram trie, in flat arrays that can be memory-mapped."""

from __future__ import annotations

import mmap

import numpy as np

#: Bits of a successor's hash below its context.
SUCCESSOR_BITS = 40
#: Codes of counts: exact up to ``EXACT``, then in steps of a factor. 0: not there.
EXACT, FACTOR = 32_767, 1.0005
_HEAD = np.dtype("<i8")


class EliasFano:
    """A sorted sequence of unsigned 64-bit integers: low bits packed, high bits as a bit vector with a one per value."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self._low, self._high = n, low_bits, low, high
        # Where each bucket of equal high bits begins: the zeros of the bit vector end the buckets.
        zeros = np.flatnonzero(np.unpackbits(high, bitorder="little") == 0) if n else np.empty(0, np.int64)
        self._bucket = np.concatenate([[0], zeros - np.arange(len(zeros))]).clip(0, n)

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        if not n:
            return cls(0, 0, np.zeros(2, np.uint64), np.zeros(0, np.uint8))
        low_bits = max(0, int(values[-1] // np.uint64(n)).bit_length() - 1)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 2, np.uint8)
        bits[ones] = 1
        low = np.zeros(n * low_bits // 64 + 2, np.uint64)
        if low_bits:
            at = np.arange(n, dtype=np.int64) * low_bits
            part = values & np.uint64((1 << low_bits) - 1)
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            # The values do not overlap, so adding up the parts of a word sets its bits.
            np.add.at(low, word, part << shift)
            over = (at & 63) + low_bits > 64
            np.add.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"))

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        # A shift by 64 is undefined: the upper part is shifted in two steps.
        value = (self._low[word] >> shift) | ((self._low[word + 1] << (np.uint64(63) - shift)) << np.uint64(1))
        return value & np.uint64((1 << self.low_bits) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        high = np.searchsorted(self._bucket, i, "right") - 1
        return high.astype(np.uint64) << np.uint64(self.low_bits) | self.lows(i)

    def find(self, values: np.ndarray, first: np.ndarray | int = 0, stop: np.ndarray | None = None) -> np.ndarray:
        """Place of the successor (least element not below) of each value within [first, stop), or -1 unless it is the value itself."""
        if not self.n or not len(values):
            return np.full(len(values), -1)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        beyond = high >= len(self._bucket) - 1
        high[beyond] = 0
        lo = np.maximum(self._bucket[high], first)
        end = np.minimum(self._bucket[high + 1], self.n if stop is None else stop)
        wanted = values & np.uint64((1 << self.low_bits) - 1)
        left, right = lo.copy(), np.maximum(end, lo)
        while True:
            open_ = np.flatnonzero(left < right)
            if not len(open_):
                break
            mid = (left[open_] + right[open_]) >> 1
            smaller = self.lows(mid) < wanted[open_]
            left[open_] = np.where(smaller, mid + 1, left[open_])
            right[open_] = np.where(smaller, right[open_], mid)
        hit = (left < end) & ~beyond
        hit[hit] = self.lows(left[hit]) == wanted[hit]
        return np.where(hit, left, -1)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits, len(self._low), len(self._high)], _HEAD), self._low, self._high, np.zeros(-len(self._high) % 8, np.uint8)]

    @classmethod
    def read(cls, buffer: memoryview, at: int) -> tuple[EliasFano, int]:
        n, low_bits, n_low, n_high = np.frombuffer(buffer, _HEAD, 4, at).tolist()
        at += 32
        low = np.frombuffer(buffer, np.uint64, n_low, at)
        at += 8 * n_low
        high = np.frombuffer(buffer, np.uint8, n_high, at)
        return cls(n, low_bits, low, high), at + n_high + -n_high % 8


def quantised(counts: np.ndarray) -> np.ndarray:
    large = np.maximum(counts, EXACT)
    codes = np.where(counts <= EXACT, counts, EXACT + np.rint(np.log(large / EXACT) / np.log(FACTOR)))
    return np.minimum(codes, 65_535).astype(np.uint16)


def dequantised(codes: np.ndarray) -> np.ndarray:
    table = np.concatenate([np.arange(EXACT + 1), EXACT * FACTOR ** np.arange(1, 65_536 - EXACT)])
    return table[codes]


class NgramTrie:
    """Contexts (sorted hashes), pointers to their successors, successors relative to their context, quantised counts."""

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.contexts, self.pointers, self.successors, self.codes = contexts, pointers, successors, codes

    @classmethod
    def build(cls, contexts: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> NgramTrie:
        """``contexts``: sorted hashes; ``keys``: sorted (number of the context, successor) in one integer; their counts."""
        owner = (keys >> np.uint64(SUCCESSOR_BITS)).astype(np.int64)
        pointers = np.searchsorted(owner, np.arange(len(contexts) + 1)).astype(np.uint64)
        return cls(EliasFano.build(contexts), EliasFano.build(pointers), EliasFano.build(keys), quantised(counts))

    def lookup(self, contexts: np.ndarray, degrees: np.ndarray, successors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of successors of each context, and code of each successor (``degrees`` of them belong to each context in turn)."""
        node = self.contexts.find(contexts)
        known = node >= 0
        first, stop = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
        first[known], stop[known] = self.pointers[node[known]], self.pointers[node[known] + 1]
        of = np.repeat(np.arange(len(contexts)), degrees)
        asked = np.flatnonzero(known[of])
        of = of[asked]
        place = self.successors.find(node[of].astype(np.uint64) << np.uint64(SUCCESSOR_BITS) | successors[asked], first[of], stop[of])
        codes = np.zeros(len(successors), np.uint16)
        codes[asked] = np.where(place >= 0, self.codes[place], 0)
        return stop - first, codes

    def to_bytes(self) -> bytes:
        parts = [p for x in (self.contexts, self.pointers, self.successors) for p in x.parts()]
        return b"".join(p.tobytes() for p in [*parts, np.array([len(self.codes)], _HEAD), self.codes])

    @classmethod
    def from_buffer(cls, buffer: bytes | mmap.mmap) -> NgramTrie:
        """Views of ``buffer``; nothing is copied, so that a mapped file is read where it is asked."""
        view, at, found = memoryview(buffer), 0, []
        for _ in range(3):
            sequence, at = EliasFano.read(view, at)
            found.append(sequence)
        n = int(np.frombuffer(view, _HEAD, 1, at)[0])
        return cls(*found, np.frombuffer(view, np.uint16, n, at + 8))

    @classmethod
    def mapped(cls, path: str) -> NgramTrie:
        with open(path, "rb") as file:
            return cls.from_buffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
