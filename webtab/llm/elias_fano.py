"""Elias-Fano codes of non-decreasing integers, in bytes.

For n values up to u the lower ``l = floor(log2(u / n))`` bits of each value
are stored as they are and the upper parts in unary: value i sets bit
``(v >> l) + i``. That is at most ``2 + log2(u / n)`` bits per value.
``select`` finds the i-th set bit from one sampled position in every
``SAMPLE``, so a single value, or a stretch of them, is read without decoding the rest.

Layout, little-endian: n (8 bytes), l (1), length of the low part (4), length
of the high part (4), low part, high part, sampled positions (4 bytes each).
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
HEAD = "<QBII"


def encode(values: np.ndarray) -> bytes:
    """``values``: non-decreasing, none negative."""
    v = np.asarray(values, dtype=np.uint64)
    n = len(v)
    if n == 0:
        return struct.pack(HEAD, 0, 0, 0, 0)
    low_bits = max(0, (int(v[-1]) // n).bit_length() - 1)
    low = b""
    if low_bits:
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()
    places = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(places[-1]) + 1, np.uint8)
    bits[places] = 1
    high = np.packbits(bits, bitorder="little").tobytes()
    return struct.pack(HEAD, n, low_bits, len(low), len(high)) + low + high + places[::SAMPLE].astype("<u4").tobytes()


class Sequence:
    """Reads an encoded sequence."""

    def __init__(self, data: bytes) -> None:
        self.n, self.low_bits, a, b = struct.unpack_from(HEAD, data)
        at = struct.calcsize(HEAD)
        self._low = np.frombuffer(data, np.uint8, a, at)
        self._high = np.frombuffer(data, np.uint8, b, at + a)
        self._marks = np.frombuffer(data, "<u4", -1, at + a + b) if self.n else np.zeros(0, "<u4")

    def _lower(self, i: int) -> int:
        start = i * self.low_bits
        end = start + self.low_bits
        part = int.from_bytes(self._low[start >> 3:(end + 7) >> 3].tobytes(), "little")
        return (part >> (start & 7)) & ((1 << self.low_bits) - 1)

    def _place(self, i: int) -> int:
        """Place of set bit number ``i`` of the high part."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self._marks[i // SAMPLE]), i % SAMPLE
        byte = place >> 3
        left += int(np.bitwise_count(self._high[byte] & np.uint8((1 << (place & 7)) - 1)))
        while True:  # whole blocks by their population, then inside one
            ones = np.cumsum(np.bitwise_count(self._high[byte:byte + 64]), dtype=np.int64)
            if ones[-1] > left:
                break
            left, byte = left - int(ones[-1]), byte + 64
        k = int(np.searchsorted(ones, left, "right"))
        inside = left - (int(ones[k - 1]) if k else 0)
        bit = int(np.flatnonzero(np.unpackbits(self._high[byte + k:byte + k + 1], bitorder="little"))[inside])
        return (byte + k) * 8 + bit

    def select(self, i: int) -> int:
        """Value number ``i``."""
        return ((self._place(i) - i) << self.low_bits) | self._lower(i)

    def between(self, a: int, b: int) -> np.ndarray:
        """Values number ``a`` to ``b - 1``: select finds both ends, and only what lies between them is decoded."""
        if a >= b:
            return np.zeros(0, np.int64)
        first, last = self._place(a) >> 3, self._place(b - 1) >> 3
        places = np.flatnonzero(np.unpackbits(self._high[first:last + 1], bitorder="little")) + first * 8
        skipped = int(np.searchsorted(places, self._place(a)))
        out = (places[skipped:skipped + b - a] - np.arange(a, b)).astype(np.int64) << self.low_bits
        if self.low_bits:
            start = a * self.low_bits
            bits = np.unpackbits(self._low[start >> 3:(b * self.low_bits + 7) >> 3], bitorder="little")[start & 7:]
            out |= (bits[:(b - a) * self.low_bits].reshape(b - a, self.low_bits).astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
        return out

    def rank(self, value: int) -> int:
        """How many values are smaller: a binary search by select."""
        a, b = 0, self.n
        while a < b:
            m = (a + b) // 2
            a, b = (m + 1, b) if self.select(m) < value else (a, m)
        return a

    def all(self) -> np.ndarray:
        """All values, as 64-bit integers."""
        if not self.n:
            return np.zeros(0, np.int64)
        high = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[:self.n] - np.arange(self.n)
        out = high.astype(np.int64) << self.low_bits
        if self.low_bits:
            bits = np.unpackbits(self._low, bitorder="little")[:self.n * self.low_bits].reshape(self.n, self.low_bits)
            out |= (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
        return out
