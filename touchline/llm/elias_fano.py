"""Elias-Fano sequences: nondecreasing integers in about 2 + log2(u / n) bits each, with constant-time-like ``select``.

A value is split into ``low_bits`` low bits, stored side by side, and the rest, stored in unary as one bit vector in which
the i-th set bit lies at (value >> low_bits) + i. Positions of every ``SAMPLE``-th set bit are kept, so ``select`` scans at
most the bytes between two samples.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = "<QBQQ"  # values, low bits, bytes of the low part, bytes of the high part


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        bits = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        vector = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        vector[ones] = 1
        return cls(
            n, low_bits, np.packbits(bits.ravel(), bitorder="little"), np.packbits(vector, bitorder="little"),
            ones[::SAMPLE].astype("<u4"),
        )

    def _low(self, i: int) -> int:
        start = i * self.low_bits
        part = self.low[start // 8 : (start + self.low_bits + 7) // 8].tobytes()
        return (int.from_bytes(part, "little") >> (start % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value."""
        at = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, at // 8
        block = int(self.high[byte]) >> (at % 8) << (at % 8)
        while (count := block.bit_count()) <= left:
            left, byte = left - count, byte + 1
            block = int(self.high[byte])
        for _ in range(left):
            block &= block - 1
        position = byte * 8 + (block & -block).bit_length() - 1
        return ((position - i) << self.low_bits) | self._low(i)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return high | low

    def to_bytes(self) -> bytes:
        head = struct.pack(_HEAD, self.n, self.low_bits, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence that starts at byte ``at``, and the byte after it."""
        n, low_bits, n_low, n_high = struct.unpack_from(_HEAD, data, at)
        at += struct.calcsize(_HEAD)
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        at += n_low + n_high
        n_samples = -(-n // SAMPLE)
        return cls(n, low_bits, low, high, np.frombuffer(data, "<u4", n_samples, at)), at + 4 * n_samples
