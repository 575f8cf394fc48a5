"""Elias-Fano coding of ascending whole numbers, with select."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# One position is kept for so many ones of the upper bits; between them select counts.
SAMPLE = 256


@dataclass(frozen=True)
class EliasFano:
    """``size`` ascending numbers from 0 to ``top`` in about 2 + log2(top / size) bits each."""

    size: int
    top: int
    low_bits: int
    low: bytes
    high: bytes
    samples: bytes

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if n and (np.diff(values.astype(np.int64)) < 0).any():
            raise ValueError("values must ascend")
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        upper = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        upper[places] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        lower = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
        return EliasFano(
            n,
            top,
            low_bits,
            np.packbits(lower, bitorder="little").tobytes(),
            np.packbits(upper, bitorder="little").tobytes(),
            places[::SAMPLE].astype("<u4").tobytes(),
        )

    def values(self) -> np.ndarray:
        """All numbers."""
        upper = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        places = np.flatnonzero(upper)[: self.size]
        high = (places - np.arange(self.size)).astype(np.int64) << self.low_bits
        return high + self._lows(0, self.size)

    def select(self, i: int) -> int:
        """The number at place ``i``, found from the nearest sample."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        place = int(np.frombuffer(self.samples, "<u4")[i // SAMPLE])
        left, byte = i % SAMPLE, place // 8
        bits = int.from_bytes(self.high[byte : byte + 1], "little") >> place % 8 << place % 8
        while bits.bit_count() <= left:
            left -= bits.bit_count()
            byte += 1
            bits = self.high[byte]
        for _ in range(left):
            bits &= bits - 1
        place = byte * 8 + (bits & -bits).bit_length() - 1
        return ((place - i) << self.low_bits) + int(self._lows(i, i + 1)[0])

    def _lows(self, start: int, end: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(end - start, np.int64)
        first, last = start * self.low_bits, end * self.low_bits
        bits = np.unpackbits(np.frombuffer(self.low[first // 8 : -(-last // 8)], np.uint8), bitorder="little")
        rows = bits[first % 8 : first % 8 + last - first].reshape(end - start, self.low_bits)
        return rows.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
