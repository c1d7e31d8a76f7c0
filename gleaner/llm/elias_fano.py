"""Elias-Fano coding of an ascending list: about 2 + log2(universe / n) bits an entry, with select."""

from __future__ import annotations

import numpy as np

SAMPLE = 64  # every 64th set bit of the upper part has its position stored


def encode(values: np.ndarray, universe: int) -> tuple[int, bytes, bytes, bytes]:
    """``low_bits, low, high, samples`` of ascending values up to ``universe``; repeats and no values are fine."""
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    low_bits = max(0, (int(universe) // n).bit_length() - 1) if n else 0
    shifts = np.arange(low_bits, dtype=np.uint64)
    low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
    ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    high = np.zeros(n + (int(universe) >> low_bits) + 1, dtype=np.uint8)
    high[ones] = 1
    samples = ones[::SAMPLE].astype("<u4")
    return low_bits, low.tobytes(), np.packbits(high, bitorder="little").tobytes(), samples.tobytes()


def decode(n: int, low_bits: int, low: bytes, high: bytes) -> np.ndarray:
    """All values."""
    if not n:
        return np.zeros(0, dtype=np.int64)
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(high, np.uint8), bitorder="little"))[:n]
    upper = (ones - np.arange(n)) << low_bits
    bits = np.unpackbits(np.frombuffer(low, np.uint8), bitorder="little")[: n * low_bits].reshape(n, low_bits)
    return upper + bits.astype(np.int64) @ (1 << np.arange(low_bits, dtype=np.int64))


def select(i: int, low_bits: int, low: bytes, high: bytes, samples: bytes) -> int:
    """Value ``i`` alone: from the nearest stored position, counting set bits byte by byte."""
    at = int(np.frombuffer(samples, "<u4", 1, i // SAMPLE * 4)[0])
    left = i % SAMPLE  # set bits to pass beyond the stored one
    if left:
        byte, bit = divmod(at + 1, 8)
        word = high[byte] >> bit << bit
        while left > word.bit_count():
            left -= word.bit_count()
            byte += 1
            word = high[byte]
        for _ in range(left - 1):
            word &= word - 1
        at = byte * 8 + (word & -word).bit_length() - 1
    value = (at - i) << low_bits
    first = i * low_bits
    for bit in range(low_bits):
        place = first + bit
        value |= (low[place >> 3] >> (place & 7) & 1) << bit
    return value
