"""Elias-Fano coding of non-decreasing sequences, with select samples.

n values below u take n * (2 + log2(u / n)) bits: each value's low bits are packed as they are,
the high bits are in unary, value i setting bit (high + i). A sample of every SAMPLE-th set bit
(32 bits each) lets `get` find the i-th value without decoding the rest.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 256
_COUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def encode(values: np.ndarray) -> dict:
    """low_bits, low, high, samples (bytes each) and n of a non-decreasing array of integers >= 0."""
    v = np.asarray(values, dtype=np.uint64)
    n = len(v)
    top = int(v[-1]) + 1 if n else 0
    bits = max(0, (top // n).bit_length() - 1) if n else 0
    if bits:
        shifts = np.arange(bits, dtype=np.uint64)
        low = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()
    else:
        low = b""
    ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
    unary = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
    unary[ones] = 1
    return {"n": n, "low_bits": bits, "low": low, "high": np.packbits(unary, bitorder="little").tobytes(),
            "samples": ones[::SAMPLE].astype("<u4").tobytes()}


def decode(n: int, low_bits: int, low: bytes, high: bytes) -> np.ndarray:
    """All n values."""
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(high, np.uint8), bitorder="little"))[:n]
    v = (ones - np.arange(n)).astype(np.uint64) << np.uint64(low_bits)
    if low_bits:
        b = np.unpackbits(np.frombuffer(low, np.uint8), bitorder="little")[: n * low_bits].reshape(n, low_bits)
        v |= (b.astype(np.uint64) << np.arange(low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return v.astype(np.int64)


def get(i: int, low_bits: int, low: bytes, high: bytes, samples: bytes) -> int:
    """The i-th value alone: from the nearest sampled set bit, counting set bits a byte at a time."""
    at = int(np.frombuffer(samples, "<u4")[i // SAMPLE])
    left = i % SAMPLE
    view = np.frombuffer(high, np.uint8)
    byte, word = at >> 3, int(view[at >> 3]) >> (at & 7) << (at & 7)
    while left >= _COUNT[word]:
        left -= int(_COUNT[word])
        byte += 1
        word = int(view[byte])
    for _ in range(left):
        word &= word - 1
    one = byte * 8 + (word & -word).bit_length() - 1
    value = (one - i) << low_bits
    if low_bits:
        first = i * low_bits
        chunk = int.from_bytes(low[first >> 3 : (first + low_bits + 7) >> 3], "little")
        value |= (chunk >> (first & 7)) & ((1 << low_bits) - 1)
    return value
