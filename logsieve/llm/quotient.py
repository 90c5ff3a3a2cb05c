"""Counting quotient filters over sorted 64-bit fingerprints, as arrays of bytes (numpy).

A filter holds the fingerprints of one shard: those with the same first `shard_bits` bits. The next `q` bits of a
fingerprint are its quotient, the home slot, and the rest its remainder. The remainders of a quotient stand in a
run, in ascending order, at the home slot or, where slots are taken, at the first free one after it. A count above
one follows its remainder as digits, in slots of their own. Per home slot one bit tells whether its run exists, per
slot one bit ends a run and one marks a digit; so quotients, remainders and counts are all recovered, and filters
merge without loss: their runs are read in order of quotient and remainder and counts of equal ones are added.

Bytes: q, bytes a slot, slots (4) | home bits | run ends | digit marks | slots, little-endian. A filter of no
fingerprints has one home slot and no others.
"""

from __future__ import annotations

import struct

import numpy as np

_U = np.uint64
_HEAD = struct.Struct("<BBI")
#: Share of the home slots in use, at most.
LOAD = 0.9


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags, bitorder="little").tobytes()


def _runs(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... for length[i] numbers, one run after another."""
    before = np.cumsum(length) - length
    return np.arange(length.sum()) + np.repeat(first - before, length)


def build(fps: np.ndarray, counts: np.ndarray, shard_bits: int) -> bytes:
    """The filter of ascending distinct fingerprints (uint64) of one shard and their counts (1 and more)."""
    n = len(fps)
    q = max(0, int(np.ceil(np.log2(max(1, n) / LOAD))))
    rest = 64 - shard_bits - q
    width = -(-rest // 8)
    inner = fps & _U((1 << (64 - shard_bits)) - 1)
    quotient = (inner >> _U(rest)).astype(np.int64)
    remainder = inner & _U((1 << rest) - 1)
    more = counts.astype(np.uint64) - _U(1)
    digits = np.zeros(n, np.int64)
    left = more.copy()
    while left.any():
        digits += left > 0
        left >>= _U(8 * width)
    run = np.flatnonzero(np.append(True, quotient[1:] != quotient[:-1])) if n else np.zeros(0, np.int64)
    taken = np.cumsum(1 + digits)
    before = taken - 1 - digits  # slots of the fingerprints before
    # a run starts at its home slot or where the run before it ends
    home, packed = quotient[run], before[run]
    start = packed + np.maximum.accumulate(home - packed) if n else home
    run_of = np.repeat(np.arange(len(run)), np.diff(np.append(run, n)))
    at = start[run_of] + before - packed[run_of]
    end = at + digits
    n_slots = int(end[-1]) + 1 if n else 0
    value, mark, ends = np.zeros(n_slots, np.uint64), np.zeros(n_slots, bool), np.zeros(n_slots, bool)
    value[at] = remainder
    spot = _runs(at + 1, digits)
    mark[spot] = True
    shift = (_runs(np.zeros(n, np.int64), digits) * (8 * width)).astype(np.uint64)
    value[spot] = (np.repeat(more, digits) >> shift) & _U((1 << (8 * width)) - 1)
    ends[end[np.append(run[1:], n) - 1] if n else []] = True
    homes = np.zeros(1 << q, bool)
    homes[home] = True
    slots = value.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    return _HEAD.pack(q, width, n_slots) + _bits(homes) + _bits(ends) + _bits(mark) + slots


def _parts(data: bytes):
    q, width, n_slots = _HEAD.unpack_from(data)
    raw, at, out = np.frombuffer(data, np.uint8), _HEAD.size, []
    for size in (1 << q, n_slots, n_slots):
        have = -(-size // 8)
        out.append(np.unpackbits(raw[at : at + have], count=size, bitorder="little").view(bool))
        at += have
    wide = np.zeros((n_slots, 8), np.uint8)
    wide[:, :width] = raw[at:].reshape(n_slots, width)
    return q, width, *out, wide.view("<u8").ravel().astype(np.uint64)


def _bounds(homes: np.ndarray, ends: np.ndarray):
    """Quotient, first and last slot of each run."""
    quotient, last = np.flatnonzero(homes), np.flatnonzero(ends)
    return quotient, np.maximum(quotient, np.append(-1, last[:-1]) + 1), last


def decode(data: bytes, shard: int, shard_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """All fingerprints of a filter, ascending, and their counts."""
    q, width, homes, ends, mark, value = _parts(data)
    quotient, first, last = _bounds(homes, ends)
    if not len(quotient):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    slot = _runs(first, last - first + 1)
    of = np.repeat(quotient, last - first + 1).astype(np.uint64)
    digit = mark[slot]
    item = np.cumsum(~digit) - 1
    at = np.flatnonzero(~digit)
    rank = (np.arange(len(slot)) - at[item] - 1)[digit].astype(np.uint64)
    counts = np.ones(len(at), np.uint64)
    np.add.at(counts, item[digit], value[slot[digit]] << (rank * _U(8 * width)))
    rest = 64 - shard_bits - q
    fps = (of[at] << _U(rest)) | value[slot[at]]
    if shard_bits:
        fps |= _U(shard) << _U(64 - shard_bits)
    return fps, counts.astype(np.int64)


def count(data: bytes, fp: int, shard_bits: int) -> int:
    """How often a filter counted a fingerprint of its shard (0: never)."""
    q, width, homes, ends, mark, value = _parts(data)
    rest = 64 - shard_bits - q
    inner = fp & ((1 << (64 - shard_bits)) - 1)
    home = inner >> rest
    if not homes[home]:
        return 0
    run = int(homes[:home].sum())
    _, first, last = _bounds(homes, ends)
    a, b = int(first[run]), int(last[run]) + 1
    for k in np.flatnonzero(~mark[a:b] & (value[a:b] == _U(inner & ((1 << rest) - 1)))) + a:
        n, i = 1, int(k) + 1
        while i < b and mark[i]:
            n += int(value[i]) << (8 * width * (i - int(k) - 1))
            i += 1
        return n
    return 0


def summed(fps: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct fingerprints with the sums of their counts."""
    order = np.argsort(fps, kind="stable")
    fps, counts = fps[order], counts[order]
    first = np.flatnonzero(np.append(True, fps[1:] != fps[:-1])) if len(fps) else np.zeros(0, np.int64)
    return fps[first], np.add.reduceat(counts, first) if len(first) else counts[:0]
