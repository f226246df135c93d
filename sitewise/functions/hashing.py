"""Spark's ``xxhash64`` of whole columns in numpy: the same number that the expression gives."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x, n: int):
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _end(h):
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _word(h, k):
    return _turn(h ^ (_turn(k * _P2, 31) * _P1), 27) * _P1 + _P4


def _half(h, k):
    return _turn(h ^ (k * _P1), 23) * _P2 + _P3


class Hashed:
    """A column of integers or strings without nulls, laid out once and hashed after any prefix.

    ``seeded(h)`` is the hash of (prefix, value), ``h`` that of the prefix: a number, or one for each value.
    """

    def __init__(self, values: pa.Array):
        self.size = len(values)
        self.text = pa.types.is_string(values.type) or pa.types.is_large_string(values.type)
        if not self.text:
            self.wide = pa.types.is_int64(values.type)
            numbers = values.to_numpy(zero_copy_only=False).astype(np.int64)
            self.numbers = numbers.view(np.uint64) if self.wide else numbers.astype(np.int32).view(np.uint32).astype(np.uint64)
            return
        rows = [v.encode() for v in values.to_pylist()]
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        self.groups = []  # (rows, length, words of eight bytes, a word of four or none, last bytes)
        for n in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == n)
            raw = np.frombuffer(b"".join(rows[k] for k in own.tolist()), np.uint8).reshape(len(own), n)
            at = n & -8
            words = np.ascontiguousarray(raw[:, :at]).view("<u8").astype(np.uint64)
            half = np.ascontiguousarray(raw[:, at : at + 4]).view("<u4")[:, 0].astype(np.uint64) if n - at >= 4 else None
            rest = raw[:, at + 4 * (half is not None) :].astype(np.uint64)
            self.groups.append((own, n, words, half, rest))

    def seeded(self, prefix) -> np.ndarray:
        prefix = np.asarray(prefix).astype(np.int64).view(np.uint64)
        with np.errstate(over="ignore"):
            if not self.text:
                h = np.broadcast_to(prefix + _P5 + np.uint64(8 if self.wide else 4), self.size)
                return _end(_word(h, self.numbers) if self.wide else _half(h, self.numbers)).view(np.int64)
            out = np.empty(self.size, np.uint64)
            for own, n, words, half, rest in self.groups:
                seed, first = np.broadcast_to(prefix if prefix.ndim == 0 else prefix[own], len(own)), 0
                h = seed + _P5
                if n >= 32:
                    first = n // 32 * 4
                    lanes = [seed + _P1 + _P2, seed + _P2, seed, seed - _P1]
                    for k in range(first):
                        lanes[k % 4] = _turn(lanes[k % 4] + words[:, k] * _P2, 31) * _P1
                    h = sum(_turn(x, r) for x, r in zip(lanes, (1, 7, 12, 18)))
                    for x in lanes:
                        h = (h ^ (_turn(x * _P2, 31) * _P1)) * _P1 + _P4
                h = h + np.uint64(n)
                for k in range(first, words.shape[1]):
                    h = _word(h, words[:, k])
                if half is not None:
                    h = _half(h, half)
                for k in range(rest.shape[1]):
                    h = _turn(h ^ (rest[:, k] * _P5), 11) * _P1
                out[own] = _end(h)
        return out.view(np.int64)


def hash_number(value: int, wide: bool, prefix) -> np.ndarray:
    """The hash of (prefix, a number) for each prefix."""
    prefix = np.asarray(prefix)
    return Hashed(pa.array(np.full(prefix.size, value), pa.int64() if wide else pa.int32())).seeded(prefix)
