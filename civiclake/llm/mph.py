"""Minimal perfect hashing by levels of collision-free bits, in numpy."""

from __future__ import annotations

import struct

import numpy as np

_GAMMA = 2.0
_LEVELS = 48


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer of uint64 values (multiply and xor-shift)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_bytes(values: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(v) for v in values), np.uint64, len(values))


class MinimalPerfectHash:
    """Distinct 64-bit hashes to 0..n-1 without gaps; a foreign hash gives some slot too, so keep fingerprints.

    Level k holds about twice as many bits as keys are left; keys alone on their bit stay there, the rest go on. The
    slot is the rank of the bit. Hashes still left after all levels (equal ones) are kept in a sorted list.
    """

    def __init__(self, bits: list[np.ndarray], rest: np.ndarray):
        self.bits, self.rest, self.ranks, at = bits, rest, [], 0
        for b in bits:
            ones = np.cumsum(b, dtype=np.int64) + at
            self.ranks.append(ones - 1)
            at = int(ones[-1]) if len(ones) else at
        self.n = at

    @classmethod
    def build(cls, hashes: np.ndarray) -> MinimalPerfectHash:
        left, bits = hashes, []
        while len(left) and len(bits) < _LEVELS:
            size = max(8, int(len(left) * _GAMMA))
            at = cls._place(left, len(bits), size)
            one = np.bincount(at, minlength=size) == 1
            bits.append(one)
            left = left[~one[at]]
        return cls(bits, np.unique(left))

    @staticmethod
    def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(hashes + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(size)).astype(np.int64)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int64)
        left = np.arange(len(hashes))
        for k, (b, r) in enumerate(zip(self.bits, self.ranks, strict=True)):
            if not len(left):
                return out
            at = self._place(hashes[left], k, len(b))
            hit = b[at]
            out[left[hit]] = r[at[hit]]
            left = left[~hit]
        if len(left) and len(self.rest):
            out[left] = self.n + np.minimum(np.searchsorted(self.rest, hashes[left]), len(self.rest) - 1)
        return out

    def dump(self) -> bytes:
        out = struct.pack("<II", len(self.bits), len(self.rest)) + self.rest.astype("<u8").tobytes()
        return out + b"".join(struct.pack("<I", len(b)) + np.packbits(b).tobytes() for b in self.bits)

    @classmethod
    def load(cls, data: bytes) -> MinimalPerfectHash:
        levels, rest = struct.unpack_from("<II", data)
        at, bits = 8 + 8 * rest, []
        for _ in range(levels):
            (n,) = struct.unpack_from("<I", data, at)
            size = (n + 7) // 8
            bits.append(np.unpackbits(np.frombuffer(data, np.uint8, size, at + 4), count=n).astype(bool))
            at += 4 + size
        return cls(bits, np.frombuffer(data, "<u8", rest, 8).astype(np.uint64))
