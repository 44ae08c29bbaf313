"""Words and word windows of whole texts as 64-bit hashes, for many texts at once in numpy."""

from __future__ import annotations

import numpy as np

from .mph import mix

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_ODD = np.uint64(0xD6E8FEB86659FD93)
#: The low n bytes of eight.
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: A word of more bytes is hashed by itself.
_LONG = 64
#: Texts that are hashed together, in bytes; a longer text goes alone.
RUN = 1 << 20


def _hash_words(joined: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, eight bytes at a time, each step mixed: up to eight bytes, words of one length never collide."""
    import xxhash

    wide = np.ndarray((len(joined),), "<u8", joined + bytes(8), strides=(1,))
    size = ends - starts
    h = mix((size.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE))
    left, k = np.flatnonzero(size <= _LONG), 0
    while len(left):
        part = wide[starts[left] + k] & _LOW[np.minimum(size[left] - k, 8)]
        h[left] = mix(h[left] ^ (part * _ODD))
        k += 8
        left = left[size[left] > k]
    for i in np.flatnonzero(size > _LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(joined[starts[i] : ends[i]])
    return h


def word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Hash, start and end (in the joined bytes) of every word, first word of each text (and the end), joined bytes."""
    joined = b"\n".join(raw) + b"\n"
    space = _SPACE[np.frombuffer(joined, np.uint8)]
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    offsets = np.concatenate([[0], np.cumsum([len(x) + 1 for x in raw])])
    return _hash_words(joined, starts, ends), starts, ends, np.searchsorted(starts, offsets), joined


def windows(h: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` neighbouring word hashes (over text borders too: the caller leaves those out)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, salt + size, np.uint64)
    c = 1
    for k in range(size):
        c = c * _BASE % (1 << 64)
        out += h[k : k + n] * np.uint64(c)
    return mix(out)


def shingle_sets(raw: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct window hashes of each text; a text of fewer words gives one hash of them all, without words none."""
    h, _, _, first, _ = word_hashes(raw)
    every = windows(h, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            s = np.sort(every[a : b - size + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        else:
            out.append(windows(h[a:b], b - a, salt=1 << 32) if b > a else np.empty(0, np.uint64))
    return out


def runs(items: list[bytes]):
    """Slices of a list whose bytes stay near RUN."""
    start, size = 0, 0
    for i, x in enumerate(items):
        size += len(x)
        if size >= RUN:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(items):
        yield slice(start, len(items))
