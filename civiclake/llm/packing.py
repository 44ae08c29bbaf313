"""Sequence packing: vector bin packing by the dot-product heuristic, under token, segment and loss-token limits."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordids import encoder

#: Examples that one task places at a time; what it holds is bounded by this and the longest example.
POOL = 1024
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


def pack_pool(tokens: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int]) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences for one pool of examples, as lists of (example, start, length).

    ``tokens`` and ``loss`` are the examples' sizes; the loss-bearing tokens are an example's last ones. A sequence
    keeps within ``limits`` (tokens, segments, loss tokens). While a whole example fits, the one with the largest
    dot product of its size vector and the room left, both in units of the limits, is placed. Where none fits, the
    example with the largest product is cut to the room. When the pool runs dry the open sequence is cut into
    lengths that are powers of two, which need no padding.
    """
    cap, segments, cap_loss = limits
    n = len(tokens)
    left, left_loss, start = tokens.astype(np.int64).copy(), loss.astype(np.int64).copy(), np.zeros(n, np.int64)
    alive = np.arange(n)
    while len(alive):
        room, room_s, room_l, bin_ = cap, segments, cap_loss, []
        while room and room_s and len(alive):
            t, lo = left[alive], left_loss[alive]
            score = t * (room / cap**2) + lo * (room_l / cap_loss**2) + room_s / segments**2
            fits = (t <= room) & (lo <= room_l)
            if fits.any():
                k = int(np.argmax(np.where(fits, score, -1.0)))
                i, take = int(alive[k]), int(t[k])
            else:
                # The front part of an example: its prompt tokens first, then as many loss tokens as there is room for.
                free = np.minimum(np.minimum(t, room), t - lo + room_l)
                k = int(np.argmax(np.where(free > 0, score, -1.0)))
                i, take = int(alive[k]), int(free[k])
                if take <= 0:
                    break
            got = max(0, take - int(left[i] - left_loss[i]))
            bin_.append((i, int(start[i]), take))
            start[i] += take
            left[i] -= take
            left_loss[i] -= got
            room, room_s, room_l = room - take, room_s - 1, room_l - got
            if not left[i]:
                alive = np.delete(alive, k)
        if room and room_s and not len(alive):
            yield from _powers(bin_)
        else:
            yield bin_


def _powers(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces, cut into sequences whose lengths are powers of two."""
    pieces = pieces[::-1]
    total = sum(p[2] for p in pieces)
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        out = []
        while size:
            i, s, n = pieces.pop()
            take = min(n, size)
            out.append((i, s, take))
            size -= take
            if take < n:
                pieces.append((i, s + take, n - take))
        yield out


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int, max_tokens: int = 2048, max_segments: int = 256, max_loss: int | None = None, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens.

    An example is the ids of its prompt (optional, bearing no loss), its text and ``end_id``; null texts are empty.
    Every id lies in exactly one piece. Each task packs its own rows in pools of ``POOL``, so nothing is shuffled
    and a hot source or very long texts matter only to the scan. sequence_id is unique, not dense: the partition
    number in the upper bits. An empty table gives no pieces; repeated rows and null ids are packed like any other.
    """
    limits = (max_tokens, max_segments, max_tokens if max_loss is None else max_loss)
    if min(limits) < 1:
        raise ValueError("limits must be positive")
    prompt = F.col(prompt_col) if prompt_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), prompt.alias("prompt"), F.col(text_col).alias("text"))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        enc = encoder(vocabulary)
        sequence = TaskContext.get().partitionId() << 33
        tail = np.array([end_id], "<u4")

        def flush(keys, ids, loss):
            nonlocal sequence
            out = [[] for _ in range(8)]
            sizes = np.array([len(x) for x in ids])
            for bin_ in pack_pool(sizes, np.array(loss), limits):
                at = 0
                for i, s, n in bin_:
                    bears = min(n, max(0, s + n - (len(ids[i]) - loss[i])))
                    for c, v in zip(out, (keys[i], s, n, zlib.crc32(ids[i][s : s + n]), len(ids[i]), sequence, at, bears), strict=True):
                        c.append(v)
                    at += n
                sequence += 1
            names = [x.split()[0] for x in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)

        keys, ids, loss = [], [], []
        for b in batches:
            for k, p, t in zip(*(b.column(c).to_pylist() for c in ("id", "prompt", "text")), strict=True):
                head = enc.text(p)
                one = np.ascontiguousarray(np.concatenate([head, enc.text(t), tail]), "<u4")
                keys.append(k)
                ids.append(one)
                loss.append(len(one) - len(head))
                if len(keys) >= POOL:
                    yield flush(keys, ids, loss)
                    keys, ids, loss = [], [], []
        if keys:
            yield flush(keys, ids, loss)

    return rows.mapInArrow(run, PIECES)
