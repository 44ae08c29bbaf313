"""Token-id output: binary shards of raw ids, each with a minimal perfect hash index over its document keys."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions
from .mph import MinimalPerfectHash, mix
from .wordids import encoder

MAGIC = b"TIDX0001"
#: Ids in one shard at least, before it is closed; a longer document makes a longer shard.
SHARD_IDS = 1_000_000
SHARDS = "part int, shard int, start_in_part long, n_docs int, n_tokens long, first_key long, last_key long, data binary"
#: Keys whose shards are looked for one by one; more keys take all shards from the first to the last of them.
POINTS = 100


def pack_shard(keys: np.ndarray, null: np.ndarray, counts: np.ndarray, ids: list[np.ndarray]) -> bytes:
    """One shard file: header, perfect hash of the distinct keys, fingerprints, first ordinals, keys, offsets, ids.

    Rows come in key order, null keys first, so that the rows of one key are neighbours and the index holds the first.
    Ids take 2 bytes where all of them fit, else 4.
    """
    n_null = int(null.sum())
    distinct, first = np.unique(keys[n_null:], return_index=True)
    mph = MinimalPerfectHash.build(mix(distinct.astype(np.int64).view(np.uint64)))
    slot = mph.slots(mix(distinct.view(np.uint64)))
    prints, ordinal = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    prints[slot] = (mix(distinct.view(np.uint64)) >> np.uint64(32)).astype("<u4")
    ordinal[slot] = first + n_null
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
    flat = np.concatenate(ids) if ids else np.empty(0, "<u4")
    width = 2 if not len(flat) or flat.max() < 65536 else 4
    index = mph.dump()
    head = MAGIC + struct.pack("<IIIII", len(keys), n_null, len(distinct), width, len(index))
    return head + index + prints.tobytes() + ordinal.tobytes() + keys.astype("<i8").tobytes() + offsets.tobytes() + flat.astype(f"<u{width}").tobytes()


class Shard:
    """Keyed access to a shard's bytes: a key costs one hash, one slot, one fingerprint and one slice."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token shard")
        self.n, self.n_null, m, width, size = struct.unpack_from("<IIIII", data, 8)
        at = 28
        self.mph = MinimalPerfectHash.load(data[at : at + size])
        at += size
        self.prints = np.frombuffer(data, "<u4", m, at)
        self.ordinal = np.frombuffer(data, "<u4", m, at + 4 * m)
        self.keys = np.frombuffer(data, "<i8", self.n, at + 8 * m)
        self.offsets = np.frombuffer(data, "<u8", self.n + 1, at + 8 * (m + self.n))
        self.ids = np.frombuffer(data, f"<u{width}", -1, at + 8 * (m + self.n) + 8 * (self.n + 1))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """First row of each key, -1 where the fingerprint says that the shard lacks it."""
        if not len(self.prints):
            return np.full(len(keys), -1, np.int64)
        h = mix(np.asarray(keys, np.int64).view(np.uint64))
        slot = self.mph.slots(h)
        return np.where(self.prints[slot] == (h >> np.uint64(32)).astype("<u4"), self.ordinal[slot].astype(np.int64), -1)

    def row(self, i: int) -> np.ndarray:
        return self.ids[int(self.offsets[i]) : int(self.offsets[i + 1])].astype("<u4")


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode whole texts and write them as shards below ``path`` in ascending id order; gives the shard table.

    Rows are range-partitioned by (id, text hash), so that one id with very many rows spreads too, and sorted inside
    the partitions; a task closes a shard after ``shard_ids`` ids and holds one shard. Spark's commit makes a shard
    visible only with its task, so a lost executor leaves none half written. A null text counts as empty, null ids
    come first, rows of one id are ordered by text hash.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(partitions(docs.sparkSession), "key", "tie").sortWithinPartitions("key", "tie")

    def encode(batches):
        from pyspark import TaskContext

        enc, part = encoder(vocabulary), TaskContext.get().partitionId()
        keys: list = []
        ids: list[np.ndarray] = []
        held, number, done = 0, 0, 0
        tail = np.array([] if end_id is None else [end_id], "<u4")

        def close():
            null = np.array([k is None for k in keys], bool)
            data = pack_shard(np.array([k or 0 for k in keys], np.int64), null, np.array([len(x) for x in ids], np.int64), ids)
            return pd.DataFrame({"part": [part], "shard": [number], "start_in_part": [done], "n_docs": [len(keys)], "n_tokens": [held], "first_key": [next((k for k in keys if k is not None), None)], "last_key": [keys[-1]], "data": [data]})

        for batch in batches:
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                one = np.concatenate([enc.text(t), tail])
                keys.append(k)
                ids.append(one)
                held += len(one)
                if held >= shard_ids:
                    yield _arrow(close())
                    done, number, keys, ids, held = done + held, number + 1, [], [], 0
        if keys:
            yield _arrow(close())

    shards = ordered.select("key", "text").mapInArrow(encode, SHARDS)
    shards.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)
    return docs.sparkSession.read.schema(SHARDS).parquet(path)


def _arrow(frame: pd.DataFrame):
    import pyarrow as pa

    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(frame[c].tolist(), t) for c, t in zip(frame.columns, kinds, strict=True)], list(frame.columns))


def read_tokens(shards: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Each row is read through its shard's index, by key; rows without a key come first; repeated rows are all there; no
    shards give no rows. Only one total per writing partition reaches the driver; their number is that of the partitions.
    """
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    bases, at = {}, 0
    for r in totals:
        bases[r.part] = at
        at += r.n

    def rows(batches):
        for batch in batches:
            cols = (batch.column(c) for c in ("part", "start_in_part", "data"))
            for part, first, data in zip(*(c.to_pylist() for c in cols), strict=True):
                yield _rows(Shard(data), bases[part] + first)

    return shards.select("part", "start_in_part", "data").mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(shards: DataFrame, keys: list[int]) -> DataFrame:
    """doc_id and ids of the given keys, a row for each document that has the key; absent keys give none.

    The shards' first and last keys are compared in the scan, where the files' statistics leave out all others; in a
    shard a key costs one hash, one slot, one fingerprint and one slice, however many documents it holds.
    """
    wanted = sorted({int(k) for k in keys})
    if not wanted:
        return shards.limit(0).selectExpr("first_key AS doc_id", "CAST(NULL AS array<long>) AS ids")
    near = (F.col("last_key") >= wanted[0]) & (F.col("first_key") <= wanted[-1])
    if len(wanted) <= POINTS:
        one = F.lit(False)
        for k in wanted:
            one |= (F.col("first_key") <= k) & (F.col("last_key") >= k)
        near &= one

    def rows(batches):
        import pyarrow as pa

        every = np.array(wanted, np.int64)
        for batch in batches:
            cols = (batch.column(c).to_pylist() for c in ("first_key", "last_key", "data"))
            for first, last, data in zip(*cols, strict=True):
                s = Shard(data)
                some = every[(every >= first) & (every <= last)]
                at = s.find(some)
                hit = at >= 0
                hit[hit] = s.keys[at[hit]] == some[hit]
                out = [(k, s.row(i)) for k, a in zip(some[hit].tolist(), at[hit].tolist(), strict=True) for i in range(a, a + int(np.searchsorted(s.keys[a:], k, "right")))]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([x.tolist() for _, x in out], pa.list_(pa.int64()))], ["doc_id", "ids"])

    return shards.where(near).select("first_key", "last_key", "data").mapInArrow(rows, "doc_id long, ids array<long>")


def _rows(s: Shard, base: int):
    import pyarrow as pa

    distinct, copies = np.unique(s.keys[s.n_null :], return_counts=True)
    first = s.find(distinct)
    if (first < 0).any() or (s.keys[first] != distinct).any():
        raise ValueError("a key is missing from its shard's index")
    row = np.concatenate([np.arange(s.n_null), np.repeat(first - np.cumsum(copies) + copies, copies) + np.arange(s.n - s.n_null)])
    start, end = s.offsets[row].astype(np.int64), s.offsets[row + 1].astype(np.int64)
    crc = [zlib.crc32(s.row(int(i))) for i in row]
    null = np.arange(s.n) < s.n_null
    return pa.RecordBatch.from_arrays(
        [pa.array(s.keys[row], pa.int64(), mask=null), pa.array(start + base), pa.array(end - start), pa.array(crc, pa.int64())],
        ["doc_id", "start", "n_tokens", "ids_crc32"],
    )
