"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the others by a heap over linked bytes; and back."""

from __future__ import annotations

import base64
import hashlib
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .mph import MinimalPerfectHash, hash_bytes

#: Entries of a worker's tables; a full one starts anew: memory is bounded, no result changes.
CACHE = 800_000
#: Longer words are rarer: they are put together from their pre-tokens each time.
SHORT = 10
_CODECS: dict[tuple[str, str], "ByteBpe"] = {}


class ByteBpe:
    """A rank file's codec. ``pattern`` cuts a text into pre-tokens; special tokens are ordinary text."""

    def __init__(self, path: str, pattern: str):
        import regex

        lines = (x.split() for x in Path(path).read_bytes().splitlines() if x)
        self.ranks = {base64.b64decode(a): int(b) for a, b in lines}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            self.tokens[i] = token
        self.longest = max(map(len, self.ranks))
        known = list(self.ranks)
        hashes = hash_bytes(known)
        self.mph = MinimalPerfectHash.build(hashes)
        slot = self.mph.slots(hashes)
        self.slot_id, self.slot_print = np.zeros(len(known), np.int64), np.zeros(len(known), np.uint32)
        self.slot_id[slot] = np.fromiter(self.ranks.values(), np.int64, len(known))
        self.slot_print[slot] = (hashes >> np.uint64(32)).astype(np.uint32)
        self.find = regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes | None] = {}

    def whole(self, pieces: list[bytes]) -> list[int]:
        """The id of each pre-token that is itself in the vocabulary, else -1: one slot, one fingerprint, one compare."""
        h = hash_bytes(pieces)
        slot = self.mph.slots(h)
        ids = np.where(self.slot_print[slot] == (h >> np.uint64(32)).astype(np.uint32), self.slot_id[slot], -1).tolist()
        return [i if i >= 0 and self.tokens[i] == p else -1 for i, p in zip(ids, pieces, strict=True)]

    def merge(self, piece: bytes) -> list[int]:
        """Lowest rank first, leftmost on ties: a heap of neighbouring pairs over a linked list of byte spans."""
        n, rank, longest = len(piece), self.ranks.get, self.longest
        after, before = list(range(1, n + 2)), list(range(-1, n))
        # One int for rank and place: compares faster than a tuple.
        shift = n.bit_length()
        low = (1 << shift) - 1
        pair = [rank(piece[i : i + 2]) for i in range(n - 1)]
        heap = [r << shift | i for i, r in enumerate(pair) if r is not None]
        pair.append(None)
        heapify(heap)
        while heap:
            top = heappop(heap)
            i = top & low
            if pair[i] != top >> shift:
                continue
            j = after[i]
            end = after[i] = after[j]
            before[end] = i
            pair[j] = r = None
            if end < n and (stop := after[end]) - i <= longest:
                r = rank(piece[i:stop])
                if r is not None:
                    heappush(heap, r << shift | i)
            pair[i] = r
            k = before[i]
            if k >= 0:
                r = pair[k] = rank(piece[k:end]) if end - k <= longest else None
                if r is not None:
                    heappush(heap, r << shift | k)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def learn(self, words: list[str]) -> dict[str, bytes | None]:
        """Ids of a space and each word (None: white space at its edge needs its context). Short ones are kept."""
        find, pieces = self.find, self.pieces
        cut: dict[str, list[str] | None] = {}
        for w in words:
            if w.isascii() and w.isalpha():
                cut[w] = [" " + w]
            elif w.isascii() and w[-1:] in (".", ",") and w[:-1].isalpha():
                cut[w] = [" " + w[:-1], w[-1]]
            else:
                cut[w] = find(" " + w) if w and not w[0].isspace() and not w[-1].isspace() else None
        self.learn_pieces({p for c in cut.values() if c for p in c})
        out = {w: None if c is None else b"".join([pieces[p] for p in c]) for w, c in cut.items()}
        self.words.update((w, v) for w, v in out.items() if len(w) <= SHORT)
        return out

    def learn_pieces(self, pieces: set[str]) -> None:
        if len(self.pieces) + len(pieces) > CACHE:
            self.pieces.clear()
        new = [p for p in pieces if p not in self.pieces]
        raw = [p.encode() for p in new]
        for p, b, i in zip(new, raw, self.whole(raw), strict=True):
            self.pieces[p] = i.to_bytes(4, "little") if i >= 0 else b"".join([x.to_bytes(4, "little") for x in self.merge(b)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian uint32 bytes, in bounded runs."""
        out: list[bytes] = []
        run: list[str] = []
        size = 0
        for t in texts:
            run.append(t)
            size += len(t)
            if size > 1_000_000:
                out += self._run(run)
                run, size = [], 0
        return out + self._run(run)

    def _run(self, texts: list[str]) -> list[bytes]:
        # A single space between two words belongs to the second; any other white space needs its context.
        cut = [None if not t or t[0].isspace() or t[-1].isspace() or any(x in t for x in ("  ", " \n", "\n ")) else t.split(" ") for t in texts]
        words: set[str] = set()
        for c in cut:
            if c:
                words.update(c[1:])
        # Only here, where all words of the run are looked up afterwards.
        if len(self.words) > CACHE // 2:
            self.words.clear()
        known = self.words
        table = self.learn([w for w in words if w not in known])
        out = []
        for t, c in zip(texts, cut, strict=True):
            ids = None
            if c:
                ids = [known[w] if w in known else table[w] for w in c[1:]]
            if ids is None or None in ids:
                found = self.find(t)
                self.learn_pieces(set(found))
                out.append(b"".join([self.pieces[p] for p in found]))
            else:
                found = self.find(c[0])
                self.learn_pieces(set(found))
                out.append(b"".join([self.pieces[p] for p in found]) + b"".join(ids))
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(path: str, pattern: str) -> ByteBpe:
    """This worker's codec of a rank file."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = ByteBpe(path, pattern)
    return _CODECS[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``ids`` (binary, little-endian uint32) of every whole text; a null text is empty and has no ids.

    Narrow: no shuffle. Repeated rows, null ids and other columns need no care; an empty table gives no rows.
    """
    return _mapped(docs, path, pattern, id_col, text_col, False)


def decode_column(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the decoded bytes of an ``ids`` column.

    Null ids decode to null, no ids to no bytes; ids of any number, repeated rows, ties and null doc_ids need no care;
    other columns are ignored; an empty table gives no rows.
    """

    def run(batches):
        import pyarrow as pa

        c = codec(path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([None if x is None else c.decode(x) for x in b.column("ids").to_pylist()], pa.binary())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text binary")


def digest_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, decodes the ids again and digests both.

    A null text counts as empty; texts of any length are encoded in whole; repeated rows and null doc_ids have rows of
    their own; other columns, whatever their names, are ignored; an empty table gives no rows.
    """
    return _mapped(docs, path, pattern, id_col, text_col, True)


def _mapped(docs: DataFrame, path: str, pattern: str, id_col: str, text_col: str, digest: bool) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        import pyarrow as pa

        c = codec(path, pattern)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids = c.encode(part.column("text").to_pylist())
                if digest:
                    cols = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([sha(x) for x in ids], pa.string()), pa.array([sha(c.decode(x)) for x in ids], pa.string())]
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), *cols], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "doc_id long, ids binary")
