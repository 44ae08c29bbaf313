"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes of a text, by products of sparse incidence matrices."""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass
from functools import cached_property
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, scratch, store

#: Bytes of text that are aligned together; a longer text goes alone.
RUN = 1 << 19
#: Id pairs that tasks hold as a table; the others are joined. A pair, its count and its mark take 17 bytes.
COMMON = 1 << 20
#: Pairs that a task holds before it hands on their counts.
HELD = 1 << 22
#: Nonzeros of a product that are made at a time.
PRODUCT = 1 << 22
#: Characters whose classes every release of the character tables since 2010 gives alike; for other texts the json file's own library is asked.
_SETTLED = re.compile(r"[\u0000-\u02FF\u2010-\u2027\u2030-\u205E\u20A0-\u20B5]*")
_CACHE: dict[tuple[str, str], "Pair"] = {}


@dataclass
class Csr:
    """A sparse matrix by rows: where each row's columns start, the columns, and the values (all 1 where absent)."""

    starts: np.ndarray
    columns: np.ndarray
    width: int
    values: np.ndarray | None = None

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def rows(self) -> np.ndarray:
        """The row of each nonzero."""
        return np.repeat(np.arange(self.height), np.diff(self.starts))


def row_bounds(a: Csr, b: Csr) -> np.ndarray:
    """For each row of A B the products that make it: the sizes of the rows of B that its columns name."""
    sizes = np.diff(b.starts)[a.columns]
    total = np.concatenate([[0], np.cumsum(sizes)])
    return total[a.starts[1:]] - total[a.starts[:-1]]


def product(a: Csr, b: Csr) -> Csr:
    """A B by Gustavson's rule: row i is the sum of the rows of B that row i of A names. Values count the products."""
    sizes = np.diff(b.starts)[a.columns]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    row = np.repeat(a.rows(), sizes)
    column = b.columns[np.arange(total) + np.repeat(b.starts[:-1][a.columns] - ends + sizes, sizes)]
    key = row * b.width + column
    if total and (key[1:] < key[:-1]).any():
        key = np.sort(key)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if total else np.empty(0, np.int64)
    values = np.diff(np.concatenate([new, [total]]))
    row, column = np.divmod(key[new], b.width)
    starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=a.height))])
    return Csr(starts, column, b.width, values)


def blocks(a: Csr, b: Csr, most: int = PRODUCT):
    """(first row, product of a block of rows): blocks of ``most`` products at most, but for a single row with more."""
    bound, at = np.cumsum(row_bounds(a, b)), 0
    while at < a.height:
        base = int(bound[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(bound, base + most, "right")))
        part = Csr(a.starts[at : end + 1] - a.starts[at], a.columns[a.starts[at] : a.starts[end]], a.width)
        yield at, product(part, b)
        at = end


@dataclass
class Aligned:
    """Tokens of both sides over the same bytes (several texts behind one another), given by their ends."""

    a_end: np.ndarray
    b_end: np.ndarray

    @cached_property
    def size(self) -> int:
        return int(self.a_end[-1]) if len(self.a_end) else 0

    @cached_property
    def shared(self) -> np.ndarray:
        """Offsets at which tokens of both sides end, by a mark for each byte."""
        a, b = (np.zeros(self.size + 1, bool) for _ in range(2))
        a[self.a_end], b[self.b_end] = True, True
        return a & b

    @cached_property
    def a_group(self) -> np.ndarray:
        ends = self.shared[self.a_end]
        return np.cumsum(ends) - ends

    @cached_property
    def b_group(self) -> np.ndarray:
        ends = self.shared[self.b_end]
        return np.cumsum(ends) - ends

    @cached_property
    def n_groups(self) -> int:
        return int(self.shared.sum())

    @cached_property
    def byte_rows(self) -> Csr:
        """A: a row a token, a column a byte."""
        return Csr(np.concatenate([[0], self.a_end]), np.arange(self.size), self.size)

    @cached_property
    def byte_columns(self) -> Csr:
        """B transposed: a row a byte, a column a token."""
        sizes = np.diff(self.b_end, prepend=0)
        return Csr(np.arange(self.size + 1), np.repeat(np.arange(len(sizes)), sizes), len(sizes))

    @cached_property
    def group_rows(self) -> Csr:
        return Csr(np.arange(len(self.a_group) + 1), self.a_group, self.n_groups)

    @cached_property
    def group_columns(self) -> Csr:
        sizes = np.bincount(self.b_group, minlength=self.n_groups)
        return Csr(np.concatenate([[0], np.cumsum(sizes)]), np.arange(len(self.b_group)), len(self.b_group))

    def overlaps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links: tokens of A and of B whose bytes overlap, and by how many bytes."""
        links = product(self.byte_rows, self.byte_columns)
        return links.rows(), links.columns, links.values

    def partners(self):
        """Blocks of links (tokens of A, tokens of B) of one group each; a group may have many, so they come in turn."""
        for at, part in blocks(self.group_rows, self.group_columns):
            yield part.rows() + at, part.columns


class Pair:
    """Both tokenizers, the bytes and the printed ids of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(a_path)
        self.lib.encode_special_tokens = True
        shape = json.loads(Path(a_path).read_text())
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
        vocab = shape["model"]["vocab"]
        self.a_bytes = [b""] * self.lib.get_vocab_size()
        for token, i in vocab.items():
            if all(c in byte for c in token):
                self.a_bytes[i] = bytes(byte[c] for c in token)
        # Merges join in the order of their list; their results come after the single bytes, so ids stand for ranks.
        added = {t.content for t in self.lib.get_added_tokens_decoder().values()}
        ranks = {self.a_bytes[i]: i for t, i in vocab.items() if t not in added}
        self.fast = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = ((self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size()))
        self.b_bytes = [bytes([int(p[3:5], 16)]) if is_byte else p.replace("▁", " ").encode() for p, is_byte in pieces]
        self.a_size, self.b_size = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        ids_a, ids_b = (list(map(str, range(len(x)))) for x in (self.a_bytes, self.b_bytes))
        #: Printed ids with what follows: A within and at the end of its part of a group, B likewise.
        self.printed = [f"{i}," for i in ids_a] + [f"{i}|" for i in ids_a] + [f"{i}," for i in ids_b] + [f"{i};" for i in ids_b]

    def encode_a(self, text: str) -> list[int]:
        """Ids of the json vocabulary, without special tokens."""
        if text.isascii() or _SETTLED.fullmatch(text):
            return self.fast.encode_ordinary(text)
        return self.lib.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of space and text by A, of the text by B; None where the bytes of either aren't those of space and text."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            a, raw = self.encode_a(f" {text}") if text else [], f" {text}".encode()
            same = text and b"".join([self.b_bytes[i] for i in b]) == raw and b"".join([self.a_bytes[i] for i in a]) == raw
            out.append((a, b) if same else None)
        return out


#: The pattern by which byte-level vocabularies of this kind cut texts into words: a fixed value.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def pair(a_path: str, b_path: str) -> Pair:
    """This worker's two tokenizers."""
    if (a_path, b_path) not in _CACHE:
        _CACHE[a_path, b_path] = Pair(a_path, b_path)
    return _CACHE[a_path, b_path]


def _runs(texts: list[str]):
    """Slices of texts whose characters stay near RUN."""
    start, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= RUN:
            yield slice(start, k + 1)
            start, size = k + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and where each list starts and the last ends."""
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
    return np.array([i for x in lists for i in x], np.int64), starts


def _binary(values: np.ndarray, starts: np.ndarray):
    """An Arrow array of the little-endian 32-bit values of each row."""
    import pyarrow as pa

    return pa.BinaryArray.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer((starts * 4).astype("<i4")), pa.py_buffer(values.astype("<u4"))])


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups_sha256 string, pairs binary, times binary"


def _align(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """Per document its counts, the digest of its groups, its distinct linked id pairs (a * width + b) and how often it links each."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def one(both: Pair, ids, texts: list[str]):
        import pyarrow as pa

        found = both.encode(texts)
        a, a_at = _flat([x[0] if x else [] for x in found])
        b, b_at = _flat([x[1] if x else [] for x in found])
        n = len(texts)
        al = Aligned(np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b]))
        i, j, _ = al.overlaps()
        group_at = np.concatenate([[0], np.cumsum(al.shared[al.a_end])])[a_at]
        link_at = np.searchsorted(i, a_at)
        shared = np.concatenate([[0], np.cumsum(row_bounds(al.group_rows, al.group_columns))])[a_at]
        doc = np.repeat(np.arange(n), np.diff(link_at))
        key, times = np.unique((doc << 32) | (a[i] * len(both.b_bytes) + b[j]), return_counts=True)
        pair_at = np.searchsorted(key >> 32, np.arange(n + 1))
        # Printed: the A ids of a group, then its B ids.
        wide = len(both.a_bytes)
        text_id = np.concatenate([a + wide * al.shared[al.a_end], 2 * wide + b + len(both.b_bytes) * al.shared[al.b_end]])
        ends = np.concatenate([[0], np.cumsum(np.bincount(al.a_group, minlength=al.n_groups))])
        order = np.empty(len(text_id), np.int64)
        order[np.arange(len(a)) + al.group_columns.starts[al.a_group]] = np.arange(len(a))
        order[np.arange(len(b)) + ends[al.b_group + 1]] = np.arange(len(a), len(text_id))
        printed, at = text_id[order].tolist(), (a_at + b_at).tolist()
        digests = [hashlib.sha256("".join([both.printed[k] for k in printed[s:e]])[:-1].encode()).hexdigest() if e > s else "" for s, e in zip(at[:-1], at[1:], strict=True)]
        counts = [pa.array(np.diff(x), pa.int64()) for x in (a_at, b_at, group_at, link_at, shared)]
        cols = [ids, *counts, pa.array(digests, pa.string()), _binary(key & 0xFFFFFFFF, pair_at), _binary(times, pair_at)]
        return pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in ALIGNED.split(", ")])

    def run(batches):
        both = pair(a_path, b_path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for cut in _runs(texts):
                yield one(both, batch.column("doc_id")[cut.start : cut.stop], texts[cut])

    return rows.mapInArrow(run, ALIGNED)


def _pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n: how many documents link each id pair. Tasks sum what they hold before it is shuffled."""

    def run(batches):
        import pyarrow as pa

        def merged(keys: list, counts: list):
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            return key, np.bincount(at, np.concatenate(counts)).astype(np.int64)

        keys, counts, held = [], [], 0
        for b in batches:
            one = np.frombuffer(b"".join(b.column("pairs").to_pylist()), "<u4")
            key, n = np.unique(one, return_counts=True)
            keys.append(key)
            counts.append(n)
            held += len(key)
            if held >= HELD:
                key, n = merged(keys, counts)
                keys, counts, held = [key], [n], len(key)
                if held >= HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(n)], ["pair", "n"])
                    keys, counts, held = [], [], 0
        if held:
            key, n = merged(keys, counts)
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(n)], ["pair", "n"])

    return aligned.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _common(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The commonest pairs, COMMON at most: pairs in order, counts, marks. Their least count comes from a table of some hundred steps of it."""
    step = F.floor(F.log2("n") * 8).cast("int")
    room, least = COMMON, None
    for s, n in sorted(map(tuple, counts.groupBy(step.alias("s")).count().collect()), reverse=True):
        room -= n
        if room < 0:
            break
        least = s
    if least is None:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    found = counts.where(step >= least).toArrow()
    key, n, best = (found.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(key)
    return key[order], n[order], best[order].astype(bool)


def _scores(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """row, n_best, count_sum: for each document the sums over its links.

    Tasks settle the pairs of the bounded common table; each other pair of a document is a row that meets its count in
    a join. As common pairs take no part, no key of that join is hot.
    """
    spark = aligned.sparkSession
    common = spark.sparkContext.broadcast(_common(counts))

    def run(batches):
        import pyarrow as pa

        key, n, best = common.value
        for b in batches:
            pairs, times = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u4").astype(np.int64) for c in ("pairs", "times"))
            row = b.column("row").to_numpy()
            sizes = np.array([len(x) // 4 for x in b.column("pairs").to_pylist()], np.int64)
            owner = np.repeat(np.arange(len(row)), sizes)
            at = np.minimum(np.searchsorted(key, pairs), max(0, len(key) - 1))
            hit = key[at] == pairs if len(key) else np.zeros(len(pairs), bool)
            h, o = at[hit], owner[hit]
            sums = [np.bincount(o, times[hit] * x[h], minlength=len(row)).astype(np.int64) for x in (best, n)] if len(h) else [np.zeros(len(row), np.int64)] * 2
            names = ["row", "n_best", "count_sum", "pair", "times"]
            nothing = pa.nulls(len(row), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(sums[0]), pa.array(sums[1]), nothing, nothing], names)
            rest = ~hit
            if rest.any():
                nothing = pa.nulls(int(rest.sum()), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(row[owner[rest]]), nothing, nothing, pa.array(pairs[rest]), pa.array(times[rest])], names)

    made = aligned.select("row", "pairs", "times").mapInArrow(run, "row long, n_best long, count_sum long, pair long, times long")
    folder = scratch(spark)
    made = store(made, folder, "sums")
    rare = made.where("pair IS NOT NULL").select("row", "pair", "times").join(counts, "pair")
    rare = rare.select("row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    every = made.where("pair IS NULL").select("row", "n_best", "count_sum").unionByName(rare)
    return every.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_a and n_b (tokens), n_groups (stretches between shared ends), n_links (overlapping token pairs),
    n_shared (token pairs of one group), n_best (links whose id pair is its A id's most frequent), count_sum (documents that
    link each link's id pair, summed), groups_sha256.

    Null and empty texts, and those that the tokens of either side don't spell, have zeros and an empty digest. Repeated
    rows and ids count as documents of their own; a null id stays null; other columns, whatever their names, are ignored;
    an empty table gives no rows. A text of any length is aligned in whole, in one task; so are runs of short ones. Documents are tokenized
    once, what they link is stored, and the corpus-wide counts are read back from there.
    """
    spark = docs.sparkSession
    folder = scratch(spark)
    aligned = store(_align(docs, a_path, b_path, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), folder, "aligned")
    counts = store(_pair_counts(aligned), folder, "pairs")
    n_b = _b_width(b_path)
    best = counts.groupBy(F.floor(F.col("pair") / n_b).alias("a")).agg(F.max("n").alias("top"))
    # One row for each id of A at most.
    marked = counts.withColumn("a", F.floor(F.col("pair") / n_b)).join(F.broadcast(best), "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    counts = store(marked, folder, "marked")
    sums = _scores(aligned, counts)
    discard(spark, folder, "pairs")
    kept = aligned.drop("pairs", "times").join(sums, "row", "left")
    return kept.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")


def _b_width(b_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


LINKS = "doc_id long, a_at long, a_id long, b_first long, b_last long, group long, group_b_first long, group_b_last long"


def token_links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment itself, a row for each token of A: its place and id, the first and last token of B that overlap it, its
    group, and the group's first and last token of B. Both kinds of links are unbroken ranges, so a row says them all.

    Texts without tokens give no rows; the edge cases are those of ``align_tokenizers``.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        import pyarrow as pa

        both, names = pair(a_path, b_path), [c.split()[0] for c in LINKS.split(", ")]
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = both.encode([text])[0]
                if found:
                    a, b = (np.array(x, np.int64) for x in found)
                    al = Aligned(np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b]))
                    links = product(al.byte_rows, al.byte_columns)
                    of_group = al.group_columns.starts
                    cols = [np.arange(len(a)), a, links.columns[links.starts[:-1]], links.columns[links.starts[1:] - 1], al.a_group, of_group[al.a_group], of_group[al.a_group + 1] - 1]
                    yield pa.RecordBatch.from_arrays([pa.array([doc] * len(a), pa.int64()), *(pa.array(c.astype(np.int64)) for c in cols)], names)

    return rows.mapInArrow(run, LINKS)
