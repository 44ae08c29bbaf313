"""Substring deduplication: repeated word windows found by an FM-index per shard, covered words removed."""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, scratch, store
from .fm_index import repeated_windows
from .shingles import runs, windows, word_hashes

WINDOW = 35
#: Words of the gram that routes a window: of the grams in a window, the one with the smallest hash.
GRAM = 8
#: Windows in one segment at most (the bits of a mask).
RUN = 64
#: A routing gram with more segments than this sends each window on its own, by the window's hash.
HOT = 20_000
#: Words in one shard's index, about.
SHARD_WORDS = 1_000_000
#: Bytes of segments that a task hands on at a time.
OUT_BYTES = 8 << 20
_WIDTH = WINDOW - GRAM + 1


def _extreme(g: np.ndarray, right: bool) -> np.ndarray:
    """Position of the smallest of each _WIDTH neighbouring values, the right- or leftmost on ties."""
    pick = (lambda a, b: np.where(g[a] < g[b], a, b)) if right else (lambda a, b: np.where(g[a] <= g[b], a, b))
    at, width = np.arange(len(g)), 1
    while width * 2 <= _WIDTH:
        at, width = pick(at[:-width], at[width:]), width * 2
    rest = _WIDTH - width
    return pick(at[:-rest], at[rest:]) if rest else at


def segments(raw: list[bytes]):
    """For many texts: words of each, where each text's segments begin in the lists (and the end), and the segments' routing keys, first words, window counts, and whether the routing gram occurs twice in them."""
    h, _, _, first, _ = word_hashes(raw)
    n = np.diff(first)
    empty = np.empty(0, np.int64)
    if len(h) < WINDOW:
        return n, np.zeros(len(raw) + 1, np.int64), (empty, empty, empty, empty)
    g = windows(h, GRAM)
    left, right = _extreme(g, False), _extreme(g, True)
    key = g[left]
    # Window starts that lie within one text, and where a new segment begins.
    valid = np.zeros(len(key) + 1, bool)
    text_of = np.repeat(np.arange(len(raw)), n)
    valid[: len(key)] = text_of[: len(key)] == text_of[WINDOW - 1 :][: len(key)]
    new = valid[:-1] & np.concatenate([[True], (key[1:] != key[:-1]) | ~valid[:-2] | (text_of[1 : len(key)] != text_of[: len(key) - 1])])
    start = np.flatnonzero(new)
    # A segment ends before the next start or the next invalid window.
    bad = np.flatnonzero(~valid)
    stop = np.minimum(np.append(start[1:], len(key)), bad[np.searchsorted(bad, start)])
    pieces = -(-(stop - start) // RUN)
    start = np.repeat(start, pieces) + RUN * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    stop = np.minimum(np.repeat(stop, pieces), start + RUN)
    twice = (left[start] != right[stop - 1]).astype(np.int64)
    return n, np.searchsorted(start, first), (key[start].view(np.int64), start - first[text_of[start]], stop - start, twice)


def _scan(docs: DataFrame) -> DataFrame:
    """One row a document: id0, th, doc_id, n_words, digest and its segments as arrays."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            raw = [t.encode() for t in b.column("text").to_pylist()]
            for cut in runs(raw):
                n, at, lists = segments(raw[cut])
                digests = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in raw[cut]]
                ids = [b.column(c)[cut.start : cut.stop] for c in ("id0", "th", "doc_id")]
                at = pa.array(at.astype(np.int32))
                lists = [pa.ListArray.from_arrays(at, pa.array(x if k == 0 else x.astype(np.int32))) for k, x in enumerate(lists)]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(n, pa.int64()), pa.array(digests), *lists], ["id0", "th", "doc_id", "n_words", "digest", "keys", "starts", "counts", "twice"])

    return docs.mapInArrow(run, "id0 long, th long, doc_id long, n_words long, digest string, keys array<long>, starts array<int>, counts array<int>, twice array<int>")


def _flat(lists, *names: str) -> tuple[list, list[np.ndarray]]:
    """Row borders and the fields of an Arrow list of structs."""
    values = lists.flatten()
    at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
    return at.tolist(), [values.field(c).to_numpy(zero_copy_only=False) for c in names]


def _cut(found: DataFrame) -> DataFrame:
    """The words of each candidate segment: key, md, words, n, id0, th, start."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        def flush(out):
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["key", "md", "words", "n", "id0", "th", "start"])

        for b in batches:
            at, (keys, starts, counts, hot) = _flat(b.column("segs"), "key", "start", "count", "hot")
            keys, starts, counts, hot = keys.tolist(), starts.tolist(), counts.tolist(), hot.tolist()
            ids = list(zip(b.column("id0").to_pylist(), b.column("th").to_pylist(), strict=True))
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            held = 0
            for row, text in enumerate(b.column("text")):
                words = text.as_py().encode().split()
                joined = b" ".join(words)
                place = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)]).tolist()
                for k in range(at[row], at[row + 1]):
                    s, size = starts[k], counts[k] + WINDOW - 1
                    if hot[k]:
                        parts = [(i, joined[place[i] : place[i + WINDOW] - 1], WINDOW) for i in range(s, s + counts[k])]
                    else:
                        parts = [(s, joined[place[s] : place[s + size] - 1], size)]
                    for i, part, m in parts:
                        # A window of a hot gram goes by its own hash.
                        key = xxhash.xxh3_64_intdigest(part) - (1 << 63) if hot[k] else keys[k]
                        for c, v in zip(out, (key, hashlib.md5(part).digest(), part, m, *ids[row], i), strict=True):
                            c.append(v)
                        held += len(part)
                if held > OUT_BYTES:
                    yield flush(out)
                    out, held = ([], [], [], [], [], [], []), 0
            yield flush(out)

    return found.select("id0", "th", "text", "segs").mapInArrow(run, "key long, md binary, words binary, n int, id0 long, th long, start int")


def _index_shard(batch):
    """Masks of the repeated windows of one shard's segments."""
    import pandas as pd

    ids: dict[bytes, int] = {}
    pieces = [np.array([ids.setdefault(w, len(ids) + 2) for w in x.split()], np.int64) for x in batch["words"]]
    mask = repeated_windows(pieces, batch["copies"].to_numpy(np.int64), len(ids) + 2, WINDOW)
    out = pd.DataFrame({"key": batch["key"], "md": batch["md"], "mask": mask.view(np.int64)})
    return out[out["mask"] != 0]


def _remove(rows: DataFrame) -> DataFrame:
    """Texts and their repeated windows to id0, th, n_removed, kept_sha256."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            at, (starts, masks) = _flat(b.column("hits"), "start", "mask")
            # The windows of all hits of the batch: which hit, and which bit.
            hit, bit = np.nonzero(np.unpackbits(masks.astype("<i8").view(np.uint8), bitorder="little").reshape(-1, 64))
            window, border = starts[hit] + bit, np.searchsorted(hit, at).tolist()
            removed, digests = [], []
            for row, text in enumerate(b.column("text")):
                words = text.as_py().encode().split()
                w, n = window[border[row] : border[row + 1]], len(words) + 1
                stays = np.cumsum(np.bincount(w, minlength=n) - np.bincount(w + WINDOW, minlength=n))[:-1] == 0
                removed.append(len(words) - int(stays.sum()))
                digests.append(hashlib.sha256(b" ".join(compress(words, stays.tolist()))).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("id0"), b.column("th"), pa.array(removed, pa.int64()), pa.array(digests, pa.string())], ["id0", "th", "n_removed", "kept_sha256"])

    return rows.select("id0", "th", "text", "hits").mapInArrow(run, "id0 long, th long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 (of the words that stay, joined by one space).

    1. Every window of 35 words belongs to the 8-word gram with the smallest hash in it; neighbouring windows of one
    gram are a segment. Equal windows have the same gram, so only grams that occur twice matter. 2. The words of
    those segments are cut from the texts, equal segments folded with their number, and dealt to shards by gram.
    3. Each shard builds an FM-index of its segments and streams them through it by backward search; windows with two
    or more occurrences come back as bit masks. 4. Masks meet the documents again and covered words go.

    Windows are judged on the input; a window that repeats inside one document counts. Null texts have no words;
    repeated rows repeat all their windows; rows with null ids are judged like others; an empty table gives no rows.
    Shards hold a bounded number of words: a gram with more than HOT segments is routed window by window instead,
    where equal windows fold before the shuffle. Intermediate tables lie in the shared folder.
    """
    spark = docs.sparkSession
    folder = scratch(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id0"), F.xxhash64("text").alias("th"))
    scanned = store(_scan(rows), folder, "scanned")
    segs = scanned.select("id0", "th", F.inline(F.arrays_zip("keys", "starts", "counts", "twice"))).toDF("id0", "th", "key", "start", "count", "twice")
    # Stored, so that the join below shuffles both sides by itself and a hot gram can be split.
    uses = store(segs.groupBy("key").agg(F.sum(1 + F.col("twice")).alias("uses")).where("uses > 1"), folder, "uses")
    found = segs.join(uses, "key").groupBy("id0", "th").agg(F.collect_set(F.struct("key", "start", "count", (F.col("uses") > HOT).alias("hot"))).alias("segs"))
    found = store(rows.select("id0", "th", "text").join(found, ["id0", "th"]), folder, "found")
    cut = store(_cut(found), folder, "segments")
    folded = store(cut.groupBy("key", "md", "words", "n").agg(F.count(F.lit(1)).alias("copies")), folder, "folded")
    words = folded.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-words // SHARD_WORDS))
    dealt = folded.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    masks = store(dealt.groupBy("shard").applyInPandas(lambda b: _index_shard(b), "key long, md binary, mask long"), folder, "masks")
    hits = cut.select("key", "md", "id0", "th", "start").join(masks, ["key", "md"]).groupBy("id0", "th").agg(F.collect_set(F.struct("start", "mask")).alias("hits"))
    removed = store(_remove(found.dropDuplicates(["id0", "th"]).join(hits, ["id0", "th"])), folder, "removed")
    discard(spark, folder, "uses", "found", "segments", "folded", "masks")
    out = scanned.select("id0", "th", "doc_id", "n_words", "digest").join(removed, ["id0", "th"], "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept_sha256", "digest").alias("kept_sha256"))


#: DuckDB: the same rows, by grouping all windows.
ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM w, unnest(range(1, len(w) - 33)) AS r(i)),
b AS (SELECT doc_id, i FROM x WHERE h IN (SELECT h FROM x GROUP BY h HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, i + k AS p FROM b, unnest(range(0, 35)) AS r(k)),
l AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id),
k AS (SELECT d.doc_id, i, d.w[i] AS word FROM w d JOIN l ON l.doc_id = d.doc_id, unnest(range(1, len(d.w) + 1)) AS r(i) WHERE (d.doc_id, i) NOT IN (SELECT doc_id, p FROM c)),
s AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM k GROUP BY doc_id)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(l.n, 0) AS n_removed,
  sha256(CASE WHEN l.n IS NULL THEN array_to_string(w.w, ' ') ELSE coalesce(s.kept, '') END) AS kept_sha256
FROM w LEFT JOIN l USING (doc_id) LEFT JOIN s USING (doc_id)
"""
