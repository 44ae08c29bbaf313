"""Near-duplicate detection: MinHash bands, sequential Bayesian verification of candidates, exact verification."""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, fresh, scratch, store
from .components import components
from .shingles import runs, shingle_sets

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
BANDS, ROWS = 28, 4
HASHES = BANDS * ROWS
#: Signature values compared at a time, and the posterior probability of a link below which a candidate is dropped.
BATCH, MISS = 16, 1e-5
#: Members of a bucket that one task compares with one another; larger buckets become a grid of such blocks.
BLOCK = 4096
#: Shingles of a set that is told from others by its words instead of its hashes.
SMALL = 16
CELL_BYTES = 16 << 20
_RNG = np.random.Generator(np.random.PCG64(20240229))
_A = (_RNG.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash signatures (one row a set, uint32) of sorted distinct 64-bit hashes; the sets mustn't be empty."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1]
    out = np.empty((len(sets), HASHES), np.uint32)
    work = np.empty_like(flat)
    for k in range(HASHES):
        np.multiply(flat, _A[k], out=work)
        work += _B[k]
        # The upper bits of a product are the well mixed ones.
        work ^= work >> np.uint32(15)
        out[:, k] = np.minimum.reduceat(work, at)
    return out


def least_matches(percent: int = PERCENT, miss: float = MISS) -> list[tuple[int, int]]:
    """For each batch end n: the fewest matches of n at which P(similarity >= threshold | matches) reaches ``miss``.

    With a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1), and its mass above t equals
    P(Binomial(n + 1, t) <= m).
    """
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        mass, m = 0.0, -1
        while mass < miss:
            m += 1
            mass += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


_LEAST = least_matches()


def plausible(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of signature rows survive all batches, and their matches; a pair is dropped at its first bad batch."""
    left, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n, least in _LEAST:
        matches[left] += (a[left, n - BATCH : n] == b[left, n - BATCH : n]).sum(axis=1)
        left = left[matches[left] >= least]
        if not len(left):
            break
    alive = np.zeros(len(a), bool)
    alive[left] = True
    return alive, matches


def _node(shingles: np.ndarray, text: bytes) -> bytes | None:
    """What documents of one shingle set share. A few 64-bit hashes could agree by chance in a large corpus, so a small set goes by its words."""
    if not len(shingles):
        return None
    return hashlib.md5(shingles.tobytes() if len(shingles) > SMALL else b" ".join(text.split())).digest()


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, node (128-bit hash of the shingle set, of the words themselves where it is small, null if empty), sig."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            raw = [t.encode().lower() for t in b.column("text").to_pylist()]
            for cut in runs(raw):
                sets = shingle_sets(raw[cut], WORDS)
                full = [s for s in sets if len(s)]
                sig = iter(signatures(full)) if full else iter(())
                node = [_node(s, t) for s, t in zip(sets, raw[cut], strict=True)]
                cols = [b.column("doc_id")[cut.start : cut.stop], pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.binary()), pa.array([next(sig).tobytes() if len(s) else None for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "node", "sig"])

    return rows.mapInArrow(run, "doc_id long, n_shingles long, node binary, sig binary")


def _bands(nodes: DataFrame) -> DataFrame:
    """key, band, node: one row for each band of a signature."""

    def run(batches):
        import pyarrow as pa

        from .mph import mix

        for b in batches:
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), sig.shape[:2]).copy()
            for k in range(ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, k])
            node = b.column("node").take(pa.array(np.repeat(np.arange(b.num_rows), BANDS)))
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(np.tile(np.arange(BANDS, dtype=np.int8), b.num_rows)), node], ["key", "band", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "key long, band byte, node binary")


def _survivors(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that the signature batches leave."""
    left, right = nodes.select(F.col("node").alias("a"), F.col("sig").alias("sa")), nodes.select(F.col("node").alias("b"), F.col("sig").alias("sb"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                sa, sb = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("sa", "sb"))
                yield b.select(["a", "b"]).filter(pa.array(plausible(sa, sb)[0]))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""
    left, right = sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            pairs_ = zip(b.column("xa"), b.column("xb"), strict=True)
            keep = [_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in pairs_]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # Set sizes go first: sizes more than the threshold apart can't link. A size is 8 bytes a shingle.
    na, nb = F.octet_length("xa"), F.octet_length("xb")
    near = (100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb))
    return pairs.join(left, "a").join(right, "b").where(near).select("a", "b", "xa", "xb").mapInArrow(run, "a binary, b binary")


def _bucket_links(members: DataFrame) -> DataFrame:
    """Links (a, b) between different components in buckets, enough of them to join what belongs together.

    ``members``: key, blocks, band, node, comp, sig, shingles. A bucket above BLOCK members or CELL_BYTES of sets is
    dealt to blocks by a hash of the node, and each pair of blocks is one group: a task holds two blocks at most. Pairs
    of one component, joined ones included, are skipped; the others pass the signature batches, most matches first,
    and are verified on the full sets there, so a bucket gives fewer links than members. A pair that shares several
    buckets is compared in that of its first band.
    """
    dealt = members.withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def cell(batch):
        import pandas as pd

        sig = np.frombuffer(b"".join(batch["sig"]), np.uint32).reshape(-1, HASHES)
        banded = sig.reshape(-1, BANDS, ROWS)
        label, own = pd.factorize(batch["comp"])[0], batch["own"].to_numpy()
        one_block, band = batch["i"].iloc[0] == batch["j"].iloc[0], int(batch["band"].iloc[0])
        node, sets = batch["node"].to_numpy(), [np.frombuffer(x, np.uint64) for x in batch["shingles"]]
        size, out = np.array([len(x) for x in sets]), []
        for u in range(len(node) - 1):
            rest = np.arange(u + 1, len(node))
            near = 100 * np.minimum(size[rest], size[u]) >= PERCENT * np.maximum(size[rest], size[u])
            rest = rest[near & (label[rest] != label[u]) & (one_block | (own[rest] != own[u]))]
            alive, matches = plausible(np.broadcast_to(sig[u], (len(rest), HASHES)), sig[rest])
            rest, matches = rest[alive], matches[alive]
            if len(rest):
                first = (banded[rest] == banded[u]).all(axis=2).argmax(axis=1) == band
                rest, matches = rest[first], matches[first]
            for v in rest[np.argsort(-matches, kind="stable")].tolist():
                if label[v] != label[u] and _similar(sets[u], sets[v]):
                    label[label == label[v]] = label[u]
                    out.append((node[u], node[v]))
        return pd.DataFrame(out, columns=["a", "b"])

    return cells.drop("other").groupBy("key", "i", "j").applyInPandas(cell, "a binary, b binary")


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    """The link condition on two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    1. Documents of the same shingle set become one node, so exact copies make no pairs. 2. Nodes that share a band
    of their MinHash signature share a bucket: each bucket links its members to its first one only, a linear number of
    candidates. 3. Candidates pass the signature batches or are dropped by the posterior bound, survivors are
    verified on full sets, links are contracted to components. 4. Buckets whose members are still in different
    components are compared in full, block by block, pairs of one component left out; links found there are
    contracted with the others. So no link between components is lost but by the banding (2e-5 at the threshold) and
    the chosen miss probability. Sets are compared as 64-bit hashes of their shingles: two shingles of a pair agree
    falsely with a chance of 5e-20 each.

    Rows with a null id get component_id null and kept false; a document without words is alone. Repeated rows of
    one id get the same component and are all kept if that id is. Other columns are ignored; an empty table gives
    no rows. Copies fold into nodes first; hot buckets and hubs are pre-aggregated, and the joins on them shuffle both
    sides, so that adaptive execution splits them. Intermediate tables lie in the shared folder and go when they are
    no longer read.
    """
    spark = docs.sparkSession
    folder = scratch(spark)
    all_rows = store(sketch(docs, id_col, text_col), folder, "sketch")
    with_id = all_rows.where("doc_id IS NOT NULL AND node IS NOT NULL")
    nodes = store(with_id.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles")), folder, "nodes")
    bands = _bands(nodes)
    # Stored, as the other aggregates by key below, so that their joins shuffle both sides and a hot key can be split.
    shared = store(bands.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("leader")).where("n > 1"), folder, "shared")
    members = store(bands.join(shared, "key"), folder, "members")

    wanted = members.select("node").distinct().join(nodes.select("node", "first_id"), "node").select(F.col("first_id").alias("id")).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(wanted, "id", "left_semi")

    def to_sets(batches):
        import pyarrow as pa

        for b in batches:
            raw = [(t or "").encode().lower() for t in b.column("text").to_pylist()]
            for cut in runs(raw):
                made = [(_node(s, t), s.tobytes()) for s, t in zip(shingle_sets(raw[cut], WORDS), raw[cut], strict=True) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in made], pa.binary()) for k in (0, 1)], ["node", "shingles"])

    sets = store(texts.mapInArrow(to_sets, "node binary, shingles binary").dropDuplicates(["node"]), folder, "sets")

    star = members.where("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = store(_links(_survivors(star, nodes), sets), folder, "links_star")
    roots = components(links, f"{folder}/cc_star")
    label = members.where("n > 2").join(nodes.select("node", "n_shingles"), "node")
    if roots is not None:
        label = label.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    else:
        label = label.withColumn("comp", F.col("node"))
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") * 8 / CELL_BYTES)).cast("int")
    mixed = label.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), blocks.alias("blocks")).where("lo != hi").select("key", "blocks")
    mixed = store(mixed, folder, "mixed")
    open_ = store(label.select("key", "band", "node", "comp").join(mixed, "key"), folder, "open")
    more = _bucket_links(open_.join(nodes.select("node", "sig"), "node").join(sets, "node"))
    links = links.unionByName(store(more, folder, "links_open"))
    roots = components(links, f"{folder}/cc")

    named = nodes.select("node", "first_id")
    if roots is None:
        named = named.withColumnRenamed("first_id", "component_id")
    else:
        rooted = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        lowest = store(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), folder, "lowest")
        named = rooted.join(lowest, "root").select("node", "component_id")
    named = store(named, folder, "named")
    discard(spark, folder, "nodes", "shared", "members", "sets", "links_star", "cc_star", "mixed", "open", "links_open", "cc", "lowest")
    out = all_rows.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("doc_id").isNull(), None).when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def near_unique(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one document of each component, and rows without an id.

    Null and empty texts, which link with nothing, stay; so do repeated rows of an id that stays; an empty table stays empty.
    """
    (other,) = fresh(docs, "dropped_id")
    drop = near_duplicates(docs, id_col, text_col).where("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias(other)).distinct()
    return docs.join(drop, F.col(id_col).cast("long") == F.col(other), "left_anti")


#: DuckDB: the same rows, by counting shared shingles of all pairs.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
  FROM w, unnest(range(1, greatest(len(w) - 3, 2))) AS r(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT a AS doc_id, a AS t FROM l UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.t),
m AS (SELECT doc_id, min(t) AS m FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.m, d.doc_id) AS component_id, coalesce(m.m, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""
