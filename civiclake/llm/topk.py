"""Exact top-k inner-product search by the threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Candidates in one block and queries in one group: what a task holds is bounded by these.
BLOCK, GROUP = 8192, 32768


def threshold_topk(query: np.ndarray, own: int, ids: np.ndarray, vectors: np.ndarray, lists: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best (id, score) of a block for one query, ties to the smaller id.

    ``lists[d]`` holds row numbers by descending component d. Lists are read in rounds of growing depth, from the top
    where the query's component is positive and from the bottom where it is negative; each row met is scored in full.
    A row not met yet scores at most the sum over the lists of weight times the component last read; once that is
    below the kth score, nothing can enter and reading stops. Where fewer rows are left than the next round has entries
    to read, those rows are scored instead, which ends the search at no more cost than that round.
    """
    n = len(ids)
    used = np.flatnonzero(query)
    up, down = used[query[used] > 0], used[query[used] < 0]
    seen = np.zeros(n, bool)
    kept_s, kept_i = np.empty(0, np.int64), np.empty(0, np.int64)
    depth, step = 0, max(4, k)
    while depth < n:
        to = min(n, depth + step)
        left = n - int(seen.sum())
        if left <= len(used) * (to - depth) or not len(used):
            fresh, to = ~seen, n
        else:
            fresh = np.zeros(n, bool)
            fresh[lists[up, depth:to]] = True
            fresh[lists[down, n - to : n - depth]] = True
            fresh &= ~seen
        rows = np.flatnonzero(fresh)
        seen[rows] = True
        # Many scattered rows cost more to fetch than the block does to multiply as it lies.
        score = (vectors @ query)[rows] if len(rows) > n // 16 else vectors[rows] @ query
        keep = ids[rows] != own
        if len(kept_s) == k:
            # Less than the kth score can't enter, so only the rest is put in order.
            keep &= score >= kept_s[-1]
        s, i = np.concatenate([kept_s, score[keep]]), np.concatenate([kept_i, ids[rows][keep]])
        best = np.lexsort((i, -s))
        s, i = s[best], i[best]
        # Vectors of one id with the same score make one row of the result, so they take one place.
        new = np.append(True, (s[1:] != s[:-1]) | (i[1:] != i[:-1]))[: len(s)]
        kept_s, kept_i = s[new][:k], i[new][:k]
        if to < n and len(kept_s) == k:
            bound = (query[up] * vectors[lists[up, to - 1], up]).sum() + (query[down] * vectors[lists[down, n - to], down]).sum()
            if bound < kept_s[-1]:
                break
        depth, step = to, step * 2
    return list(zip(kept_i.tolist(), kept_s.tolist(), strict=True))


def exact_topk(vectors: DataFrame, is_query, k: int, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every query by integer inner product.

    Components become floor(scale * x). Rows with a null id or vector, or with a null or non-finite component, take
    no part; vectors of different lengths are not compared. A repeated id with different vectors gives a query for
    each, of which the best candidates are kept; a repeated row counts once.

    Repeated rows fold on the map side first, as copies would take the places of others in their block. Candidates are
    dealt to blocks, queries to groups, by a hash of the id and the vector; every (group, block) cell runs the
    threshold algorithm for its queries and returns k rows a query, which a window over k * blocks rows merges. A
    very frequent vector or id is spread like any other, and ties need only ids. Block and group sizes bound a task's
    memory; the number of cells follows queries times candidates, which is the stated search. Only two row counts and
    the largest component reach the driver.
    """
    v = F.transform(F.col(vec_col).cast("array<double>"), lambda x: F.floor(F.lit(scale) * x))
    bad = F.exists(F.col(vec_col).cast("array<double>"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & ~F.coalesce(bad, F.lit(False)))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), is_query.alias("is_query")).withColumn("dim", F.size("v"))
    rows = rows.groupBy("id", "v", "dim").agg(F.max("is_query").alias("is_query"))
    size = F.array_max(F.transform("v", F.abs))
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q"), F.max(size).alias("top")).first()
    # The narrowest numbers that hold all components travel; scores are the same.
    kind = next(t for t, bits in (("smallint", 15), ("int", 31), ("bigint", 63)) if (counts.top or 0) < 1 << bits)
    rows = rows.withColumn("v", F.col("v").cast(f"array<{kind}>"))
    blocks, groups = -(-counts.n // BLOCK) or 1, -(-counts.q // GROUP) or 1
    cell = lambda n, salt: F.pmod(F.xxhash64(F.col("id"), F.col("v"), F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cand = rows.select("id", "v", "dim", cell(blocks, 1).alias("b"), every(groups).alias("g"))
    asks = rows.where("is_query").select("id", "v", "dim", cell(groups, 2).alias("g"), every(blocks).alias("b"))

    def search(left, right):
        import pandas as pd

        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids = left["id"].to_numpy(np.int64)
        vec = np.stack(left["v"].to_list()).astype(np.int64)
        q = np.stack(right["v"].to_list()).astype(np.int64)
        # Floats multiply faster and are exact while every partial sum fits in their bits.
        most = vec.shape[1] * float(np.abs(vec).max(initial=0)) * float(np.abs(q).max(initial=0))
        exact = next((t for t, bits in ((np.float32, 24), (np.float64, 53)) if most < 2**bits), np.int64)
        vec, q = vec.astype(exact), q.astype(exact)
        lists = np.argsort(-vec, axis=0, kind="stable").T.copy()
        out = [(own, i, int(s)) for own, one in zip(right["id"].tolist(), q, strict=True) for i, s in threshold_topk(one, own, ids, vec, lists, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ["g", "b", "dim"]
    found = cand.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: DuckDB: the same rows, for vectors of one length and ids that don't repeat.
ORACLE = """
WITH r AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM r q JOIN r c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5
"""
