"""Connected components of a link table by contraction, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def components(links: DataFrame, folder: str) -> DataFrame | None:
    """node, root for every node of ``links`` (a, b of any type); None without links.

    Each round points every node at its neighbour that comes first in hash order, where that comes before itself,
    then joins the pointed-at nodes only. Hash order makes long chains shrink by a constant factor a round. Both
    steps are a grouped minimum and equi joins, so hubs are pre-aggregated and skewed keys can be split. Repeated links
    and links in both directions count once; a link of a node with itself or with null is left out; other columns are
    ignored.
    """
    current = store(links.select("a", "b").where(F.col("a") != F.col("b")).distinct(), folder, "links0")
    parents: list[DataFrame] = []
    while not current.isEmpty():
        k = len(parents)
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
        best = both.groupBy("a").agg(F.min(order("b")).alias("m")).select(F.col("a").alias("node"), F.least("m", F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("n")))["n"].alias("parent"))
        step = store(best, folder, f"parents{k}")
        parents.append(step)
        left, right = step.toDF("a", "pa"), step.toDF("b", "pb")
        nxt = current.join(left, "a").join(right, "b").where(F.col("pa") != F.col("pb"))
        nxt = nxt.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        current = store(nxt, folder, f"links{k + 1}")
    if not parents:
        return None
    out = parents[0].withColumnRenamed("parent", "root")
    for k, step in enumerate(parents[1:]):
        # A node that was pointed at may point on in the next round.
        out = out.join(step.toDF("root", "next"), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return store(out, folder, "roots")
