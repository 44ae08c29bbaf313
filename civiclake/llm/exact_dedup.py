"""Exact deduplication by 128-bit content hash with a byte comparison inside the groups (native)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, fresh, text_of


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, n_classes.

    Texts are equal when identical after each run of ASCII white space becomes one space; a null text is the empty
    text. Of equal texts the smallest id stays.

    The text travels once, into an aggregate keyed by (128-bit hash, text): grouping by the text itself is the byte
    comparison, and the map-side half folds large groups of copies before the shuffle. ``n_classes`` counts the
    distinct texts behind one 128-bit hash, so anything but 1 is a collision; rows meet their group by that hash
    and the SHA-256 together, which keeps collided texts apart. Only digests and ids take part in that join, and
    a group with a third of all rows is a skewed join key that adaptive execution splits.

    Rows with a null id take part; they are kept only where no row of the group has an id. Repeated rows (same id,
    same text) are each reported as kept. An empty table gives an empty result; other columns are ignored.
    """
    norm = F.regexp_replace(text_of(text_col), SPACE, " ")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("norm"))
    hashed = base.withColumn("h", F.unhex(F.md5(F.encode("norm", "UTF-8"))))
    classes = hashed.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = (
        classes.select("h", F.unhex(F.sha2("norm", 256)).alias("s"), "keep_id", "group_size")
        .groupBy("h", "s")
        .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )
    collisions = groups.groupBy("h").agg(F.count(F.lit(1)).alias("n_classes"), F.collect_list(F.struct("s", "keep_id", "group_size")).alias("g"))
    groups = collisions.select("h", "n_classes", F.inline("g"))
    rows = hashed.select("doc_id", "h", F.sha2("norm", 256).alias("text_sha256")).withColumn("s", F.unhex("text_sha256"))
    return rows.join(groups, ["h", "s"], "left").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "n_classes"
    )


def exact_unique(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each text, the smallest id's.

    Repeated rows and texts without any id leave one row each; null texts count as empty; an empty table stays empty.
    """
    k, other = fresh(docs, "row_key", "kept_key")
    found = exact_dedup(docs, id_col, text_col).where("kept").select(F.concat_ws(":", F.col("doc_id"), F.col("text_sha256")).alias(other))
    sha = F.sha2(F.regexp_replace(text_of(text_col), SPACE, " "), 256)
    keyed = docs.withColumn(k, F.concat_ws(":", F.col(id_col).cast("long"), sha))
    return keyed.join(found, F.col(k) == F.col(other), "left_semi").dropDuplicates([k]).drop(k)


#: DuckDB: the same rows.
ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, coalesce(d.doc_id = g.keep_id, false) AS kept, sha256(d.norm) AS text_sha256, CAST(1 AS BIGINT) AS n_classes
FROM d JOIN g USING (norm)
"""
