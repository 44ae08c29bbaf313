"""Record deduplication and merging by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_by_hash(df: DataFrame, digest: str, *order: str) -> DataFrame:
    """The first row of each hash in ``order``; rows with a null or empty hash all stay."""
    kept = F.coalesce(F.col(digest), F.lit("")) != ""
    first = df.where(kept).withColumn("__n", F.row_number().over(Window.partitionBy(digest).orderBy(*order))).where("__n = 1").drop("__n")
    return first.unionByName(df.where(~kept))


def not_seen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not stored yet."""
    return df.join(seen.select(key).distinct(), key, "left_anti")


def most_complete(df: DataFrame, key: str, fields: list[str], *tie: str) -> DataFrame:
    """The row of each key with most non-null ``fields``."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in fields), F.lit(0))
    ranked = df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(filled.desc(), *tie)))
    return ranked.where("__n = 1").drop("__n")


def priority_union(sources: list[tuple[DataFrame, int]], key: str, *tie: str) -> DataFrame:
    """One row a key over several sources of the same columns: the source with the smallest number wins."""
    rows = None
    for df, rank in sources:
        df = df.withColumn("priority", F.lit(rank))
        rows = df if rows is None else rows.unionByName(df, allowMissingColumns=True)
    ranked = rows.where(F.col(key).isNotNull()).withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy("priority", *tie)))
    return ranked.where("__n = 1").drop("__n")


def fill_merge(df: DataFrame, keys: list[str], fields: list[str], order: Column) -> DataFrame:
    """One row per keys: each field is its first non-null value in ``order``."""
    return df.groupBy(*keys).agg(*(F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in fields))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``old`` with those of ``new`` put over them by key."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"), allowMissingColumns=True)


def insert_absent(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``new`` whose keys, compared null-safe, are not in ``old``."""
    o = old.select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
    cond = None
    for k in keys:
        c = new[k].eqNullSafe(o[f"__{k}"])
        cond = c if cond is None else cond & c
    return new.join(o, cond, "left_anti")


def union_sources(*tables: DataFrame) -> DataFrame:
    """Rows of sources of one type with a source number; columns that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (t.withColumn("source_number", F.lit(k)) for k, t in enumerate(tables)))


def first_with_url(df: DataFrame, key: str, url: str, *order: str) -> DataFrame:
    """The first row of each key that has an address; rows with an address but no key all stay."""
    rows = df.where(F.trim(F.coalesce(F.col(url), F.lit(""))) != "")
    first = rows.where(F.col(key).isNotNull()).withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("place = 1").drop("place")
    return first.unionByName(rows.where(F.col(key).isNull()))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a dimension in order, without null."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
