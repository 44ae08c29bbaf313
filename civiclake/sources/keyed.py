"""Tables stored by bucket of their key: upserts and inserts that read and rewrite the touched buckets alone."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from civiclake.sources.scratch import materialize

#: Buckets of a new table; so many that one bucket is a file of moderate size.
BUCKETS = 64


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The bucket of a row's key; null parts hash like any other."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Layout:
    """What is stored beside the data: the number of buckets and the schema, which a table without rows has nowhere else."""

    buckets: int
    schema: StructType


def _write_layout(spark: SparkSession, path: str, layout: Layout) -> None:
    spark.createDataFrame([(layout.buckets, layout.schema.json())], "buckets int, schema string").coalesce(1).write.mode("overwrite").json(f"{path}/layout")


def layout_of(spark: SparkSession, path: str) -> Layout:
    r = spark.read.schema("buckets int, schema string").json(f"{path}/layout").first()
    return Layout(r.buckets, StructType.fromJson(json.loads(r.schema)))


def write_keyed(df: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """A new table below ``path``, one folder a bucket."""
    rows = df.withColumn("bucket", bucket_of(keys, buckets))
    rows.repartition("bucket").write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/data")
    _write_layout(df.sparkSession, path, Layout(buckets, df.schema))


def read_keyed(spark: SparkSession, path: str, hit: list[int] | None = None) -> DataFrame:
    """The table, or its rows in the buckets ``hit`` alone."""
    schema = StructType([*layout_of(spark, path).schema, StructField("bucket", IntegerType())])
    df = spark.read.schema(schema).parquet(f"{path}/data")
    return (df if hit is None else df.where(F.col("bucket").isin(hit))).drop("bucket")


def touched(rows: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """The buckets that ``rows`` fall into: values that partition pruning needs, so many at most."""
    return sorted(r[0] for r in rows.select(bucket_of(keys, buckets).alias("b")).distinct().collect())


def same_key(keys: list[str], prefix: str) -> Column:
    """Keys equal those with a prefix, null to null."""
    return reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys))


def keys_of(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    return df.select(*(F.col(k).alias(f"{prefix}{k}") for k in keys))


def _one_each(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key: the greatest by its other columns, so the same one on every run."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    order = F.to_json(F.struct(*rest), {"ignoreNullFields": "false"})
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def _place(rows: DataFrame, path: str, keys: list[str], buckets: int, mode: str) -> None:
    """Write rows into their buckets; "overwrite" replaces the buckets that have rows, the others stay."""
    placed = rows.withColumn("bucket", bucket_of(keys, buckets)).repartition("bucket")
    placed.write.partitionBy("bucket").mode(mode).option("partitionOverwriteMode", "dynamic").parquet(f"{path}/data")


def upsert_keyed(spark: SparkSession, path: str, new: DataFrame, keys: list[str]) -> list[int]:
    """Put the rows of ``new`` over the stored ones by key; gives the buckets that were rewritten.

    Keys compare null-safe; of several new rows of a key one counts. Buckets without a new row are neither read nor
    written: their files stay as they are. Columns that one side lacks are null there. A bucket's new files replace the
    old ones when the write commits, and a run that is repeated gives the same table.
    """
    layout = layout_of(spark, path)
    new = materialize(_one_each(new, keys))
    hit = touched(new, keys, layout.buckets)
    if not hit:
        return []
    kept = read_keyed(spark, path, hit).join(keys_of(new, keys, "_new_"), same_key(keys, "_new_"), "left_anti")
    # Stored first, as the write replaces what it would read.
    rows = materialize(kept.unionByName(new, allowMissingColumns=True))
    if rows.columns != layout.schema.names:
        _write_layout(spark, path, Layout(layout.buckets, rows.schema))
    _place(rows, path, keys, layout.buckets, "overwrite")
    return hit


def insert_keyed(spark: SparkSession, path: str, new: DataFrame, keys: list[str]) -> int:
    """Add the rows of ``new``, which has the stored columns, whose keys, null-safe, are not stored; gives their number.

    Stored files are only read, and only those of touched buckets. A run that is repeated adds nothing.
    """
    layout = layout_of(spark, path)
    new = materialize(_one_each(new, keys))
    hit = touched(new, keys, layout.buckets)
    if not hit:
        return 0
    have = keys_of(read_keyed(spark, path, hit), keys, "_old_")
    absent = materialize(new.select(*layout.schema.names).join(have, same_key(keys, "_old_"), "left_anti"))
    _place(absent, path, keys, layout.buckets, "append")
    return absent.count()
