"""Dimensions with history: each key's versions with the days from which and until which they hold."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from civiclake.sources.keyed import BUCKETS, bucket_of, layout_of, read_keyed, same_key, touched, upsert_keyed, write_keyed
from civiclake.sources.scratch import materialize

OPEN, CLOSED = "current", "closed"


def row_hash(columns: list[str]) -> Column:
    """A hash of the columns that make a version; null and the empty string differ."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def versions(rows: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """Observations (keys, tracked columns, effective_date) as versions: a row where something changed, with row_hash,
    expiration_date (the day of the next version, null for the last) and is_current.

    Rows that say what the row before said fall away. Of several rows of a key and day one counts, the one with the
    greatest ``_load`` where there is such a column, then the greatest hash.
    """
    load = F.col("_load") if "_load" in rows.columns else F.lit("")
    hashed = rows.withColumn("row_hash", row_hash(tracked))
    one = hashed.groupBy(*keys, "effective_date").agg(F.max_by(F.struct(*tracked, "row_hash"), F.struct(load, "row_hash")).alias("v"))
    by = Window.partitionBy(*keys).orderBy("effective_date")
    changed = one.select(*keys, "effective_date", "v.*").withColumn("_last", F.lag("row_hash").over(by)).where(~F.col("row_hash").eqNullSafe(F.col("_last"))).drop("_last")
    until = F.lead("effective_date").over(by)
    return changed.withColumn("expiration_date", until).withColumn("is_current", F.col("expiration_date").isNull())


def create_history(rows: DataFrame, path: str, keys: list[str], tracked: list[str], buckets: int = BUCKETS, load: str = "0") -> None:
    """Store the versions of a first load below ``path``: open ones by bucket of their key, closed ones by load and bucket."""
    made = materialize(versions(rows, keys, tracked))
    write_keyed(made.where("is_current").drop("is_current", "expiration_date"), f"{path}/{OPEN}", keys, buckets)
    _write_closed(made.where("NOT is_current").drop("is_current"), path, keys, buckets, load)


def _write_closed(rows: DataFrame, path: str, keys: list[str], buckets: int, load: str) -> None:
    placed = rows.withColumns({"load": F.lit(f"load-{load}"), "bucket": bucket_of(keys, buckets)})
    _replace_folders(placed, path)


def _replace_folders(placed: DataFrame, path: str) -> None:
    """Write whole folders of closed rows; the other folders stay."""
    placed.repartition("load", "bucket").write.partitionBy("load", "bucket").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{path}/{CLOSED}")


def _closed(spark: SparkSession, path: str) -> DataFrame:
    """Closed versions with the load and bucket of their folder. The schema is that of the open ones, as there may be none."""
    fields = [*layout_of(spark, f"{path}/{OPEN}").schema, StructField("expiration_date", DateType()), StructField("load", StringType()), StructField("bucket", IntegerType())]
    return spark.read.schema(StructType(fields)).parquet(f"{path}/{CLOSED}")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions with effective_date, expiration_date, is_current and row_hash."""
    now = read_keyed(spark, f"{path}/{OPEN}").withColumns({"expiration_date": F.lit(None).cast("date"), "is_current": F.lit(True)})
    return now.unionByName(_closed(spark, path).drop("load", "bucket").withColumn("is_current", F.lit(False)))


def merge_history(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], tracked: list[str], load: str) -> dict[str, int]:
    """Put a load's observations (keys, tracked columns, effective_date) into a stored history; counts the keys opened, changed and late.

    Rows meet the open versions of their buckets. What says nothing new is left; a change closes the open version, which
    goes to the closed rows of this load, and opens its own: no closed row is read for that. A row older than its key's
    open version, or one that corrects it on its day, is late: that key's versions are read from its bucket's closed rows
    and laid out anew, and only the folders that held them are rewritten. Buckets without a change are not written.
    A row that only confirms a version leaves no trace, so a later row that is late holds until the next stored change.
    A load that is run again under its name, after a failure too, leads to the same history.
    """
    opened = f"{path}/{OPEN}"
    buckets = layout_of(spark, opened).buckets
    new = materialize(rows.select(*keys, *tracked, "effective_date").withColumn("row_hash", row_hash(tracked)))
    hit = touched(new, keys, buckets)
    open_ = read_keyed(spark, opened, hit)
    named = open_.select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.col("effective_date").alias("_since"), F.col("row_hash").alias("_hash"))
    differs = F.coalesce(F.col("row_hash") != F.col("_hash"), F.lit(True))
    late = F.coalesce((F.col("effective_date") < F.col("_since")) | ((F.col("effective_date") == F.col("_since")) & differs), F.lit(False))
    met = new.join(named, same_key(keys, "_k_"), "left")
    state = met.groupBy(*keys).agg(F.max("_since").alias("_since"), F.bool_or(late).alias("_late"), F.bool_or(differs | late).alias("_news")).where("_news")
    state = materialize(state.select(*(F.col(k).alias(f"_s_{k}") for k in keys), "_since", "_late"))
    every, some = state.drop("_since", "_late"), state.where("_late").drop("_since", "_late")
    here = same_key(keys, "_s_")
    pieces = new.join(every, here, "left_semi").drop("row_hash").withColumn("_load", F.lit(1))
    pieces = pieces.unionByName(open_.join(every, here, "left_semi").drop("row_hash").withColumn("_load", F.lit(0)))
    closed = _closed(spark, path).where(F.col("bucket").isin(hit))
    past = materialize(closed.join(some, here, "left_semi"))
    pieces = pieces.unionByName(past.drop("row_hash", "expiration_date", "load", "bucket").withColumn("_load", F.lit(0)))
    made = materialize(versions(pieces, keys, tracked))
    # What else lies in the folders that are written: rows of this load from a run before, and neighbours of late keys' rows.
    folders = [tuple(r) for r in past.select("load", "bucket").distinct().collect()]
    own = closed.where(F.col("load") == f"load-{load}").join(every, here, "left_anti")
    held = reduce(lambda a, b: a | b, ((F.col("load") == x) & (F.col("bucket") == y) for x, y in folders if x != f"load-{load}"), F.lit(False))
    rest = closed.where(held).join(some, here, "left_anti")
    keep = materialize(own.unionByName(rest))
    mine = F.col("load") == f"load-{load}"
    _write_closed(made.where("NOT is_current").drop("is_current").unionByName(keep.where(mine).drop("load", "bucket")), path, keys, buckets, load)
    upsert_keyed(spark, opened, made.where("is_current").drop("is_current", "expiration_date"), keys)
    _replace_folders(keep.where(~mine), path)
    left = {tuple(r) for r in keep.select("load", "bucket").distinct().collect()}
    for x, y in folders:
        if (x, y) not in left and x != f"load-{load}":
            _delete(spark, f"{path}/{CLOSED}/load={x}/bucket={y}")
    counts = state.agg(F.count_if(F.col("_since").isNull()), F.count_if(F.col("_since").isNotNull() & ~F.col("_late")), F.count_if("_late")).first()
    return {"opened": counts[0], "changed": counts[1], "late": counts[2]}


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{OPEN}/layout")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def as_of(history: DataFrame, day: dt.date | Column) -> DataFrame:
    """The versions that held on a day."""
    day = F.lit(day) if isinstance(day, dt.date) else day
    return history.where((F.col("effective_date") <= day) & (F.col("expiration_date").isNull() | (F.col("expiration_date") > day)))
