"""Shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.sources.scratch import shared_folder

#: ASCII white space as the contracts define it; bytes.split() of Python uses the same six bytes.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share, below the application's (see ``sources.scratch``)."""
    return shared_folder(spark)


def store(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, folder: str, *names: str) -> None:
    """Delete stored tables that nothing reads any more, on whichever store they lie."""
    for name in names:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for temporary columns that ``df`` doesn't have, whatever the case of its own."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n in have:
            n += "_"
        have.add(n)
        out.append(n)
    return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
