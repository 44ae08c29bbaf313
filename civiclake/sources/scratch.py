"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _session_folder(spark: SparkSession) -> str:
    """The folder of this application below ``spark.checkpoint.dir``.

    Without that setting a session that runs on this machine alone takes a temporary folder; a cluster raises an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="spark-civiclake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/civiclake/{spark.sparkContext.applicationId}"


def shared_folder(spark: SparkSession) -> str:
    """The path of a new folder that driver and executors share."""
    return f"{_session_folder(spark)}/{uuid.uuid4().hex}"


def clear_stored(spark: SparkSession) -> bool:
    """Delete all tables that this application has stored; for when no result that reads them is wanted any more.

    Results are lazy and read stored tables when they run, so the library can't tell that moment itself.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written to a shared folder and read back, so that several readers compute it once."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
