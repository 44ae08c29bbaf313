"""The interface of a dataset: transform, schema, rules; running it writes the valid rows and tells what happened."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civiclake.operators.validate import Rule, route
from civiclake.sources.io import conform, swap, write_quarantine
from civiclake.sources.scratch import materialize


class DatasetBuilder(Protocol):
    """What a user writes for a dataset of their own."""

    name: str

    def transform(self, spark: SparkSession, inputs: dict[str, DataFrame]) -> DataFrame: ...

    def schema(self) -> StructType: ...

    def rules(self) -> list[Rule]: ...


@dataclass(frozen=True)
class Built:
    name: str
    written: int
    quarantined: int


def run_builder(spark: SparkSession, builder: DatasetBuilder, inputs: dict[str, DataFrame], path: str, quarantine: str | None = None) -> Built:
    """Build a dataset: rows in its schema that hold its rules are written, the others go to quarantine."""
    rows = materialize(conform(builder.transform(spark, inputs), builder.schema()))
    good, bad = route(rows, builder.rules(), builder.name)
    swap(good, path)
    if quarantine:
        write_quarantine(bad, quarantine)
    written = spark.read.parquet(path).agg(F.count(F.lit(1))).first()[0]
    return Built(builder.name, written, rows.agg(F.count(F.lit(1))).first()[0] - written)
