"""Ranks, percentiles and medians of whole tables and of groups, without one task that holds a table, a group or a tie."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.sources.scratch import materialize


def ranked(df: DataFrame, value: str, key: str, name: str = "place") -> DataFrame:
    """``df`` with places 1..n by ``value`` from the highest, ties by ``key``; null values last.

    A range shuffle by value and key cuts equal values too; the place of a row is its place in its partition plus the
    rows of all partitions before. One count a partition reaches the driver. Runs its jobs and stores its rows when called.
    """
    order = [F.desc_nulls_last(value), F.asc(key)]
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    local = F.monotonically_increasing_id()
    # The id holds the partition in its upper bits and the row of the partition in its 33 lower ones.
    dealt = materialize(dealt.withColumn("_row", local))
    part = F.shiftright("_row", 33).cast("int")
    starts, at = [], 0
    for p, n in sorted(map(tuple, dealt.groupBy(part.alias("p")).count().collect())):
        starts.append((p, at))
        at += n
    before = df.sparkSession.createDataFrame(starts, "_part int, _before long")
    out = dealt.join(F.broadcast(before), part == F.col("_part"))
    return out.withColumn(name, (F.col("_row").bitwiseAND((1 << 33) - 1) + F.col("_before") + 1).cast("int")).select(*df.columns, name)


def _alike(a: DataFrame, b: DataFrame, names: dict[str, str]) -> Column:
    """Columns of ``a`` equal those of ``b`` by these names, null to null."""
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[v]) for k, v in names.items()), F.lit(True))


def _dealt(df: DataFrame, keys: list[str], value: str, *sums: Column) -> tuple[DataFrame, DataFrame]:
    """Rows folded by keys and value (keys, value, _n, sums, _part), and the parts of each group: _k.., _p, _before, _size.

    Equal values fold first, so none is heavy; a range shuffle by keys and value cuts large groups into parts, and the
    running sum of a group goes over its parts alone, of which there are as many as partitions at most.
    """
    folded = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"), *sums)
    rows = materialize(folded.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id()))
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    parts = rows.groupBy(*named, F.col("_part").alias("_p")).agg(F.sum("_n").alias("_rows"))
    group = Window.partitionBy(*(f"_k{i}" for i in range(len(keys))))
    before = F.sum("_rows").over(group.orderBy("_p")) - F.col("_rows")
    return rows, parts.withColumn("_before", before).withColumn("_size", F.sum("_rows").over(group))


def _placed(rows: DataFrame, parts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``rows`` with _from, the rows of their group below them, and _size, those of the group."""
    both = rows.join(parts, _alike(rows, parts, {"_part": "_p", **{k: f"_k{i}" for i, k in enumerate(keys)}}))
    inside = Window.partitionBy(*keys, "_part").orderBy(value)
    return both.withColumn("_from", F.col("_before") + F.sum("_n").over(inside) - F.col("_n"))


def percent_rank(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``df`` with the place of each value in its group from 0 to 1: rows below it, by all others. Null values have none and count nowhere.

    Runs jobs and stores the folded values when called. Rows meet their value's place by an equi join, whose hot keys
    adaptive execution splits.
    """
    rows, parts = _dealt(df.select(*keys, value), keys, value)
    share = F.coalesce(F.try_divide(F.col("_from").cast("double"), (F.col("_size") - 1).cast("double")), F.lit(0.0))
    names = {**{k: f"_k{i}" for i, k in enumerate(keys)}, value: "_value"}
    placed = _placed(rows, parts, keys, value).select(*(F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)), F.col(value).alias("_value"), share.alias(name))
    out = df.join(placed, _alike(df, placed, {**{k: f"_r{i}" for i, k in enumerate(keys)}, value: names[value]}), "left")
    return out.select(*df.columns, name)


def group_places(df: DataFrame, keys: list[str], value: str, indexed: dict[str, float] | None = None, between: dict[str, float] | None = None, sums: tuple[Column, ...] = (), totals: tuple[Column, ...] = ()) -> DataFrame:
    """keys and a column for each wanted place of the group's sorted values, one pass over ``df``.

    ``indexed`` names percents: the value at place floor(n * p / 100), n - 1 at most; ``between`` names shares: linear
    between the two values next to (n - 1) * p, as a double. ``sums`` are aggregates of the rows behind a value, and
    ``totals`` aggregates over the folded rows (with _n, the rows of a value), so that other figures need no second pass.
    Null values count nowhere; groups without values have no row, but without keys there is always one. Runs jobs and stores the folded values when called.
    """
    indexed, between = indexed or {}, between or {}
    rows, parts = _dealt(df, keys, value, *sums)
    at = {n: F.least(F.floor(F.col("_size") * p / 100), F.col("_size") - 1) for n, p in indexed.items()}
    for n, p in between.items():
        spot = (F.col("_size") - 1) * F.lit(float(p))
        at |= {f"_lo_{n}": F.floor(spot), f"_hi_{n}": F.ceil(spot)}
    hit = reduce(lambda a, b: a | b, ((c >= F.col("_before")) & (c < F.col("_before") + F.col("_rows")) for c in at.values()), F.lit(False))
    near = _placed(rows, parts.where(hit), keys, value)
    here = lambda c: (c >= F.col("_from")) & (c < F.col("_from") + F.col("_n"))
    found = near.groupBy(*keys).agg(F.max("_size").alias("_size"), *(F.max(F.when(here(c), F.col(value))).alias(n) for n, c in at.items()))
    low, high = (lambda n: F.col(f"_lo_{n}").cast("double")), (lambda n: F.col(f"_hi_{n}").cast("double"))
    spot = lambda p: (F.col("_size") - 1) * F.lit(float(p))
    mean = [(low(n) + (high(n) - low(n)) * (spot(p) - F.floor(spot(p)))).alias(n) for n, p in between.items()]
    found = found.select(*keys, *indexed, *mean)
    if not totals:
        return found
    other = rows.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(*totals)
    return other.join(found, _alike(found, other, {k: f"_k{i}" for i, k in enumerate(keys)})).drop(*(f"_k{i}" for i in range(len(keys))))


def index_percentile(df: DataFrame, keys: list[str], value: str, percents: tuple[int, ...]) -> DataFrame:
    """keys, p<k>: the value at place floor(n * p / 100) of the sorted values (0-based, at most n - 1). See ``group_places``."""
    return group_places(df, keys, value, {f"p{p}": p for p in percents})
