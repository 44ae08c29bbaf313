"""Incremental work as Structured Streaming: dedup with bounded state, windowed counts, routing micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.functions.scalars import content_signature
from civiclake.operators.validate import Rule, route


def stream_of(spark: SparkSession, path: str, like: DataFrame, files: int = 16) -> DataFrame:
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).parquet(path)


def dedup_stream(df: DataFrame, time: str, keys: list[str], delay: str) -> DataFrame:
    """Each key once while it may still recur within ``delay``; older state is dropped."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def daily_counts(df: DataFrame, time: str, delay: str, *keys: str) -> DataFrame:
    """Events and value sums a day; rows later than ``delay`` are left out."""
    return df.withWatermark(time, delay).groupBy(F.window(time, "1 day").alias("w"), *keys).agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total"))


def run_available(df: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> None:
    """Take all that is there, then stop; the checkpoint is the place to resume from."""
    df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def route_stream(df: DataFrame, rules: list[Rule], source: str, good: str, bad: str, checkpoint: str) -> None:
    """Validate each micro-batch and write valid and quarantined rows; a batch that is run again overwrites itself."""

    def one(batch: DataFrame, number: int) -> None:
        ok, errors = route(batch, rules, source)
        ok.write.mode("overwrite").parquet(f"{good}/batch={number}")
        errors.write.mode("overwrite").json(f"{bad}/batch={number}")

    df.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def advance_watermark(state: DataFrame, rows: DataFrame, source: str, time: str) -> DataFrame:
    """source, high: the later of the stored and the seen time; never goes back."""
    seen = rows.groupBy(F.col(source).alias("source")).agg(F.max(time).alias("high"))
    return state.unionByName(seen).groupBy("source").agg(F.max("high").alias("high"))


def newer_rows(rows: DataFrame, state: DataFrame, source: str, time: str) -> DataFrame:
    s = state.select(F.col("source").alias(source), "high")
    return rows.join(s, source, "left").where(F.col("high").isNull() | (F.col(time) > F.col("high"))).drop("high")


def monthly_spend(df: DataFrame, time: str, amount: str, delay: str) -> DataFrame:
    """Spend and payments of each month, kept up to date; as months differ in length, days are windowed and the batch view adds them."""
    return df.withWatermark(time, delay).groupBy(F.window(time, "1 day").alias("w")).agg(F.sum(amount).alias("spend"), F.count(F.lit(1)).alias("payments")).select(F.date_format(F.col("w.start"), "yyyy-MM").alias("month"), F.to_date("w.start").alias("day"), "spend", "payments")


def months_of(days: DataFrame) -> DataFrame:
    """The months of the stored days of ``monthly_spend``: a day that was written again counts by its last, largest row."""
    last = days.groupBy("month", "day").agg(F.max_by(F.struct("spend", "payments"), "payments").alias("d"))
    return last.groupBy("month").agg(F.sum("d.spend").alias("spend"), F.sum("d.payments").alias("payments"))


def unchanged_skipped(payloads: DataFrame, seen: DataFrame) -> DataFrame:
    """Payloads (kind, url, content_hash) whose signature isn't among the stored ones (signature), each once, with it."""
    rows = payloads.withColumn("signature", content_signature(F.col("kind"), F.col("url"), F.col("content_hash"))).dropDuplicates(["signature"])
    return rows.join(seen.select("signature").distinct(), "signature", "left_anti")


def clear_progress(spark: SparkSession, checkpoint: str) -> bool:
    """Forget how far a stream has come, so that the next run takes all from the start; tells whether there was anything."""
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def progress(query) -> dict:
    """Batches, rows taken and last end positions of a query that ran."""
    done = [p for p in query.recentProgress]
    return {"batches": len({p["batchId"] for p in done}), "rows": sum(p["numInputRows"] for p in done), "end": [s["endOffset"] for s in done[-1]["sources"]] if done else []}
