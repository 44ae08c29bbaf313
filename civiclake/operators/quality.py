"""Data quality: null rates, drift, scores, contracts and alerts, each one generated aggregation."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.operators.order import index_percentile


def null_rates(df: DataFrame, dataset: str) -> DataFrame:
    """dataset, column, n, nulls, rate: one pass over all columns."""
    one = df.agg(F.count(F.lit(1)).alias("__n"), *(F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns))
    long = one.unpivot(["__n"], df.columns, "column", "nulls")
    return long.select(F.lit(dataset).alias("dataset"), "column", F.col("__n").alias("n"), "nulls", F.round(F.coalesce(F.try_divide("nulls", "__n"), F.lit(0.0)), 6).alias("rate"))


def high_null(rates: DataFrame, least: float = 0.5) -> DataFrame:
    return rates.where(F.col("rate") >= least).orderBy(F.desc("rate"), "column")


def null_summary(rates: DataFrame) -> DataFrame:
    return rates.groupBy("dataset").agg(F.round(F.avg("rate"), 6).alias("avg_rate"), F.count_if(F.col("rate") >= 0.5).alias("half_null"), F.count_if(F.col("rate") >= 0.9).alias("mostly_null"))


def null_drift(before: DataFrame, after: DataFrame, least: float = 0.1) -> DataFrame:
    """Columns whose rate changed by ``least`` or more; a column missing before or after counts as 0 there."""
    old = before.select("dataset", "column", F.col("rate").alias("old_rate"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    out = after.select("dataset", "column", "rate").join(old, ["dataset", "column"], "full").withColumns({"old_rate": zero("old_rate"), "rate": zero("rate")})
    return out.withColumn("change", F.round(F.col("rate") - F.col("old_rate"), 6)).where(F.abs("change") >= least).select("dataset", "column", "old_rate", "rate", "change")


def quality_score(rates: DataFrame) -> DataFrame:
    """1 - 0.5 * average rate - 0.3 * share of high-null columns - 0.2 if empty, not below 0."""
    agg = rates.groupBy("dataset").agg(F.avg("rate").alias("a"), F.avg((F.col("rate") >= 0.5).cast("double")).alias("h"), F.max("n").alias("n"))
    return agg.select("dataset", F.round(F.greatest(F.lit(0.0), 1 - 0.5 * F.col("a") - 0.3 * F.col("h") - F.when(F.col("n") == 0, 0.2).otherwise(0.0)), 6).alias("score"))


def check_contract(df: DataFrame, contract: dict) -> DataFrame:
    """check, column, failures, passed for a contract.

    contract: {"columns": {name: {"nullable", "max_null_rate", "type", "min", "max", "pattern", "allowed", "primary_key"}},
    "min_rows", "max_null_rate", "max_duplicate_rate" (of whole rows)}. All files are read; a declared limit of 0 counts.
    """
    spark, have = df.sparkSession, set(df.columns)
    checks = [F.count(F.lit(1)).alias("rows")]
    for name, spec in contract["columns"].items():
        c = F.col(name)
        if name not in have:
            continue
        checks.append(F.count_if(c.isNull()).alias(f"nulls|{name}"))
        if "type" in spec:
            checks.append(F.count_if(c.isNotNull() & c.try_cast(spec["type"]).isNull()).alias(f"type|{name}"))
        for kind, bad in (("min", lambda v, c=c: c < v), ("max", lambda v, c=c: c > v), ("pattern", lambda v, c=c: ~c.cast("string").rlike(v)), ("allowed", lambda v, c=c: ~c.isin(*v))):
            if kind in spec:
                checks.append(F.count_if(bad(spec[kind])).alias(f"{kind}|{name}"))
    one = df.agg(*checks)
    long = one.unpivot(["rows"], [x for x in one.columns if x != "rows"], "what", "failures").select(F.split_part("what", F.lit("|"), F.lit(1)).alias("check"), F.split_part("what", F.lit("|"), F.lit(2)).alias("column"), "failures", "rows")
    limit = F.lit(contract.get("max_null_rate", 1.0))
    for name, spec in contract["columns"].items():
        share = spec.get("max_null_rate", None if spec.get("nullable", True) else 0.0)
        if share is not None:
            limit = F.when(F.col("column") == name, share).otherwise(limit)
    passed = F.when(F.col("check") == "nulls", F.coalesce(F.try_divide("failures", "rows"), F.lit(0.0)) <= limit).otherwise(F.col("failures") == 0)
    out = long.select("check", "column", "failures", passed.alias("passed"))
    out = out.unionByName(one.select(F.lit("min_rows").alias("check"), F.lit("").alias("column"), F.greatest(F.lit(0), contract.get("min_rows", 0) - F.col("rows")).alias("failures"), (F.col("rows") >= contract.get("min_rows", 0)).alias("passed")))
    keys = [n for n, s in contract["columns"].items() if s.get("primary_key") and n in have]
    if keys:
        twice = df.groupBy(*keys).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("failures"))
        out = out.unionByName(twice.select(F.lit("primary_key").alias("check"), F.lit(",".join(keys)).alias("column"), "failures", (F.col("failures") == 0).alias("passed")))
    if "max_duplicate_rate" in contract:
        again = df.groupBy(*df.columns).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("failures"), F.coalesce(F.sum("count"), F.lit(0)).alias("n"))
        share = F.coalesce(F.try_divide("failures", "n"), F.lit(0.0))
        out = out.unionByName(again.select(F.lit("duplicates").alias("check"), F.lit("").alias("column"), "failures", (share <= contract["max_duplicate_rate"]).alias("passed")))
    schema = [("missing", n) for n in contract["columns"] if n not in have] + [("extra", n) for n in sorted(have - set(contract["columns"]))]
    if schema:
        extra = spark.createDataFrame([(k, n, 1, k == "extra") for k, n in schema], "check string, column string, failures long, passed boolean")
        out = out.unionByName(extra)
    return out


def sampled_null_rates(df: DataFrame, dataset: str, share: float = 0.01, above: int = 100_000, seed: int = 7) -> DataFrame:
    """``null_rates`` of a seeded sample where the table has more than ``above`` rows; n is the sample's size."""
    rows = df.agg(F.count(F.lit(1))).first()[0]
    return null_rates(df.sample(share, seed) if rows > above else df, dataset)


def layer_report(datasets: dict[str, DataFrame]) -> DataFrame:
    """dataset, rows, columns, avg_null_rate, max_null_rate, high_null, score for each dataset and, as ``all``, for the layer."""
    rates = reduce(DataFrame.unionByName, (null_rates(df, n) for n, df in datasets.items()))
    each = rates.groupBy("dataset").agg(F.max("n").alias("rows"), F.count(F.lit(1)).alias("columns"), F.round(F.avg("rate"), 6).alias("avg_null_rate"), F.max("rate").alias("max_null_rate"), F.count_if(F.col("rate") >= 0.5).alias("high_null"))
    each = each.join(quality_score(rates), "dataset")
    whole = each.agg(F.sum("rows").alias("rows"), F.sum("columns").alias("columns"), F.round(F.avg("avg_null_rate"), 6).alias("avg_null_rate"), F.max("max_null_rate").alias("max_null_rate"), F.sum("high_null").alias("high_null"), F.round(F.avg("score"), 6).alias("score"))
    return each.unionByName(whole.select(F.lit("all").alias("dataset"), "*"))


def with_unreadable(report: DataFrame, dataset: str, bad: DataFrame) -> DataFrame:
    """A layer's report with what can't be read: ``bad`` has the dataset, unreadable (files) and more; datasets without any have 0."""
    return report.join(bad, dataset, "left").fillna({"unreadable": 0})


def check_sla(df: DataFrame, dataset: str, sla: dict) -> DataFrame:
    """dataset, check, failures, passed: required columns, least rows and the average null rate of a dataset's SLA."""
    have = set(df.columns)
    missing = [c for c in sla.get("required_columns", ()) if c not in have]
    one = df.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{k}") for k, c in enumerate(df.columns)))
    nulls = reduce(lambda a, b: a + b, (F.col(f"c{k}") for k in range(len(df.columns))))
    rate = F.coalesce(F.try_divide(nulls, F.col("n") * len(df.columns)), F.lit(0.0))
    checks = F.array(
        F.struct(F.lit("required_columns").alias("check"), F.lit(len(missing)).cast("long").alias("failures"), F.lit(not missing).alias("passed")),
        F.struct(F.lit("min_row_count").alias("check"), F.greatest(F.lit(0), F.lit(sla.get("min_row_count", 1)) - F.col("n")).cast("long").alias("failures"), (F.col("n") >= sla.get("min_row_count", 1)).alias("passed")),
        F.struct(F.lit("max_null_rate").alias("check"), F.when(rate > sla.get("max_null_rate", 1.0), 1).otherwise(0).cast("long").alias("failures"), (rate <= sla.get("max_null_rate", 1.0)).alias("passed")),
    )
    return one.select(F.lit(dataset).alias("dataset"), F.inline(checks))


def validate_layer(checks: DataFrame, strict: bool = False) -> DataFrame:
    """dataset, checks, failed, passed, and the same for the layer as ``all``: without ``strict`` one dataset that passes is enough for it."""
    each = checks.groupBy("dataset").agg(F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("passed")).alias("failed")).withColumn("passed", F.col("failed") == 0)
    fine = F.bool_and("passed") if strict else F.bool_or("passed")
    return each.unionByName(each.agg(F.sum("checks").alias("checks"), F.sum("failed").alias("failed"), fine.alias("passed")).select(F.lit("all").alias("dataset"), "*"))


def health(runs: DataFrame) -> DataFrame:
    """Per source: records, quarantined, success and quarantine rates in percent, p95 of latency (index percentile), seconds.

    ``runs``: source, ok (whether the record was written), latency.
    """
    rows = runs.groupBy("source").agg(F.count(F.lit(1)).alias("processed"), F.count_if(~F.col("ok")).alias("quarantined"), F.round(F.sum("latency"), 4).alias("seconds"))
    p95 = index_percentile(runs, ["source"], "latency", (95,)).withColumnRenamed("p95", "latency_p95")
    rate = lambda c: F.round(F.coalesce(F.try_divide(c * 100.0, F.col("processed")), F.lit(0.0)), 2)
    return rows.join(p95, "source", "left").withColumns({"success_rate": rate(F.col("processed") - F.col("quarantined")), "quarantine_rate": rate(F.col("quarantined"))})


def health_summary(by_source: DataFrame, least: float = 0.0) -> DataFrame:
    """One row over all sources: run, succeeded (success rate above ``least`` percent), failed, records, quarantined, overall success rate."""
    good = F.count_if(F.col("success_rate") > least)
    all_, bad = F.sum("processed"), F.sum("quarantined")
    return by_source.agg(
        F.count(F.lit(1)).alias("sources_run"), good.alias("sources_succeeded"), (F.count(F.lit(1)) - good).alias("sources_failed"), F.coalesce(all_, F.lit(0)).alias("processed"), F.coalesce(bad, F.lit(0)).alias("quarantined"),
        F.round(F.coalesce(F.try_divide((all_ - bad) * 100.0, all_), F.lit(0.0)), 2).alias("success_rate"),
    )


#: What happens to a record, in order; a record counts for every step up to the one it reached.
STEPS = ("discovered", "fetched", "parsed", "valid", "written")


def run_counts(records: DataFrame, source: str, reached: str) -> DataFrame:
    """Per source: how many records reached each of STEPS, success rate (written of discovered) and error rate."""
    place = F.array_position(F.array(*map(F.lit, STEPS)), F.col(reached))
    rows = records.groupBy(source).agg(*(F.count_if(place > k).alias(n) for k, n in enumerate(STEPS)))
    rate = F.round(F.coalesce(F.try_divide(F.col("written").cast("double"), F.col("discovered")), F.lit(0.0)), 6)
    return rows.withColumn("success_rate", rate).withColumn("error_rate", F.round(1 - rate, 6))


def run_report(events: DataFrame, source: str, ok: str) -> DataFrame:
    """Per source: rows seen, failed, success rate."""
    return events.groupBy(source).agg(F.count(F.lit(1)).alias("seen"), F.count_if(~F.col(ok)).alias("failed"), F.round(F.avg(F.col(ok).cast("double")), 6).alias("success_rate"))


def freshness(spark: SparkSession, path: str, as_of, sla_hours: float) -> DataFrame:
    """Age of the newest file below ``path`` against its limit."""
    newest = spark.read.parquet(path).select(F.max("_metadata.file_modification_time").alias("newest"))
    age = (F.unix_timestamp(F.lit(as_of)) - F.unix_timestamp("newest")) / 3600
    status = F.when(F.col("age_hours") > 2 * sla_hours, "critical").when(F.col("age_hours") > sla_hours, "late").when(F.col("age_hours") > 0.8 * sla_hours, "approaching").otherwise("fresh")
    return newest.select(F.round(age, 4).alias("age_hours")).withColumn("status", status)


def dataset_stats(spark: SparkSession, path: str) -> DataFrame:
    """Rows, files, bytes, partitions (folders) and null rates of a dataset, from file metadata and one pass."""
    df = spark.read.parquet(path)
    files = df.groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("size"))
    one = files.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count_distinct(F.regexp_extract("file_path", "^(.*)/[^/]*$", 1)).alias("partitions"))
    return one.crossJoin(null_rates(df, "d").agg(F.round(F.avg("rate"), 6).alias("avg_null_rate"), F.max("rate").alias("max_null_rate")))


def schema_drift(df: DataFrame, declared: list[str]) -> DataFrame:
    """column, change: new fields against the declared ones, and missing ones."""
    have = set(df.columns)
    rows = [(c, "new") for c in df.columns if c not in set(declared)] + [(c, "missing") for c in declared if c not in have]
    return df.sparkSession.createDataFrame(rows, "column string, change string")


#: From the least to the gravest.
SEVERITIES = ("info", "warning", "error", "critical")


def alerts(metrics: DataFrame, rules: list[tuple[str, str, str, str]], least: str = SEVERITIES[0]) -> DataFrame:
    """Rows of metrics (name, value) that meet a rule (metric, SQL condition on value, severity, message), of ``least`` severity at least."""
    grave = SEVERITIES[SEVERITIES.index(least) :]
    kept = [r for r in rules if r[2] in grave]
    if unknown := {r[2] for r in rules} - set(SEVERITIES):
        raise ValueError(f"no severity: {', '.join(sorted(unknown))}")
    kind = "array<struct<severity: string, message: string>>"
    out = F.array_compact(F.array(*(F.when((F.col("name") == m) & F.expr(c), F.struct(F.lit(s).alias("severity"), F.lit(t).alias("message"))) for m, c, s, t in kept))).cast(kind)
    return metrics.select("name", "value", F.inline(out))


@dataclass(frozen=True)
class Threshold:
    """Values from which on a metric is of concern: where ``low`` it is too low below them, else too high above them."""

    warning: float
    critical: float
    target: float | None = None
    low: bool = False

    def level(self, value: Column) -> Column:
        past = lambda t: value < t if self.low else value > t
        met = F.lit(True) if self.target is None else ~past(self.target)
        return F.when(value.isNull(), "unknown").when(past(self.critical), "critical").when(past(self.warning), "warning").when(met, "met").otherwise("below target" if self.low else "above target")


#: Percent of spend with certified suppliers, and of an agency's spend with one supplier.
THRESHOLDS = {"cbe_spend_goal": Threshold(40, 30, 50, low=True), "vendor_concentration": Threshold(10, 20)}


def threshold_levels(metrics: DataFrame, thresholds: dict[str, Threshold] = THRESHOLDS) -> DataFrame:
    """``metrics`` (name, value and more) of the named thresholds with their level: critical, warning, met, below or above target, unknown."""
    level = F.lit(None).cast("string")
    for n, t in thresholds.items():
        level = F.when(F.col("name") == n, t.level(F.col("value"))).otherwise(level)
    return metrics.where(F.col("name").isin(*thresholds)).withColumn("level", level)
