"""Aggregated analytics tables: spend by vendor and agency, property values, market trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.functions.scalars import entity_id, fiscal_year, metric_category, po_amount, trend_direction, vendor_key
from civiclake.sources.scratch import materialize
from civiclake.operators.order import group_places, ranked

MONEY = "decimal(28,2)"
KINDS = {"contract": ("total_contract_value", "contract_count"), "po": ("total_po_value", "po_count"), "payment": ("total_payments", "payment_count")}


def positive_sum(c: Column) -> Column:
    return F.coalesce(F.sum(F.when(c > 0, c)), F.lit(0)).cast(MONEY)


def tagged_spend(contracts: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per contract, purchase order and payment: kind, vendor, agency, amount, date."""
    c = contracts.select(F.lit("contract").alias("kind"), F.col("supplier_name").alias("vendor"), F.col("agency_name").alias("agency"), F.col("contract_amount").cast(MONEY).alias("amount"), F.col("start_date").alias("day"))
    o = orders.select(F.lit("po").alias("kind"), F.col("supplier_name").alias("vendor"), F.col("agency_name").alias("agency"), po_amount(F.col("amount_min"), F.col("amount_max")).cast(MONEY).alias("amount"), F.lit(None).cast("date").alias("day"))
    p = payments.select(F.lit("payment").alias("kind"), F.col("supplier_name").alias("vendor"), F.col("agency_name").alias("agency"), F.col("payment_amount").cast(MONEY).alias("amount"), F.col("payment_date").alias("day"))
    return c.unionByName(o).unionByName(p)


def folded_spend(contracts: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """``tagged_spend`` folded to kind, vendor, agency and fiscal year: positive sums, rows, rows above zero, first and last day.

    The first fold of every spend table: codegen aggregates before the shuffle, and names are normalized on what is left.
    """
    rows = tagged_spend(contracts, orders, payments).withColumn("year", fiscal_year(F.col("day")))
    return rows.groupBy("kind", "vendor", "agency", "year").agg(
        positive_sum(F.col("amount")).alias("amount"), F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("amount") > 0, 1)).alias("n_positive"), F.min("day").alias("first_day"), F.max("day").alias("last_day"),
    )


def _of(kind: str, c: Column) -> Column:
    return F.when(F.col("kind") == kind, c)


def _totals() -> list[Column]:
    sums = [F.coalesce(F.sum(_of(k, F.col("amount"))), F.lit(0)).cast(MONEY).alias(total) for k, (total, _) in KINDS.items()]
    return sums + [F.coalesce(F.sum(_of(k, F.col("n"))), F.lit(0)).alias(n) for k, (_, n) in KINDS.items()]


def spend_by_vendor(contracts: DataFrame, orders: DataFrame, payments: DataFrame, certified: DataFrame) -> DataFrame:
    """Per vendor key: sums of positive amounts, counts, average contract, agencies, contract years, dates, certification, rank.

    One pass over the folded union: by raw name, whose key is made once, then by key, so a vendor may occur in any
    source. The shown name is the most frequent contract name, ties to the smallest.
    """
    rows = folded_spend(contracts, orders, payments).where(F.coalesce("vendor", F.lit("")) != "")
    names = rows.groupBy("vendor").agg(
        *_totals(), F.collect_set("agency").alias("agencies"), F.collect_set(_of("contract", F.col("year"))).alias("years"),
        F.min(_of("contract", F.col("first_day"))).alias("first_contract_date"), F.max(_of("payment", F.col("last_day"))).alias("last_payment_date"),
    )
    sums = [F.sum(c).cast(MONEY).alias(c) for c, _ in KINDS.values()] + [F.sum(c).alias(c) for _, c in KINDS.values()]
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    contracted = F.when(F.col("contract_count") > 0, F.struct(-F.col("contract_count"), F.col("vendor")))
    out = names.withColumn("vendor_key", vendor_key(F.col("vendor"))).groupBy("vendor_key").agg(
        *sums, flat("agencies").alias("agencies"), flat("years").alias("fiscal_years"), F.min("first_contract_date").alias("first_contract_date"), F.max("last_payment_date").alias("last_payment_date"), F.min_by("vendor", contracted).alias("vendor_name"),
    )
    flags = certified.select("business_name").distinct().select(vendor_key(F.col("business_name")).alias("vendor_key")).distinct().withColumn("is_cbe", F.lit(True))
    out = out.join(flags, "vendor_key", "left").select(
        entity_id(F.col("vendor_key")).alias("vendor_id"), F.coalesce("vendor_name", "vendor_key").alias("vendor_name"), "vendor_key", "total_contract_value", "total_po_value", "total_payments",
        "contract_count", "po_count", "payment_count", F.round(F.coalesce(F.try_divide(F.col("total_contract_value").cast("double"), F.col("contract_count")), F.lit(0.0)), 4).alias("average_contract"),
        "agencies", F.size("agencies").alias("agency_count"), "fiscal_years", "first_contract_date", "last_payment_date",
        F.coalesce("is_cbe", F.lit(False)).alias("is_cbe"), F.get("agencies", F.lit(0)).alias("top_agency"), (F.col("total_payments") + F.col("total_contract_value")).alias("ranked_spend"),
    )
    return ranked(out, "ranked_spend", "vendor_key", "spend_rank").drop("ranked_spend")


def property_values_by_ward(properties: DataFrame) -> DataFrame:
    """Per ward 1..8: count, total, average, median, extremes, averages of size and year, price per square foot, percentiles.

    One pass: rows fold by ward and price with the sums of the rest; all figures come from what is left.
    """
    rows = properties.where(F.col("ward").between(1, 8) & (F.col("price") > 0))
    price, n = F.col("price"), F.col("_n")
    sums = [a(c).alias(f"_{k}_{c}") for c in ("sqft", "year_built") for k, a in (("sum", F.sum), ("count", F.count))]
    mean = lambda c: F.try_divide(F.sum(f"_sum_{c}").cast("double"), F.sum(f"_count_{c}"))
    total = F.sum(price * n)
    average = total.cast("double") / F.sum(n)
    figures = (
        F.sum(n).alias("property_count"), total.cast(MONEY).alias("total_value"), F.round(average, 4).alias("avg_value"), F.min(price).alias("min_value"), F.max(price).alias("max_value"),
        F.round(mean("sqft"), 4).alias("avg_sqft"), F.round(mean("year_built"), 4).alias("avg_year_built"), F.round(F.try_divide(average, mean("sqft")), 4).alias("avg_price_per_sqft"),
    )
    return group_places(rows, ["ward"], "price", {"p25": 25, "p75": 75, "p90": 90}, {"median_value": 0.5}, tuple(sums), figures)


def value_distribution(df: DataFrame, key: str, value: str) -> DataFrame:
    """key, value, n: the rows behind a distribution map."""
    return df.groupBy(key, F.coalesce(F.col(value).cast("string"), F.lit("unknown")).alias(value)).agg(F.count(F.lit(1)).alias("n"))


def distribution_map(df: DataFrame, key: str, value: str) -> DataFrame:
    """key, distribution: the counts of each value as one JSON object, values in order."""
    rows = value_distribution(df, key, value)
    return rows.groupBy(key).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(value, "n"))))).alias("distribution"))


def agency_spend(contracts: DataFrame, orders: DataFrame, payments: DataFrame, top: int = 10) -> DataFrame:
    """Per agency: sums of positive amounts, contract count, distinct vendors with a positive amount, shown name, the
    ``top`` vendors by positive spend (raw names) and positive spend by fiscal year, both as arrays of structs.

    The tagged union is stored, so the sources are read once. Figures of an agency fold to agency and year within each
    task, whatever the number of vendors; vendors fold once, by agency and raw name, and only rows above zero do. Names
    are counted and ranked from that, each task handing on its first ``top`` names of an agency. An agency without such
    a vendor has null vendors.
    """
    rows = materialize(tagged_spend(contracts, orders, payments).where("agency IS NOT NULL").select("kind", "vendor", "agency", "amount", fiscal_year(F.col("day")).alias("year")))
    key, amount = F.lower(F.trim("agency")).alias("agency_key"), F.col("amount")
    paid = F.when(amount > 0, amount)
    sums = [F.sum(_of(k, paid)).alias(total) for k, (total, _) in KINDS.items()]
    parts = rows.groupBy("agency", "year").agg(*sums, F.count_if(F.col("kind") == "contract").alias("contract_count"), F.sum(paid).cast(MONEY).alias("spend"))
    years = parts.where("year IS NOT NULL AND spend IS NOT NULL").groupBy(key, "year").agg(F.sum("spend").cast(MONEY).alias("spend"))
    years = years.groupBy("agency_key").agg(F.array_sort(F.collect_list(F.struct("year", "spend"))).alias("spend_by_year"))
    totals = [F.coalesce(F.sum(total), F.lit(0)).cast(MONEY).alias(total) for total, _ in KINDS.values()]
    out = parts.groupBy(key).agg(F.min("agency").alias("agency_name"), *totals, F.sum("contract_count").alias("contract_count"))
    vendors = materialize(rows.where((amount > 0) & F.col("vendor").isNotNull()).groupBy(key, "vendor").agg(F.sum("amount").cast(MONEY).alias("spend")))
    names = vendors.groupBy("agency_key").agg(F.count_distinct(F.lower(F.trim("vendor"))).alias("vendor_count"))
    place = F.row_number().over(Window.partitionBy("agency_key").orderBy(F.desc("spend"), "vendor"))
    best = vendors.withColumn("place", place).where(F.col("place") <= top).groupBy("agency_key").agg(F.array_sort(F.collect_list(F.struct("place", "vendor", "spend"))).alias("best"))
    best = best.select("agency_key", F.transform("best", lambda x: F.struct(x["vendor"].alias("vendor"), x["spend"].alias("spend"))).alias("top_vendors"))
    out = out.join(names, "agency_key", "left").join(best, "agency_key", "left").join(years, "agency_key", "left")
    return out.select("agency_key", "agency_name", *(total for total, _ in KINDS.values()), "contract_count", F.coalesce("vendor_count", F.lit(0)).alias("vendor_count"), "top_vendors", "spend_by_year")


def top_vendors(payments: DataFrame, n: int = 10) -> DataFrame:
    """The n vendors with most payments in each agency: aggregated before the window."""
    sums = payments.groupBy("agency_name", "supplier_name").agg(F.sum("payment_amount").cast(MONEY).alias("spend"))
    rank = F.row_number().over(Window.partitionBy("agency_name").orderBy(F.desc("spend"), "supplier_name"))
    return sums.withColumn("place", rank).where(F.col("place") <= n)


def market_trends(stats: DataFrame, year_back: int = 11, points: int = 24) -> DataFrame:
    """Per series: latest value, change to the row before and to the row ``year_back`` before, direction, the last points in time order."""
    series = Window.partitionBy("region_name", "metric_name").orderBy("metric_date", "metric_value")
    back = Window.partitionBy("region_name", "metric_name").orderBy(F.desc("metric_date"), F.desc("metric_value"))
    change = lambda k: F.round(F.try_divide(F.col("v") - F.lag("v", k).over(series), F.lag("v", k).over(series)) * 100, 2)
    rows = stats.withColumn("v", F.col("metric_value").cast("double")).withColumn("mom_change", change(1)).withColumn("yoy_change", change(year_back)).withColumn("place", F.row_number().over(back))
    last = lambda c, n: F.max(F.when(F.col("place") == 1, F.col(c))).alias(n)
    history = F.array_sort(F.collect_list(F.when(F.col("place") <= points, F.struct("metric_date", "metric_value"))))
    return rows.groupBy("region_name", "metric_name").agg(
        last("metric_date", "latest_date"), last("v", "latest_value"), last("mom_change", "mom_change"), last("yoy_change", "yoy_change"), F.count_if(F.col("place") <= points).alias("points"), history.alias("history"),
    ).withColumns({"trend": trend_direction(F.col("yoy_change")), "category": metric_category(F.col("metric_name"))})
