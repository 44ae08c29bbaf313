"""Star schema: dimensions, the spend fact, and KPI views over them."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from civiclake.functions.scalars import code_list, entity_id, fiscal_month, fiscal_quarter, fiscal_year, spend_tier, supplier_key, uuid5, ward_label
from civiclake.operators import history
from civiclake.operators.dedup import most_complete
from civiclake.sources.scratch import materialize

MONEY = "decimal(28,2)"


def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row a day: keys, ISO week and day, names, weekend flag, fiscal parts (years start in October)."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("full_date"))
    d = F.col("full_date")
    iso_day = F.weekday(d) + 1
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), d, F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"), F.dayofmonth(d).alias("day"), iso_day.alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"), (iso_day >= 6).alias("is_weekend"),
        fiscal_year(d).alias("fiscal_year"), fiscal_quarter(d).alias("fiscal_quarter"), fiscal_month(d).alias("fiscal_month"),
    )


def supplier_names(certified: DataFrame, contracts: DataFrame, payments: DataFrame) -> DataFrame:
    """Every raw supplier name with the supplier it belongs to: name, supplier_id, supplier_name, supplier_key, is_cbe, priority.

    Names are folded before they are normalized. Of the names with one key the certified ones come first, then those
    of contracts and of payments, the smallest of each.
    """
    pick = lambda df, col, rank: df.select(F.col(col).alias("name"), F.lit(rank).alias("priority"))
    rows = pick(certified, "business_name", 1).unionByName(pick(contracts, "supplier_name", 2)).unionByName(pick(payments, "supplier_name", 3))
    # A number, as a least struct would sort every row of a task first; certified names alone come first.
    rows = rows.groupBy("name").agg(F.min("priority").alias("priority")).select("name", "priority", (F.col("priority") == 1).alias("is_cbe"), supplier_key(F.col("name")).alias("supplier_key")).where("supplier_key IS NOT NULL")
    first = F.min(F.struct("priority", F.col("name").alias("supplier_name"), "is_cbe")).over(Window.partitionBy("supplier_key"))
    return rows.select("name", "supplier_key", first.alias("f")).select("name", entity_id(F.col("supplier_key")).alias("supplier_id"), "f.supplier_name", "supplier_key", "f.is_cbe", "f.priority")


def dim_supplier(certified: DataFrame, contracts: DataFrame, payments: DataFrame) -> DataFrame:
    """One supplier per normalized name: certified businesses first, then contract and payment names (smallest of each)."""
    return suppliers_of(supplier_names(certified, contracts, payments))


def suppliers_of(names: DataFrame) -> DataFrame:
    """The dimension's rows of a table of ``supplier_names``; who also loads facts stores that table and makes both from it."""
    return names.where(F.col("name") == F.col("supplier_name")).drop("name")


def dim_contract(contracts: DataFrame, fields: list[str], *tie: str) -> DataFrame:
    """One contract per number: its most complete record, title or else description, code lists (texts or arrays) as arrays, current from today on."""
    rows = most_complete(contracts.where("contract_number IS NOT NULL"), "contract_number", fields, *tie)
    have = set(rows.columns)
    text = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    lists = {n for n, t in rows.dtypes if t == "array<string>"}
    codes = lambda c: F.coalesce(F.col(c) if c in lists else code_list(text(c)), F.array().cast("array<string>")).alias(c)
    return rows.select(
        entity_id(F.col("contract_number").cast("string")).alias("contract_key"), "contract_number", F.coalesce(F.nullif(text("title"), F.lit("")), text("description")).alias("contract_title"), text("contract_type").alias("contract_type"),
        text("procurement_method").alias("procurement_method"), codes("nigp_codes"), codes("naics_codes"), text("agency_code").alias("agency_code"), text("agency_name").alias("agency_name"), F.lit(True).alias("is_current"),
    )


def dim_geography(properties: DataFrame, businesses: DataFrame, order: str) -> DataFrame:
    """One row per ward and zip: coordinates and neighborhood of the first property in ``order`` that has them, businesses last.

    Rows without ward and zip are left out; a ward that is a number gets its label, and only zips that begin with 20 stay.
    """
    given = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    pick = lambda df, rank, *more: df.select(given("ward").alias("ward"), given("zip_code").alias("zip_code"), "latitude", "longitude", *more, F.struct(F.lit(rank), F.col(order)).alias("o"))
    rows = pick(properties, 1, "neighborhood").unionByName(pick(businesses, 2), allowMissingColumns=True).where("ward IS NOT NULL OR zip_code IS NOT NULL")
    first = lambda c, by: F.min_by(F.col(c), F.when(F.col(by).isNotNull(), F.col("o"))).alias(c)
    out = rows.groupBy("ward", "zip_code").agg(first("latitude", "latitude"), first("longitude", "latitude"), first("neighborhood", "neighborhood"))
    short = F.substring("zip_code", 1, 5)
    return out.select(geography_key(F.col("ward"), F.col("zip_code")).alias("geography_key"), ward_label(F.col("ward")).alias("ward"), F.when(short.startswith("20"), short).alias("zip_code"), "latitude", "longitude", "neighborhood")


def geography_key(ward: Column, zip_code: Column) -> Column:
    return entity_id(F.concat_ws("_", F.coalesce(ward.cast("string"), F.lit("Unknown")), F.coalesce(zip_code, F.lit(""))))


def current_rows(dimension: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Rows that are current, or that were on ``as_of`` by their effective and expiration dates."""
    return dimension.where("is_current") if as_of is None else history.as_of(dimension, as_of)


#: What makes a version of a dimension's row.
SUPPLIER_VERSION = ("supplier_name", "is_cbe")
CONTRACT_VERSION = ("contract_title", "contract_type", "procurement_method", "nigp_codes", "naics_codes", "agency_code", "agency_name")


def load_dimension(dimension: DataFrame, path: str, key: str, tracked: tuple[str, ...], effective: Column, load: str) -> dict[str, int] | None:
    """Put a built dimension into its history below ``path``: rows that say something new open versions from the day ``effective``.

    The first load creates the history. See ``history.merge_history`` for what is read and written, and for late rows.
    """
    spark = dimension.sparkSession
    rows = dimension.select(key, *tracked, effective.cast("date").alias("effective_date"))
    if history.exists(spark, path):
        return history.merge_history(spark, path, rows, [key], list(tracked), load)
    history.create_history(rows, path, [key], list(tracked), load=load)
    return None


def fact_spend(payments: DataFrame, names: DataFrame, contracts: DataFrame) -> DataFrame:
    """One row a payment with a date: supplier and contract keys where known, fiscal parts, a name-based id.

    ``names`` is the table of ``supplier_names`` (or any with name and supplier_id): raw names are its keys, so none is
    normalized here.
    """
    known = contracts.select(F.col("contract_number").alias("contract_key")).distinct()
    d = F.col("payment_date")
    rows = payments.where(d.isNotNull()).join(names.select(F.col("name").alias("supplier_name"), "supplier_id"), "supplier_name", "left").join(known, F.col("contract_number") == F.col("contract_key"), "left")
    natural = F.concat_ws(":", F.lit("payments"), "contract_number", "line", "supplier_name", "payment_amount", "payment_date")
    return rows.select(
        uuid5(natural).alias("fact_id"), F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), "supplier_id", "contract_key", F.col("payment_amount").alias("spend_amount"), "agency_name",
        fiscal_year(d).alias("fiscal_year"), fiscal_quarter(d).alias("fiscal_quarter"), fiscal_month(d).alias("fiscal_month"), "payment_type",
    )


def load_facts(payments: DataFrame, names: DataFrame, contracts: DataFrame, path: str, mode: str = "overwrite") -> dict[str, int]:
    """Write ``fact_spend`` below ``path`` and count on the way: raw, no_date, transformed, no_supplier, no_contract.

    The counts are taken as rows pass by, so nothing is read twice. They are those of the write that succeeded.
    """
    raw, made = Observation("raw"), Observation("made")
    seen = payments.observe(raw, F.count(F.lit(1)).alias("raw"), F.count_if(F.col("payment_date").isNull()).alias("no_date"))
    facts = fact_spend(seen, names, contracts)
    facts = facts.observe(made, F.count(F.lit(1)).alias("transformed"), F.count_if(F.col("supplier_id").isNull()).alias("no_supplier"), F.count_if(F.col("contract_key").isNull()).alias("no_contract"))
    facts.write.mode(mode).parquet(path)
    return {**raw.get, **made.get}


def monthly_trend(payments: DataFrame) -> DataFrame:
    """Spend a month with the running total of its fiscal year."""
    d = F.col("payment_date")
    rows = payments.where(d.isNotNull()).groupBy(fiscal_year(d).alias("fiscal_year"), F.date_format(d, "yyyy-MM").alias("month")).agg(F.sum("payment_amount").cast(MONEY).alias("spend"), F.count(F.lit(1)).alias("payments"), F.count_distinct("supplier_name").alias("suppliers"))
    return rows.withColumn("running", F.sum("spend").over(Window.partitionBy("fiscal_year").orderBy("month")).cast(MONEY))


def category_share(payments: DataFrame) -> DataFrame:
    """Spend by category and fiscal year with its percent of the year."""
    rows = payments.groupBy(fiscal_year(F.col("payment_date")).alias("fiscal_year"), F.coalesce("payment_type", F.lit("Uncategorized")).alias("category")).agg(F.sum("payment_amount").cast(MONEY).alias("spend"))
    total = F.sum(F.col("spend").cast("double")).over(Window.partitionBy("fiscal_year"))
    return rows.withColumn("percent", F.round(F.try_divide(F.col("spend").cast("double") * 100, total), 4))


def supplier_performance(payments: DataFrame) -> DataFrame:
    rows = payments.groupBy("supplier_name").agg(F.sum("payment_amount").cast(MONEY).alias("spend"), F.count(F.lit(1)).alias("payments"), F.min("payment_date").alias("first_payment"), F.max("payment_date").alias("last_payment"))
    return rows.withColumn("tier", spend_tier(F.col("spend")))


def tier_totals(payments: DataFrame) -> DataFrame:
    return supplier_performance(payments).groupBy("tier").agg(F.count(F.lit(1)).alias("suppliers"), F.sum("spend").cast(MONEY).alias("spend"))


def cbe_split(payments: DataFrame, names: DataFrame) -> DataFrame:
    """Certified against other spend, with its share of the total; payments fold by raw name before they meet ``names``."""
    return cbe_split_of(payments.groupBy("supplier_name").agg(F.count(F.lit(1)).alias("n"), F.sum("payment_amount").alias("s")), names)


def cbe_split_of(sums: DataFrame, names: DataFrame) -> DataFrame:
    """``cbe_split`` of payments that are folded already: supplier_name, n, s, a name in any number of rows."""
    rows = sums.join(names.select(F.col("name").alias("supplier_name"), "is_cbe"), "supplier_name", "left")
    rows = rows.groupBy(F.coalesce("is_cbe", F.lit(False)).alias("is_cbe")).agg(F.sum("n").alias("payments"), F.sum("s").cast(MONEY).alias("spend"))
    return rows.withColumn("share", F.round(F.try_divide(F.col("spend").cast("double") * 100, F.sum(F.col("spend").cast("double")).over(Window.partitionBy())), 4))


def category_spend(facts: DataFrame, contracts: DataFrame) -> DataFrame:
    """Spend by code of the contract and fiscal year, its percent of the year and distinct contracts; without a code 'Uncategorized'.

    Facts fold by contract and year before the codes are unnested; a fact counts for each code as often as its contract
    lists it. ``contracts`` has one row a number, so a contract is told apart within its row: its first mention of a
    code counts, and no contract is held or shuffled by category.
    """
    sums = facts.groupBy("contract_number", "fiscal_year").agg(F.sum("spend_amount").cast(MONEY).alias("s"))
    none = F.lit("Uncategorized")
    codes = F.when(F.size("nigp_codes") > 0, F.transform("nigp_codes", lambda c: F.coalesce(c, none))).otherwise(F.array(none))
    rows = sums.join(contracts.select("contract_number", "nigp_codes"), "contract_number", "left").select("contract_number", "fiscal_year", "s", codes.alias("codes"))
    rows = rows.select("*", F.posexplode("codes").alias("at", "category"))
    first = F.col("contract_number").isNotNull() & (F.array_position("codes", F.col("category")) == F.col("at") + 1)
    out = rows.groupBy("category", "fiscal_year").agg(F.sum("s").cast(MONEY).alias("spend"), F.count_if(first).alias("contracts"))
    total = F.sum(F.col("spend").cast("double")).over(Window.partitionBy("fiscal_year"))
    return out.withColumn("percent", F.round(F.try_divide(F.col("spend").cast("double") * 100, total), 4))


def spend_by_ward(facts: DataFrame, geographies: DataFrame) -> DataFrame:
    """Spend, payments and distinct suppliers by ward and fiscal year; facts without a known place count as 'Unknown'."""
    rows = facts.join(geographies.select("geography_key", "ward"), "geography_key", "left")
    return rows.groupBy(F.coalesce("ward", F.lit("Unknown")).alias("ward"), "fiscal_year").agg(F.sum("spend_amount").cast(MONEY).alias("spend"), F.count(F.lit(1)).alias("payments"), F.count_distinct("supplier_id").alias("suppliers"))


def supplier_overview(suppliers: DataFrame, facts: DataFrame) -> DataFrame:
    """Every supplier with its spend and payments, those without any at 0."""
    sums = facts.groupBy("supplier_id").agg(F.sum("spend_amount").cast(MONEY).alias("s"), F.count(F.lit(1)).alias("n"))
    return suppliers.join(sums, "supplier_id", "left").select("supplier_id", "supplier_name", "is_cbe", F.coalesce("s", F.lit(0)).cast(MONEY).alias("spend"), F.coalesce("n", F.lit(0)).alias("payments"))


def supplier_activity(suppliers: DataFrame, facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Suppliers with facts on days of the date dimension: spend, first and last day, weekend spend, tier."""
    day = dates.select("date_key", "full_date", "is_weekend")
    rows = facts.join(day, "date_key").groupBy("supplier_id").agg(F.sum("spend_amount").cast(MONEY).alias("spend"), F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day"), F.coalesce(F.sum(F.when(F.col("is_weekend"), F.col("spend_amount"))), F.lit(0)).cast(MONEY).alias("weekend_spend"))
    return rows.join(suppliers.select("supplier_id", "supplier_name"), "supplier_id").withColumn("tier", spend_tier(F.col("spend")))


def spend_by_year(payments: DataFrame) -> DataFrame:
    """Spend a fiscal year, also in millions."""
    rows = payments.where("payment_date IS NOT NULL").groupBy(fiscal_year(F.col("payment_date")).alias("fiscal_year")).agg(F.sum("payment_amount").cast(MONEY).alias("spend"), F.count(F.lit(1)).alias("payments"))
    return rows.withColumn("millions", F.round(F.col("spend").cast("double") / 1e6, 2))


def last_months(trend: DataFrame, n: int = 12) -> DataFrame:
    """The newest ``n`` months of a monthly trend, in time order with their place."""
    return trend.orderBy(F.desc("month")).limit(n).withColumn("place", F.row_number().over(Window.orderBy("month")))


def kpi_views(payments: DataFrame, by_ward: DataFrame) -> DataFrame:
    """view, label, value, n: total spend, value by ward and spend by month as one long table."""
    total = payments.agg(F.sum("payment_amount").cast("double").alias("value"), F.count(F.lit(1)).alias("n")).select(F.lit("total_spend").alias("view"), F.lit("all").alias("label"), "value", "n")
    wards = by_ward.select(F.lit("ward_value").alias("view"), ward_label(F.col("ward").cast("string")).alias("label"), F.col("total_value").cast("double").alias("value"), F.col("property_count").alias("n"))
    months = payments.where("payment_date IS NOT NULL").groupBy(F.date_format("payment_date", "yyyy-MM").alias("label")).agg(F.sum("payment_amount").cast("double").alias("value"), F.count(F.lit(1)).alias("n")).select(F.lit("month_spend").alias("view"), "label", "value", "n")
    return total.unionByName(wards).unionByName(months)


def row_counts(**tables: DataFrame) -> DataFrame:
    """table, n: the rows of each table."""
    out = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, out)


def refresh_views(spark: SparkSession, views: dict, names: list[str] | None = None) -> list[str]:
    """Recompute named views (all or some) from their builders and register them; gives the names in order."""
    chosen = list(views) if names is None else [n for n in views if n in set(names)]
    for n in chosen:
        materialize(views[n](spark)).createOrReplaceTempView(n)
    return chosen


def kpi_summary(contracts: DataFrame, payments: DataFrame, names: DataFrame) -> DataFrame:
    """One row: contracts and their value, spend, distinct suppliers, average payment, percent of spend with certified suppliers."""
    c = contracts.agg(F.count(F.lit(1)).alias("contracts"), F.sum("contract_amount").cast(MONEY).alias("contract_value"))
    sums = payments.groupBy("supplier_name").agg(F.count("payment_amount").alias("n"), F.sum("payment_amount").cast(MONEY).alias("s"))
    rows = sums.join(names.select(F.col("name").alias("supplier_name"), "is_cbe"), "supplier_name", "left")
    spend = F.sum("s").cast("double")
    p = rows.agg(
        F.sum("s").cast(MONEY).alias("spend"), F.count("supplier_name").alias("suppliers"), F.round(F.try_divide(spend, F.sum("n")), 4).alias("avg_payment"),
        F.round(F.coalesce(F.try_divide(F.sum(F.when(F.col("is_cbe"), F.col("s"))).cast("double") * 100, spend), F.lit(0.0)), 4).alias("cbe_percent"),
    )
    return c.crossJoin(p)


def top_n(df: DataFrame, value: str, key: str, n: int) -> DataFrame:
    """The first n rows by value, nulls last, with their place."""
    best = df.orderBy(F.desc_nulls_last(value), key).limit(n)
    return best.withColumn("place", F.row_number().over(Window.orderBy(F.desc_nulls_last(value), key)))


def page(df: DataFrame, condition, order: list, offset: int, size: int) -> DataFrame:
    return df.where(condition).orderBy(*order).offset(offset).limit(size)


def measures(df: DataFrame, dimensions: list[str], named: dict[str, str]) -> DataFrame:
    """Semantic query: SQL measure expressions over any declared dimensions."""
    return df.groupBy(*dimensions).agg(*(F.expr(e).alias(n) for n, e in named.items()))
