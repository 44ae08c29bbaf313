"""Feature tables: winsorized, scaled and dated columns; ``as_of`` is the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclake.functions.scalars import log_or_null, property_type_flags
from civiclake.operators.order import index_percentile, percent_rank
from civiclake.sources.scratch import materialize


def ratio(a: Column, b: Column) -> Column:
    """a / b as doubles, 0 where b is 0 or missing."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def vendor_features(vendors: DataFrame, as_of: dt.date) -> DataFrame:
    """26 features of each vendor of the spend table.

    The table is stored once; the scales over all vendors are one-row tables of exact index percentiles.
    """
    now = F.lit(as_of)
    rows = vendors.withColumn("spend", (F.col("total_contract_value") + F.col("total_payments")).cast("double")).withColumn(
        "years", F.greatest(F.lit(1), F.coalesce(F.array_max("fiscal_years") - F.array_min("fiscal_years") + 1, F.lit(1)))
    )
    rows = materialize(rows.withColumn("per_year", ratio(F.col("contract_count"), F.col("years"))))
    p99 = index_percentile(rows.where("spend > 0"), [], "spend", (99,)).select(F.col("p99").alias("spend_p99"))
    c99 = index_percentile(rows.where("per_year > 0"), [], "per_year", (99,)).select(F.col("p99").alias("count_p99"))
    most = rows.agg(F.max("agency_count").alias("most_agencies"))
    # One row an agency: the codes are their places in order.
    codes = rows.select("top_agency").where("top_agency IS NOT NULL").distinct().withColumn("agency_code", F.row_number().over(Window.orderBy("top_agency")) - 1)
    tenure = F.greatest(F.lit(0), F.when(F.col("first_contract_date").isNull(), 0).otherwise(F.datediff(F.coalesce("last_payment_date", now), "first_contract_date")))
    months = lambda c: F.coalesce(F.floor(F.datediff(now, c) / 30), F.lit(0)).cast("int")
    since = F.datediff(now, "last_payment_date")
    wide = rows.crossJoin(F.broadcast(most)).join(F.broadcast(p99), how="left").join(F.broadcast(c99), how="left").join(codes, "top_agency", "left")
    return wide.select(
        "vendor_id", F.col("vendor_name").alias("supplier_name"), F.col("vendor_key").alias("supplier_name_normalized"), F.round("spend", 4).alias("total_lifetime_spend"), F.round(F.log1p("spend"), 6).alias("total_lifetime_spend_log"), "contract_count",
        F.round(ratio(F.col("agency_count"), F.col("contract_count")), 6).alias("agency_diversity"), F.round(ratio(F.col("total_contract_value"), F.col("contract_count")), 4).alias("avg_contract_size"),
        tenure.alias("tenure_days"), F.round(ratio(F.col("contract_count"), tenure / 365.25), 6).alias("contracts_per_year"), F.round(ratio(F.col("total_payments"), F.col("total_contract_value")), 6).alias("payment_to_contract_ratio"),
        F.col("is_cbe").cast("int").alias("is_cbe"), F.coalesce("agency_code", F.lit(0)).alias("primary_agency_encoded"), months("first_contract_date").alias("months_since_last_contract"), months("last_payment_date").alias("months_since_last_payment"),
        F.round(ratio(F.least("spend", "spend_p99"), F.col("spend_p99")), 6).alias("total_spend_normalized"), F.round(F.when(F.col("spend") > 0, F.log10(F.col("spend") + 1)).otherwise(0), 6).alias("log_total_spend"),
        F.round(ratio(F.least("per_year", "count_p99"), F.col("count_p99")), 6).alias("contract_frequency"), F.round(ratio(F.col("agency_count"), F.col("most_agencies")), 6).alias("agency_diversity_score"), F.round(tenure / 365.25, 6).alias("tenure_years"),
        F.least(F.coalesce(since, F.lit(3650)), F.lit(3650)).alias("recency_days"), (F.coalesce(since, F.lit(3650)) < 730).alias("is_active"), F.array_max("fiscal_years").alias("fiscal_year_latest"),
        F.col("total_contract_value").cast("double").alias("total_contract_value"), F.col("total_payments").cast("double").alias("total_payment_value"), "agency_count",
    )


def scaled(c: Column, low: Column, high: Column) -> Column:
    """``c`` held between ``low`` and ``high``, as a share of that span; 0 where there is none."""
    return F.when(c.isNotNull(), F.when(high > low, (F.least(F.greatest(c, low), high) - low) / (high - low)).otherwise(0.0))


def property_features(properties: DataFrame, by_ward: DataFrame, index: DataFrame, as_of: dt.date, regions: tuple[str, str] = ("Washington", "Washington, DC")) -> DataFrame:
    """40 features of each property, null in, null out.

    Ward statistics join on the ward; ``index`` (region_name, latest_value, yoy_change) gives one row, that of the
    first of ``regions`` that it has; scales are one-row tables of exact index percentiles over positive values.
    Columns that ``properties`` lacks are null.
    """
    have = set(properties.columns)
    kinds = {"property_id": "string", "source_record_id": "string", "ssl": "string", "sqft": "double", "bedrooms": "int", "bathrooms": "double", "year_built": "int", "lot_sqft": "double", "ward": "int", "latitude": "double", "longitude": "double", "property_type": "string", "assessed_value": "double", "price": "double", "sold_date": "date", "city": "string", "state": "string"}
    rows = properties.select(*((F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()))
    rows = materialize(rows.withColumn("pps", F.when(F.col("sqft") > 0, F.try_divide("price", "sqft"))))
    scale = lambda c, p, **n: index_percentile(rows.where(F.col(c) > 0), [], c, p).select(*(F.col(k).alias(v) for k, v in n.items()))
    wards = by_ward.select("ward", F.col("avg_value").alias("ward_avg_value"), F.col("median_value").alias("ward_median_value"), F.col("avg_price_per_sqft").alias("ward_pps"))
    place = F.when(F.col("region_name") == regions[0], 1).when(F.col("region_name") == regions[1], 2)
    one = index.where(place.isNotNull()).agg(F.min_by(F.struct("latest_value", "yoy_change"), place).alias("i")).select(F.col("i.latest_value").alias("zhvi_current"), F.col("i.yoy_change").alias("zhvi_yoy_change"))
    wide = rows.join(F.broadcast(scale("price", (1, 99), p1="lo", p99="hi")), how="left").join(F.broadcast(scale("pps", (1, 99), p1="pps_lo", p99="pps_hi")), how="left")
    wide = wide.join(F.broadcast(scale("sqft", (99,), p99="sqft_p99")), how="left").join(F.broadcast(scale("lot_sqft", (99,), p99="lot_p99")), how="left").crossJoin(F.broadcast(one)).join(wards, "ward", "left")
    price, sqft, sold = F.col("price"), F.col("sqft"), F.col("sold_date")
    age = F.when(F.col("year_built") > 1600, F.lit(as_of.year) - F.col("year_built"))
    since = F.least(F.datediff(F.lit(as_of), sold), F.lit(3650))
    flags = {n: F.coalesce(c, F.lit(0)).alias(n) for n, c in property_type_flags(F.col("property_type")).items()}
    return wide.select(
        "property_id", "source_record_id", "ssl", "sqft", F.round(log_or_null(sqft), 6).alias("sqft_log"), "bedrooms", "bathrooms", "year_built", age.alias("age_years"), "lot_sqft", F.when(F.col("ward").between(1, 8), F.col("ward")).alias("ward"),
        "ward_avg_value", "ward_median_value", "latitude", "longitude", F.col("zhvi_current").cast("double").alias("zhvi_current"), F.col("zhvi_yoy_change").cast("double").alias("zhvi_yoy_change"),
        F.round(F.try_divide("pps", F.col("ward_pps")), 4).alias("price_per_sqft_vs_ward"), F.round(F.try_divide(F.col("bedrooms") + F.col("bathrooms"), sqft) * 1000, 6).alias("rooms_per_sqft"), *flags.values(), "assessed_value",
        F.round(F.when(price > 0, scaled(price, F.col("lo"), F.col("hi"))), 6).alias("price_normalized"), F.round(F.when(price > 0, F.log10(price + 1)), 6).alias("log_price"), F.round(F.when(price != 0, scaled(F.col("pps"), F.col("pps_lo"), F.col("pps_hi"))), 6).alias("price_per_sqft_normalized"),
        F.round(F.when(sqft != 0, F.try_divide(F.least("sqft", "sqft_p99"), F.col("sqft_p99"))), 6).alias("sqft_normalized"), F.round(F.when(F.col("lot_sqft") != 0, F.try_divide(F.least("lot_sqft", "lot_p99"), F.col("lot_p99"))), 6).alias("lot_sqft_normalized"),
        F.least(age, F.lit(200)).alias("building_age"), F.when(F.col("bedrooms").isNotNull(), F.least("bedrooms", F.lit(10))).alias("bedrooms_capped"), F.when(F.col("bathrooms").isNotNull(), F.least("bathrooms", F.lit(10.0))).alias("bathrooms_capped"),
        F.month(sold).alias("sale_month"), F.year(sold).alias("sale_year"), F.quarter(sold).alias("sale_quarter"), F.when(sold.isNotNull(), since).alias("days_since_sale"), F.coalesce(F.when(sold.isNotNull(), since) < 730, F.lit(False)).alias("is_recent_sale"),
        F.when(F.col("ward").between(1, 8), F.col("ward")).otherwise(0).alias("ward_encoded"), "city", "state", "price",
    )


def recent_spend(payments: DataFrame, as_of: dt.date) -> DataFrame:
    """Spend of each supplier in the 12 and 6 months before ``as_of``, and the trend: slope of its monthly spend over those 12 months."""
    months = F.floor(F.months_between(F.trunc(F.lit(as_of), "month"), F.trunc("payment_date", "month"))).cast("int")
    rows = payments.where("payment_date IS NOT NULL").groupBy("supplier_name", months.alias("back")).agg(F.sum("payment_amount").cast("decimal(28,2)").alias("s")).where("back BETWEEN 1 AND 12")
    x, y, n = F.col("back").cast("double"), F.col("s").cast("double"), F.lit(12.0)
    # Months without a payment count as 0, so the sums over the time axis are fixed: 78 and 650 for 1..12.
    slope = -(n * F.sum(x * y) - 78.0 * F.sum(y)) / (n * 650.0 - 78.0 * 78.0)
    return rows.groupBy("supplier_name").agg(F.sum("s").cast("double").alias("spend_last_12m"), F.coalesce(F.sum(F.when(F.col("back") <= 6, F.col("s"))), F.lit(0)).cast("double").alias("spend_last_6m"), F.round(slope, 4).alias("spend_trend"))


def agency_cbe_spend(payments: DataFrame, names: DataFrame) -> DataFrame:
    """Per agency and fiscal year: spend with certified suppliers, its percent of all, and the supplier with most spend."""
    from civiclake.functions.scalars import fiscal_year

    sums = payments.where("payment_date IS NOT NULL").groupBy("agency_name", fiscal_year(F.col("payment_date")).alias("fiscal_year"), "supplier_name").agg(F.sum("payment_amount").cast("decimal(28,2)").alias("s"))
    rows = sums.join(names.select(F.col("name").alias("supplier_name"), "is_cbe"), "supplier_name", "left")
    cbe = F.coalesce(F.sum(F.when(F.col("is_cbe"), F.col("s"))), F.lit(0)).cast("double")
    return rows.groupBy("agency_name", "fiscal_year").agg(cbe.alias("cbe_spend"), F.round(F.coalesce(F.try_divide(cbe * 100, F.sum("s").cast("double")), F.lit(0.0)), 4).alias("cbe_spend_pct"), F.min_by("supplier_name", F.struct(-F.col("s"), "supplier_name")).alias("top_vendor"))


def ward_features(properties: DataFrame) -> DataFrame:
    """Place of a price within its ward (0 to 1, none for a null price), the ward's mean price per square foot, bedrooms against the ward's mean.

    No task holds a ward: see ``order.percent_rank``; the means are one row a ward.
    """
    rows = properties.where(F.col("ward").between(1, 8)).select("property_id", "ward", "price", "sqft", "bedrooms")
    pps = F.try_divide(F.col("price").cast("double"), F.col("sqft").cast("double"))
    means = rows.groupBy(F.col("ward").alias("its_ward")).agg(F.avg(pps).alias("pps"), F.avg("bedrooms").alias("beds"))
    wide = percent_rank(rows, ["ward"], "price", "place").join(means, F.col("ward") == F.col("its_ward"), "left")
    return wide.select(
        "property_id", "ward", F.round("place", 6).alias("ward_price_percentile"), F.round("pps", 4).alias("ward_avg_price_sqft"), F.round(F.try_divide(F.col("bedrooms").cast("double"), F.col("beds")), 4).alias("bedroom_ratio"),
    )


def features_of(features: DataFrame, key: str, ids: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame:
    """Feature store read: all entities or those of ``ids``, all columns or some of them with the key."""
    rows = features if ids is None else features.join(ids.select(key).distinct(), key, "left_semi")
    return rows if columns is None else rows.select(key, *(c for c in columns if c != key))


def feature_schema(features: DataFrame, descriptions: dict[str, str] | None = None) -> DataFrame:
    """column, type, description of a feature table; descriptions given here or as column metadata."""
    told = descriptions or {}
    rows = [(f.name, f.dataType.simpleString(), told.get(f.name, f.metadata.get("comment", ""))) for f in features.schema]
    return features.sparkSession.createDataFrame(rows, "column string, type string, description string")


def feature_sets(spark: SparkSession, base: str) -> DataFrame:
    """feature_set, column, type of the sets stored in the folders below ``base``; no folder gives no rows.

    Only folders and one schema a set are looked at, on whichever store they lie.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in fs.listStatus(root) if f.isDirectory()] if fs.exists(root) else []
    rows = [(p.getName(), f.name, f.dataType.simpleString()) for p in found if not p.getName().startswith(("_", ".")) for f in spark.read.parquet(p.toString()).schema]
    return spark.createDataFrame(rows, "feature_set string, column string, type string")


def dataset_metadata(df: DataFrame, name: str, as_of: dt.datetime) -> DataFrame:
    """One row: dataset, row count, field names, time."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("dataset"), "row_count", F.array(*map(F.lit, df.columns)).alias("fields"), F.lit(as_of).alias("computed_at"))


def agency_concentration(payments: DataFrame) -> DataFrame:
    """Herfindahl index of each vendor's spend over agencies."""
    sums = payments.groupBy("supplier_name", "agency_name").agg(F.sum("payment_amount").cast("double").alias("s"))
    share = F.try_divide("s", F.sum("s").over(Window.partitionBy("supplier_name")))
    return sums.withColumn("q", share * share).groupBy("supplier_name").agg(F.round(F.sum("q"), 6).alias("agency_concentration"), F.max_by("agency_name", F.struct("s", "agency_name")).alias("main_agency"))
