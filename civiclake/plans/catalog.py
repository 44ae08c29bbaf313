"""Registered queries of the engine's own operators, with DuckDB SQL for the same rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.functions import scalars as S
from civiclake.functions import sql as sql_functions
from civiclake.operators import dedup, features, gold, history, ingest, order, places, quality, text, validate, warehouse
from civiclake.plans import semantic
from civiclake.plans.bindings import duck, table, view
from civiclake.sources import io, keyed
from civiclake.sources.scratch import materialize, shared_folder
from civiclake.streaming import recent, stream

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
AS_OF = dt.date(2002, 1, 1)
#: Decimal columns of registered results; they leave as doubles, which both engines print alike.
MONEY = {
    "spend_by_vendor": "total_contract_value total_po_value total_payments",
    "agency_spend_summary": "total_contract_value total_po_value total_payments",
    "property_values_by_ward": "total_value min_value max_value p25 p75 p90",
    "agency_top_vendors": "spend",
    "fact_spend": "spend_amount",
    "monthly_spend_trend": "spend running",
    "spend_by_category": "spend",
    "supplier_performance": "spend",
    "vendor_tiers": "spend",
    "cbe_participation": "spend",
    "kpi_summary": "contract_value spend",
    "category_spend": "spend",
    "spend_by_ward": "spend",
    "spend_by_year": "spend",
    "stream_monthly_spend": "spend",
    "last_12_months": "spend running",
    "supplier_overview": "spend",
    "supplier_activity": "spend weekend_spend",
    "normalized_payments": "payment_amount",
    "normalized_orders": "amount_min amount_max fiscal_year",
    "normalized_sales": "price",
    "normalized_rentals": "rent_price floor",
    "normalized_listings": "price",
    "normalized_assessments": "property_tax ward land_area",
    "property_features": "ward sale_month sale_year sale_quarter days_since_sale",
    "union_sources": "length size",
    "first_with_url": "k",
    "inserted_if_absent": "slot",
    "top_suppliers": "spend",
    "contracts_page": "contract_amount",
    "semantic_measures": "total",
    "normalized_contracts": "contract_amount",
}
#: Columns of days that may be null; they leave as texts.
DAYS = {"normalized_contracts": "start_date end_date", "normalized_orders": "order_date", "normalized_sales": "sale_date", "normalized_rentals": "available_date"}


def query(sql: str | None = None, *views: str):
    """Register a query under its function's name, with its SQL over the named views."""

    def add(f):
        casts = {c: ("double", "DOUBLE") for c in MONEY.get(f.__name__, "").split()} | {c: ("string", "VARCHAR") for c in DAYS.get(f.__name__, "").split()}

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.withColumns({c: df[c].cast(t) for c, (t, _) in casts.items()}) if casts else df

        QUERIES[f.__name__] = run
        if sql:
            text_ = duck(sql, *views) if views else sql
            cast = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, (_, t) in casts.items())
            ORACLES[f.__name__] = f"SELECT * REPLACE ({cast}) FROM ({text_})" if casts else text_
        return f

    return add


def _key(c: str) -> str:
    """DuckDB: the vendor key of a name."""
    n = f"trim(lower({c}))"
    for s in S.GOLD_SUFFIXES:
        n = f"regexp_replace({n}, '{s}$', '')"
    return f"trim({n})"


def _supplier(c: str) -> str:
    cases = " ".join(f"WHEN ends_with(trim(upper({c})), '{s}') THEN left(trim(upper({c})), length(trim(upper({c}))) - {len(s)})" for s in S.SUPPLIER_SUFFIXES)
    return f"nullif(trim(CASE {cases} ELSE trim(upper({c})) END), '')"


def _fy(d: str) -> str:
    return f"CAST(year({d} + INTERVAL 3 MONTH) AS INTEGER)"


_VENDOR = ("contracts", "payments", "purchase_orders", "cbe_businesses")
_TAGGED = f"""!t AS (SELECT 'c' AS kind, supplier_name AS vendor, agency_name AS agency, CAST(contract_amount AS DECIMAL(28,2)) AS amount, start_date AS day FROM contracts
  UNION ALL SELECT 'o', supplier_name, agency_name, CAST(coalesce((amount_min + amount_max) * CAST(0.5 AS DECIMAL(2,1)), amount_min, amount_max, 0) AS DECIMAL(28,2)), NULL FROM purchase_orders
  UNION ALL SELECT 'p', supplier_name, agency_name, CAST(payment_amount AS DECIMAL(28,2)), payment_date FROM payments),
k AS (SELECT *, {_key('vendor')} AS vendor_key FROM t)
"""


def _vendors(spark: SparkSession, sf: str) -> DataFrame:
    return gold.spend_by_vendor(*(view(spark, sf, v) for v in ("contracts", "purchase_orders", "payments", "cbe_businesses")))


_VENDOR_CTE = _TAGGED + f""", g AS (SELECT vendor_key, CAST(coalesce(sum(amount) FILTER (kind = 'c' AND amount > 0), 0) AS DECIMAL(28,2)) AS total_contract_value,
  CAST(coalesce(sum(amount) FILTER (kind = 'o' AND amount > 0), 0) AS DECIMAL(28,2)) AS total_po_value, CAST(coalesce(sum(amount) FILTER (kind = 'p' AND amount > 0), 0) AS DECIMAL(28,2)) AS total_payments,
  count(*) FILTER (kind = 'c') AS contract_count, count(*) FILTER (kind = 'o') AS po_count, count(*) FILTER (kind = 'p') AS payment_count,
  count(DISTINCT agency) AS agency_count, string_agg(DISTINCT agency, '|' ORDER BY agency) AS agencies, min(agency) AS top_agency, min(day) FILTER (kind = 'c') AS first_contract_date, max(day) FILTER (kind = 'p') AS last_payment_date,
  list_sort(list_distinct(list(CASE WHEN kind = 'c' THEN {_fy('day')} END))) AS years FROM k GROUP BY vendor_key),
n AS (SELECT vendor_key, vendor, row_number() OVER (PARTITION BY vendor_key ORDER BY count(*) DESC, vendor) AS r FROM k WHERE kind = 'c' GROUP BY 1, 2),
v AS (SELECT left(md5(g.vendor_key), 16) AS vendor_id, coalesce(n.vendor, g.vendor_key) AS vendor_name, g.vendor_key, total_contract_value, total_po_value, total_payments, contract_count, po_count, payment_count,
  round(coalesce(CAST(total_contract_value AS DOUBLE) / nullif(contract_count, 0), 0), 4) AS average_contract, agency_count, agencies, top_agency, years, first_contract_date, last_payment_date,
  g.vendor_key IN (SELECT {_key('business_name')} FROM cbe_businesses) AS is_cbe, row_number() OVER (ORDER BY total_payments + total_contract_value DESC, g.vendor_key) AS spend_rank FROM g LEFT JOIN n ON n.vendor_key = g.vendor_key AND r = 1)
"""


@query(_VENDOR_CTE + "SELECT * EXCLUDE years, array_to_string(years, '|') AS fiscal_years FROM v", *_VENDOR)
def spend_by_vendor(spark, sf):
    return _vendors(spark, sf).withColumns({"agencies": F.array_join("agencies", "|"), "fiscal_years": F.array_join(F.col("fiscal_years").cast("array<string>"), "|")})


@query(_TAGGED + f""", a AS (SELECT *, lower(trim(agency)) AS agency_key FROM t WHERE agency IS NOT NULL),
m AS (SELECT agency_key, vendor, sum(amount) AS s, row_number() OVER (PARTITION BY agency_key ORDER BY sum(amount) DESC, vendor) AS r FROM a WHERE amount > 0 AND vendor IS NOT NULL GROUP BY 1, 2),
y AS (SELECT agency_key, {_fy('day')} AS y, CAST(sum(amount) AS DECIMAL(28,2)) AS s FROM a WHERE amount > 0 AND day IS NOT NULL GROUP BY 1, 2)
SELECT agency_key, min(agency) AS agency_name, CAST(coalesce(sum(amount) FILTER (kind = 'c' AND amount > 0), 0) AS DECIMAL(28,2)) AS total_contract_value,
  CAST(coalesce(sum(amount) FILTER (kind = 'o' AND amount > 0), 0) AS DECIMAL(28,2)) AS total_po_value, CAST(coalesce(sum(amount) FILTER (kind = 'p' AND amount > 0), 0) AS DECIMAL(28,2)) AS total_payments,
  count(*) FILTER (kind = 'c') AS contract_count, count(DISTINCT lower(trim(vendor))) FILTER (amount > 0) AS vendor_count,
  (SELECT string_agg(vendor || '=' || CAST(CAST(s AS DECIMAL(28,2)) AS VARCHAR), ';' ORDER BY r) FROM m WHERE m.agency_key = a.agency_key AND r <= 10) AS top_vendors, (SELECT string_agg(y || '=' || CAST(s AS VARCHAR), ';' ORDER BY y) FROM y WHERE y.agency_key = a.agency_key) AS spend_by_year
FROM a GROUP BY 1""", *_VENDOR[:3])
def agency_spend_summary(spark, sf):
    out = gold.agency_spend(*(view(spark, sf, v) for v in ("contracts", "purchase_orders", "payments")))
    pair = lambda c, a, b: F.array_join(F.transform(c, lambda x: F.concat(x[a].cast("string"), F.lit("="), x[b].cast("string"))), ";")
    return out.withColumns({"top_vendors": pair("top_vendors", "vendor", "spend"), "spend_by_year": pair("spend_by_year", "year", "spend")})


_PLACE = "list_extract(list_sort(list({0})), least(CAST(floor(count({0}) * {1} / 100) AS BIGINT), count({0}) - 1) + 1)"


@query(f"""SELECT ward, count(*) AS property_count, CAST(sum(price) AS DECIMAL(28,2)) AS total_value, round(avg(CAST(price AS DOUBLE)), 4) AS avg_value, quantile_cont(CAST(price AS DOUBLE), 0.5) AS median_value, min(price) AS min_value, max(price) AS max_value,
  round(avg(sqft), 4) AS avg_sqft, round(avg(year_built), 4) AS avg_year_built, round(avg(CAST(price AS DOUBLE)) / avg(sqft), 4) AS avg_price_per_sqft,
  {_PLACE.format('price', 25)} AS p25, {_PLACE.format('price', 75)} AS p75, {_PLACE.format('price', 90)} AS p90 FROM properties WHERE ward BETWEEN 1 AND 8 AND price > 0 GROUP BY ward""", "properties")
def property_values_by_ward(spark, sf):
    return gold.property_values_by_ward(view(spark, sf, "properties"))


@query("SELECT ward, coalesce(property_type, 'unknown') AS property_type, count(*) AS n FROM properties WHERE ward BETWEEN 1 AND 8 GROUP BY 1, 2", "properties")
def property_type_distribution(spark, sf):
    return gold.value_distribution(view(spark, sf, "properties").where("ward BETWEEN 1 AND 8"), "ward", "property_type")


@query("""!s AS (SELECT agency_name, supplier_name, CAST(sum(payment_amount) AS DECIMAL(28,2)) AS spend FROM payments GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY agency_name ORDER BY spend DESC, supplier_name) AS INTEGER) AS place FROM s) SELECT * FROM r WHERE place <= 10""", "payments")
def agency_top_vendors(spark, sf):
    return gold.top_vendors(view(spark, sf, "payments"))


@query("""!v AS (SELECT region_name, metric_date, metric_value, CASE left(metric_name, 1) WHEN '1' THEN 'Median Rent ' WHEN '2' THEN 'ZORI ' WHEN '3' THEN 'inventory ' ELSE '' END || metric_name AS metric_name, CAST(metric_value AS DOUBLE) AS v FROM market_stats), r AS (SELECT *, row_number() OVER b AS place, round((v - lag(v, 1) OVER s) / nullif(lag(v, 1) OVER s, 0) * 100, 2) AS m, round((v - lag(v, 11) OVER s) / nullif(lag(v, 11) OVER s, 0) * 100, 2) AS y
  FROM v WINDOW s AS (PARTITION BY region_name, metric_name ORDER BY metric_date, metric_value), b AS (PARTITION BY region_name, metric_name ORDER BY metric_date DESC, metric_value DESC))
SELECT region_name, metric_name, max(metric_date) FILTER (place = 1) AS latest_date, max(v) FILTER (place = 1) AS latest_value, max(m) FILTER (place = 1) AS mom_change, max(y) FILTER (place = 1) AS yoy_change, count(*) FILTER (place <= 24) AS points, string_agg(CAST(metric_date AS VARCHAR) || '=' || CAST(metric_value AS VARCHAR), ';' ORDER BY metric_date, metric_value) FILTER (place <= 24) AS history,
  CASE WHEN max(y) FILTER (place = 1) > 2 THEN 'up' WHEN max(y) FILTER (place = 1) < -2 THEN 'down' ELSE 'stable' END AS trend, CASE left(regexp_extract(metric_name, '[0-9]', 0), 1) WHEN '1' THEN 'rent' WHEN '2' THEN 'rent' WHEN '3' THEN 'inventory' ELSE 'sale' END AS category FROM r GROUP BY 1, 2""", "market_stats")
def market_trends(spark, sf):
    point = lambda x: F.concat(x["metric_date"].cast("string"), F.lit("="), x["metric_value"].cast("string"))
    kind = F.when(F.col("metric_name").startswith("1"), "Median Rent ").when(F.col("metric_name").startswith("2"), "ZORI ").when(F.col("metric_name").startswith("3"), "inventory ").otherwise("")
    stats = view(spark, sf, "market_stats").withColumn("metric_name", F.concat(kind, "metric_name"))
    return gold.market_trends(stats).withColumn("history", F.array_join(F.transform("history", point), ";"))


@query(f"SELECT n_name AS k, {_PLACE.format('c_acctbal', 50)} AS p50, {_PLACE.format('c_acctbal', 99)} AS p99 FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def index_percentiles(spark, sf):
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("k"), "c_acctbal")
    return order.index_percentile(rows, ["k"], "c_acctbal", (50, 99))


_DEDUP = "SELECT text, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text"


@query("SELECT doc_id, md5(text) AS digest FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1 OR text IS NULL")
def dedup_by_content(spark, sf):
    return dedup.dedup_by_hash(table(spark, sf, "documents").select("doc_id", F.md5("text").alias("digest")), "digest", "doc_id")


@query("""WITH e AS (SELECT user_id + event_id % 3 * 1000 AS user_id, ts FROM events) SELECT DISTINCT user_id FROM e WHERE ts >= TIMESTAMP '2024-01-20' AND NOT EXISTS (SELECT 1 FROM e o WHERE o.user_id = e.user_id AND o.ts < TIMESTAMP '2024-01-10' AND o.user_id < 2000)""")
def unseen_users(spark, sf):
    """Users of three groups; those of the third are not stored yet."""
    e = table(spark, sf, "events").withColumn("user_id", F.col("user_id") + F.col("event_id") % 3 * 1000)
    return dedup.not_seen(e.where("ts >= TIMESTAMP_NTZ '2024-01-20'"), e.where("ts < TIMESTAMP_NTZ '2024-01-10' AND user_id < 2000"), "user_id").select("user_id").distinct()


@query("""SELECT contract_number, supplier_name, line FROM (SELECT *, row_number() OVER (PARTITION BY contract_number ORDER BY (CASE WHEN pt IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN pa IS NOT NULL THEN 1 ELSE 0 END) DESC, line, supplier_name, payment_amount) AS r
  FROM (SELECT *, nullif(payment_type, 'N') AS pt, CASE WHEN line % 2 = 0 THEN payment_amount END AS pa FROM payments)) WHERE r = 1""", "payments")
def most_complete_record(spark, sf):
    rows = view(spark, sf, "payments").withColumn("pt", F.nullif("payment_type", F.lit("N"))).withColumn("pa", F.when(F.col("line") % 2 == 0, F.col("payment_amount")))
    return dedup.most_complete(rows, "contract_number", ["pt", "pa"], "line", "supplier_name", "payment_amount").select("contract_number", "supplier_name", "line")


_DIM = f"""u AS (SELECT DISTINCT business_name AS supplier_name, {_supplier('business_name')} AS supplier_key, true AS is_cbe, 1 AS priority FROM cbe_businesses
  UNION SELECT supplier_name, {_supplier('supplier_name')}, false, 2 FROM contracts UNION SELECT supplier_name, {_supplier('supplier_name')}, false, 3 FROM payments),
dim AS (SELECT left(md5(supplier_key), 16) AS supplier_id, supplier_name, supplier_key, is_cbe, priority FROM (SELECT *, row_number() OVER (PARTITION BY supplier_key ORDER BY priority, supplier_name) AS r FROM u WHERE supplier_key IS NOT NULL) WHERE r = 1)
"""


def _suppliers(spark, sf):
    return warehouse.suppliers_of(_names(spark, sf))


def _names(spark, sf):
    return warehouse.supplier_names(view(spark, sf, "cbe_businesses"), view(spark, sf, "contract_names"), view(spark, sf, "payment_sums"))


@query("!" + _DIM + "SELECT * FROM dim", "cbe_businesses", "contracts", "payments")
def dim_supplier(spark, sf):
    return _suppliers(spark, sf)


@query("""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(week(d) AS INTEGER) AS week,
  CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend, CAST(year(d + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_year, CAST(quarter(d + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_quarter, CAST(month(d + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_month
FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 DAY)) AS d FROM orders)""")
def dim_date(spark, sf):
    r = table(spark, sf, "orders").agg(F.min(F.trunc("o_orderdate", "month")), F.max(F.trunc("o_orderdate", "month"))).first()
    return warehouse.dim_date(spark, r[0], r[1])


@query("""WITH b AS (SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS lo, CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS hi FROM orders), d AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM b)
SELECT CAST(year(d + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_year, count(*) AS days, count(*) FILTER (isodow(d) >= 6) AS weekend_days, min(CAST(strftime(d, '%Y%m%d') AS INTEGER)) AS first_key, count(DISTINCT monthname(d)) AS months, max(CAST(make_date(CAST(year(d + INTERVAL 3 MONTH) AS INTEGER), 9, 30) AS DATE)) AS last_day FROM d GROUP BY 1""")
def dim_date_function(spark, sf):
    """The day table and the table of fiscal years, called from SQL over the orders' first and last month."""
    sql_functions.register(spark)
    r = table(spark, sf, "orders").agg(F.min(F.trunc("o_orderdate", "month")), F.max(F.trunc("o_orderdate", "month"))).first()
    return spark.sql("""SELECT d.fiscal_year, count(*) AS days, count_if(is_weekend) AS weekend_days, min(date_key) AS first_key, count(DISTINCT month_name) AS months, max(y.last_day) AS last_day
      FROM dim_date(DATE :lo, DATE :hi) d JOIN fiscal_years(1990, 2010) y ON y.fiscal_year = d.fiscal_year GROUP BY d.fiscal_year""".replace(":lo", f"'{r[0]}'").replace(":hi", f"'{r[1]}'"))


_FACT = _DIM + f""", h AS (SELECT *, sha1(unhex('{S.NAMESPACE_DNS}') || encode(concat_ws(':', 'payments', contract_number, line, supplier_name, payment_amount, payment_date))) AS h FROM payments WHERE payment_date IS NOT NULL),
fact AS (SELECT concat_ws('-', left(h, 8), substr(h, 9, 4), '5' || substr(h, 14, 3), substr('89ab', (strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1, 1) || substr(h, 18, 3), substr(h, 21, 12)) AS fact_id,
  CAST(strftime(payment_date, '%Y%m%d') AS INTEGER) AS date_key, supplier_id, contract_key, payment_amount AS spend_amount, agency_name, {_fy('payment_date')} AS fiscal_year, CAST(quarter(payment_date + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_quarter,
  CAST(month(payment_date + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_month, payment_type FROM h LEFT JOIN dim ON supplier_key = {_supplier('h.supplier_name')} LEFT JOIN (SELECT DISTINCT contract_number AS contract_key FROM contracts) c ON contract_key = h.contract_number)
"""


def _loaded(spark, sf):
    """Payments, contract numbers with their names, and supplier names, each stored, as facts and dimension read them several times."""
    payments, contracts = materialize(view(spark, sf, "payments").drop("quantity")), materialize(view(spark, sf, "contracts").select("contract_number", "supplier_name"))
    return payments, contracts, materialize(warehouse.supplier_names(view(spark, sf, "cbe_businesses"), contracts, payments))


def _facts(spark, sf):
    payments, contracts, names = _loaded(spark, sf)
    return warehouse.fact_spend(payments, names, contracts)


@query("!" + _FACT + "SELECT (SELECT count(*) FROM payments) AS raw, (SELECT count(*) FROM payments WHERE payment_date IS NULL) AS no_date, count(*) AS transformed, count(*) FILTER (supplier_id IS NULL) AS no_supplier, count(*) FILTER (contract_key IS NULL) AS no_contract FROM fact", "cbe_businesses", "contracts", "payments")
def fact_load(spark, sf):
    """What the load of the fact table counted while it wrote."""
    payments, contracts, names = _loaded(spark, sf)
    counts = warehouse.load_facts(payments, names, contracts, shared_folder(spark))
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{n} long" for n in counts))


@query("!" + _FACT + "SELECT * FROM fact", "cbe_businesses", "contracts", "payments")
def fact_spend(spark, sf):
    return _facts(spark, sf)


@query(f"""!s AS (SELECT {_fy('payment_date')} AS fiscal_year, strftime(payment_date, '%Y-%m') AS month, CAST(sum(payment_amount) AS DECIMAL(28,2)) AS spend, count(*) AS payments, count(DISTINCT supplier_name) AS suppliers FROM payments WHERE payment_date IS NOT NULL GROUP BY 1, 2)
SELECT *, CAST(sum(spend) OVER (PARTITION BY fiscal_year ORDER BY month) AS DECIMAL(28,2)) AS running FROM s""", "payments")
def monthly_spend_trend(spark, sf):
    return warehouse.monthly_trend(view(spark, sf, "payments"))


@query(f"""!s AS (SELECT {_fy('payment_date')} AS fiscal_year, coalesce(payment_type, 'Uncategorized') AS category, CAST(sum(payment_amount) AS DECIMAL(28,2)) AS spend FROM payments GROUP BY 1, 2)
SELECT *, round(CAST(spend AS DOUBLE) * 100 / sum(CAST(spend AS DOUBLE)) OVER (PARTITION BY fiscal_year), 4) AS percent FROM s""", "payments")
def spend_by_category(spark, sf):
    return warehouse.category_share(view(spark, sf, "payments"))


_PERF = "p AS (SELECT supplier_name, CAST(sum(payment_amount) AS DECIMAL(28,2)) AS spend, count(*) AS payments, min(payment_date) AS first_payment, max(payment_date) AS last_payment FROM payments GROUP BY 1), q AS (SELECT *, CASE WHEN spend >= 10000000 THEN 'Enterprise' WHEN spend >= 1000000 THEN 'Large' WHEN spend >= 100000 THEN 'Medium' ELSE 'Small' END AS tier FROM p) "


@query("!" + _PERF + "SELECT * FROM q", "payments")
def supplier_performance(spark, sf):
    return warehouse.supplier_performance(view(spark, sf, "payments"))


@query("!" + _PERF + "SELECT tier, count(*) AS suppliers, CAST(sum(spend) AS DECIMAL(28,2)) AS spend FROM q GROUP BY tier", "payments")
def vendor_tiers(spark, sf):
    return warehouse.tier_totals(view(spark, sf, "payments"))


@query("!" + _DIM + f", s AS (SELECT coalesce(is_cbe, false) AS is_cbe, count(*) AS payments, CAST(sum(payment_amount) AS DECIMAL(28,2)) AS spend FROM payments LEFT JOIN dim ON supplier_key = {_supplier('payments.supplier_name')} GROUP BY 1) SELECT *, round(CAST(spend AS DOUBLE) * 100 / sum(CAST(spend AS DOUBLE)) OVER (), 4) AS share FROM s", "cbe_businesses", "contracts", "payments")
def cbe_participation(spark, sf):
    """Payments fold by supplier once, for the sums and for the names."""
    sums = materialize(view(spark, sf, "payment_sums"))
    return warehouse.cbe_split_of(sums, warehouse.supplier_names(view(spark, sf, "cbe_businesses"), view(spark, sf, "contract_names"), sums))


@query("!" + _DIM + f", p AS (SELECT payments.*, is_cbe FROM payments LEFT JOIN dim ON supplier_key = {_supplier('payments.supplier_name')}) SELECT (SELECT count(*) FROM contracts) AS contracts, (SELECT CAST(sum(contract_amount) AS DECIMAL(28,2)) FROM contracts) AS contract_value, CAST(sum(payment_amount) AS DECIMAL(28,2)) AS spend, count(DISTINCT supplier_name) AS suppliers, round(CAST(sum(payment_amount) AS DOUBLE) / count(payment_amount), 4) AS avg_payment, round(coalesce(CAST(sum(payment_amount) FILTER (is_cbe) AS DOUBLE) * 100 / CAST(sum(payment_amount) AS DOUBLE), 0), 4) AS cbe_percent FROM p", "cbe_businesses", "contracts", "payments")
def kpi_summary(spark, sf):
    return warehouse.kpi_summary(view(spark, sf, "contracts"), view(spark, sf, "payments"), _names(spark, sf))


@query("!" + _PERF + "SELECT supplier_name, spend, CAST(row_number() OVER (ORDER BY spend DESC NULLS LAST, supplier_name) AS INTEGER) AS place FROM q ORDER BY place LIMIT 10", "payments")
def top_suppliers(spark, sf):
    return warehouse.top_n(warehouse.supplier_performance(view(spark, sf, "payments")).select("supplier_name", "spend"), "spend", "supplier_name", 10)


@query("SELECT contract_number, supplier_name, contract_amount FROM contracts WHERE status = 'O' ORDER BY contract_amount DESC, contract_number LIMIT 25 OFFSET 50", "contracts")
def contracts_page(spark, sf):
    return warehouse.page(view(spark, sf, "contracts"), "status = 'O'", [F.desc("contract_amount"), "contract_number"], 50, 25).select("contract_number", "supplier_name", "contract_amount")


@query("SELECT agency_name, payment_type, CAST(sum(payment_amount) AS DECIMAL(28,2)) AS total, count(DISTINCT supplier_name) AS suppliers, round(CAST(sum(payment_amount) AS DOUBLE) / count(payment_amount), 4) AS mean, quantile_cont(CAST(payment_amount AS DOUBLE), 0.5) AS median FROM payments GROUP BY 1, 2", "payments")
def semantic_measures(spark, sf):
    m = semantic.Measure
    figures = {"total": m("sum", "payment_amount"), "suppliers": m("count_distinct", "supplier_name"), "mean": m("average", "payment_amount"), "median": m("median", "payment_amount")}
    model = semantic.Model("payments", "payments", {d: ("payments", d) for d in ("agency_name", "payment_type")}, figures)
    return model.query({"payments": view(spark, sf, "payments")}, list(figures), list(model.dimensions))


_DAY = f"DATE '{AS_OF}'"
_RATIO = "coalesce(CAST({0} AS DOUBLE) / nullif(CAST({1} AS DOUBLE), 0), 0)"


def _share(c: str, p: int, source: str) -> str:
    """DuckDB: the index percentile of the positive values of a column."""
    return f"(SELECT {_PLACE.format(c, p)} FROM {source} WHERE {c} > 0)"


@query(_VENDOR_CTE + f""", w AS (SELECT *, CAST(total_contract_value + total_payments AS DOUBLE) AS spend, greatest(1, coalesce(list_max(years) - list_min(years) + 1, 1)) AS n_years FROM v),
x AS (SELECT *, {_RATIO.format('contract_count', 'n_years')} AS per_year, greatest(0, CASE WHEN first_contract_date IS NULL THEN 0 ELSE date_diff('day', first_contract_date, coalesce(last_payment_date, {_DAY})) END) AS tenure, date_diff('day', last_payment_date, {_DAY}) AS since FROM w),
y AS (SELECT {_share('spend', 99, 'x')} AS spend_p99, {_share('per_year', 99, 'x')} AS count_p99, (SELECT max(agency_count) FROM x) AS most),
c AS (SELECT top_agency, row_number() OVER (ORDER BY top_agency) - 1 AS code FROM (SELECT DISTINCT top_agency FROM x WHERE top_agency IS NOT NULL))
SELECT vendor_id, vendor_name AS supplier_name, vendor_key AS supplier_name_normalized, round(spend, 4) AS total_lifetime_spend, round(ln(1 + spend), 6) AS total_lifetime_spend_log, contract_count, round({_RATIO.format('agency_count', 'contract_count')}, 6) AS agency_diversity,
  round({_RATIO.format('total_contract_value', 'contract_count')}, 4) AS avg_contract_size, CAST(tenure AS INTEGER) AS tenure_days, round({_RATIO.format('contract_count', 'tenure / 365.25')}, 6) AS contracts_per_year, round({_RATIO.format('total_payments', 'total_contract_value')}, 6) AS payment_to_contract_ratio,
  CAST(is_cbe AS INTEGER) AS is_cbe, CAST(coalesce(code, 0) AS INTEGER) AS primary_agency_encoded, CAST(coalesce(floor(date_diff('day', first_contract_date, {_DAY}) / 30.0), 0) AS INTEGER) AS months_since_last_contract, CAST(coalesce(floor(since / 30.0), 0) AS INTEGER) AS months_since_last_payment,
  round({_RATIO.format('least(spend, spend_p99)', 'spend_p99')}, 6) AS total_spend_normalized, round(CASE WHEN spend > 0 THEN log10(spend + 1) ELSE 0 END, 6) AS log_total_spend, round({_RATIO.format('least(per_year, count_p99)', 'count_p99')}, 6) AS contract_frequency, round({_RATIO.format('agency_count', 'most')}, 6) AS agency_diversity_score,
  round(tenure / 365.25, 6) AS tenure_years, CAST(least(coalesce(since, 3650), 3650) AS INTEGER) AS recency_days, coalesce(since, 3650) < 730 AS is_active, list_max(years) AS fiscal_year_latest, CAST(total_contract_value AS DOUBLE) AS total_contract_value, CAST(total_payments AS DOUBLE) AS total_payment_value, agency_count
FROM x CROSS JOIN y LEFT JOIN c ON c.top_agency = x.top_agency""", *_VENDOR)
def vendor_features(spark, sf):
    return features.vendor_features(_vendors(spark, sf), AS_OF)


_WARD_SQL = "SELECT ward, avg(CAST(price AS DOUBLE)) AS a, quantile_cont(CAST(price AS DOUBLE), 0.5) AS m, round(avg(CAST(price AS DOUBLE)) / avg(sqft), 4) AS pps FROM properties WHERE ward BETWEEN 1 AND 8 AND price > 0 GROUP BY ward"
_SCALED = "CASE WHEN {0} IS NOT NULL THEN CASE WHEN {2} > {1} THEN (least(greatest({0}, {1}), {2}) - {1}) / ({2} - {1}) ELSE 0 END END"


@query(f"""!p AS (SELECT CAST(property_id AS VARCHAR) AS property_id, source_record_id, ssl, CAST(sqft AS DOUBLE) AS sqft, bedrooms, CAST(bathrooms AS DOUBLE) AS bathrooms, year_built, lot_sqft, ward, latitude, longitude,
  lower(property_type) AS kind, assessed_value, CAST(price AS DOUBLE) AS price, sold_date, city, state, CAST(price AS DOUBLE) / nullif(CAST(sqft AS DOUBLE), 0) AS pps FROM properties),
w AS ({_WARD_SQL}), i AS (SELECT max(v) FILTER (r = 1) AS v, max(y) FILTER (r = 1) AS y FROM (SELECT v, round((v - lag(v, 11) OVER b) / nullif(lag(v, 11) OVER b, 0) * 100, 2) AS y, row_number() OVER (ORDER BY metric_date DESC, metric_value DESC) AS r
  FROM (SELECT *, CAST(metric_value AS DOUBLE) AS v FROM market_stats WHERE region_name = 'CHINA' AND metric_name = '1-URGENT') WINDOW b AS (ORDER BY metric_date, metric_value))),
z AS (SELECT {_share('price', 1, 'p')} AS lo, {_share('price', 99, 'p')} AS hi, {_share('pps', 1, 'p')} AS pps_lo, {_share('pps', 99, 'p')} AS pps_hi, {_share('sqft', 99, 'p')} AS sqft_p99, {_share('lot_sqft', 99, 'p')} AS lot_p99)
SELECT property_id, source_record_id, ssl, sqft, round(CASE WHEN sqft > 0 THEN ln(sqft) END, 6) AS sqft_log, bedrooms, bathrooms, year_built, CASE WHEN year_built > 1600 THEN {AS_OF.year} - year_built END AS age_years, lot_sqft, CASE WHEN p.ward BETWEEN 1 AND 8 THEN p.ward END AS ward,
  round(w.a, 4) AS ward_avg_value, w.m AS ward_median_value, latitude, longitude, CAST(i.v AS DOUBLE) AS zhvi_current, i.y AS zhvi_yoy_change, round(p.pps / nullif(w.pps, 0), 4) AS price_per_sqft_vs_ward, round((bedrooms + bathrooms) / nullif(sqft, 0) * 1000, 6) AS rooms_per_sqft,
  CAST(contains(kind, 'single') OR contains(kind, 'sfr') AS INTEGER) AS is_single_family, CAST(contains(kind, 'condo') AS INTEGER) AS is_condo, CAST(contains(kind, 'town') AS INTEGER) AS is_townhouse, assessed_value,
  round(CASE WHEN price > 0 THEN {_SCALED.format('price', 'lo', 'hi')} END, 6) AS price_normalized, round(CASE WHEN price > 0 THEN log10(price + 1) END, 6) AS log_price, round(CASE WHEN price <> 0 THEN {_SCALED.format('p.pps', 'pps_lo', 'pps_hi')} END, 6) AS price_per_sqft_normalized,
  round(CASE WHEN sqft <> 0 THEN least(sqft, sqft_p99) / nullif(sqft_p99, 0) END, 6) AS sqft_normalized, round(CASE WHEN lot_sqft <> 0 THEN least(lot_sqft, lot_p99) / nullif(lot_p99, 0) END, 6) AS lot_sqft_normalized, CASE WHEN year_built > 1600 THEN least({AS_OF.year} - year_built, 200) END AS building_age,
  least(bedrooms, 10) AS bedrooms_capped, least(bathrooms, 10.0) AS bathrooms_capped, CAST(month(sold_date) AS INTEGER) AS sale_month, CAST(year(sold_date) AS INTEGER) AS sale_year, CAST(quarter(sold_date) AS INTEGER) AS sale_quarter, CAST(CASE WHEN sold_date IS NOT NULL THEN least(date_diff('day', sold_date, {_DAY}), 3650) END AS INTEGER) AS days_since_sale,
  coalesce(least(date_diff('day', sold_date, {_DAY}), 3650) < 730 AND sold_date IS NOT NULL, false) AS is_recent_sale, CASE WHEN p.ward BETWEEN 1 AND 8 THEN p.ward ELSE 0 END AS ward_encoded, city, state, price
FROM p CROSS JOIN z CROSS JOIN i LEFT JOIN w ON w.ward = p.ward""", "properties", "market_stats")
def property_features(spark, sf):
    p = view(spark, sf, "properties")
    index = gold.market_trends(view(spark, sf, "market_stats").where("metric_name = '1-URGENT'"))
    return features.property_features(p, gold.property_values_by_ward(p), index, AS_OF, ("CHINA", "INDIA"))


@query("""SELECT property_id, ward, round(percent_rank() OVER (PARTITION BY ward ORDER BY price), 6) AS ward_price_percentile, round(avg(CAST(price AS DOUBLE) / nullif(CAST(sqft AS DOUBLE), 0)) OVER (PARTITION BY ward), 4) AS ward_avg_price_sqft,
  round(CAST(bedrooms AS DOUBLE) / nullif(avg(bedrooms) OVER (PARTITION BY ward), 0), 4) AS bedroom_ratio FROM properties WHERE ward BETWEEN 1 AND 8""", "properties")
def ward_price_percentile(spark, sf):
    return features.ward_features(view(spark, sf, "properties"))


@query("""!s AS (SELECT supplier_name, agency_name, CAST(sum(payment_amount) AS DOUBLE) AS s FROM payments GROUP BY 1, 2), q AS (SELECT *, s / sum(s) OVER (PARTITION BY supplier_name) AS h FROM s)
SELECT supplier_name, round(sum(h * h), 6) AS agency_concentration, max_by(agency_name, struct_pack(s := s, a := agency_name)) AS main_agency FROM q GROUP BY 1""", "payments")
def agency_concentration(spark, sf):
    return features.agency_concentration(view(spark, sf, "payments"))


@query("SELECT 'labels' AS dataset, c AS column, n, n - k AS nulls, round((n - k) / n, 6) AS rate FROM (SELECT unnest(['doc_id', 'quality', 'toxic']) AS c, count(*) AS n, unnest([count(doc_id), count(quality), count(toxic)]) AS k FROM labels)")
def null_rates(spark, sf):
    return quality.null_rates(table(spark, sf, "labels"), "labels")


_COLUMNS = {"documents": "doc_id text lang source n_chars", "events": "event_id ts user_id event_type value props", "labels": "doc_id quality toxic", "pages": "page_id url html"}


def _rates(table_: str) -> str:
    """DuckDB: the null rates of a table."""
    c = _COLUMNS[table_].split()
    return f"SELECT '{table_}' AS dataset, n, round(coalesce(k / nullif(n, 0), 0), 6) AS rate FROM (SELECT count(*) AS n, unnest([{', '.join(f'count(*) - count({x})' for x in c)}]) AS k FROM {table_})"


_LAYER = "WITH r AS (" + " UNION ALL ".join(map(_rates, _COLUMNS)) + "), q AS (SELECT dataset, max(n) AS rows, count(*) AS columns, round(avg(rate), 6) AS avg_null_rate, max(rate) AS max_null_rate, count(*) FILTER (rate >= 0.5) AS high_null, round(greatest(0, 1 - 0.5 * avg(rate) - 0.3 * avg(CAST(rate >= 0.5 AS DOUBLE)) - CASE WHEN max(n) = 0 THEN 0.2 ELSE 0 END), 6) AS score FROM r GROUP BY 1)"


@query(_LAYER + " SELECT dataset, score FROM q")
def quality_score(spark, sf):
    rates = [quality.null_rates(table(spark, sf, n), n) for n in _COLUMNS]
    return quality.quality_score(reduce(DataFrame.unionByName, rates))


@query(_LAYER + " SELECT * FROM q UNION ALL SELECT 'all', CAST(sum(rows) AS BIGINT), CAST(sum(columns) AS BIGINT), round(avg(avg_null_rate), 6), max(max_null_rate), CAST(sum(high_null) AS BIGINT), round(avg(score), 6) FROM q")
def layer_report(spark, sf):
    return quality.layer_report({n: table(spark, sf, n) for n in _COLUMNS})


_SLAS = {"documents": {"required_columns": ["doc_id", "text"], "min_row_count": 100, "max_null_rate": 0.2}, "events": {"required_columns": ["event_id", "source"], "min_row_count": 10_000_000}, "labels": {"required_columns": ["doc_id"]}, "pages": {}}


def _sla_sql() -> str:
    out = []
    for n, c in _COLUMNS.items():
        sla, c = _SLAS[n], c.split()
        missing = len(set(sla.get("required_columns", ())) - set(c))
        least, most = sla.get("min_row_count", 1), sla.get("max_null_rate", 1.0)
        rate = "(" + " + ".join(f"count(*) - count({x})" for x in c) + f") / (count(*) * {len(c)})"
        out += [f"SELECT '{n}' AS dataset, {missing} AS failures FROM {n} GROUP BY 1", f"SELECT '{n}', greatest(0, {least} - count(*)) FROM {n}", f"SELECT '{n}', CASE WHEN {rate} > {most} THEN 1 ELSE 0 END FROM {n}"]
    return " UNION ALL ".join(out)


@query(f"WITH c AS ({_sla_sql()}), e AS (SELECT dataset, count(*) AS checks, count(*) FILTER (failures > 0) AS failed, count(*) FILTER (failures > 0) = 0 AS passed FROM c GROUP BY 1) SELECT * FROM e UNION ALL SELECT 'all', CAST(sum(checks) AS BIGINT), CAST(sum(failed) AS BIGINT), bool_and(passed) FROM e")
def layer_validation(spark, sf):
    checks = [quality.check_sla(table(spark, sf, n), n, _SLAS[n]) for n in _COLUMNS]
    return quality.validate_layer(reduce(DataFrame.unionByName, checks), strict=True)


@query("""SELECT 'nulls' AS check, unnest(['event_id', 'event_type', 'value']) AS column, unnest([count(*) - count(event_id), count(*) - count(event_type), count(*) - count(value)]) AS failures, unnest([count(*) = count(event_id), (count(*) - count(event_type)) / count(*) <= 0.3, (count(*) - count(value)) / count(*) <= 0.3]) AS passed FROM events
UNION ALL SELECT 'type', 'props', count(*) FILTER (props IS NOT NULL AND TRY_CAST(props AS BIGINT) IS NULL), count(*) FILTER (props IS NOT NULL AND TRY_CAST(props AS BIGINT) IS NULL) = 0 FROM events
UNION ALL SELECT 'nulls', 'props', count(*) - count(props), (count(*) - count(props)) / count(*) <= 0.3 FROM events
UNION ALL SELECT 'pattern', 'event_type', count(*) FILTER (NOT regexp_matches(event_type, '^[a-z_]+$')), count(*) FILTER (NOT regexp_matches(event_type, '^[a-z_]+$')) = 0 FROM events
UNION ALL SELECT 'min', 'value', count(*) FILTER (value < 10), count(*) FILTER (value < 10) = 0 FROM events
UNION ALL SELECT 'min_rows', '', greatest(0, 100 - count(*)), count(*) >= 100 FROM events
UNION ALL SELECT 'primary_key', 'event_id', count(*) - count(DISTINCT event_id), count(*) = count(DISTINCT event_id) FROM events
UNION ALL SELECT 'duplicates', '', n - d, (n - d) / n <= 0 FROM (SELECT (SELECT count(*) FROM events) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM events)) AS d)
UNION ALL SELECT 'missing', 'ward', 1, false UNION ALL SELECT 'extra', unnest(['ts', 'user_id']), 1, true""")
def contract_check(spark, sf):
    contract = {"columns": {"event_id": {"nullable": False, "primary_key": True}, "event_type": {"pattern": "^[a-z_]+$"}, "value": {"min": 10.0}, "props": {"type": "bigint"}, "ward": {}}, "min_rows": 100, "max_null_rate": 0.3, "max_duplicate_rate": 0.0}
    return quality.check_contract(table(spark, sf, "events"), contract)


@query(f"""WITH r AS (SELECT event_type AS source, value >= 10 AS ok, value FROM events), g AS (SELECT source, count(*) AS processed, count(*) FILTER (NOT ok) AS quarantined, round(sum(value), 4) AS seconds, {_PLACE.format('value', 95)} AS latency_p95 FROM r GROUP BY 1)
SELECT *, round((processed - quarantined) * 100.0 / processed, 2) AS success_rate, round(quarantined * 100.0 / processed, 2) AS quarantine_rate FROM g""")
def source_health(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("source"), (F.col("value") >= 10).alias("ok"), F.col("value").alias("latency"))
    return quality.health(e)


@query("""WITH g AS (SELECT event_type, count(*) AS n, count(*) FILTER (NOT value >= 10) AS q FROM events GROUP BY 1)
SELECT count(*) AS sources_run, count(*) FILTER (round((n - q) * 100.0 / n, 2) > 70) AS sources_succeeded, count(*) FILTER (NOT round((n - q) * 100.0 / n, 2) > 70) AS sources_failed, CAST(sum(n) AS BIGINT) AS processed, CAST(sum(q) AS BIGINT) AS quarantined, round((sum(n) - sum(q)) * 100.0 / sum(n), 2) AS success_rate FROM g""")
def health_summary(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("source"), (F.col("value") >= 10).alias("ok"), F.col("value").alias("latency"))
    return quality.health_summary(quality.health(e), 70.0)


@query("""WITH r AS (SELECT event_type AS source, user_id % 5 AS k FROM events), g AS (SELECT source, count(*) AS discovered, count(*) FILTER (k >= 1) AS fetched, count(*) FILTER (k >= 2) AS parsed, count(*) FILTER (k >= 3) AS valid, count(*) FILTER (k >= 4) AS written FROM r GROUP BY 1)
SELECT *, round(written / discovered, 6) AS success_rate, round(1 - round(written / discovered, 6), 6) AS error_rate FROM g""")
def run_counts(spark, sf):
    steps = F.array(*map(F.lit, quality.STEPS))
    return quality.run_counts(table(spark, sf, "events").select(F.col("event_type").alias("source"), F.element_at(steps, (F.col("user_id") % 5 + 1).cast("int")).alias("reached")), "source", "reached")


@query("SELECT event_type, count(*) AS seen, count(*) FILTER (NOT (value >= 10)) AS failed, round(avg(CAST(value >= 10 AS DOUBLE)), 6) AS success_rate FROM events GROUP BY 1")
def run_report(spark, sf):
    return quality.run_report(table(spark, sf, "events").withColumn("ok", F.col("value") >= 10), "event_type", "ok")


_RAW = "SELECT o_orderkey AS CONTRACT_NUMBER, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS AGENCY_NAME, CAST(NULL AS VARCHAR) AS AGENCY, CASE WHEN o_orderkey % 7 = 0 THEN 'n/a?' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS CONTRACTAMOUNT, CASE WHEN o_orderkey % 13 = 0 THEN 1066 ELSE 2020 END AS FISCALYEAR, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS BUYER, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS STARTDATE, concat(' A', o_orderkey, ';;', o_orderstatus, ' ') AS NIGP_CODES FROM orders"


def _raw(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("CONTRACT_NUMBER"), F.when(k % 11 == 0, None).otherwise(F.col("o_orderpriority")).alias("AGENCY_NAME"), F.lit(None).cast("string").alias("AGENCY"), F.when(k % 7 == 0, "n/a?").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("CONTRACTAMOUNT"),
        F.when(k % 13 == 0, 1066).otherwise(2020).alias("FISCALYEAR"), F.when(k % 2 == 0, F.col("o_orderstatus")).alias("BUYER"), F.col("o_orderdate").cast("date").cast("string").alias("STARTDATE"), F.concat(F.lit(" A"), k.cast("string"), F.lit(";;"), "o_orderstatus", F.lit(" ")).alias("NIGP_CODES"),
    )


@query(f"""WITH r AS ({_RAW}) SELECT m AS message, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN AGENCY_NAME IS NULL THEN 'missing AGENCY_NAME or AGENCY' END, CASE WHEN CONTRACTAMOUNT = 'n/a?' THEN 'CONTRACTAMOUNT is not a number: n/a?' END, CASE WHEN FISCALYEAR = 1066 THEN 'FISCALYEAR is out of range' END], lambda x: x IS NOT NULL)) AS m FROM r) GROUP BY 1""")
def validation_errors(spark, sf):
    raw = _raw(spark, sf)
    return validate.validated(raw, validate.rules_for("contracts", raw.columns)).select(F.explode("validation_errors").alias("message")).groupBy("message").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH r AS ({_RAW}) SELECT 'contracts' AS source, 'validation_error' AS error_type, count(*) AS n FROM r WHERE AGENCY_NAME IS NULL OR CONTRACTAMOUNT = 'n/a?' OR FISCALYEAR = 1066")
def quarantine_summary(spark, sf):
    return validate.quarantine_summary(ingest.ingest(_raw(spark, sf), ingest.sources()["contracts"])[1])


@query(f"""WITH r AS ({_RAW}), b AS (SELECT * FROM r WHERE AGENCY_NAME IS NULL OR CONTRACTAMOUNT = 'n/a?' OR FISCALYEAR = 1066), f AS (SELECT * FROM b WHERE CONTRACT_NUMBER % 2 = 0)
SELECT 'waiting' AS state, CAST(NULL AS VARCHAR) AS contract_number, count(*) AS n FROM b WHERE CONTRACT_NUMBER % 2 <> 0 UNION ALL SELECT 'mended', CAST(CONTRACT_NUMBER AS VARCHAR), 1 FROM f WHERE FISCALYEAR <> 1066 UNION ALL SELECT 'bad again', NULL, count(*) FROM f WHERE FISCALYEAR = 1066""")
def requeued_contracts(spark, sf):
    """Quarantined rows of even contracts are sent back with agency and amount mended; those of an odd year fail again, the others wait."""
    base, raw = shared_folder(spark), _raw(spark, sf)
    io.write_quarantine(ingest.ingest(raw, ingest.sources()["contracts"])[1], base)
    ids = io.read_quarantine(spark, base).where("get_json_object(original, '$.CONTRACT_NUMBER') % 2 = 0").select("quarantine_id")
    back = io.requeue_stored(spark, base, ids, ", ".join(f"{n} {t}" for n, t in raw.dtypes))
    mended = back.withColumns({"AGENCY_NAME": F.coalesce("AGENCY_NAME", F.lit("known")), "CONTRACTAMOUNT": F.when(F.col("CONTRACTAMOUNT") == "n/a?", "1").otherwise(F.col("CONTRACTAMOUNT"))})
    good, bad = ingest.ingest(mended, ingest.sources()["contracts"])
    count = lambda df, state: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(state).alias("state"), F.lit(None).cast("string").alias("contract_number"), "n")
    return count(io.read_quarantine(spark, base), "waiting").unionByName(good.select(F.lit("mended").alias("state"), "contract_number", F.lit(1).cast("long").alias("n"))).unionByName(count(bad, "bad again"))


@query(f"""WITH r AS ({_RAW}) SELECT 'validation_error' AS error_type, count(*) AS n FROM r WHERE AGENCY_NAME IS NULL OR CONTRACTAMOUNT = 'n/a?' OR FISCALYEAR = 1066
UNION ALL SELECT 'normalization_error', count(*) FROM r WHERE NOT (AGENCY_NAME IS NULL OR CONTRACTAMOUNT = 'n/a?' OR FISCALYEAR = 1066) AND CONTRACT_NUMBER % 5 = 0""")
def normalization_errors(spark, sf):
    """Rows that hold the rules but whose day can't be read, where a source needs it."""
    raw = _raw(spark, sf).withColumn("STARTDATE", F.when(F.col("CONTRACT_NUMBER") % 5 == 0, "soon").otherwise(F.col("STARTDATE")))
    bad = ingest.ingest(raw, replace(ingest.sources()["contracts"], needed=("contract_number", "start_date")))[1]
    return bad.groupBy("error_type").agg(F.count(F.lit(1)).alias("n"))


def _flat(df: DataFrame) -> DataFrame:
    """Maps and arrays as text, the time columns that are null here left out."""
    pairs = F.array_sort(F.transform(F.map_entries("extra"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    lists = {n: F.array_join(n, "|") for n, t in df.dtypes if t == "array<string>"}
    return df.withColumns({"extra": F.coalesce(F.array_join(pairs, "|"), F.lit("")), **lists}).drop("lineage_url", "lineage_scraped_at", "partition_date")


def _none(names: str, kind: str = "VARCHAR") -> str:
    """DuckDB: typed nulls."""
    return ", ".join(f"CAST(NULL AS {kind}) AS {n}" for n in names.split())


_LINEAGE = "'{0}' AS lineage_source, 'batch' AS lineage_run_id, '1' AS lineage_schema_version, '1' AS lineage_parser_version"


@query(f"""WITH r AS ({_RAW}) SELECT left(md5(CAST(CONTRACT_NUMBER AS VARCHAR)), 16) AS record_id, CAST(CONTRACT_NUMBER AS VARCHAR) AS source_record_id, CAST(CONTRACT_NUMBER AS VARCHAR) AS contract_number, CAST(NULL AS VARCHAR) AS title, AGENCY_NAME AS agency_name, CAST(NULL AS VARCHAR) AS supplier_name, TRY_CAST(CONTRACTAMOUNT AS DECIMAL(18,2)) AS contract_amount, FISCALYEAR AS fiscal_year,
  {_none('description agency_code contract_status contract_type procurement_method contract_url')}, CAST(NULL AS VARCHAR) AS naics_codes, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude, CAST(STARTDATE AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date, 'A' || CONTRACT_NUMBER || '|' || right(trim(NIGP_CODES), 1) AS nigp_codes, coalesce('BUYER=' || BUYER, '') AS extra, {_LINEAGE.format('contracts')},
  sha256(CAST(json_object('AGENCY', AGENCY, 'AGENCY_NAME', AGENCY_NAME, 'BUYER', BUYER, 'CONTRACTAMOUNT', CONTRACTAMOUNT, 'CONTRACT_NUMBER', CONTRACT_NUMBER, 'FISCALYEAR', FISCALYEAR, 'NIGP_CODES', NIGP_CODES, 'STARTDATE', STARTDATE) AS VARCHAR)) AS lineage_raw_hash FROM r""")
def normalized_contracts(spark, sf):
    return _flat(ingest.normalize(_raw(spark, sf), ingest.sources()["contracts"]))


def _records(spark, sf, source: str, raw: DataFrame) -> DataFrame:
    """Valid canonical records of raw rows; the raw hash is compared in ``normalized_contracts`` and left out here."""
    return _flat(ingest.ingest(raw, ingest.sources()[source])[0]).drop("lineage_raw_hash")


_ID = "left(md5({0}), 16) AS record_id, {0} AS source_record_id"


@query(f"""WITH r AS (SELECT concat('P', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS id, s_name, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(l_shipdate AS DATE) AS day, l_orderkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_quantity >= 10)
SELECT {_ID.format('id')}, s_name AS supplier_name, CAST(NULL AS VARCHAR) AS agency_name, amount AS payment_amount, day AS payment_date, 2021 AS fiscal_year, CAST(l_orderkey AS VARCHAR) AS contract_number, '' AS extra, {_LINEAGE.format('payments')} FROM r""")
def normalized_payments(spark, sf):
    """Amounts as dollars, days as milliseconds; small quantities are spoiled and go to quarantine."""
    l = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))  # noqa: E741
    money = F.when(F.col("l_quantity") >= 10, F.concat(F.lit("$"), F.format_number(F.col("l_extendedprice").cast("decimal(18,2)"), 2))).otherwise("unknown")
    raw = l.select(F.concat_ws("-", F.concat(F.lit("P"), "l_orderkey"), "l_linenumber", "l_partkey", "l_suppkey").alias("PAYMENTID"), F.col("s_name").alias("SUPPLIERNAME"), money.alias("PAYMENTAMOUNT"), (F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint") * 86_400_000).alias("PAYMENTDATE"), F.lit("FY2021").alias("FISCAL"), F.col("l_orderkey").alias("CONTRACT_NUMBER"))
    return _records(spark, sf, "payments", raw.withColumn("FISCALYEAR", F.lit(2021)).drop("FISCAL"))


@query(f"""WITH r AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_totalprice AS DECIMAL(18,2)) AS t, o_orderpriority AS a FROM orders WHERE o_orderkey % 9 <> 0)
SELECT {_ID.format('id')}, a AS agency_name, CAST(NULL AS VARCHAR) AS supplier_name, t AS amount_min, t AS amount_max, CAST(NULL AS DATE) AS order_date, CAST(NULL AS INTEGER) AS fiscal_year, '$' || format('{{:,.2f}}', t) AS amount_label, '' AS extra, {_LINEAGE.format('purchase_orders')} FROM r""")
def normalized_orders(spark, sf):
    o = table(spark, sf, "orders")
    raw = o.select(F.col("o_orderkey").alias("PONUMBER"), F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")).otherwise(" ").alias("AGENCY_NAME"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("POTOTAL"))
    return _records(spark, sf, "purchase_orders", raw)


@query(f"""WITH r AS (SELECT *, CAST(p_partkey AS VARCHAR) AS ssl, CASE WHEN p_partkey % 3 <> 0 THEN CAST(DATE '2001-02-03' + CAST(p_partkey % 900 AS INTEGER) AS VARCHAR) END AS day FROM part WHERE p_partkey % 10 <> 0)
SELECT left(md5(concat_ws('_', ssl, day)), 16) AS record_id, concat_ws('_', ssl, day) AS source_record_id, ssl, CAST(p_retailprice AS DECIMAL(18,2)) AS price, CAST(day AS DATE) AS sale_date, p_size % 4 IN (0, 1) AS qualified, coalesce('QUALIFIED=' || CASE p_size % 4 WHEN 0 THEN 'q' WHEN 1 THEN 'Y' WHEN 2 THEN 'U' END, '') AS extra, {_LINEAGE.format('sales')} FROM r""")
def normalized_sales(spark, sf):
    k = F.col("p_partkey")
    raw = table(spark, sf, "part").select(k.alias("SSL"), F.when(k % 10 == 0, "-5").otherwise(F.col("p_retailprice").cast("decimal(18,2)").cast("string")).alias("SALEPRICE"), F.when(k % 3 != 0, F.date_add(F.lit(dt.date(2001, 2, 3)), (k % 900).cast("int")).cast("string")).alias("SALEDATE"), F.element_at(F.array(F.lit("q"), F.lit("Y"), F.lit("U"), F.lit(None).cast("string")), (F.col("p_size") % 4 + 1).cast("int")).alias("QUALIFIED"))
    return _records(spark, sf, "sales", raw)


@query(f"""WITH r AS (SELECT *, CAST(p_partkey AS VARCHAR) AS ssl FROM part)
SELECT {_ID.format('ssl')}, ssl, lpad(CAST(p_partkey % 20000 AS VARCHAR), 5, '0') AS zip, CASE WHEN p_size % 3 = 0 THEN p_size * 2.0::DOUBLE ELSE CAST(p_size AS DOUBLE) END AS lot_area, concat_ws(' ', p_size, p_name) AS address, lpad(CAST(p_partkey % 20000 AS VARCHAR), 5, '0') || CASE WHEN p_size % 2 = 0 THEN '-' || lpad(CAST(p_size AS VARCHAR), 4, '0') ELSE '' END AS zip_plus_four, concat_ws('|', 'ADDRNUM=' || p_size, 'COMPUTED_AREA=' || p_size * 2, 'RECORD_AREA=' || CASE WHEN p_size % 3 = 0 THEN 0 ELSE p_size END, 'STNAME=' || p_name, 'ZIP4=' || CASE WHEN p_size % 2 = 0 THEN p_size END) AS extra, {_LINEAGE.format('lots')} FROM r""")
def normalized_lots(spark, sf):
    size = F.col("p_size")
    raw = table(spark, sf, "part").select(F.col("p_partkey").alias("SSL"), (F.col("p_partkey") % 20000).alias("ZIP"), F.when(size % 2 == 0, size).alias("ZIP4"), F.when(size % 3 == 0, 0).otherwise(size).alias("RECORD_AREA"), (size * 2).alias("COMPUTED_AREA"), size.alias("ADDRNUM"), F.col("p_name").alias("STNAME"))
    return _records(spark, sf, "lots", raw)


@query(f"""WITH r AS (SELECT *, CAST(p_partkey AS VARCHAR) AS id FROM part WHERE p_size <= 20)
SELECT {_ID.format('id')}, CAST(NULL AS VARCHAR) AS property_name, id AS unit_number, CAST(NULL AS INTEGER) AS floor, p_type AS floor_plan_name, CAST(p_retailprice AS DECIMAL(18,2)) AS rent_price, p_size AS bedrooms, CAST(NULL AS DOUBLE) AS bathrooms, CAST(p_size * 30 AS BIGINT) AS sqft, p_brand AS status, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS DATE) AS available_date, '' AS extra, {_LINEAGE.format('rentals')} FROM r""")
def normalized_rentals(spark, sf):
    p = table(spark, sf, "part")
    return _records(spark, sf, "rentals", p.select(F.col("p_partkey").alias("unit_number"), F.col("p_type").alias("floor_plan_name"), F.col("p_retailprice").cast("decimal(18,2)").alias("price"), F.col("p_size").alias("bedrooms"), (F.col("p_size") * 30).alias("sqft"), F.col("p_brand").alias("status")))


@query(f"""WITH r AS (SELECT n_name || '_' || o_orderpriority || '_' || strftime(o_orderdate, '%Y-%m') AS id, n_name, o_orderpriority, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DOUBLE) AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT {_ID.format('id')}, n_name AS region_name, o_orderpriority AS metric_name, d AS metric_date, v AS metric_value, '' AS extra, {_LINEAGE.format('market')} FROM r""")
def normalized_market(spark, sf):
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return _records(spark, sf, "market", rows.select(F.col("n_name").alias("region_name"), F.col("o_orderpriority").alias("metric_name"), F.col("o_orderdate").cast("date").cast("string").alias("metric_date"), F.col("o_totalprice").cast("double").alias("metric_value")))


@query(f"""WITH r AS (SELECT *, CAST(p_partkey AS VARCHAR) AS id, CAST(p_retailprice AS DECIMAL(18,2)) AS m FROM part)
SELECT {_ID.format('id')}, id AS listing_id, p_name AS address, m AS price, CAST(p_size AS DOUBLE) AS sqft, CAST(20000 + p_partkey % 3000 AS VARCHAR) AS zip, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude, CAST((CAST(m * 100 AS BIGINT) * 2 + p_size) // (2 * p_size) AS DOUBLE) / 100 AS price_per_sqft,
  CASE WHEN left(CAST(20000 + p_partkey % 3000 AS VARCHAR), 3) IN ('200', '201') THEN 'DC' WHEN left(CAST(20000 + p_partkey % 3000 AS VARCHAR), 3) IN ('222', '223') THEN 'VA' WHEN left(CAST(20000 + p_partkey % 3000 AS VARCHAR), 3) IN ('208', '209') THEN 'MD' END AS state, p_size % 2 = 0 AS price_reduced, 'list_price=' || CAST(CASE WHEN p_size % 2 = 0 THEN m + 1 ELSE m END AS VARCHAR) AS extra, {_LINEAGE.format('listings')} FROM r""")
def normalized_listings(spark, sf):
    price = F.col("p_retailprice").cast("decimal(18,2)")
    raw = table(spark, sf, "part").select(F.col("p_partkey").alias("listing_id"), F.col("p_name").alias("address"), price.alias("price"), F.col("p_size").alias("sqft"), (20000 + F.col("p_partkey") % 3000).cast("string").alias("zip_code"), F.when(F.col("p_size") % 2 == 0, (price + 1).cast("decimal(18,2)")).otherwise(price).alias("list_price"))
    return _records(spark, sf, "listings", raw)


@query(f"""WITH r AS (SELECT *, CAST(p_partkey AS VARCHAR) AS ssl FROM part)
SELECT {_ID.format('ssl')}, ssl, CASE WHEN p_size <= 8 THEN p_size END AS ward, CAST(p_retailprice AS DECIMAL(18,2)) AS property_tax, CAST(NULL AS DOUBLE) AS land_area, p_name AS address,
  CASE CASE WHEN p_partkey % 4 = 3 THEN 99 ELSE 10 + p_size % 8 END WHEN 11 THEN 'townhouse' WHEN 12 THEN 'single_family' WHEN 13 THEN 'townhouse' WHEN 14 THEN 'condo' WHEN 15 THEN 'condo' WHEN 16 THEN 'multi_family' WHEN 17 THEN 'multi_family' ELSE CASE p_partkey % 3 WHEN 0 THEN 'single_family' WHEN 1 THEN 'commercial' ELSE 'other' END END AS property_type, 'TAXCLASS=' || CASE p_partkey % 3 WHEN 0 THEN '001' WHEN 1 THEN '002' ELSE '9' END || '|USECODE=' || CASE WHEN p_partkey % 4 = 3 THEN 99 ELSE 10 + p_size % 8 END AS extra, {_LINEAGE.format('assessments')} FROM r""")
def normalized_assessments(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size")
    raw = table(spark, sf, "part").select(k.alias("SSL"), F.concat(F.lit("Ward "), size).alias("ASSESSWARD"), F.col("p_retailprice").cast("decimal(18,2)").alias("NEWTOTAL"), F.col("p_name").alias("PREMISEADD"), F.when(k % 4 == 3, 99).otherwise(10 + size % 8).alias("USECODE"), F.element_at(F.array(F.lit("001"), F.lit("002"), F.lit("9")), (k % 3 + 1).cast("int")).alias("TAXCLASS"))
    return _records(spark, sf, "assessments", raw)


@query("""SELECT left(md5(CAST(o_orderkey AS VARCHAR)), 16) AS contract_key, CAST(o_orderkey AS VARCHAR) AS contract_number, CASE WHEN o_orderkey % 3 = 0 THEN 'Order ' || o_orderkey ELSE 'Supply ' || o_orderkey END AS contract_title, CASE WHEN o_orderkey % 4 = 0 THEN 'other' ELSE o_orderpriority END AS contract_type, 'method ' || o_orderstatus AS procurement_method,
  'C' || o_orderkey % 9 || '|C' || o_orderstatus AS nigp_codes, 'N' || o_orderkey % 5 AS naics_codes, left(o_orderpriority, 1) AS agency_code, o_orderpriority AS agency_name, true AS is_current FROM orders""")
def dim_contract_from_records(spark, sf):
    """The contract dimension over normalized records; each contract comes twice, once without most of its fields."""
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    say = lambda *parts: F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts))
    raw = o.select(
        k.alias("CONTRACTNUMBER"), k.alias("CONTRACT_NUMBER"), F.when(k % 3 != 0, say("Supply ", k)).alias("TITLE"), say("Order ", k).alias("DESCRIPTION"), F.col("o_orderpriority").alias("AGENCY_NAME"), F.substring("o_orderpriority", 1, 1).alias("AGENCY_ACRONYM"), F.col("o_totalprice").cast("decimal(18,2)").alias("CONTRACTAMOUNT"),
        F.when(k % 4 != 0, F.col("o_orderpriority")).alias("MARKETTYPE"), F.lit("other").alias("CONTRACTTYPEDESCRIPTION"), say("method ", F.col("o_orderstatus")).alias("PROCUREMENTMETHODDESCRIPTION"), say("C", k % 9, "; C", F.col("o_orderstatus")).alias("COMMODITYCODE"), say("N", k % 5).alias("NAICS_CODES"),
    )
    bare = o.select(k.alias("CONTRACT_NUMBER"), F.col("o_orderpriority").alias("AGENCY_NAME"))
    records = ingest.ingest(raw.unionByName(bare, allowMissingColumns=True), ingest.sources()["contracts"])[0]
    fields = ["title", "description", "contract_type", "procurement_method", "nigp_codes", "agency_code"]
    return warehouse.dim_contract(records, fields, "contract_amount").withColumns({c: F.array_join(c, "|") for c in ("nigp_codes", "naics_codes")})


@query(f"""WITH r AS (SELECT *, CAST(p_partkey AS VARCHAR) AS ssl, CAST(p_retailprice AS DECIMAL(18,2)) AS m FROM part WHERE p_partkey % 6 <> 0 AND 1900 + p_partkey % 120 <= {AS_OF.year + 1})
SELECT {_ID.format('ssl')}, ssl, CAST(p_size AS BIGINT) AS bedrooms, CASE WHEN p_size % 2 = 0 THEN 1.0::DOUBLE END AS half_bathrooms, CAST(m AS DOUBLE) AS price, 1900 + p_partkey % 120 AS year_built, CAST(p_size * 100 AS DOUBLE) AS sqft, p_size % 3 + CASE WHEN p_size % 2 = 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS bathrooms, p_brand AS style,
  CASE p_partkey % 5 WHEN 0 THEN 'townhouse' WHEN 1 THEN 'semi_detached' WHEN 2 THEN 'condo' ELSE 'single_family' END AS property_type, p_size % 4 = 0 AS qualified, CASE WHEN m <> 0 THEN CAST((CAST(m * 100 AS BIGINT) * 2 + p_size * 100) // (2 * p_size * 100) AS DOUBLE) / 100 END AS price_per_sqft FROM r""")
def normalized_appraisals(spark, sf):
    """Rows without an id or with a building year in the future are spoiled."""
    k, size = F.col("p_partkey"), F.col("p_size")
    kind = F.element_at(F.array(*map(F.lit, ("Row Inside", "Semi-Detached", "CONDO", "Single", "Town End"))), (k % 5 + 1).cast("int"))
    raw = table(spark, sf, "part").select(
        F.when(k % 12 != 0, k).alias("SSL"), size.alias("BEDRM"), (size % 3).alias("BATHRM"), F.when(size % 2 == 0, 1).alias("HF_BATHRM"), F.col("p_retailprice").cast("decimal(18,2)").alias("PRICE"), F.when(k % 6 == 0, 2090).otherwise(1900 + k % 120).alias("AYB"), (size * 100).alias("GBA"),
        kind.alias("STRUCT_D"), F.col("p_brand").alias("STYLE_D"), F.when(size % 4 == 0, "q").alias("QUALIFIED"),
    )
    rows = ingest.ingest(raw, ingest.sources()["appraisals"], as_of=AS_OF)[0]
    return rows.select("record_id", "source_record_id", "ssl", "bedrooms", "half_bathrooms", F.col("price").cast("double").alias("price"), "year_built", "sqft", "bathrooms", "style", "property_type", "qualified", "price_per_sqft")


@query(f"""WITH r AS (SELECT CAST(n_nationkey AS VARCHAR) AS ward_, 'Ward ' || n_nationkey AS name, n_nationkey * 1000.5::DOUBLE AS v FROM nation WHERE n_nationkey BETWEEN 1 AND 8)
SELECT {_ID.format('ward_')}, name AS region_name, CAST(ward_ AS INTEGER) AS ward, v AS metric_value FROM r""")
def normalized_wards(spark, sf):
    k = F.col("n_nationkey")
    raw = table(spark, sf, "nation").select(k.alias("WARD"), F.concat(F.lit("Ward "), k.cast("string")).alias("NAME"), (k * 1000.5).alias("POP100"))
    return ingest.ingest(raw, ingest.sources()["wards"])[0].select("record_id", "source_record_id", "region_name", "ward", "metric_value")


@query("""WITH r AS (SELECT *, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'L' || s_suppkey END AS l, CASE WHEN s_suppkey % 3 = 1 THEN NULL ELSE 'S' || s_suppkey END AS sol FROM supplier)
SELECT left(md5(concat_ws('_', l, sol)), 16) AS record_id, concat_ws('_', l, sol) AS source_record_id, s_name AS business_name, l AS license, sol AS solicitation, 'A|B' || s_nationkey AS categories, '+1202555' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS phone, s_nationkey % 8 + 1 AS ward FROM r""")
def normalized_businesses(spark, sf):
    k = F.col("s_suppkey")
    raw = table(spark, sf, "supplier").select(
        F.when(k % 3 != 0, F.concat(F.lit("L"), k.cast("string"))).alias("LICENSE_NUMBER"), F.when(k % 3 != 1, F.concat(F.lit("S"), k.cast("string"))).alias("SOLICITATION_NUMBER"), F.col("s_name").alias("ENTITY_NAME"),
        F.concat(F.lit("A, B"), F.col("s_nationkey").cast("string")).alias("CERTIFICATION_CATEGORIES"), F.concat(F.lit("+1 (202) 555-"), F.lpad(k.cast("string"), 4, "0")).alias("PHONE"), F.concat(F.lit("Ward "), (F.col("s_nationkey") % 8 + 1).cast("string")).alias("WARD"),
    )
    rows = ingest.ingest(raw, ingest.sources()["businesses"])[0]
    return rows.select("record_id", "source_record_id", "business_name", "license", "solicitation", F.array_join("categories", "|").alias("categories"), "phone", "ward")


@query(f"""WITH r AS (SELECT *, CAST(p_partkey AS VARCHAR) AS id FROM part WHERE p_partkey % 5 <> 0)
SELECT {_ID.format('id')}, p_name AS project_name, CASE WHEN p_partkey % 2 = 0 THEN p_name || ' full' ELSE p_brand END AS address, CAST(p_size AS VARCHAR) AS units, p_size % 8 + 1 AS ward, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size // 2 AS VARCHAR) END AS units_0_30_ami, CASE WHEN p_partkey % 2 = 1 THEN p_type END AS owner_name, 'multi_family' AS property_type, 'for_rent' AS listing_type FROM r""")
def normalized_housing(spark, sf):
    """Both kinds of housing rows, each with its own field names; negative units are spoiled."""
    p, k, size = table(spark, sf, "part"), F.col("p_partkey"), F.col("p_size")
    spoiled = k % 5 == 0
    one = p.where(k % 2 == 0).select(k.alias("OBJECTID"), F.col("p_name").alias("PROJECT_NAME"), F.concat("p_name", F.lit(" full")).alias("FULLADDRESS"), F.col("p_brand").alias("ADDRESS"), F.when(spoiled, -1).otherwise(size).alias("UNITS"), F.floor(size / 2).alias("AFFORDABLE_UNITS_AT_0_30_AMI"), (size % 8 + 1).alias("MAR_WARD"))
    two = p.where(k % 2 == 1).select(k.alias("OBJECTID"), F.col("p_name").alias("SITENAME"), F.col("p_brand").alias("ADDRESS"), F.when(spoiled, -1).otherwise(size).alias("UNITS"), F.concat(F.lit("WARD "), (size % 8 + 1).cast("string")).alias("WARD"), F.col("p_type").alias("OWNERNAME"))
    rows = reduce(DataFrame.unionByName, (ingest.ingest(x, ingest.sources()["housing"])[0].drop("extra") for x in (one, two)))
    return rows.select("record_id", "source_record_id", "project_name", "address", F.col("units").cast("string").alias("units"), "ward", F.col("units_0_30_ami").cast("string").alias("units_0_30_ami"), "owner_name", "property_type", "listing_type")


@query("""WITH r AS (SELECT CAST(20000 + c_nationkey % 3 * 100 AS VARCHAR) AS z, c_mktsegment AS t, CASE WHEN c_custkey % 4 <> 0 THEN '2021-0' || c_custkey % 4 || '-15' END AS d, c_acctbal AS v FROM customer)
SELECT left(md5(concat_ws('_', z, t, 'average_rent', left(d, 7))), 16) AS record_id, concat_ws('_', z, t, 'average_rent', left(d, 7)) AS source_record_id, z AS region_name, 'average_rent' AS metric_name, CAST(CAST(d AS DATE) AS VARCHAR) AS metric_date, CAST(v AS DOUBLE) AS metric_value, CASE WHEN left(z, 3) IN ('200', '201') THEN 'DC' END AS state FROM r""")
def normalized_rent_metrics(spark, sf):
    k = F.col("c_custkey")
    raw = table(spark, sf, "customer").select(
        (20000 + F.col("c_nationkey") % 3 * 100).cast("string").alias("zip_code"), F.col("c_mktsegment").alias("property_type"), F.lit("average_rent").alias("metric_name"), F.when(k % 4 != 0, F.concat(F.lit("2021-0"), (k % 4).cast("string"), F.lit("-15"))).alias("metric_date"), F.col("c_acctbal").alias("metric_value"),
    )
    return ingest.ingest(raw, ingest.sources()["rent_metrics"])[0].select("record_id", "source_record_id", "region_name", "metric_name", F.col("metric_date").cast("string").alias("metric_date"), "metric_value", "state")


@query("""SELECT left(md5(concat_ws('_', n_name, c_mktsegment, 'balance')), 16) AS record_id, concat_ws('_', n_name, c_mktsegment, 'balance') AS source_record_id, n_name AS region_name, c_mktsegment AS metric_name, 'balance' AS category, CAST(c_acctbal AS DOUBLE) AS metric_value FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 3 <> 0""")
def normalized_demographics(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    raw = c.select(F.col("n_name").alias("region_name"), F.col("c_mktsegment").alias("metric_name"), F.lit("balance").alias("category"), F.when(F.col("c_custkey") % 3 == 0, "low").otherwise(F.col("c_acctbal").cast("string")).alias("metric_value"))
    return ingest.ingest(raw, ingest.sources()["demographics"])[0].select("record_id", "source_record_id", "region_name", "metric_name", "category", "metric_value")


@query(f"""WITH r AS (SELECT *, CAST(p_partkey AS VARCHAR) AS ssl_ FROM part WHERE p_partkey % 3 <> 0)
SELECT {_ID.format('ssl_')}, ssl_ AS ssl, p_name AS address, p_size % 8 + 1 AS ward, CAST(19990 + p_partkey % 20 AS VARCHAR) AS zip, CAST(p_size AS DOUBLE) AS latitude, 19990 + p_partkey % 20 >= 20000 AS is_local FROM r""")
def normalized_locations(spark, sf):
    """Replies of a location service in XML; those of latitudes off the globe are spoiled."""
    k, size = F.col("p_partkey"), F.col("p_size")
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), F.replace(c.cast("string"), F.lit("&"), F.lit("&amp;")), F.lit(f"</{name}>"))
    body = F.concat(F.lit("<reply><row>"), tag("SSL", k), tag("FULLADDRESS", F.col("p_name")), tag("WARD", F.concat(F.lit("Ward "), (size % 8 + 1).cast("string"))), tag("ZIPCODE", 19990 + k % 20), tag("LATITUDE", F.when(k % 3 == 0, 120).otherwise(size)), tag("LONGITUDE", size), F.lit("</row></reply>"))
    replies = table(spark, sf, "part").select(body.alias("reply"))
    tags = ("SSL", "FULLADDRESS", "WARD", "ZIPCODE", "LATITUDE", "LONGITUDE")
    raw = io.location_rows(replies, "reply", tags).toDF(*tags)
    return ingest.ingest(raw, ingest.sources()["locations"])[0].select("record_id", "source_record_id", "ssl", "address", "ward", "zip", "latitude", "is_local")


@query("""WITH r AS (SELECT CAST(p_size AS DOUBLE) AS lat, CAST(p_partkey % 50 AS DOUBLE) AS lon, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS d, CASE WHEN p_partkey % 3 = 0 THEN p_type END AS f FROM part)
SELECT lat AS latitude, lon AS longitude, d AS historic_district, f AS flood_plain, d IS NOT NULL AS in_historic_district, false AS is_historic_landmark, f IS NOT NULL AS in_flood_plain FROM r""")
def normalized_highlights(spark, sf):
    k = F.col("p_partkey")
    raw = table(spark, sf, "part").select(F.col("p_size").cast("double").alias("latitude"), (k % 50).cast("double").alias("longitude"), F.when(k % 2 == 0, F.col("p_brand")).otherwise(" ").alias("historic_district"), F.when(k % 3 == 0, F.col("p_type")).alias("flood_plain"), F.lit(None).cast("string").alias("historic_landmark"))
    rows = ingest.ingest(raw.withColumns({"LATITUDE": F.col("latitude"), "LONGITUDE": F.col("longitude")}).select("LATITUDE", "LONGITUDE", "historic_district", "flood_plain", "historic_landmark"), ingest.sources()["highlights"])[0]
    return rows.select("latitude", "longitude", "historic_district", "flood_plain", "in_historic_district", "is_historic_landmark", "in_flood_plain")


@query("""WITH w AS (SELECT c_nationkey, 2000 + k AS y, CAST(sum(c_acctbal) FILTER (c_custkey % 20 = k) AS DOUBLE) AS v FROM customer, range(20) AS r(k) GROUP BY 1, 2)
SELECT c_nationkey, y || '-01' AS metric_date, round(v, 4) AS metric_value FROM w WHERE v IS NOT NULL AND y >= 2008""")
def unpivoted_series(spark, sf):
    """A table with a column a month of twenty years, back to rows of its newest twelve."""
    years = [(F.sum(F.when(F.col("c_custkey") % 20 == k, F.col("c_acctbal"))).cast("string")).alias(f"{2000 + k}-01") for k in range(20)]
    wide = table(spark, sf, "customer").groupBy("c_nationkey").agg(*years)
    return io.unpivot_dates(wide, ["c_nationkey"]).withColumn("metric_value", F.round("metric_value", 4))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE contains(lower(o_orderpriority), 'high') OR left(lpad(CAST(o_orderkey AS VARCHAR), 5, '0'), 3) IN ('000', '002')")
def market_regions(spark, sf):
    return ingest.in_regions(table(spark, sf, "orders"), "o_orderpriority", "o_orderkey", ("High",), ("000", "002")).select("o_orderkey", "o_orderpriority")


@query("""SELECT p_partkey, m AS metric_name, v AS metric_value FROM (SELECT p_partkey, unnest(['average_rent', 'median_rent', 'min_rent', 'max_rent', 'average_rent_per_sqft', 'occupancy_rate', 'days_on_market', 'total_listings']) AS m,
  unnest([p_retailprice, CASE WHEN p_size % 2 = 0 THEN p_size END, NULL, p_retailprice * 2, NULL, NULL, CASE WHEN p_size % 3 = 0 THEN p_partkey END, p_size]) AS v FROM part) WHERE v IS NOT NULL""")
def rent_metric_rows(spark, sf):
    p, size = table(spark, sf, "part"), F.col("p_size")
    values = (F.col("p_retailprice"), F.when(size % 2 == 0, size), F.lit(None), F.col("p_retailprice") * 2, F.lit(None), F.lit(None), F.when(size % 3 == 0, F.col("p_partkey")), size)
    return ingest.metric_rows(p, ["p_partkey"], dict(zip(ingest.RENT_METRICS.values(), values, strict=True)))


@query("""SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS property_id, CASE WHEN p_partkey % 4 <> 3 THEN CAST(p_retailprice AS DOUBLE) END AS list_price, p_name AS line, CAST(p_partkey % 5 AS VARCHAR) AS state_code, CAST(p_size AS DOUBLE) AS lat, CASE WHEN p_partkey % 4 <> 3 THEN CAST(p_size AS VARCHAR) END AS beds, CASE WHEN p_partkey % 4 = 1 THEN CAST(p_size * 10 AS DOUBLE) WHEN p_partkey % 4 <> 3 THEN CAST(p_size AS DOUBLE) END AS sqft
FROM part WHERE p_partkey % 7 <> 0""")
def listing_rows(spark, sf):
    """Replies of four shapes by the part's number, each with its own paths of fields; some numbers as text, some replies cut off."""
    p = table(spark, sf, "part")
    c = lambda n, t="string": F.col(n).cast(t)
    nested = F.struct(c("p_partkey").alias("property_id"), c("p_retailprice", "double").alias("list_price"), F.struct(F.struct(F.col("p_name").alias("line"), (F.col("p_partkey") % 5).cast("string").alias("state_code"), F.struct(c("p_size", "double").alias("lat")).alias("coordinate")).alias("address")).alias("location"), F.struct(F.col("p_size").alias("beds"), F.col("p_size").alias("sqft")).alias("description"))
    flat = F.struct(F.col("p_partkey").alias("listing_id"), F.struct(c("p_retailprice").alias("list")).alias("price"), F.struct(F.col("p_name").alias("line"), (F.col("p_partkey") % 5).alias("state"), c("p_size").alias("lat")).alias("address"), c("p_size").alias("beds"), F.struct((F.col("p_size") * 10).alias("size")).alias("building_size"))
    bare = F.struct(c("p_partkey").alias("property_id"), F.lit("on request").alias("list_price"), F.struct(F.struct(F.col("p_name").alias("line"), (F.col("p_partkey") % 5).alias("state_code"), F.struct(c("p_size", "double").alias("lat")).alias("coordinate")).alias("address")).alias("location"))
    of = lambda name, x: F.struct(x.alias(name))
    shapes = [F.to_json(of("home_search", of("results", F.array(nested)))), F.to_json(of("properties", F.array(flat))), F.to_json(of("data", of("results", F.array(nested)))), F.to_json(F.array(bare))]
    reply = F.element_at(F.array(*shapes), (F.col("p_partkey") % 4 + 1).cast("int"))
    payloads = p.select("p_partkey", F.when(F.col("p_partkey") % 7 == 0, F.substring(reply, 1, 40)).otherwise(reply).alias("reply"))
    rows = ingest.listing_rows(payloads, "reply")
    return rows.select("p_partkey", "property_id", "list_price", "line", "state_code", "lat", F.col("beds").cast("string").alias("beds"), "sqft")


@query("SELECT event_type, user_id, value, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS r FROM events) WHERE r = 1")
def latest_metric(spark, sf):
    return ingest.latest_metric(table(spark, sf, "events"), "user_id", "event_type", "ts", "event_id").select("event_type", "user_id", "value", "ts")


@query("SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS PAYMENTAMOUNT, l_quantity AS longitude, l_discount AS latitude FROM lineitem")
def feature_collection(spark, sf):
    row = F.struct(F.struct("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)").alias("PAYMENTAMOUNT")).alias("attributes"), F.struct(F.col("l_quantity").alias("x"), F.col("l_discount").alias("y")).alias("geometry"))
    payloads = table(spark, sf, "lineitem").select(F.to_json(F.struct(F.array(row).alias("features"))).alias("payload"))
    return io.parse_features(payloads, "payload", "l_orderkey long, l_linenumber int, PAYMENTAMOUNT double")


_TOKENS = r"list_filter(list_transform(string_split_regex(lower(text), '\s+'), lambda w: regexp_replace(w, '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g')), lambda w: length(w) >= 2)"
_SENTENCES = r"list_filter(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '')"


@query(f"""SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_unique, len(s) AS n_sentences, round(coalesce(CAST(list_sum(list_transform(t, lambda w: length(w))) AS DOUBLE) / nullif(len(t), 0), 0), 4) AS mean_length, round(coalesce(CAST(len(t) AS DOUBLE) / nullif(len(s), 0), 0), 4) AS mean_sentence,
  len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS n_words FROM (SELECT doc_id, text, {_TOKENS} AS t, {_SENTENCES} AS s FROM documents)""")
def doc_token_stats(spark, sf):
    d = table(spark, sf, "documents")
    return text.token_stats(d, S.word_count(F.col("text")).alias("n_words"))


@query(f"""WITH t AS (SELECT doc_id, {_TOKENS} AS t FROM documents), g AS (SELECT doc_id, t[i] || ' ' || t[i + 1] AS gram, count(*) AS uses FROM t, unnest(range(1, len(t))) AS r(i) GROUP BY 1, 2)
SELECT doc_id, gram, uses FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY uses DESC, gram) AS r FROM g) WHERE r <= 10""")
def doc_top_bigrams(spark, sf):
    return text.top_ngrams(table(spark, sf, "documents"), 2, 10)


@query(f"WITH t AS (SELECT doc_id, unnest({_TOKENS}) AS token FROM documents) SELECT doc_id, token, count(*) AS uses FROM t WHERE token NOT IN ({', '.join(repr(w) for w in text.STOPWORDS)}) GROUP BY 1, 2")
def search_tokens(spark, sf):
    return text.search_tokens(table(spark, sf, "documents"))


@query(f"""SELECT doc_id, source AS parent_id, sha256(text) AS content_hash, length(text) AS n_chars, len(t) AS n_tokens, len(s) AS n_sentences, array_to_string(t, ' ') AS tokens, array_to_string(s, '|') AS sentences FROM (SELECT *, {_TOKENS} AS t, {_SENTENCES} AS s FROM documents)""")
def document_table(spark, sf):
    return text.document_table(table(spark, sf, "documents"), "source", most_tokens=None, most_sentences=None).withColumns({"tokens": F.array_join("tokens", " "), "sentences": F.array_join("sentences", "|")})


_BODY = r"""regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>|<!--.*?-->', ' ', 'g'), '(?s)<[a-zA-Z/!][^>]*$', '')"""
_PAGE_URL = r"lower(regexp_extract(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', 0)) || substr(regexp_replace(url, '#.*$', ''), length(regexp_extract(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', 0)) + 1)"


def _signs(c: str) -> str:
    """DuckDB: the character references that these pages hold, those that lack their semicolon included."""
    for name, sign in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"')):
        c = f"replace({c}, '{name}', '{sign}')"
    return f"regexp_replace({c}, '&amp;?', '&', 'g')"


#: DuckDB: links of pages whose addresses begin with a slash, as all in these tables do; each at its first place.
_LINKS = rf"""pages_ AS (SELECT page_id, {_PAGE_URL} AS url, {_BODY} AS body FROM pages),
raws AS (SELECT page_id, url, unnest(h) AS raw, generate_subscripts(h, 1) AS i FROM (SELECT page_id, url, regexp_extract_all(body, '(?is)<a\b[^>]*?\bhref="([^"]*)"', 1) AS h FROM pages_)),
links AS (SELECT page_id, url, link, CASE WHEN regexp_matches(lower(link), '\.pdf($|\?)') THEN 'pdf' ELSE 'internal' END AS kind, CAST(row_number() OVER (PARTITION BY page_id ORDER BY min(i)) - 1 AS INTEGER) AS place
  FROM (SELECT page_id, url, i, regexp_extract(url, '^[a-z]+://[^/?]*', 0) || regexp_replace({_signs("raw")}, '#.*$', '') AS link FROM raws WHERE raw LIKE '/%') GROUP BY 1, 2, 3)
"""
#: A description in front of each page's title, its attributes in either order, with signs that end or open nothing.
_ABOUT = "CASE WHEN page_id % 3 = 0 THEN concat('<META content=''About &lt;', page_id, '&gt; &amp;amp; more'' title=\"a > b\" name=description>') WHEN page_id % 3 = 1 THEN concat('<meta name=\"Description\" data-x=''>'' content=\" Page > ', page_id, ' &eacute;\" />') ELSE '<meta name=description>' END"
_DESCRIBED = "SELECT page_id, url, replace(html, '<title>', concat({about}, '<title>')) AS html FROM {pages}"


_TITLE = "trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1))"
_HEADINGS = r"array_to_string(list_transform(regexp_extract_all(b, '(?is)<h[1-3][^>]*>(.*?)</h[1-3]>', 1), lambda h: trim(regexp_replace(h, '\s+', ' ', 'g'))), '|')"
_TEXT = r"trim(regexp_replace(regexp_replace(regexp_replace(b, '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'), '[^\PC]', '', 'g'))"
_META = r"""(?is)<meta\b(?:"[^"]*"|''[^'']*''|[^>"''])*>"""


@query(f"""WITH p AS ({_DESCRIBED.format(about=_ABOUT, pages="pages")})
SELECT page_id, {_PAGE_URL} AS url, {_signs(_TITLE)} AS title, CASE page_id % 3 WHEN 0 THEN 'About <' || page_id || '> &amp; more' WHEN 1 THEN 'Page > ' || page_id || ' é' END AS description, {_signs(_HEADINGS)} AS headings, md5({_signs(_TEXT)}) AS text_md5
FROM (SELECT page_id, url, html, regexp_replace(b, '{_META}', ' ', 'g') AS b FROM (SELECT *, {_BODY} AS b FROM p))""")
def page_titles(spark, sf):
    pages = spark.sql(_DESCRIBED.format(about=_ABOUT, pages="{pages}"), pages=table(spark, sf, "pages"))
    return text.page_parts(pages).select("page_id", "url", "title", "description", F.array_join("headings", "|").alias("headings"), F.md5("text").alias("text_md5"))


@query("WITH " + _LINKS + "SELECT page_id, place, link, kind FROM links")
def page_links(spark, sf):
    return text.page_links(table(spark, sf, "pages")).select("page_id", "place", "link", "kind")


@query("WITH " + _LINKS + "SELECT page_id, place, link, kind FROM (SELECT *, row_number() OVER (PARTITION BY page_id, kind ORDER BY place) AS r FROM links) WHERE r <= CASE kind WHEN 'internal' THEN 4 WHEN 'pdf' THEN 1 ELSE 2 END")
def page_links_capped(spark, sf):
    links = text.page_links(table(spark, sf, "pages")).select("page_id", "place", "link", "kind")
    return text.capped_links(links, {"internal": 4, "external": 2, "pdf": 1})


@query("WITH " + _LINKS + ", h AS (SELECT DISTINCT regexp_extract(url, '://([^/?:]*)', 1) AS host FROM pages_ WHERE page_id % 3 = 0) SELECT l.page_id, l.link FROM links l WHERE substr(regexp_extract(link, '^[a-z]+://[^/?]*([^?#]*)', 1), 1, 2) = '/a'")
def link_allowlist(spark, sf):
    pages = table(spark, sf, "pages")
    hosts = pages.where("page_id % 3 = 0").select(text.host_of(text.canonical_url(F.col("url"))).alias("host"))
    return text.allowed(text.page_links(pages), "url", "link", hosts, "/a").select("page_id", "link")


@query("WITH " + _LINKS + r"""SELECT page_id, link, CASE WHEN regexp_matches(p, '\.pdf$') THEN string_split(p, '/')[-1] WHEN page_id % 2 = 0 THEN 'Report_' || page_id || '.PDF' ELSE 'attachment_' || left(md5(link), 8) || '.pdf' END AS name,
  regexp_matches(p || CASE WHEN page_id % 2 = 0 THEN ' see Report_' || page_id || '.PDF' ELSE ' Floor   Plans' END, '(?i)drawing|dwg|cad|plan[s]?\s*(sheet|set)|architectural\s*plan|structural\s*plan|mep\s*plan|civil\s*plan|floor\s*plan|site\s*plan|elevation|section\s*view|detail\s*sheet|[A-Z]\d{3}') AS drawing
FROM (SELECT *, regexp_extract(link, '^[a-z]+://[^/?]*([^?#]*)', 1) AS p FROM links)""")
def attachment_names(spark, sf):
    told = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("see Report_"), "page_id", F.lit(".PDF"))).otherwise("Floor   Plans")
    path = F.regexp_extract("link", "^[a-z]+://[^/?]*([^?#]*)", 1)
    return text.page_links(table(spark, sf, "pages")).select("page_id", "link", text.attachment_name(F.col("link"), told).alias("name"), text.is_drawing(path, told).alias("drawing"))


@query("SELECT event_id, event_type AS name, CAST(user_id AS INTEGER) AS layer_id, CASE WHEN user_id % 3 = 0 THEN 'esriGeometryPoint' END AS geometry_type, CASE WHEN user_id % 3 = 0 THEN 2 ELSE 0 END AS n_fields, CAST(CASE WHEN user_id % 2 = 0 THEN 3 ELSE user_id END AS BIGINT) AS feature_count, user_id % 5 = 0 AS limited FROM events")
def service_metadata(spark, sf):
    u = F.col("user_id")
    body = F.to_json(F.struct(F.col("event_type").alias("name"), u.alias("id"), F.when(u % 3 == 0, "esriGeometryPoint").alias("geometryType"), F.when(u % 3 == 0, F.array(F.lit("a"), F.lit("b"))).alias("fields"), F.when(u % 2 == 0, F.array(F.lit(1), F.lit(2), F.lit(3))).alias("features"), u.alias("count"), F.when(u % 5 == 0, True).alias("exceededTransferLimit")))
    return text.service_metadata(table(spark, sf, "events").select("event_id", body.alias("body")), "body").drop("body")


@query("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS events FROM events GROUP BY 1, 2")
def daily_events(spark, sf):
    return table(spark, sf, "events").groupBy(F.window("ts", "1 day")["start"].alias("day"), "event_type").agg(F.count(F.lit(1)).alias("events")).withColumn("day", F.col("day").cast("timestamp_ntz"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, round(value, 2) AS v, sha256(props) AS content_hash FROM events")
def event_payloads(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.round("value", 2).alias("v"), F.sha2("props", 256).alias("content_hash"))


@query("""SELECT p_partkey AS ssl, CAST(p_size AS DOUBLE) AS latitude, CAST(p_partkey % 25 AS DOUBLE) AS longitude, p_name AS address, CASE WHEN p_partkey % 3 = 0 THEN p_type END AS use_code, a.n AS sales, a.top AS top_price, n_name AS name
FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n, max(l_extendedprice) AS top FROM lineitem GROUP BY 1) a ON l_partkey = p_partkey LEFT JOIN nation ON n_nationkey = p_size AND n_nationkey = p_partkey % 25""")
def property_360(spark, sf):
    part, nation = table(spark, sf, "part"), table(spark, sf, "nation")
    addresses = part.select(F.col("p_partkey").alias("ssl"), F.col("p_size").cast("double").alias("latitude"), (F.col("p_partkey") % 25).cast("double").alias("longitude"), F.col("p_name").alias("address"))
    assessments = part.where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("ssl"), F.col("p_type").alias("use_code"))
    appraisals = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("ssl")).agg(F.count(F.lit(1)).alias("sales"), F.max("l_extendedprice").alias("top_price"))
    here = F.col("n_nationkey").cast("double")
    return places.property_360(addresses, assessments, appraisals, nation.select(here.alias("latitude"), here.alias("longitude"), F.col("n_name").alias("name")))


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, l_quantity + 0.25::DOUBLE AS x, l_discount * 500::DOUBLE + 0.125::DOUBLE AS y FROM lineitem),
g AS (SELECT n_name, n_nationkey % 5 * 10 AS x0, n_nationkey // 5 * 10 AS y0 FROM nation)
SELECT l_orderkey, l_linenumber, (SELECT min(n_name) FROM g WHERE abs(x - x0 - 5) + abs(y - y0 - 5) < 5) AS diamond,
  (SELECT min_by(r_name, r_regionkey) FROM region WHERE x BETWEEN r_regionkey * 10 AND r_regionkey * 10 + 15 AND y BETWEEN 0 AND 45 AND NOT (y BETWEEN 20 AND 30)) AS band FROM p""")
def point_in_polygon(spark, sf):
    points = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") + 0.25).alias("x"), (F.col("l_discount") * 500.0 + 0.125).alias("y"))
    ring = lambda *xy: F.array(*(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in xy))
    k = F.col("n_nationkey")
    x, y = k % 5 * 10, F.floor(k / 5) * 10
    diamonds = table(spark, sf, "nation").select(F.lit("diamond").alias("layer"), k.alias("place"), F.col("n_name").alias("name"), F.array(ring((x + 5, y), (x + 10, y + 5), (x + 5, y + 10), (x, y + 5))).alias("rings"))
    k = F.col("r_regionkey")
    box = lambda a, b: ring((k * 10, F.lit(a)), (k * 10 + 15, F.lit(a)), (k * 10 + 15, F.lit(b)), (k * 10, F.lit(b)))
    bands = table(spark, sf, "region").select(F.lit("band").alias("layer"), k.alias("place"), F.col("r_name").alias("name"), F.array(box(0, 45), box(20, 30)).alias("rings"))
    return places.locate(points, diamonds.unionByName(bands), ["diamond", "band"], 10.0).drop("x", "y")


@query(r"""WITH l AS (SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS i FROM (SELECT doc_id, regexp_replace(s[i], '^\s+|\s+$', '', 'g') AS x, i FROM (SELECT doc_id, string_split('before' || chr(10) || 'SECTION ' || doc_id % 7 || ': ' || lang || chr(10) || coalesce(text, '') || chr(10) || 'NOTHING BELOW' || chr(10) || '2. Closing Words' || chr(10) || ' ' || source, chr(10)) AS s FROM documents), unnest(range(1, len(s) + 1)) AS r(i)) WHERE x <> ''),
h AS (SELECT *, length(x) < 100 AND regexp_full_match(x, '[A-Z][A-Z\s]{2,50}|\d+\.?\s+[A-Z][A-Za-z\s]+|SECTION\s+\d+[:\s].+|ARTICLE\s+\d+[:\s].+|PART\s+[A-Z0-9]+[:\s].+') AS head FROM l),
g AS (SELECT *, sum(CAST(head AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM h),
s AS (SELECT doc_id, g, max(x) FILTER (head) AS heading, string_agg(x, chr(10) ORDER BY i) FILTER (NOT head) AS content FROM g WHERE g > 0 GROUP BY 1, 2)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY g) - 1 AS INTEGER) AS place, heading, content FROM s WHERE content IS NOT NULL""")
def doc_sections(spark, sf):
    """Documents with headings of three kinds put around their texts; one of them has nothing below it."""
    line = lambda *parts: F.concat(*(F.lit(x) if isinstance(x, str) else x for x in parts))
    whole = line("before\nSECTION ", (F.col("doc_id") % 7).cast("string"), ": ", F.col("lang"), "\n", F.coalesce("text", F.lit("")), "\nNOTHING BELOW\n2. Closing Words\n ", F.col("source"))
    return text.sections(table(spark, sf, "documents").select("doc_id", whole.alias("text")), body=None, most=None)


@query("WITH RECURSIVE " + _LINKS + """, seeds AS (SELECT min(url) AS url FROM pages_ GROUP BY regexp_extract(url, '^[a-z]+://[^/?]*', 0)),
w AS (SELECT url, 0 AS depth FROM seeds UNION SELECT l.link, w.depth + 1 FROM w JOIN links l ON l.url = w.url WHERE w.depth < 3) SELECT url, min(depth) AS depth FROM w GROUP BY url""")
def page_reach(spark, sf):
    pages = table(spark, sf, "pages")
    links = text.page_links(pages).where("kind <> 'external'").select(F.col("url").alias("source"), F.col("link").alias("target"))
    seeds = pages.select(text.canonical_url(F.col("url")).alias("url")).groupBy(F.regexp_extract("url", "^[a-z]+://[^/?]*", 0)).agg(F.min("url").alias("url"))
    return text.reach(links, seeds)


@query("""SELECT p_partkey AS page_id, 'B' || p_size || '-' || k AS unit_number, 'B' || p_size AS floor_plan_name, CAST(p_partkey + k AS BIGINT) AS price, CAST(p_partkey + 100 AS BIGINT) AS max_price, CAST(p_size AS BIGINT) AS sqft, p_brand AS status, 2 AS bedrooms
FROM part, unnest([1, 2]) AS r(k)""")
def floor_plans(spark, sf):
    plan = "concat('&quot;floorplanName&quot;:[0,&quot;B', p_size, '&quot;],\"maximumRent\":[0,', p_partkey + 100, '],\"minimumRent\":[0,', p_partkey + {}, '], \"sqft\":[0,', p_size, '],\"unitStatus\":[0,\"', p_brand, '\"]')"
    return text.floor_plans(table(spark, sf, "part").select(F.col("p_partkey").alias("page_id"), F.concat(F.expr(plan.format(1)), F.lit("\n"), F.expr(plan.format(2))).alias("html")))


@query(f"SELECT {_fy('payment_date')} AS fy, CAST(quarter(payment_date + INTERVAL 3 MONTH) AS INTEGER) AS fq, {_key('supplier_name')} AS vendor, CAST(sum(payment_amount) AS DOUBLE) AS spend, count(*) AS n FROM payments GROUP BY 1, 2, 3", "payments")
def sql_functions_spend(spark, sf):
    sql_functions.register(spark)
    return spark.sql("SELECT fiscal_year(payment_date) AS fy, fiscal_quarter(payment_date) AS fq, vendor_key(supplier_name) AS vendor, CAST(sum(safe_money(concat('$', payment_amount))) AS DOUBLE) AS spend, count(*) AS n FROM {payments} GROUP BY 1, 2, 3", payments=view(spark, sf, "payments"))


_CODES = "list_filter(list_transform(string_split(nigp_codes, CASE WHEN contains(nigp_codes, ';') THEN ';' ELSE ',' END), lambda x: trim(x)), lambda x: x <> '')"
_CONTRACTS = f"dc AS (SELECT left(md5(CAST(contract_number AS VARCHAR)), 16) AS contract_key, contract_number, coalesce(title, description) AS contract_title, contract_type, coalesce({_CODES}, []) AS nigp_codes, agency_name FROM contracts)"


def _contracts(spark, sf):
    return warehouse.dim_contract(view(spark, sf, "contracts"), ["title", "nigp_codes"], "supplier_name", "contract_amount")


@query("!" + _CONTRACTS + " SELECT contract_key, contract_number, contract_title, contract_type, CAST(NULL AS VARCHAR) AS procurement_method, array_to_string(nigp_codes, '|') AS nigp_codes, '' AS naics_codes, CAST(NULL AS VARCHAR) AS agency_code, agency_name, true AS is_current FROM dc", "contracts")
def dim_contract(spark, sf):
    return warehouse.current_rows(_contracts(spark, sf)).withColumns({c: F.array_join(c, "|") for c in ("nigp_codes", "naics_codes")})


@query("SELECT event_type AS source, count(*) AS rows, CAST(CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS BIGINT) AS unreadable, CAST(CASE WHEN event_type IN ('click', 'view') THEN 7 END AS DOUBLE) AS bad_bytes FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1")
def unreadable_files(spark, sf):
    """A layer of events with a broken file in two sources: rows that are read, and the files that are not."""
    base = shared_folder(spark)
    rows = table(spark, sf, "events").where("ts < TIMESTAMP_NTZ '2024-01-20'").select(F.col("event_type").alias("source"), F.lit(dt.date(2024, 1, 1)).alias("date"), "user_id")
    io.append(rows, base)
    for source in ("click", "view"):
        spark.createDataFrame([("broken",)], "value string").coalesce(1).write.mode("append").text(f"{base}/source={source}/date=2024-01-02")
    bad = io.unreadable_files(spark, base).groupBy(F.regexp_extract("path", "source=([^/]*)", 1).alias("name")).agg(F.count(F.lit(1)).alias("unreadable"), F.max("n_bytes").alias("bad_bytes"))
    read = reduce(DataFrame.unionByName, (io.scan(spark, base, s, dt.date(2023, 1, 1)).select("source") for s in sorted(r[0] for r in rows.select("source").distinct().collect())))
    counts = read.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    return quality.with_unreadable(counts, "source", bad.withColumnRenamed("name", "source")).withColumn("bad_bytes", F.col("bad_bytes").cast("double"))


def _streamed(spark, sf, name: str, files: int = 1) -> DataFrame:
    """A table as a stream of files in the shared folder."""
    rows, path = table(spark, sf, name), shared_folder(spark)
    rows.repartition(files).write.parquet(path)
    return stream.stream_of(spark, path, rows, files)


def _taken(spark, df: DataFrame) -> DataFrame:
    """What a stream writes until nothing is left."""
    out = shared_folder(spark)
    stream.run_available(df, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.schema(df.schema).parquet(f"{out}/rows")


@query("""WITH d AS (SELECT date_trunc('day', ts) AS d, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS s, count(*) AS n FROM events GROUP BY 1)
SELECT strftime(d, '%Y-%m') AS month, CAST(sum(s) AS DECIMAL(28,2)) AS spend, CAST(sum(n) AS BIGINT) AS payments FROM d WHERE d + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 DAY FROM events) GROUP BY 1""")
def stream_monthly_spend(spark, sf):
    """Days that the watermark has closed, added to months."""
    days = stream.monthly_spend(_streamed(spark, sf, "events").withColumns({"ts": F.col("ts").cast("timestamp"), "amount": F.col("value").cast("decimal(18,2)")}), "ts", "amount", "2 days")
    return stream.months_of(_taken(spark, days)).withColumn("spend", F.col("spend").cast("decimal(28,2)"))


@query("SELECT event_type, user_id FROM events GROUP BY 1, 2")
def stream_recent_users(spark, sf):
    """Users of each kind of event, by bounded state that none outgrows."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    recent.with_rocksdb(spark)
    try:
        rows = _streamed(spark, sf, "events", 16).select("event_type", F.col("user_id").cast("string").alias("digest"))
        # So many users of one kind that no slot outgrows its share; slots in plenty deal the kinds over the tasks.
        most = table(spark, sf, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("n")).agg(F.max("n")).first()[0] or 1
        slots = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        return _taken(spark, recent.dedup_recent(rows, "event_type", "digest", most=most * slots, slots=slots)).select("event_type", F.col("digest").cast(dict(table(spark, sf, "events").dtypes)["user_id"]).alias("user_id"))
    finally:
        spark.conf.set(key, before)


@query("SELECT user_id, event_type FROM events GROUP BY 1, 2")
def stream_distinct(spark, sf):
    rows = _streamed(spark, sf, "events", 3).select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    return _taken(spark, stream.dedup_stream(rows, "ts", ["user_id", "event_type"], "3650 days")).select("user_id", "event_type")


@query("SELECT event_type, count(*) FILTER (value >= 10) AS good, count(*) FILTER (NOT value >= 10) AS bad FROM events GROUP BY 1")
def stream_routed(spark, sf):
    """Micro-batches routed by a rule to rows and quarantine."""
    out = shared_folder(spark)
    rule = validate.Rule("value", F.col("value") >= 10, F.lit("value is below 10"))
    stream.route_stream(_streamed(spark, sf, "events", 2), [rule], "events", f"{out}/good", f"{out}/bad", f"{out}/checkpoint")
    good = spark.read.schema("event_type string").parquet(f"{out}/good").select("event_type", F.lit(1).alias("g"))
    bad = spark.read.schema("original string").json(f"{out}/bad").select(F.get_json_object("original", "$.event_type").alias("event_type"), F.lit(0).alias("g"))
    return good.unionByName(bad).groupBy("event_type").agg(F.sum("g").alias("good"), F.sum(1 - F.col("g")).alias("bad"))


@query("""WITH o AS (SELECT event_type, max(ts) AS high FROM events WHERE event_id % 2 = 0 AND event_type <> 'click' GROUP BY 1)
SELECT 'newer' AS step, e.event_type AS source, count(*) AS n, CAST(max(ts) AS VARCHAR) AS high FROM events e LEFT JOIN o ON o.event_type = e.event_type WHERE event_id % 2 = 1 AND (high IS NULL OR ts > high) GROUP BY 2 UNION ALL SELECT 'mark', event_type, 1, CAST(max(ts) AS VARCHAR) FROM events WHERE event_id % 2 = 1 OR event_type <> 'click' GROUP BY 2""")
def watermarks(spark, sf):
    """Stored watermarks of half the rows, without those of one source; what of the other half is newer, and the watermarks after it."""
    e = table(spark, sf, "events")
    state = e.where("event_id % 2 = 0 AND event_type <> 'click'").groupBy(F.col("event_type").alias("source")).agg(F.max("ts").alias("high"))
    rest = e.where("event_id % 2 = 1")
    newer = stream.newer_rows(rest, state, "event_type", "ts").groupBy(F.lit("newer").alias("step"), F.col("event_type").alias("source")).agg(F.count(F.lit(1)).alias("n"), F.max("ts").cast("string").alias("high"))
    return newer.unionByName(stream.advance_watermark(state, rest, "event_type", "ts").select(F.lit("mark").alias("step"), "source", F.lit(1).cast("long").alias("n"), F.col("high").cast("string").alias("high")))


@query("SELECT event_type AS kind, k AS url, h AS content_hash FROM (SELECT DISTINCT event_type, CAST(user_id % 7 AS VARCHAR) AS k, md5(props) AS h FROM events) x WHERE NOT EXISTS (SELECT 1 FROM events o WHERE o.event_id % 3 = 0 AND o.event_type = x.event_type AND CAST(o.user_id % 7 AS VARCHAR) = k AND md5(o.props) = h)")
def unchanged_payloads(spark, sf):
    """Payloads whose signature isn't that of a third of them, which are stored."""
    rows = table(spark, sf, "events").select(F.col("event_type").alias("kind"), (F.col("user_id") % 7).cast("string").alias("url"), F.md5("props").alias("content_hash"), "event_id")
    seen = rows.where("event_id % 3 = 0").select(S.content_signature(F.col("kind"), F.col("url"), F.col("content_hash")).alias("signature"))
    return stream.unchanged_skipped(rows, seen).select("kind", "url", "content_hash")


def _versions(obs: str, key: str, tracked: str) -> str:
    """DuckDB: versions of the rows ``obs`` (load, key, tracked columns, day), later loads winning on a day."""
    cells = ", ".join(f"{c} := {c}" for c in tracked.split(", "))
    return f"""o AS (SELECT *, struct_pack({cells}) AS s, row_number() OVER (PARTITION BY {key}, day ORDER BY load DESC) AS r FROM ({obs})),
c AS (SELECT * FROM (SELECT *, lag(s) OVER (PARTITION BY {key} ORDER BY day) AS last, row_number() OVER (PARTITION BY {key} ORDER BY day) AS i FROM o WHERE r = 1) WHERE i = 1 OR s IS DISTINCT FROM last)
SELECT {key}, {tracked}, day AS effective_date, CAST(lead(day) OVER (PARTITION BY {key} ORDER BY day) AS VARCHAR) AS expiration_date, lead(day) OVER (PARTITION BY {key} ORDER BY day) IS NULL AS is_current FROM c"""


def _history(spark, path: str, columns: tuple[str, ...]) -> DataFrame:
    rows = history.read_history(spark, path)
    return rows.select(*columns, "effective_date", F.col("expiration_date").cast("string").alias("expiration_date"), "is_current")


@query("!" + _DIM + ", " + _versions("""SELECT 1 AS load, supplier_id, supplier_name, false AS is_cbe, DATE '1998-01-01' AS day FROM dim
  UNION ALL SELECT 2, supplier_id, CASE WHEN priority = 2 THEN supplier_name || ' (before)' ELSE supplier_name END, is_cbe, CASE WHEN priority = 2 THEN DATE '1997-06-01' ELSE DATE '1999-01-01' END FROM dim""", "supplier_id", "supplier_name, is_cbe"), "cbe_businesses", "contracts", "payments")
def dim_supplier_history(spark, sf):
    """Two loads: all uncertified, then certifications (changes), old names of contract suppliers (late) and the rest as before."""
    dim, path = materialize(_suppliers(spark, sf)), shared_folder(spark)
    late = F.col("priority") == 2
    warehouse.load_dimension(dim.withColumn("is_cbe", F.lit(False)), path, "supplier_id", warehouse.SUPPLIER_VERSION, F.lit(dt.date(1998, 1, 1)), "1")
    second = dim.withColumn("supplier_name", F.when(late, F.concat("supplier_name", F.lit(" (before)"))).otherwise(F.col("supplier_name")))
    warehouse.load_dimension(second, path, "supplier_id", warehouse.SUPPLIER_VERSION, F.when(late, F.lit(dt.date(1997, 6, 1))).otherwise(F.lit(dt.date(1999, 1, 1))), "2")
    return _history(spark, path, ("supplier_id", *warehouse.SUPPLIER_VERSION))


_AMENDED = "CASE WHEN contract_number % 4 = 0 THEN 'amended' ELSE contract_type END"


@query("!" + _CONTRACTS + ", " + _versions(f"""SELECT 1 AS load, contract_key, contract_title, contract_type, agency_name, DATE '1996-01-01' AS day FROM dc
  UNION ALL SELECT 2, contract_key, CASE WHEN contract_number % 4 = 2 THEN NULL ELSE contract_title END, {_AMENDED}, agency_name, CASE WHEN contract_number % 8 = 0 THEN DATE '1996-01-01' WHEN contract_number % 4 = 2 THEN DATE '1995-01-01' ELSE DATE '1997-01-01' END FROM dc WHERE contract_number % 4 <> 3""", "contract_key", "contract_title, contract_type, agency_name"), "contracts")
def dim_contract_history(spark, sf):
    """Two loads: every contract, then amendments, corrections on the day itself, late rows without a title, confirmations."""
    tracked = ("contract_title", "contract_type", "agency_name")
    # What the loads read alone: the code lists and agency codes would be shuffled and written with every contract.
    dim, path, n = materialize(_contracts(spark, sf).select("contract_key", "contract_number", *tracked)), shared_folder(spark), F.col("contract_number")
    warehouse.load_dimension(dim, path, "contract_key", tracked, F.lit(dt.date(1996, 1, 1)), "1")
    second = dim.where(n % 4 != 3).withColumns({"contract_title": F.when(n % 4 == 2, None).otherwise(F.col("contract_title")), "contract_type": F.when(n % 4 == 0, "amended").otherwise(F.col("contract_type"))})
    day = F.when(n % 8 == 0, F.lit(dt.date(1996, 1, 1))).when(n % 4 == 2, F.lit(dt.date(1995, 1, 1))).otherwise(F.lit(dt.date(1997, 1, 1)))
    warehouse.load_dimension(second, path, "contract_key", tracked, day, "2")
    return _history(spark, path, ("contract_key", *tracked))


_GEO = """ge AS (SELECT left(md5(coalesce(w, 'Unknown') || '_' || coalesce(z, '')), 16) AS geography_key, CASE WHEN w IS NOT NULL THEN 'Ward ' || w END AS ward, CASE WHEN z LIKE '20%' THEN left(z, 5) END AS zip_code,
  min_by(latitude, o) FILTER (latitude IS NOT NULL) AS latitude, min_by(longitude, o) FILTER (latitude IS NOT NULL) AS longitude, min_by(n, o) FILTER (n IS NOT NULL) AS neighborhood
FROM (SELECT place_id + 1000000000 * (place_id % 2) AS o, ward AS w, zip_code AS z, latitude, longitude, CASE WHEN place_id % 2 = 0 THEN neighborhood END AS n FROM places) WHERE w IS NOT NULL OR z IS NOT NULL GROUP BY w, z)"""


def _geographies(spark, sf):
    p = view(spark, sf, "places")
    return warehouse.dim_geography(p.where("place_id % 2 = 0"), p.where("place_id % 2 = 1"), "place_id")


@query("!" + _GEO + " SELECT * FROM ge", "places")
def dim_geography(spark, sf):
    return _geographies(spark, sf)


@query("!" + _GEO + f""", f AS (SELECT left(md5(coalesce(CAST(nullif(contract_number % 12, 0) AS VARCHAR), 'Unknown') || '_' || CAST(20000 + contract_number % 3 AS VARCHAR)), 16) AS k, {_fy('payment_date')} AS fiscal_year, payment_amount, supplier_name FROM payments)
SELECT coalesce(ward, 'Unknown') AS ward, fiscal_year, CAST(sum(payment_amount) AS DECIMAL(28,2)) AS spend, count(*) AS payments, count(DISTINCT supplier_name) AS suppliers FROM f LEFT JOIN ge ON geography_key = k GROUP BY 1, 2""", "places", "payments")
def spend_by_ward(spark, sf):
    n = F.col("contract_number")
    facts = view(spark, sf, "payments").select(warehouse.geography_key(F.nullif(n % 12, F.lit(0)), (20000 + n % 3).cast("string")).alias("geography_key"), S.fiscal_year(F.col("payment_date")).alias("fiscal_year"), F.col("payment_amount").alias("spend_amount"), F.col("supplier_name").alias("supplier_id"))
    return warehouse.spend_by_ward(facts, _geographies(spark, sf))


@query("!" + _CONTRACTS + f""", f AS (SELECT contract_number, {_fy('payment_date')} AS fiscal_year, sum(payment_amount) AS s FROM payments GROUP BY 1, 2), u AS (SELECT f.*, unnest(CASE WHEN len(nigp_codes) > 0 THEN nigp_codes ELSE ['Uncategorized'] END) AS category FROM f LEFT JOIN dc ON dc.contract_number = f.contract_number),
g AS (SELECT category, fiscal_year, CAST(sum(s) AS DECIMAL(28,2)) AS spend, count(DISTINCT contract_number) AS contracts FROM u GROUP BY 1, 2) SELECT *, round(CAST(spend AS DOUBLE) * 100 / nullif(sum(CAST(spend AS DOUBLE)) OVER (PARTITION BY fiscal_year), 0), 4) AS percent FROM g""", "contracts", "payments")
def category_spend(spark, sf):
    facts = view(spark, sf, "payments").select("contract_number", S.fiscal_year(F.col("payment_date")).alias("fiscal_year"), F.col("payment_amount").alias("spend_amount"))
    return warehouse.category_spend(facts, _contracts(spark, sf))


@query("!" + _DIM + f""", s AS (SELECT agency_name, supplier_name, CAST(sum(payment_amount) AS DOUBLE) AS s FROM payments GROUP BY 1, 2), j AS (SELECT s.*, coalesce(is_cbe, false) AS c FROM s LEFT JOIN dim ON supplier_key = {_supplier('s.supplier_name')}),
m AS (SELECT agency_name, 'cbe_spend_goal' AS name, round(coalesce(sum(s) FILTER (c), 0) * 100 / sum(s), 2) AS value FROM j GROUP BY 1 UNION ALL SELECT agency_name, 'vendor_concentration', round(max(s) * 100 / sum(s), 2) FROM j GROUP BY 1)
SELECT *, CASE WHEN name = 'cbe_spend_goal' THEN CASE WHEN value < 30 THEN 'critical' WHEN value < 40 THEN 'warning' WHEN value >= 50 THEN 'met' ELSE 'below target' END ELSE CASE WHEN value > 20 THEN 'critical' WHEN value > 10 THEN 'warning' ELSE 'met' END END AS level FROM m""", "cbe_businesses", "contracts", "payments")
def business_thresholds(spark, sf):
    """Each agency's certified share and its largest supplier's share against the thresholds."""
    sums = view(spark, sf, "payments").groupBy("agency_name", "supplier_name").agg(F.sum("payment_amount").cast("double").alias("s"))
    rows = sums.join(_names(spark, sf).select(F.col("name").alias("supplier_name"), "is_cbe"), "supplier_name", "left").groupBy("agency_name").agg(F.sum("s").alias("all"), F.coalesce(F.sum(F.when(F.col("is_cbe"), F.col("s"))), F.lit(0.0)).alias("cbe"), F.max("s").alias("most"))
    share = lambda name, c: F.struct(F.lit(name).alias("name"), F.round(F.col(c) * 100 / F.col("all"), 2).alias("value"))
    return quality.threshold_levels(rows.select("agency_name", F.inline(F.array(share("cbe_spend_goal", "cbe"), share("vendor_concentration", "most")))))


@query(f"SELECT {_fy('payment_date')} AS fiscal_year, CAST(sum(payment_amount) AS DECIMAL(28,2)) AS spend, count(*) AS payments, round(CAST(CAST(sum(payment_amount) AS DECIMAL(28,2)) AS DOUBLE) / 1e6, 2) AS millions FROM payments WHERE payment_date IS NOT NULL GROUP BY 1", "payments")
def spend_by_year(spark, sf):
    return warehouse.spend_by_year(view(spark, sf, "payments"))


@query(f"""!s AS (SELECT {_fy('payment_date')} AS fiscal_year, strftime(payment_date, '%Y-%m') AS month, CAST(sum(payment_amount) AS DECIMAL(28,2)) AS spend, count(*) AS payments, count(DISTINCT supplier_name) AS suppliers FROM payments WHERE payment_date IS NOT NULL GROUP BY 1, 2),
t AS (SELECT *, CAST(sum(spend) OVER (PARTITION BY fiscal_year ORDER BY month) AS DECIMAL(28,2)) AS running FROM s), l AS (SELECT * FROM t ORDER BY month DESC LIMIT 12) SELECT *, CAST(row_number() OVER (ORDER BY month) AS INTEGER) AS place FROM l""", "payments")
def last_12_months(spark, sf):
    return warehouse.last_months(warehouse.monthly_trend(view(spark, sf, "payments")))


@query("""SELECT 'total_spend' AS view, 'all' AS label, CAST(sum(payment_amount) AS DOUBLE) AS value, count(*) AS n FROM payments UNION ALL SELECT 'ward_value', 'Ward ' || ward, CAST(sum(price) AS DOUBLE), count(*) FROM properties WHERE ward BETWEEN 1 AND 8 AND price > 0 GROUP BY ward
UNION ALL SELECT 'month_spend', strftime(payment_date, '%Y-%m'), CAST(sum(payment_amount) AS DOUBLE), count(*) FROM payments WHERE payment_date IS NOT NULL GROUP BY 2""", "payments", "properties")
def kpi_views(spark, sf):
    return warehouse.kpi_views(view(spark, sf, "payments"), gold.property_values_by_ward(view(spark, sf, "properties")))


@query("SELECT unnest(['orders', 'part', 'supplier']) AS table, unnest([(SELECT count(*) FROM orders), (SELECT count(*) FROM part), (SELECT count(*) FROM supplier)]) AS n")
def table_counts(spark, sf):
    return warehouse.row_counts(**{n: table(spark, sf, n) for n in ("orders", "part", "supplier")})


@query("!" + _FACT + "SELECT dim.supplier_id, supplier_name, is_cbe, CAST(coalesce(sum(spend_amount), 0) AS DECIMAL(28,2)) AS spend, count(fact_id) AS payments FROM dim LEFT JOIN fact f ON f.supplier_id = dim.supplier_id GROUP BY 1, 2, 3", "cbe_businesses", "contracts", "payments")
def supplier_overview(spark, sf):
    star = _star(spark, sf)
    return warehouse.supplier_overview(star["dim_supplier"], star["fact_spend"])


@query("!" + _FACT + """, a AS (SELECT supplier_id, CAST(sum(spend_amount) AS DECIMAL(28,2)) AS spend, min(d) AS first_day, max(d) AS last_day, CAST(coalesce(sum(spend_amount) FILTER (isodow(d) >= 6), 0) AS DECIMAL(28,2)) AS weekend_spend FROM (SELECT *, CAST(strptime(CAST(date_key AS VARCHAR), '%Y%m%d') AS DATE) AS d FROM fact WHERE date_key BETWEEN 19920101 AND 19981231) GROUP BY 1)
SELECT a.*, supplier_name, CASE WHEN spend >= 10000000 THEN 'Enterprise' WHEN spend >= 1000000 THEN 'Large' WHEN spend >= 100000 THEN 'Medium' ELSE 'Small' END AS tier FROM a JOIN dim ON dim.supplier_id = a.supplier_id""", "cbe_businesses", "contracts", "payments")
def supplier_activity(spark, sf):
    star = _star(spark, sf)
    return warehouse.supplier_activity(star["dim_supplier"], star["fact_spend"], warehouse.dim_date(spark, dt.date(1992, 1, 1), dt.date(1998, 12, 31)))


@query("""!m AS (SELECT supplier_name, (1998 - CAST(year(payment_date) AS INTEGER)) * 12 + 1 - CAST(month(payment_date) AS INTEGER) AS back, CAST(sum(payment_amount) AS DECIMAL(28,2)) AS s FROM payments WHERE payment_date IS NOT NULL GROUP BY 1, 2)
SELECT supplier_name, CAST(sum(s) AS DOUBLE) AS spend_last_12m, CAST(coalesce(sum(s) FILTER (back <= 6), 0) AS DOUBLE) AS spend_last_6m, round(-(12.0::DOUBLE * sum(CAST(back AS DOUBLE) * CAST(s AS DOUBLE)) - 78.0::DOUBLE * sum(CAST(s AS DOUBLE))) / 1716.0::DOUBLE, 4) AS spend_trend FROM m WHERE back BETWEEN 1 AND 12 GROUP BY 1""", "payments")
def vendor_recent_spend(spark, sf):
    return features.recent_spend(view(spark, sf, "payments"), dt.date(1998, 1, 1))


@query("!" + _DIM + f""", q AS (SELECT agency_name, {_fy('payment_date')} AS fiscal_year, supplier_name, CAST(sum(payment_amount) AS DECIMAL(28,2)) AS s FROM payments WHERE payment_date IS NOT NULL GROUP BY 1, 2, 3),
j AS (SELECT q.*, is_cbe, row_number() OVER (PARTITION BY agency_name, fiscal_year ORDER BY s DESC, q.supplier_name) AS r FROM q LEFT JOIN dim ON supplier_key = {_supplier('q.supplier_name')})
SELECT agency_name, fiscal_year, CAST(coalesce(sum(s) FILTER (is_cbe), 0) AS DOUBLE) AS cbe_spend, round(coalesce(CAST(coalesce(sum(s) FILTER (is_cbe), 0) AS DOUBLE) * 100 / nullif(CAST(sum(s) AS DOUBLE), 0), 0), 4) AS cbe_spend_pct, max(supplier_name) FILTER (r = 1) AS top_vendor FROM j GROUP BY 1, 2""", "cbe_businesses", "contracts", "payments")
def agency_cbe_spend(spark, sf):
    return features.agency_cbe_spend(view(spark, sf, "payments"), _names(spark, sf))


@query("""SELECT CAST(k AS INTEGER) AS source_number, doc_id, length, size FROM (SELECT 0 AS k, doc_id, length(text) AS length, NULL AS size FROM documents UNION ALL SELECT 1, page_id, NULL, length(html) FROM pages)""")
def union_sources(spark, sf):
    a = table(spark, sf, "documents").select("doc_id", F.length("text").alias("length"))
    b = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.length("html").alias("size"))
    return dedup.union_sources(a, b)


@query("""SELECT k, contract_number, url FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY contract_number) AS r FROM (SELECT *, nullif(contract_number // 40, 3) AS k FROM contracts) WHERE trim(coalesce(url, '')) <> '') WHERE r = 1 OR k IS NULL""", "contracts")
def first_with_url(spark, sf):
    c = view(spark, sf, "contracts").withColumn("k", F.nullif(F.floor(F.col("contract_number") / 40), F.lit(3)))
    return dedup.first_with_url(c, "k", "url", "contract_number").select("k", "contract_number", "url")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'moved' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 5 <> 0 OR c_custkey % 3 = 0")
def upserted_customers(spark, sf):
    """A stored table without every fifth customer, then a load of every third one."""
    c, path = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), shared_folder(spark)
    keyed.write_keyed(c.where("c_custkey % 5 <> 0"), path, ["c_custkey"], 16)
    keyed.upsert_keyed(spark, path, c.where("c_custkey % 3 = 0").withColumns({"c_mktsegment": F.lit("moved"), "c_acctbal": F.col("c_acctbal") + 1}), ["c_custkey"])
    return keyed.read_keyed(spark, path)


@query("SELECT nullif(c_custkey % 40, 7) AS slot, min(c_nationkey) AS c_nationkey FROM customer GROUP BY 1 UNION ALL SELECT 100 + n_nationkey, n_nationkey FROM nation")
def inserted_if_absent(spark, sf):
    """Keys, one of them null, that a second load repeats in part: the first rows stay."""
    path = shared_folder(spark)
    first = table(spark, sf, "customer").groupBy(F.nullif(F.col("c_custkey") % 40, F.lit(7)).alias("slot")).agg(F.min("c_nationkey").alias("c_nationkey"))
    keyed.write_keyed(first, path, ["slot"], 16)
    repeated = first.withColumn("c_nationkey", F.lit(-1).cast(dict(first.dtypes)["c_nationkey"]))
    news = table(spark, sf, "nation").select((100 + F.col("n_nationkey")).cast(dict(first.dtypes)["slot"]).alias("slot"), F.col("n_nationkey").cast(dict(first.dtypes)["c_nationkey"]).alias("c_nationkey"))
    keyed.insert_keyed(spark, path, repeated.unionByName(news), ["slot"])
    return keyed.read_keyed(spark, path)


@query("SELECT DISTINCT agency_name FROM payments WHERE agency_name IS NOT NULL", "payments")
def distinct_agencies(spark, sf):
    return dedup.distinct_values(view(spark, sf, "payments"), "agency_name")


def _star(spark, sf):
    payments, known, names = _loaded(spark, sf)
    suppliers = warehouse.current_rows(warehouse.suppliers_of(names).withColumn("is_current", F.lit(True)))
    contracts = _contracts(spark, sf).withColumn("contract_key", F.col("contract_number"))
    facts = warehouse.fact_spend(payments, names, known)
    return {"fact_spend": facts, "dim_supplier": suppliers, "dim_contract": contracts}


@query("!" + _FACT + ", " + _CONTRACTS + """ SELECT contract_type, is_cbe, CAST(sum(spend_amount) AS DOUBLE) AS total_spend, count(*) AS payment_count, count(DISTINCT fact.supplier_id) AS vendor_count, round(CAST(sum(spend_amount) AS DOUBLE) / count(spend_amount), 4) AS average_payment, quantile_cont(CAST(spend_amount AS DOUBLE), 0.5) AS median_payment
FROM fact LEFT JOIN dim ON dim.supplier_id = fact.supplier_id LEFT JOIN dc ON dc.contract_number = fact.contract_key WHERE fiscal_year >= 1995 GROUP BY 1, 2""", "cbe_businesses", "contracts", "payments")
def semantic_query(spark, sf):
    figures = ["total_spend", "payment_count", "vendor_count", "average_payment", "median_payment"]
    return semantic.PROCUREMENT.query(_star(spark, sf), figures, ["contract_type", "is_cbe"], "fiscal_year >= 1995")


@query("!" + _FACT + """ SELECT agency_name AS agency, fiscal_year, count(DISTINCT contract_key) AS contract_count, CAST(coalesce(sum(CASE WHEN is_cbe THEN spend_amount ELSE 0 END), 0) AS DOUBLE) AS cbe_spend, round(coalesce(CAST(sum(spend_amount) FILTER (is_cbe) AS DOUBLE) * 100 / CAST(sum(spend_amount) AS DOUBLE), 0), 4) AS cbe_share
FROM fact LEFT JOIN dim ON dim.supplier_id = fact.supplier_id GROUP BY 1, 2""", "cbe_businesses", "contracts", "payments")
def semantic_certified(spark, sf):
    """Measures whose expressions alone say that suppliers are joined."""
    return semantic.PROCUREMENT.query(_star(spark, sf), ["contract_count", "cbe_spend", "cbe_share"], ["agency", "fiscal_year"])


@query(f"""SELECT ward, bedrooms AS bedroom_count, count(*) AS property_count, CAST(sum(price) AS DOUBLE) AS total_assessed_value, round(CAST(sum(price) AS DOUBLE) / count(price), 4) AS avg_assessed_value, quantile_cont(CAST(price AS DOUBLE), 0.5) AS median_assessed_value,
  round(CAST(sum(CAST(CAST(price AS DOUBLE) / nullif(sqft, 0) AS DECIMAL(28,8))) AS DOUBLE) / count(sqft), 4) AS avg_price_per_sqft, CAST(sum(sqft) AS DOUBLE) AS total_square_footage, round(CAST(sum({AS_OF.year} - year_built) AS DOUBLE) / count(year_built), 4) AS avg_property_age FROM properties WHERE ward <= 8 GROUP BY 1, 2""", "properties")
def semantic_real_estate(spark, sf):
    model = semantic.real_estate(AS_OF)
    return model.query({"properties": view(spark, sf, "properties")}, list(model.measures), ["ward", "bedroom_count"], "ward <= 8")


@query("!" + _FACT + """, b AS (SELECT fact.*, supplier_name, is_cbe FROM fact LEFT JOIN dim ON dim.supplier_id = fact.supplier_id), s AS (SELECT supplier_name, CAST(sum(spend_amount) AS DOUBLE) AS v FROM b WHERE supplier_name IS NOT NULL GROUP BY 1 ORDER BY v DESC, supplier_name LIMIT 10)
SELECT 'kpi' AS section, 'total_spend' AS label, CAST(sum(spend_amount) AS DOUBLE) AS value FROM b UNION ALL SELECT 'kpi', 'payment_count', CAST(count(*) AS DOUBLE) FROM b UNION ALL SELECT 'kpi', 'vendor_count', CAST(count(DISTINCT supplier_id) AS DOUBLE) FROM b UNION ALL SELECT 'kpi', 'average_payment', round(CAST(sum(spend_amount) AS DOUBLE) / count(spend_amount), 4) FROM b
UNION ALL SELECT 'year', CAST(fiscal_year AS VARCHAR), CAST(sum(spend_amount) AS DOUBLE) FROM b GROUP BY fiscal_year UNION ALL SELECT 'agency', agency_name, CAST(sum(spend_amount) AS DOUBLE) FROM b GROUP BY agency_name UNION ALL SELECT 'cbe', CAST(coalesce(is_cbe, false) AS VARCHAR), CAST(sum(spend_amount) AS DOUBLE) FROM b GROUP BY coalesce(is_cbe, false) UNION ALL SELECT 'supplier', supplier_name, v FROM s""", "cbe_businesses", "contracts", "payments")
def dashboard(spark, sf):
    return semantic.dashboard(_star(spark, sf))
