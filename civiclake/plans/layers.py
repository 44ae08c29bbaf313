"""Registered queries of scalar functions, layer reads and writes, quality and builders, over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civiclake.functions import scalars as S
from civiclake.operators import features, ingest, quality, text, validate, warehouse
from civiclake.plans import semantic
from civiclake.plans.bindings import table, view
from civiclake.plans.builder import run_builder
from civiclake.plans.catalog import AS_OF, query
from civiclake.sources import io
from civiclake.sources.scratch import shared_folder


@query("""WITH r AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, o_totalprice AS t, o_orderpriority AS p FROM orders)
SELECT k, CASE k % 4 WHEN 0 THEN strftime(d, '%Y-%m-%d') || ' 10:20:30' WHEN 1 THEN strftime(d, '%Y-%m-%d') || ' 00:00:00' WHEN 2 THEN strftime(d, '%Y-%m-%d') || ' 00:00:00' END AS stamp, CASE WHEN k % 3 = 0 THEN NULL ELSE '1202555' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') END AS phone,
  CASE WHEN k % 2 = 0 THEN strftime(d, '%Y-%m-%d') END AS from_ms, sha256(p || '|u' || k % 5 || '|' || k % 3) AS signature, CASE k % 3 WHEN 0 THEN 10000.0 WHEN 1 THEN 5.0 ELSE 0.0 END::DOUBLE AS lo, CASE k % 3 WHEN 0 THEN 25000.0 WHEN 1 THEN 75.0 ELSE 0.0 END::DOUBLE AS hi,
  CAST(CASE WHEN k % 2 = 0 THEN 12.5 WHEN k % 3 = 0 THEN 7 ELSE 3 END AS DOUBLE) AS assessed, CASE k % 4 WHEN 0 THEN 'townhouse' WHEN 1 THEN 'condo' ELSE 'single_family' END AS structure, CASE WHEN t * 100 >= 10000000 THEN '$10M+' WHEN t * 100 >= 1000000 THEN '$1M-$10M' WHEN t * 100 >= 100000 THEN '$100K-$1M' ELSE 'Under $100K' END AS size,
  strftime(d, '%Y-%m-%d') AS day_part, CASE WHEN k % 2 = 0 THEN p END AS from_json FROM r""")
def scalar_functions(spark, sf):
    """Functions on texts that are built from the orders, some of them spoiled."""
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date")
    pick = lambda n, *cs: F.element_at(F.array(*(c if not isinstance(c, str) else F.lit(c) for c in cs)), (k % n + 1).cast("int"))
    iso = F.date_format(d, "yyyy-MM-dd")
    stamp = pick(4, F.concat(iso, F.lit("T10:20:30")), F.date_format(d, "MM/dd/yyyy"), F.date_format(d, "MMMM d, yyyy"), "some day")
    amount = pick(3, "$10,000 - $25,000", "between 5 and 75", "none")
    rows = o.select(
        k.alias("k"), F.date_format(S.safe_timestamp(stamp), "yyyy-MM-dd HH:mm:ss").alias("stamp"), S.clean_phone(F.when(k % 3 == 0, "12-34").otherwise(F.concat(F.lit("1 (202) 555-"), F.lpad((k % 10000).cast("string"), 4, "0")))).alias("phone"),
        S.epoch_date(F.when(k % 2 == 0, F.unix_date(d).cast("bigint") * 86_400_000).otherwise(17).cast("string")).alias("from_ms"), S.content_signature(F.col("o_orderpriority"), F.concat(F.lit("u"), (k % 5).cast("string")), (k % 3).cast("string")).alias("signature"), S.amount_range(amount).alias("range"),
        S.assessed_value(F.when(k % 2 == 0, "12.5"), F.when(k % 3 == 0, '{"assessment": 7}').otherwise("{}"), F.lit("3")).cast("double").alias("assessed"), S.structure_type(pick(4, "Row Inside", "CONDO", "Detached house", "Villa")).alias("structure"), S.spend_size(F.col("o_totalprice") * 100).alias("size"),
        S.iso_day(F.concat(iso, F.lit("T01:02:03Z"))).alias("day_part"), S.json_map(F.when(k % 2 == 0, F.to_json(F.struct(F.col("o_orderpriority").alias("p")))).otherwise("no json"))["p"].alias("from_json"),
    )
    return rows.select("k", "stamp", "phone", "from_ms", "signature", "range.lo", "range.hi", "assessed", "structure", "size", "day_part", "from_json")


@query("""WITH r AS (SELECT user_id % 3 AS g, event_type, value, CAST(ts AS DATE) AS d FROM events)
SELECT event_type AS source, CAST(d AS VARCHAR) AS date, count(*) AS n, round(sum(value), 4) AS total, count(*) FILTER (g = 0) AS typed, count(*) FILTER (g = 1) AS extra FROM r WHERE event_type IN ('click', 'view') AND d BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' GROUP BY 1, 2""")
def layer_round_trip(spark, sf):
    """Two appends to a layer, the second with more columns, schema enforced; one source is read between two days."""
    base = shared_folder(spark)
    rows = table(spark, sf, "events").select(F.col("event_type").alias("source"), F.col("ts").cast("date").alias("date"), F.col("value").cast("string").alias("value"), (F.col("user_id") % 3).cast("int").alias("g"))
    schema = StructType.fromDDL("value double, label string, source string, date date")
    io.append(rows.where("g = 0").drop("g"), base, 5000, schema)
    io.append(rows.where("g <> 0").withColumn("more", F.col("g")).drop("g"), base, 5000, schema)
    one = lambda s: io.scan(spark, base, s, dt.date(2024, 1, 5), dt.date(2024, 1, 12))
    read = one("click").unionByName(one("view"))
    typed = F.count_if(F.col("value").isNotNull() & F.col("label").isNull() & F.col("more").isNull())
    return read.groupBy("source", F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"), typed.alias("typed"), F.count_if(F.col("more") == 1).alias("extra"))


@query("SELECT 'limit' AS what, least(count(*), 7) AS n FROM events WHERE event_type = 'click' UNION ALL SELECT 'json', count(*) FROM nation UNION ALL SELECT 'series', 12 * count(*) FROM nation UNION ALL SELECT 'payloads', count(DISTINCT r_name) FROM region UNION ALL SELECT 'run', count(*) FROM region UNION ALL SELECT 'latest', count(*) FROM nation")
def layer_files(spark, sf):
    """A limit on a scan, JSON arrays, a CSV of months, raw payload files, and a dataset that is swapped."""
    base, n, r = shared_folder(spark), table(spark, sf, "nation"), table(spark, sf, "region")
    io.append(table(spark, sf, "events").select(F.col("event_type").alias("source"), F.col("ts").cast("date").alias("date"), "value"), f"{base}/layer")
    arrays = n.groupBy("n_regionkey").agg(F.to_json(F.collect_list(F.struct("n_name", "n_nationkey"))).alias("value")).select("value")
    arrays.repartition(5).write.text(f"{base}/json")
    n.select("n_name", *((F.col("n_nationkey") + k).alias(f"20{10 + k}-01") for k in range(15))).write.option("header", True).csv(f"{base}/csv")
    r.select("r_name").repartition(5, "r_name").write.text(f"{base}/raw")
    io.swap(r, f"{base}/data", "1")
    io.swap(n, f"{base}/swapped")
    io.swap(n, f"{base}/swapped")
    counts = {
        "limit": io.scan(spark, f"{base}/layer", "click", limit=7), "json": io.json_array(spark, f"{base}/json"), "series": io.series_csv(spark, f"{base}/csv", ["n_name"]),
        "payloads": io.raw_files(spark, f"{base}/raw").select(F.explode(F.split(F.col("content").cast("string"), "\n")).alias("x")).where("x <> ''").distinct(), "run": spark.read.parquet(f"{base}/data"), "latest": spark.read.parquet(f"{base}/swapped"),
    }
    return warehouse.row_counts(**counts).withColumnRenamed("table", "what")


@query("""SELECT 'spend{source="' || replace(n_name, ' ', ' ') || '"} ' || CAST(n_nationkey AS VARCHAR) || '.0' AS line FROM nation UNION ALL SELECT 'odd{source="a\\\\b\\"c\\nd"} 1.0'""")
def metric_lines(spark, sf):
    """Metrics as lines of text, label values escaped."""
    rows = table(spark, sf, "nation").select(F.lit("spend").alias("name"), F.col("n_name").alias("source"), F.col("n_nationkey").cast("double").alias("value"))
    odd = spark.createDataFrame([("odd", 'a\\b"c\nd', 1.0)], "name string, source string, value double")
    return io.prometheus_lines(rows.unionByName(odd)).select(F.col("value").alias("line"))


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS record_id, CAST(l_extendedprice AS DECIMAL(18,2))::DOUBLE AS payment_amount, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS payment_date, CAST(NULL AS VARCHAR) AS agency_name, l_linenumber AS line FROM lineitem""")
def conformed_payments(spark, sf):
    """Texts put into the registered schema of payments; a field it lacks stays, last."""
    l = table(spark, sf, "lineitem")  # noqa: E741
    raw = l.select(F.col("l_linenumber").alias("line"), F.col("l_shipdate").cast("date").cast("string").alias("payment_date"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("payment_amount"), F.col("l_orderkey").cast("string").alias("record_id"))
    return io.conform_to(raw, "payment").select("record_id", F.col("payment_amount").cast("double").alias("payment_amount"), F.col("payment_date").cast("string").alias("payment_date"), "agency_name", "line")


@query("SELECT doc_id % 3 AS kind, count(*) AS n FROM documents WHERE doc_id % 3 <> 0 AND length(trim(left(text, 12))) >= 10 GROUP BY 1")
def valid_attachments(spark, sf):
    d = table(spark, sf, "documents").select(F.when(F.col("doc_id") % 3 != 0, F.col("doc_id").cast("string")).alias("contract_id"), F.substring("text", 1, 12).alias("text"), (F.col("doc_id") % 3).alias("kind"))
    return validate.route(d, validate.rules_for("attachments", d.columns), "attachments")[0].groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT CAST(x AS VARCHAR) AS kind, count(*) AS n FROM (SELECT ['pdf', 'office', 'zip', 'ole', 'unknown'][doc_id % 5 + 1] AS x FROM documents) GROUP BY 1""")
def file_types(spark, sf):
    """Bytes of five kinds of files in front of texts."""
    heads = [F.unhex(F.lit(h)) for h in ("255044462D", "504B030414000600" + b"[Content_Types].xml".hex(), "504B030414000600", "D0CF11E0A1B11AE1", "")]
    d = table(spark, sf, "documents").select(F.element_at(F.array(*heads), (F.col("doc_id") % 5 + 1).cast("int")).alias("head"), F.encode(F.concat(F.lit("text "), F.coalesce("lang", F.lit(""))), "UTF-8").alias("rest"))
    return d.select(text.file_type(F.concat("head", "rest")).alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def _half_null(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("half"), F.when(F.col("o_orderkey") % 100 == 0, F.col("o_custkey")).alias("few"))


_NULLS = "n AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 2 <> 0) AS half, count(*) FILTER (o_orderkey % 100 <> 0) AS few FROM orders)"


@query(f"""WITH {_NULLS}, r AS (SELECT 'o_orderkey' AS field, 0.0::DOUBLE AS rate UNION ALL SELECT 'half', round(half / n, 6) FROM n UNION ALL SELECT 'few', round(few / n, 6) FROM n)
SELECT 'high' AS what, field, rate, CAST(NULL AS DOUBLE) AS change FROM r WHERE rate >= 0.5 UNION ALL SELECT 'summary', 'avg', round(avg(rate), 6), CAST(count(*) FILTER (rate >= 0.9) AS DOUBLE) FROM r UNION ALL SELECT 'drift', field, rate, round(rate, 6) FROM r WHERE rate >= 0.1""")
def null_reports(spark, sf):
    """Columns of many nulls, their summary, and the drift against a table without nulls."""
    rates = quality.null_rates(_half_null(spark, sf), "o")
    full = quality.null_rates(table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("half")), "o")
    none = F.lit(None).cast("double")
    out = quality.high_null(rates).select(F.lit("high").alias("what"), F.col("column").alias("field"), "rate", none.alias("change"))
    out = out.unionByName(quality.null_summary(rates).select(F.lit("summary").alias("what"), F.lit("avg").alias("field"), F.col("avg_rate").alias("rate"), F.col("mostly_null").cast("double").alias("change")))
    return out.unionByName(quality.null_drift(full, rates).select(F.lit("drift").alias("what"), F.col("column").alias("field"), "rate", "change"))


@query(f"WITH {_NULLS} SELECT CAST(n AS BIGINT) AS rows, CAST(3 AS BIGINT) AS files, CAST(1 AS BIGINT) AS partitions, round((half / n + few / n) / 3, 4) AS avg_null_rate, 'fresh' AS soon, 'critical' AS late FROM n")
def dataset_state(spark, sf):
    """Statistics of a stored dataset of three files, and its age against a limit it keeps and one it misses."""
    path = shared_folder(spark)
    _half_null(spark, sf).repartition(3).write.parquet(path)
    stats = quality.dataset_stats(spark, path).select("rows", "files", "partitions", F.round("avg_null_rate", 4).alias("avg_null_rate"))
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    age = lambda hours, name, at: quality.freshness(spark, path, at, hours).select(F.col("status").alias(name))
    return stats.crossJoin(age(24 * 30, "soon", now)).crossJoin(age(1, "late", now + dt.timedelta(days=30)))


@query("""SELECT 'new' AS change, unnest(['text', 'n_chars']) AS column, CAST(NULL AS VARCHAR) AS severity UNION ALL SELECT 'missing', 'title', NULL UNION ALL SELECT source, 'size', CASE WHEN sum(length(text)) > 20000 THEN 'critical' ELSE 'warning' END FROM documents GROUP BY source HAVING sum(length(text)) > 5000""")
def drift_and_alerts(spark, sf):
    """Fields that are new or missing, and sources whose size meets a rule of warning at least."""
    d = table(spark, sf, "documents")
    drift = quality.schema_drift(d, ["doc_id", "lang", "source", "title"]).select("change", "column", F.lit(None).cast("string").alias("severity"))
    sizes = d.groupBy(F.col("source").alias("at")).agg(F.sum(F.length("text")).alias("value")).select("at", F.lit("size").alias("name"), "value")
    rules = [("size", "value > 0", "info", "any"), ("size", "value > 5000 AND value <= 20000", "warning", "large"), ("size", "value > 20000", "critical", "very large")]
    met = quality.alerts(sizes, rules, "warning").join(sizes, ["name", "value"])
    return drift.unionByName(met.select(F.col("at").alias("change"), F.col("name").alias("column"), "severity").distinct())


class _Big:
    """A user's own dataset: large orders, their price in thousands."""

    name = "big_orders"

    def transform(self, spark, inputs):
        return inputs["orders"].where("o_totalprice > 1000").select("o_orderkey", (F.col("o_totalprice") / 1000).alias("thousands"))

    def schema(self) -> StructType:
        return StructType.fromDDL("o_orderkey long, thousands double, note string")

    def rules(self):
        return [validate.Rule("small", F.col("thousands") < 200, F.lit("too much"))]


@query("SELECT 'big_orders' AS name, count(*) FILTER (o_totalprice / 1000 < 200) AS written, count(*) FILTER (NOT o_totalprice / 1000 < 200) AS quarantined FROM orders WHERE o_totalprice > 1000")
def built_dataset(spark, sf):
    path = shared_folder(spark)
    built = run_builder(spark, _Big(), {"orders": table(spark, sf, "orders")}, f"{path}/data", f"{path}/quarantine")
    waiting = io.read_quarantine(spark, f"{path}/quarantine").count()
    return spark.createDataFrame([(built.name, built.written, waiting)], "name string, written long, quarantined long")


@query("SELECT upper(o_orderpriority) AS agency_name, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1")
def transformed_records(spark, sf):
    """A user's own step on normalized records."""
    raw = table(spark, sf, "orders").select(F.col("o_orderkey").alias("CONTRACT_NUMBER"), F.col("o_orderpriority").alias("AGENCY_NAME"))
    step = lambda df: df.where("contract_number % 2 = 0").withColumn("agency_name", F.upper("agency_name"))
    return ingest.ingest(raw, ingest.sources()["contracts"], step)[0].groupBy("agency_name").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT 'view' AS what, 'v_real_estate_ward' AS name, count(DISTINCT ward) AS n FROM properties WHERE ward IS NOT NULL UNION ALL SELECT 'view', 'v_real_estate_bedroom_count', count(DISTINCT bedrooms) FROM properties UNION ALL SELECT 'measure', 'property_count', count(*) FROM properties
UNION ALL SELECT 'refreshed', 'cheap', count(*) FROM properties WHERE price < 1000 UNION ALL SELECT 'set', 'prices', 3""", "properties")
def model_views(spark, sf):
    """Views of a model and a refreshed one, by their rows; the columns of a stored feature set."""
    p, model, base = view(spark, sf, "properties"), semantic.real_estate(AS_OF), shared_folder(spark)
    model.create_views({"properties": p})
    warehouse.refresh_views(spark, {"cheap": lambda s: p.where("price < 1000"), "other": lambda s: p.limit(0)}, ["cheap"])
    p.select("property_id", "price", "ward").write.parquet(f"{base}/prices")
    rows = lambda what, name, n: n.select(F.lit(what).alias("what"), F.lit(name).alias("name"), F.col(n.columns[0]).cast("long").alias("n"))
    count = lambda df: df.agg(F.count(F.lit(1)))
    out = rows("view", "v_real_estate_ward", count(spark.table("v_real_estate_ward"))).unionByName(rows("view", "v_real_estate_bedroom_count", count(spark.table("v_real_estate_bedroom_count"))))
    out = out.unionByName(rows("measure", "property_count", spark.table("v_real_estate_measures").select("property_count"))).unionByName(rows("refreshed", "cheap", count(spark.table("cheap"))))
    sets = features.feature_sets(spark, base).groupBy("feature_set").agg(F.count(F.lit(1)).alias("n"))
    return out.unionByName(sets.select(F.lit("set").alias("what"), F.col("feature_set").alias("name"), "n"))


@query("SELECT property_id, CAST(price AS DOUBLE) AS price, city FROM properties WHERE property_id % 10 = 3", "properties")
def feature_reads(spark, sf):
    """A feature store read of some entities and some columns."""
    p = view(spark, sf, "properties").withColumn("price", F.col("price").cast("double"))
    return features.features_of(p, "property_id", p.where("property_id % 10 = 3").select("property_id"), ["price", "city"])


@query("SELECT 'properties' AS dataset, count(*) AS row_count, CAST(17 AS BIGINT) AS n_fields, 'bigint' AS id_type, 'a key' AS id_text FROM properties", "properties")
def feature_docs(spark, sf):
    p = view(spark, sf, "properties")
    meta = features.dataset_metadata(p, "properties", dt.datetime(2024, 1, 1)).select("dataset", "row_count", F.size("fields").cast("long").alias("n_fields"))
    told = features.feature_schema(p, {"property_id": "a key"}).where("column = 'property_id'").select(F.col("type").alias("id_type"), F.col("description").alias("id_text"))
    return meta.crossJoin(told)
