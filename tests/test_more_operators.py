"""Operators on small tables by hand: order without one task, links, rules, records, layers, streams, builders, views."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civiclake.functions import scalars as S
from civiclake.operators import dedup, features, gold, ingest, order, quality, text, validate, warehouse
from civiclake.plans import builder, semantic
from civiclake.sources import io
from civiclake.streaming import stream


def test_ranks_and_percentiles(spark):
    """Against sorting in Python, with ties, negative, huge and null values."""
    rnd = random.Random(6)
    rows = [(f"k{i:04d}", rnd.choice([0.0, 1.0, -3.5, 1e12, rnd.uniform(-1e6, 1e6), rnd.uniform(0, 1)])) for i in range(900)] + [("n1", None), ("n0", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    want = [k for k, v in sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))]
    assert [r.k for r in order.ranked(df, "v", "k").orderBy("place").collect()] == want
    values = sorted(v for _, v in rows if v is not None)
    got = order.index_percentile(df, [], "v", (0, 1, 50, 99, 100)).first()
    assert list(got) == [values[min(len(values) * p // 100, len(values) - 1)] for p in (0, 1, 50, 99, 100)]
    assert order.index_percentile(df.where("v > 1e20"), [], "v", (50,)).first()[0] is None
    by = {r.g: r.p25 for r in order.index_percentile(df.withColumn("g", F.substring("k", -1, 1)), ["g"], "v", (25,)).collect()}
    for g in "0123456789":
        some = sorted(v for k, v in rows if v is not None and k[-1] == g)
        assert by[g] == some[len(some) * 25 // 100]


@pytest.mark.parametrize(
    "link, want",
    [
        ("z.html", "https://a.gov/x/z.html"), ("../up", "https://a.gov/up"), ("../../../up", "https://a.gov/up"), ("./q/./r/..", "https://a.gov/x/q/"), ("//cdn.org/f", "https://cdn.org/f"),
        ("/root?a=../b", "https://a.gov/root?a=../b"), ("?p=2", "https://a.gov/x/y.html?p=2"), ("HTTP://B.org/P", "http://b.org/P"), ("a.html#top", "https://a.gov/x/a.html"), ("q?a=1&amp;b=2", "https://a.gov/x/q?a=1&b=2"),
    ],
)
def test_resolved_links(spark, link, want):
    for quote in ('"', "'"):
        page = spark.createDataFrame([(1, "https://a.gov/x/y.html", f"<a class=k href={quote}{link}{quote}>t</a>")], "page_id int, url string, html string")
        assert [r.link for r in text.page_links(page).collect()] == [want]


def test_link_kinds(spark):
    html = "<a href='https://a.gov.evil.com/'>1</a><a href=\"https://A.gov/b\">2</a><a href=/c.PDF>3</a><a href='#x'>4</a><a href='mailto:a@b.c'>5</a><a href='JavaScript:void(0)'>6</a><script><a href='/no'></script><a href='https://user@a.gov:80/d'>7</a>"
    got = {r.link: r.kind for r in text.page_links(spark.createDataFrame([(1, "https://a.gov", html)], "page_id int, url string, html string")).collect()}
    assert got == {"https://a.gov.evil.com/": "external", "https://a.gov/b": "internal", "https://a.gov/c.PDF": "pdf", "https://user@a.gov:80/d": "internal"}
    many = spark.createDataFrame([(1, 9 - i, f"l{i:02d}", "pdf") for i in range(9)], "page_id int, place int, link string, kind string")
    assert [r.link for r in text.capped_links(many, {"pdf": 3}).orderBy("place").collect()] == ["l08", "l07", "l06"]


def test_page_and_file_details(spark):
    html = '<meta name="description" content=" A &amp; B "><title> T </title><h2>one</h2><p>x<noscript>hidden</noscript> y'
    r = text.page_parts(spark.createDataFrame([(1, "HTTP://A.gov/p#f", html), (2, None, None)], "page_id int, url string, html string")).orderBy("page_id").collect()
    assert (r[0].url, r[0].title, r[0].description, r[0].headings) == ("http://a.gov/p", "T", "A & B", ["one"]) and "hidden" not in r[0].text and r[1].title is None
    files = {b"%PDF-1.7": "pdf", b"PK\x03\x04\x14\x00\x06\x00......[Content_Types].xml": "office", b"PK\x03\x04abcd": "zip", bytes.fromhex("D0CF11E0A1B11AE1"): "ole", b"x": "unknown"}
    got = {bytes(r.b): r.t for r in spark.createDataFrame([(b,) for b in files], "b binary").select("b", text.file_type(F.col("b")).alias("t")).collect()}
    assert got == files


def one(spark, fn, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(fn(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first().x


def test_safe_values_stay_safe(spark):
    for odd in ("9007199254740993", "99999999999999999999", "253402300800000", "1e400", "1705276800000.5"):
        assert one(spark, S.safe_date, odd) is None, odd
        assert one(spark, S.epoch_date, odd) in (None, "2024-01-15")
    assert str(one(spark, S.safe_date, "253402300799999")) == "9999-12-31"
    assert one(spark, S.safe_int, "9007199254740993") == 9007199254740993 and one(spark, S.safe_int, "-12.9") == -12 and one(spark, S.safe_int, "99999999999999999999") is None
    assert one(spark, S.code_list, " a ; b;;c ") == ["a", "b", "c"] and one(spark, S.code_list, "x, y ,") == ["x", "y"]
    assert float(one(spark, S.assessed_value, None, '{"ASSESSMENT": "0"}', "5")) == 0.0
    assert [one(spark, S.composite_id, "a", None), one(spark, S.zip_plus_four, "501", "12"), one(spark, S.lot_address, "12", " Main ", None)] == ["a", "00501-0012", "12 Main"]
    assert [one(spark, S.metric_category, x) for x in ("ZORI", "rent_avg", "for_sale_inventory", "zhvi")] == ["rent", "rent", "inventory", "sale"]
    assert one(spark, S.iso_day, "2024-01-02T03:04") == "2024-01-02" and one(spark, lambda c: S.label(c, 3), "abcdef") == "abc"
    assert one(spark, lambda c: S.json_map(c)["k"], '{"k": "v"}') == "v" and one(spark, lambda c: S.spend_size(c.cast("double")), "2000000") == "$1M-$10M"
    assert one(spark, lambda a, b: S.use_code_type(a, b, ingest.USE_CODES, ingest.TAX_CLASSES), " 14 ", "002") == "condo" and one(spark, lambda a, b: S.use_code_type(a, b, ingest.USE_CODES, ingest.TAX_CLASSES), "x", "002") == "commercial"
    assert one(spark, lambda c: S.property_type_flags(c)["is_condo"], "Condo unit") == 1 and one(spark, lambda a: S.lot_area(a.cast("double"), F.lit(7.0)), "0") == 7.0


@pytest.mark.parametrize("name", sorted(set(ingest.sources()) | {"attachments"}))
def test_rules_without_optional_fields(spark, name):
    """A table with an unrelated column only: required fields are missing, nothing fails."""
    df = spark.createDataFrame([("x",)], "other string")
    source = ingest.sources().get(name)
    rules = validate.rules_for((source.rules or name) if source else name, df.columns, dt.date(2026, 1, 1))
    errors = validate.validated(df, rules).first().validation_errors
    assert errors or name == "payments"
    if source:
        row = ingest.normalize(df, source, run_id="r", url="u", scraped_at=dt.datetime(2026, 1, 2)).first()
        assert row.extra == {"other": "x"} and row.lineage_run_id == "r" and row.lineage_url == "u" and str(row.partition_date) == "2026-01-02" and row.record_id


def test_rule_sets(spark):
    """One bad value for each kind of rule."""
    cases = {
        "appraisals": ({"SSL": "1", "AYB": "1599", "PRICE": "-1", "GBA": "x"}, 3), "wards": ({"NAME": "w", "WARD": "9"}, 1), "locations": ({"SSL": None, "LATITUDE": "91", "LONGITUDE": None}, 2), "housing": ({"PROJECT_NAME": "p", "UNITS": "-2"}, 1),
        "market": ({"region_name": "r", "metric_name": " ", "metric_value": "1"}, 1), "listings": ({"address": "a", "price": "-1"}, 1), "rentals": ({"unit_number": "", "bedrooms": "21"}, 2), "attachments": ({"contract_id": "c", "text": "short"}, 1),
        "lots": ({"SSL": "1", "RECORD_AREA": "-1"}, 1), "businesses": ({"LICENSE_NUMBER": " "}, 1), "demographics": ({"region_name": "r", "metric_name": "m", "category": None, "metric_value": "z"}, 2), "assessments": ({"OBJECTID": "1", "NEWTOTAL": "-1"}, 1),
    }
    for name, (row, n) in cases.items():
        df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
        assert len(validate.validated(df, validate.rules_for(name, df.columns, dt.date(2026, 1, 1))).first().validation_errors) == n, name


def test_ingest_with_hook(spark):
    df = spark.createDataFrame([("7", "ACME", "$5", "2024-01-02", "run1"), ("8", "B", "x", None, "run2")], "PAYMENTID string, SUPPLIER string, PAYMENTAMOUNT string, PAYMENTDATE string, run_id string")
    good, bad = ingest.ingest(df, ingest.sources()["payments"], transform=lambda d: d.withColumn("big", F.col("payment_amount") > 1), run_id="r9")
    r = good.collect()
    assert len(r) == 1 and r[0].big and r[0].source_record_id == "7" and r[0].lineage_run_id == "r9"
    assert [json.loads(x.original)["PAYMENTID"] for x in bad.collect()] == ["8"]
    # The hash leaves out what differs between runs.
    twice = df.limit(1).unionByName(df.limit(1).withColumn("run_id", F.lit("other")))
    assert ingest.normalize(twice, ingest.sources()["payments"]).select("lineage_raw_hash").distinct().count() == 1


def test_null_drift_both_ways(spark):
    a = spark.createDataFrame([("d", "x", 0.5), ("d", "gone", 0.4), ("d", "same", 0.2)], "dataset string, column string, rate double")
    b = spark.createDataFrame([("d", "x", 0.1), ("d", "new", 0.3), ("d", "same", 0.25)], "dataset string, column string, rate double")
    assert {r.column: r.change for r in quality.null_drift(a, b).collect()} == {"x": -0.4, "gone": -0.4, "new": 0.3}


def test_monitoring(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    report = {r.dataset: r for r in quality.layer_report({"t": df, "e": df.limit(0)}).collect()}
    assert report["all"].rows == 2 and report["t"].avg_null_rate == 0.25 and report["e"].score == 0.8
    checks = quality.check_sla(df, "t", {"required_columns": ["id", "gone"], "max_null_rate": 0.1}).unionByName(quality.check_sla(df, "u", {}))
    loose, strict = ({r.dataset: r.passed for r in quality.validate_layer(checks, s).collect()} for s in (False, True))
    assert loose == {"t": False, "u": True, "all": True} and strict == {"t": False, "u": True, "all": False}
    runs = spark.createDataFrame([("s", i % 10 != 0, float(i)) for i in range(100)] + [("z", False, 1.0)], "source string, ok boolean, latency double")
    h = {r.source: r for r in quality.health(runs).collect()}
    assert (h["s"].latency_p95, h["s"].success_rate, h["z"].quarantine_rate) == (95.0, 90.0, 100.0)
    s = quality.health_summary(quality.health(runs)).first()
    assert (s.sources_run, s.sources_succeeded, s.sources_failed, s.processed) == (2, 1, 1, 101)
    many = spark.range(20_000).select("id", F.when(F.col("id") % 4 != 0, 1).alias("x"))
    rate = {r.column: r for r in quality.sampled_null_rates(many, "m", 0.1, 1000).collect()}["x"]
    assert 1000 < rate.n < 3000 and abs(rate.rate - 0.25) < 0.06
    df.write.partitionBy("id").parquet(f"{tmp_path}/p")
    stats = quality.dataset_stats(spark, f"{tmp_path}/p").first()
    assert (stats.rows, stats.files, stats.partitions, stats.max_null_rate) == (2, 2, 2, 0.5)
    late = quality.freshness(spark, f"{tmp_path}/p", dt.datetime.now() + dt.timedelta(hours=30), 10.0).first()
    assert late.status == "critical"
    assert {(r.column, r.change) for r in quality.schema_drift(df, ["id", "z"]).collect()} == {("name", "new"), ("z", "missing")}
    hit = quality.alerts(spark.createDataFrame([("rate", 0.7), ("n", 1.0)], "name string, value double"), [("rate", "value > 0.5", "critical", "too many nulls")]).collect()
    assert [(r.name, r.severity) for r in hit] == [("rate", "critical")]


def test_layers_and_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("s", "2024-01-01", "5", 1), ("s", "2024-01-02", "x", 2), ("t", "2024-01-01", "7", 3)], "source string, date string, amount string, more int")
    io.append(rows, f"{tmp_path}/l", schema=StructType.fromDDL("amount int, gone string"))
    back = io.scan(spark, f"{tmp_path}/l", "s", dt.date(2024, 1, 2))
    assert [(r.amount, r.gone, r.more) for r in back.collect()] == [(None, None, 2)]
    (tmp_path / "l" / "source=s" / "date=2024-01-02" / "bad.parquet").write_bytes(b"not parquet at all")
    assert io.scan(spark, f"{tmp_path}/l", "s").count() == 2
    io.swap(rows, f"{tmp_path}/g", "r1")
    assert spark.read.parquet(f"{tmp_path}/g/run=r1").count() == 3
    m = spark.createDataFrame([("nulls", "s", 0.5)], "name string, source string, value double")
    io.metrics_json(m, f"{tmp_path}/j"), io.metrics_text(m, f"{tmp_path}/x")
    assert spark.read.json(f"{tmp_path}/j").first().value == 0.5 and spark.read.text(f"{tmp_path}/x").first().value == 'nulls{source="s"} 0.5'
    io.null_rates_csv(quality.null_rates(rows, "d"), f"{tmp_path}/c")
    assert spark.read.csv(f"{tmp_path}/c", header=True).count() == 4
    io.register_schema("own", "a int, b date")
    assert io.conform_to(spark.createDataFrame([("1", "z")], "a string, c string"), "own").first().asDict() == {"a": 1, "b": None, "c": "z"}
    assert all(io.conform_to(rows, t).count() == 3 for t in io.SCHEMAS)
    bad = validate.route(rows, validate.rules_for("wards", rows.columns), "w")[1]
    io.write_quarantine(bad, f"{tmp_path}/q")
    assert io.read_quarantine(spark, f"{tmp_path}/q", "validation_error").count() == 3
    text_file = tmp_path / "f.json"
    text_file.write_text('[{"a": 1}, {"a": 2}]')
    assert io.json_array(spark, str(text_file)).count() == 2 and io.raw_files(spark, str(text_file)).first().records == 2
    (tmp_path / "s.csv").write_text("RegionName,2024-01-31,2024-02-29,2023-12-31\nDC,1,,3\n")
    got = io.series_csv(spark, f"{tmp_path}/s.csv", ["RegionName"], 2).collect()
    assert [(r.metric_date, r.metric_value) for r in got] == [("2024-01-31", 1.0)]
    xml = spark.createDataFrame([("<r><t><SSL>7</SSL><WARD>Ward 2</WARD></t></r>",)], "x string").select(*io.location_reply(F.col("x"), ("SSL", "WARD", "ZIP"))).first()
    assert (xml.ssl, xml.ward, xml.zip) == ("7", "Ward 2", "")


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, d), 10.0 * d) for d in (1, 2, 2, 31)] + [(dt.datetime(2024, 2, 5), 1.0)], "ts timestamp, amount double")
    rows.repartition(1).write.parquet(f"{tmp_path}/in")
    s = stream.monthly_spend(stream.stream_of(spark, f"{tmp_path}/in", rows), "ts", "amount", "400 days")
    q = s.writeStream.format("memory").queryName("days_").outputMode("complete").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.month: (r.spend, r.payments) for r in stream.months_of(spark.table("days_")).collect()}
    assert got == {"2024-01": (360.0, 4), "2024-02": (1.0, 1)}
    p = stream.progress(q)
    assert p["rows"] == 5 and p["batches"] >= 1
    assert stream.clear_progress(spark, f"{tmp_path}/cp") and not stream.clear_progress(spark, f"{tmp_path}/cp")
    pay = spark.createDataFrame([("json", "u1", "h1"), ("json", "u1", "h1"), ("json", "u2", "h2")], "kind string, url string, content_hash string")
    first = stream.unchanged_skipped(pay, spark.createDataFrame([], "signature string"))
    assert first.count() == 2 and stream.unchanged_skipped(pay, first).isEmpty()
    state = spark.createDataFrame([("a", 5)], "source string, high int")
    seen = spark.createDataFrame([("a", 3), ("a", 9), ("b", 1)], "source string, t int")
    assert sorted((r.source, r.t) for r in stream.newer_rows(seen, state, "source", "t").collect()) == [("a", 9), ("b", 1)]
    assert {r.source: r.high for r in stream.advance_watermark(state, seen.where("t < 5"), "source", "t").collect()} == {"a": 5, "b": 1}
    stream.route_stream(stream.stream_of(spark, f"{tmp_path}/in", rows).withColumn("WARD", F.lit("9")), validate.rules_for("wards", ["WARD"]), "w", f"{tmp_path}/ok", f"{tmp_path}/bad", f"{tmp_path}/cp2")
    assert spark.read.json(f"{tmp_path}/bad").count() == 5


class Wards:
    name = "wards"

    def transform(self, spark, inputs):
        return inputs["raw"].select(F.col("w").alias("ward"), "n")

    def schema(self):
        return StructType.fromDDL("ward int, n string")

    def rules(self):
        return [validate.within("ward", 1, 8)]


def test_builder_views_and_feature_store(spark, tmp_path):
    raw = spark.createDataFrame([("3", "a"), ("9", "b")], "w string, n string")
    assert builder.run_builder(spark, Wards(), {"raw": raw}, f"{tmp_path}/w", f"{tmp_path}/q") == builder.Built("wards", 1, 1)
    views = {"v_one": lambda s: s.range(3), "v_two": lambda s: s.range(4)}
    assert warehouse.refresh_views(spark, views, ["v_two"]) == ["v_two"] and spark.table("v_two").count() == 4 and not spark.catalog.tableExists("v_one")
    f = spark.createDataFrame([("a", 1, 2.0), ("b", 3, 4.0)], "vendor_id string, x int, y double")
    got = features.features_of(f, "vendor_id", spark.createDataFrame([("b",), ("b",)], "vendor_id string"), ["y"])
    assert [r.asDict() for r in got.collect()] == [{"vendor_id": "b", "y": 4.0}]
    assert {r.column: r.description for r in features.feature_schema(f, {"x": "count"}).collect()} == {"vendor_id": "", "x": "count", "y": ""}
    meta = features.dataset_metadata(f, "f", dt.datetime(2026, 1, 1)).first()
    assert (meta.row_count, meta.fields) == (2, ["vendor_id", "x", "y"])
    fact = spark.createDataFrame([("s1", "A", 2024, 1, 5.0, "c1"), (None, "B", 2024, 2, 7.0, None)], "supplier_id string, agency_name string, fiscal_year int, fiscal_quarter int, spend_amount double, contract_key string")
    tables = {"fact_spend": fact, "dim_supplier": spark.createDataFrame([("s1", "One", True)], "supplier_id string, supplier_name string, is_cbe boolean"), "dim_contract": spark.createDataFrame([("c1", "t")], "contract_key string, contract_type string")}
    names = semantic.PROCUREMENT.create_views(tables)
    assert "v_procurement_measures" in names and spark.table("v_procurement_measures").first().cbe_share == round(500 / 12, 4)
    assert [r.vendor for r in spark.table("v_procurement_vendor").collect()] == ["One"]


def test_dimension_history_and_merge(spark):
    d = spark.createDataFrame([("a", dt.date(2020, 1, 1), dt.date(2022, 1, 1), False), ("a", dt.date(2022, 1, 1), None, True)], "k string, effective_date date, expiration_date date, is_current boolean")
    assert warehouse.current_rows(d).count() == 1 and warehouse.current_rows(d, dt.date(2021, 5, 5)).first().is_current is False
    m = spark.createDataFrame([(1, None, "n1", 1), (1, 5.0, None, 2), (1, 6.0, "n3", 3)], "k int, lat double, name string, o int")
    assert dedup.fill_merge(m, ["k"], ["lat", "name"], F.col("o")).first().asDict() == {"k": 1, "lat": 5.0, "name": "n1"}
    dist = gold.distribution_map(spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None)], "w int, t string"), "w", "t").first()
    assert json.loads(dist.distribution) == {"a": 1, "b": 2, "unknown": 1}
    q = validate.route(spark.createDataFrame([("9",)], "WARD string"), validate.rules_for("wards", ["WARD"]), "w")[1]
    assert validate.requeue(q, q.select("quarantine_id"), "WARD string").first().WARD == "9" and validate.pending(q, q).count() == 0


def test_plans_of_spend(spark):
    """One read of each source behind the vendor table, and no window over all vendors in one task."""
    from civiclake.plans.bindings import view

    sf = "/root/testdata/sf0.001"
    df = gold.spend_by_vendor(*(view(spark, sf, v) for v in ("contracts", "purchase_orders", "payments", "cbe_businesses")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("lineitem.parquet") <= 6


def test_top_ngrams_shuffle_ids_alone(spark):
    docs = [(1, "b a b a b c"), (2, None), (3, "one"), (4, ""), (5, "x y x y"), (5, "x y"), (None, "p q"), (None, "p q p")]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    got = {(r.doc_id, r.gram, r.uses) for r in text.top_ngrams(df.withColumn("text", F.regexp_replace("text", r"(\w+)", "$1$1")), 2, 2).collect()}
    assert got == {(1, "aa bb", 2), (1, "bb aa", 2), (5, "xx yy", 3), (5, "yy xx", 1), (None, "pp qq", 2), (None, "qq pp", 1)}
    # Ids that no other row has: counted within the row.
    plan = text.top_ngrams(df.where("doc_id < 4"), 2, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and {r.uses for r in text.top_ngrams(df.where("doc_id = 3"), 2, 2).collect()} == set()


def test_pages_are_handed_on_in_small_batches():
    import pyarrow as pa

    pages = pa.RecordBatch.from_pydict({"page_id": list(range(500)), "url": ["http://a.b/"] * 500, "html": ["<title>t</title>", None] * 250})
    out = list(text.page_batches(iter([pages])))
    assert max(b.num_rows for b in out) <= text.PAGES and [i for b in out for i in b.column("page_id").to_pylist()] == list(range(500))
    assert out[0].column("title").to_pylist()[:2] == ["t", None]


def test_supplier_names_fold_by_hash(spark):
    frame = lambda c, *names: spark.createDataFrame([(n,) for n in names], f"{c} string")
    made = warehouse.supplier_names(frame("business_name", "ACME LLC"), frame("supplier_name", "Acme LLC", "Bolt"), frame("supplier_name", "Bolt", "Acme", None))
    got = {r.name: (r.supplier_name, r.is_cbe, r.priority) for r in made.collect()}
    assert got == {"ACME LLC": ("ACME LLC", True, 1), "Acme LLC": ("ACME LLC", True, 1), "Acme": ("ACME LLC", True, 1), "Bolt": ("Bolt", False, 2)}
    # Names fold before anything is sorted: no sort below the first exchange.
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
