"""Loads, replies, quarantine, unreadable files and the semantic planner on odd input."""

import datetime as dt
import json
import os

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from civiclake.functions import sql as sql_functions
from civiclake.operators import features, ingest, quality, validate, warehouse
from civiclake.plans import semantic
from civiclake.sources import io

M = semantic.Measure


def test_facts_are_counted_while_they_are_written(spark, tmp_path):
    pay = [("A LLC", 1, 1, 5, dt.date(2024, 1, 1), "x", "t"), ("B", 2, 1, 6, None, "x", "t"), ("C", 9, 1, 7, dt.date(2024, 1, 2), "x", "t")]
    payments = spark.createDataFrame(pay, "supplier_name string, contract_number long, line int, payment_amount int, payment_date date, agency_name string, payment_type string")
    names = spark.createDataFrame([("A LLC", "s1")], "name string, supplier_id string")
    contracts = spark.createDataFrame([(1,), (1,), (2,)], "contract_number long")
    counts = warehouse.load_facts(payments, names, contracts, str(tmp_path / "f"))
    assert counts == {"raw": 3, "no_date": 1, "transformed": 2, "no_supplier": 1, "no_contract": 1}
    assert spark.read.parquet(str(tmp_path / "f")).count() == 2


def test_replies_of_any_shape(spark):
    one = {"property_id": 7, "list_price": "12.5", "description": {"beds": 2.0}, "location": {"address": {"line": "a", "coordinate": None}}}
    replies = [{"home_search": {"results": [one, {}]}}, [one], {"results": "none"}, {"results": []}, {"properties": [{"listing_id": "x", "price": {"list": 3}, "beds": "two"}]}]
    rows = [(k, json.dumps(r)) for k, r in enumerate(replies)] + [(90, "{cut"), (91, None), (92, "")]
    got = ingest.listing_rows(spark.createDataFrame(rows, "k int, reply string"), "reply").orderBy("k", "property_id").collect()
    assert [(r.k, r.property_id, r.list_price, r.beds, r.line) for r in got] == [(0, None, None, None, None), (0, "7", 12.5, 2, "a"), (1, "7", 12.5, 2, "a"), (4, "x", 3.0, None, None)]


def test_unreadable_files_have_a_reason(spark, tmp_path):
    base = str(tmp_path / "layer")
    rows = spark.range(30).select("id", F.lit("s").alias("source"), F.lit(dt.date(2024, 1, 1)).alias("date"))
    io.append(rows, base)
    rows.where("id < 0").drop("source", "date").coalesce(1).write.parquet(f"{base}/source=s/date=2024-01-03")
    assert io.unreadable_files(spark, base).count() == 0
    folder = f"{base}/source=s/date=2024-01-02"
    os.makedirs(folder)
    whole = next(os.path.join(a, f) for a, _, fs in os.walk(base) for f in fs if f.endswith(".parquet") and "01-01" in a)
    with open(whole, "rb") as f:
        data = f.read()
    for name, part in (("cut.parquet", data[: len(data) // 2]), ("empty.parquet", b""), ("text.parquet", b"no parquet at all, but long enough")):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(part)
    got = {os.path.basename(r.path): (r.n_bytes, r.reason) for r in io.unreadable_files(spark, base).collect()}
    assert set(got) == {"cut.parquet", "text.parquet"} and got["text.parquet"][0] == len(b"no parquet at all, but long enough") and all(reason for _, reason in got.values())
    assert io.scan(spark, base, "s").count() == 30


def test_quarantine_ids_are_stable_and_requeued_rows_leave(spark, tmp_path):
    raw = spark.createDataFrame([("1", None), ("1", None), ("2", "x"), ("3", "5")], "CONTRACT_NUMBER string, CONTRACTAMOUNT string").withColumn("AGENCY_NAME", F.when(F.col("CONTRACT_NUMBER") != "1", "a"))
    source = ingest.sources()["contracts"]
    good, bad = ingest.ingest(raw, source)
    assert good.count() == 1 and sorted(r.quarantine_id for r in bad.collect()) == sorted(r.quarantine_id for r in ingest.ingest(raw.repartition(3), source)[1].collect())
    base = str(tmp_path / "q")
    io.write_quarantine(bad, base)
    ids = io.read_quarantine(spark, base).where("original LIKE '%\"1\"%'").select("quarantine_id")
    schema = "CONTRACT_NUMBER string, CONTRACTAMOUNT string, AGENCY_NAME string"
    assert sorted(r.CONTRACT_NUMBER for r in io.requeue_stored(spark, base, ids, schema).collect()) == ["1", "1"]
    assert io.requeue_stored(spark, base, ids, schema).count() == 0
    assert io.read_quarantine(spark, base).count() == 1 and io.read_quarantine(spark, base, requeued=True).count() == 3 and io.read_quarantine(spark, base, "normalization_error").count() == 0


def test_building_years_follow_the_given_day(spark):
    raw = spark.createDataFrame([("s", "2031")], "SSL string, AYB string")
    source = ingest.sources()["appraisals"]
    assert [ingest.ingest(raw, source, as_of=dt.date(y, 1, 1))[0].count() for y in (2029, 2030, 2031)] == [0, 1, 1]


def test_columns_come_from_the_expression(spark):
    assert semantic.columns_of(spark, "sum(CASE WHEN is_cbe THEN `a b` ELSE t.amount END) / nullif('ab', other)") == {"is_cbe", "a b", "amount", "other"}


def model():
    return semantic.Model("m", "fact", {"c": ("dim", "ab"), "g": ("fact", "g")}, {"s": M("sum", "abc"), "w": M("sum", "CASE WHEN ab = 'x' THEN abc END"), "h": M("median", "abc")}, {"dim": "k", "far": "k2"})


def test_joins_are_those_that_columns_need(spark):
    fact = spark.createDataFrame([("1", 1.5, "p"), ("2", 2.5, "p"), (None, 4.0, None)], "k string, abc double, g string")
    tables = {"fact": fact, "dim": spark.createDataFrame([("1", "x"), ("2", "y")], "k string, ab string"), "far": spark.createDataFrame([("1", "z")], "k2 string, zz string")}
    m = model()
    assert m.needed(tables, ["s"], ["g"]) == {} and m.needed(tables, ["w"], []) == {"dim": ["ab"]} and m.needed(tables, ["s"], [], "zz = 'z'") == {"far": ["zz"]}
    assert "Join" not in m.query(tables, ["s"], ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in m.query(tables, ["s", "w", "h"], ["g"]).collect()} == {("p", 4.0, 1.5, 2.0), (None, 4.0, None, 4.0)}
    assert [tuple(r) for r in m.query(tables, ["h", "s"], []).collect()] == [(2.5, 8.0)]


def test_a_key_of_several_rows_fails_instead_of_multiplying(spark):
    fact = spark.createDataFrame([("1", 1.5, "p")], "k string, abc double, g string")
    tables = {"fact": fact, "dim": spark.createDataFrame([("1", "x"), ("1", "y"), (None, "a"), (None, "b")], "k string, ab string")}
    with pytest.raises(SparkRuntimeException, match="dim has several rows of k 1"):
        model().query(tables, ["s"], ["c"]).collect()
    assert model().query({**tables, "dim": tables["dim"].where("k IS NULL OR ab = 'x'")}, ["s"], ["c"]).first()["s"] == 1.5


def test_table_functions_are_the_date_dimension(spark):
    sql_functions.register(spark)
    lo, hi = dt.date(2023, 12, 30), dt.date(2025, 1, 2)
    got = spark.sql(f"SELECT * FROM dim_date(DATE'{lo}', DATE'{hi}')")
    want = warehouse.dim_date(spark, lo, hi)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.sql(f"SELECT * FROM dim_date(DATE'{hi}', DATE'{lo}')").count() == 0
    assert [tuple(r) for r in spark.sql("SELECT * FROM fiscal_years(2024, 2024)").collect()] == [(2024, dt.date(2023, 10, 1), dt.date(2024, 9, 30), 366)]


def test_errors_of_rules_come_with_their_rows(spark):
    df = spark.createDataFrame([("A", "x")], "AGENCY_NAME string, CONTRACTAMOUNT string")
    bad = validate.route(df, validate.rules_for("contracts", df.columns), "contracts")[1].first()
    assert (bad.error_type, bad.source, json.loads(bad.original)) == ("validation_error", "contracts", {"AGENCY_NAME": "A", "CONTRACTAMOUNT": "x"}) and len(bad.quarantine_id) == 32


def test_severities_have_an_order(spark):
    metrics = spark.createDataFrame([("a", 5.0), ("b", None)], "name string, value double")
    rules = [("a", "value > 1", "info", "i"), ("a", "value > 2", "critical", "c"), ("a", "value > 3", "warning", "w"), ("b", "value IS NULL", "error", "e")]
    got = lambda least: {r.message for r in quality.alerts(metrics, rules, least).collect()}
    assert [got(s) for s in quality.SEVERITIES] == [{"i", "c", "w", "e"}, {"c", "w", "e"}, {"c", "e"}, {"c"}]
    assert quality.alerts(metrics, rules[:1], "critical").count() == 0
    with pytest.raises(ValueError, match="loud"):
        quality.alerts(metrics, [("a", "true", "loud", "x")])


def test_levels_of_thresholds(spark):
    rows = [(n, v) for n in ("cbe_spend_goal", "vendor_concentration", "other") for v in (29.9, 30.0, 39.9, 40.0, 49.9, 50.0, 10.0, 10.1, 20.1, None)]
    got = {(r["name"], r.value): r.level for r in quality.threshold_levels(spark.createDataFrame(rows, "name string, value double")).collect()}
    assert [got["cbe_spend_goal", v] for v in (29.9, 30.0, 39.9, 40.0, 49.9, 50.0, None)] == ["critical", "warning", "warning", "below target", "below target", "met", "unknown"]
    assert [got["vendor_concentration", v] for v in (10.0, 10.1, 20.1)] == ["met", "warning", "critical"] and not any(n == "other" for n, _ in got)


def test_stored_feature_sets_are_listed(spark, tmp_path):
    base = str(tmp_path / "features")
    assert features.feature_sets(spark, base).count() == 0
    spark.range(3).write.parquet(f"{base}/one")
    spark.range(3).selectExpr("id AS k", "array('a') AS names").write.parquet(f"{base}/two")
    assert {tuple(r) for r in features.feature_sets(spark, base).collect()} == {("one", "id", "bigint"), ("two", "k", "bigint"), ("two", "names", "array<string>")}
