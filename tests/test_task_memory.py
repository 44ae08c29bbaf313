"""Steps that keep small what one task holds or runs: the same rows by hand, and the plan without what was costly."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from civiclake.functions import scalars as S
from civiclake.operators import gold, ingest, warehouse
from civiclake.plans import bindings, catalog


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_category_spend_tells_contracts_apart_within_their_row(spark):
    facts = spark.createDataFrame([(1, 2020, 5), (1, 2020, 7), (1, 2021, 1), (2, 2020, 10), (3, 2020, 20), (None, 2020, 40), (9, 2020, 80)], "contract_number long, fiscal_year int, spend_amount int")
    facts = facts.withColumn("spend_amount", F.col("spend_amount").cast("decimal(18,2)"))
    codes = [(1, ["a", "b", "a"]), (2, ["a", None, "Uncategorized"]), (3, []), (4, ["z"])]
    out = warehouse.category_spend(facts, spark.createDataFrame(codes, "contract_number long, nigp_codes array<string>"))
    got = {(r.category, r.fiscal_year): (int(r.spend), r.contracts) for r in out.collect()}
    # A code that a contract lists twice doubles its spend, not its contracts; unknown contracts have no code, facts without a number no contract.
    assert got == {("a", 2020): (34, 2), ("b", 2020): (12, 1), ("a", 2021): (2, 1), ("b", 2021): (1, 1), ("Uncategorized", 2020): (160, 3)}
    assert "distinct" not in plan(out)


def test_numbers_of_raw_rows_stay_small_code(spark):
    """HotSpot leaves a method of more than 8,000 bytes uncompiled, so its rows are interpreted."""
    raw = spark.range(3).selectExpr("id AS SSL", "id AS BEDRM", "id AS BATHRM", "id AS HF_BATHRM", "CAST(id AS decimal(18,2)) AS PRICE", "1900 + id AS AYB", "id * 100 AS GBA", "'CONDO' AS STRUCT_D", "'s' AS STYLE_D", "'q' AS QUALIFIED")
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = ingest.ingest(raw, ingest.sources()["appraisals"], as_of=dt.date(2002, 1, 1))[0].select("record_id", "ssl", "bedrooms", "half_bathrooms", "price", "year_built", "sqft", "bathrooms", "property_type", "price_per_sqft")
        code = rows._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    assert 0 < max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000


@pytest.mark.parametrize(
    "text, number, whole, money",
    [
        ("$1,234.50", 1234.5, 1234, "1234.50"), (" na,n ", None, None, None), ("NaN", None, None, None), ("-Infinity", None, None, None), ("$-", None, None, None), ("n/a", None, None, None), ("", None, None, None), (None, None, None, None),
        ("9007199254740993", 9007199254740992.0, 9007199254740993, "9007199254740993.00"), ("\t9007199254740993", 9007199254740992.0, 9007199254740993, "9007199254740993.00"), ("-12.7", -12.7, -12, "-12.70"), ("1 2", None, None, None),
    ],
)
def test_odd_numbers(spark, text, number, whole, money):
    r = spark.createDataFrame([(text,)], "x string").select(S.safe_float(F.col("x")), S.safe_int(F.col("x")), S.safe_decimal(F.col("x")).cast("string")).first()
    assert tuple(r) == (number, whole, money)


def test_agency_spend_ranks_names_above_zero_alone(spark):
    """Rows without a name take no place, spellings of an agency are one, and an agency without a paid name has null vendors."""
    schema = "supplier_name string, agency_name string, payment_amount int, payment_date date"
    day = dt.date(2020, 11, 1)
    rows = [(None, "A", 900, day), ("x", "A", 5, day), ("y", " a", 7, day), ("X ", "A", 6, None), ("z", "A", -3, day), ("x", "A", 4, day), ("w", "B", 0, day), ("v", None, 50, day)]
    payments = spark.createDataFrame(rows, schema).withColumn("payment_amount", F.col("payment_amount").cast("decimal(18,2)"))
    contracts = payments.where("supplier_name = 'x' AND payment_amount = 5").selectExpr("supplier_name", "agency_name", "payment_amount AS contract_amount", "payment_date AS start_date")
    orders = payments.where("false").selectExpr("supplier_name", "agency_name", "payment_amount AS amount_min", "payment_amount AS amount_max")
    got = {r.agency_key: r for r in gold.agency_spend(contracts, orders, payments, 2).collect()}
    a, b = got["a"], got["b"]
    assert set(got) == {"a", "b"} and (a.agency_name, a.contract_count, a.vendor_count, int(a.total_payments), int(a.total_contract_value)) == (" a", 1, 2, 922, 5)
    assert [(v.vendor, int(v.spend)) for v in a.top_vendors] == [("x", 14), ("y", 7)] and [(y.year, int(y.spend)) for y in a.spend_by_year] == [(2021, 921)]
    assert (b.agency_name, b.vendor_count, int(b.total_payments), b.top_vendors, b.spend_by_year) == ("B", 0, 0, None, None)


def test_contract_history_stores_what_its_loads_read(spark, monkeypatch):
    class Stored(Exception):
        pass

    def stop(df):
        raise Stored(df.columns)

    monkeypatch.setattr(catalog, "materialize", stop)
    with pytest.raises(Stored) as e:
        catalog.dim_contract_history(spark, "/root/testdata/sf0.001")
    assert e.value.args[0] == ["contract_key", "contract_number", "contract_title", "contract_type", "agency_name"]


def tables(spark, folder, third):
    """Orders, lines and suppliers with nulls, repeated keys and names, and keys that nothing else has."""
    made = {
        "nation": ("n_nationkey int, n_name string", [(1, "N"), (2, "M")]),
        "customer": ("c_custkey long, c_nationkey int", [(1, 1), (2, 2), (3, 9), (4, None)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string", [(k, c, "O", 1.0, dt.datetime(1995, 1, 1), "1") for k, c in ((1, 1), (2, 2), (2, 1), (3, 3), (4, 4), (5, None), (None, 1), (7, 1))]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(1, "A", 1, 5.0), (2, "B", 1, -5.0), (2, "A", 2, 1.0), (3, third, 1, 1.0), (4, "D", 1, -1.0), (5, "E", 1, -1.0), (None, "F", 1, -1.0), (6, "A", 9, -1.0), (8, "H", 1, -1.0)]),
        "lineitem": (
            "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp",
            [(o, s, n, 1.0, p, "R", dt.datetime(1995, 1, 1)) for o, s, n, p in ((1, 1, 1, 10.25), (1, 2, 5, 20.0), (2, 2, 2, 30.0), (2, 3, 3, 40.0), (3, 4, 4, 50.0), (4, 4, 0, 60.0), (5, 4, 1, 70.0), (9, 4, 1, 80.0), (7, 5, None, 90.5), (7, 6, -1, None), (7, None, 2, 5.0), (None, 8, 1, 6.0), (7, 9, 1, 7.0), (7, 5, 4, 1.0), (7, 5, 8, 2.0))],
        ),
    }
    for name, (schema, rows) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_folded_views_hold_what_their_views_hold(spark, tmp_path):
    sf = tables(spark, tmp_path, None)
    folded = lambda df, n, s: sorted(map(str, df.groupBy("supplier_name").agg(n, s).collect()))
    want = folded(bindings.view(spark, sf, "payments"), F.count(F.lit(1)).alias("n"), F.sum("payment_amount").cast("decimal(28,2)").alias("s"))
    assert folded(bindings.view(spark, sf, "payment_sums"), F.sum("n").alias("n"), F.sum("s").cast("decimal(28,2)").alias("s")) == want and len(want) > 6
    names = lambda v: {r.supplier_name for r in bindings.view(spark, sf, v).collect()}
    assert names("contract_names") == names("contracts") == {"A LLC", "B LLC", "E LLC"}


@pytest.mark.parametrize("name", ["dim_supplier", "cbe_participation"])
def test_supplier_queries_match_their_sql_and_sort_no_lines(spark, tmp_path, name):
    import duckdb

    sf = tables(spark, tmp_path, "C")  # a null name is null in Spark's concat, empty in DuckDB's
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # As with tables that are too large to broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = catalog.QUERIES[name](spark, sf)
        got, made = sorted(map(str, map(tuple, df.collect()))), df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    db = duckdb.connect()
    for t in ("nation", "customer", "orders", "supplier", "lineitem"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet/*.parquet'")
    assert got == sorted(map(str, db.execute(f"SELECT {', '.join(df.columns)} FROM ({catalog.ORACLES[name]})").fetchall()))
    assert "ShuffledHashJoin [l_orderkey" in made and "Sort [l_orderkey" not in made


def test_cbe_participation_folds_payments_once(spark, tmp_path, monkeypatch):
    stored = []
    monkeypatch.setattr(catalog, "materialize", lambda df: stored.append(df.columns) or df.limit(0))
    # Sums and names both read what is stored: without its rows no payment is left.
    assert catalog.cbe_participation(spark, tables(spark, tmp_path, "C")).count() == 0
    assert stored == [["supplier_name", "n", "s"]]


def test_supplier_history_sorts_no_lines(spark, tmp_path, monkeypatch):
    class Stored(Exception):
        pass

    def stop(df):
        raise Stored(df._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(catalog, "materialize", stop)
    sf, kept = tables(spark, tmp_path, "C"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pytest.raises(Stored) as e:
            catalog.dim_supplier_history(spark, sf)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "ShuffledHashJoin [l_orderkey" in e.value.args[0] and "Sort [l_orderkey" not in e.value.args[0]


def test_folded_views_deal_lines_out_before_they_fold_by_order(spark, tmp_path, monkeypatch):
    sf, kept = tables(spark, tmp_path, "C"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(bindings, "TASK_LINES", 2, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = {v: bindings.view(spark, sf, v) for v in ("contract_names", "payment_sums")}
        plans = {v: df._jdf.queryExecution().executedPlan().toString() for v, df in made.items()}
        assert {r.supplier_name for r in made["contract_names"].collect()} == {"A LLC", "B LLC", "E LLC"}
        assert sum(r.n for r in made["payment_sums"].collect()) == bindings.view(spark, sf, "payments").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    for text in plans.values():
        # 15 lines, two a task: parts follow the lines, beyond the 4 of the session, and both sides have them.
        assert re.search(r"hashpartitioning\(l_orderkey#\d+L?, 8\)", text) and re.search(r"hashpartitioning\(o_orderkey#\d+L?, 8\)", text)
        assert not re.search(r"hashpartitioning\([lo]_orderkey#\d+L?, 4\)", text)
    # The fold by order stands on the exchange, in the task of its part, not on the scan.
    assert re.search(r"partial_min\(l_suppkey#\d+L?\)\].*\n[^\n]*Exchange hashpartitioning\(l_orderkey", plans["contract_names"])
