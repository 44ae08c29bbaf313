import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from civiclake.operators import dedup, order, places, quality, text, validate
from civiclake.sources import io
from civiclake.streaming import stream

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def base_queries():
    return sorted(entry._base()[0])


@pytest.mark.parametrize("name", base_queries())
def test_against_sql(spark, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    sql = entry.oracle_sql()[name]
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.sql(sql).df()
    rows = lambda df: sorted(map(tuple, df[sorted(df.columns)].astype(str).values.tolist()))
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_index_percentile(spark):
    df = spark.range(1, 101).select(F.lit("a").alias("k"), F.col("id").alias("v"))
    r = order.index_percentile(df, ["k"], "v", (50, 90, 99)).first()
    assert (r.p50, r.p90, r.p99) == (51, 91, 100)


def test_contract_rules(spark):
    rows = [("A", None, "100", 2024), (None, None, "1", 2024), ("A", None, "x", 2024), (None, "B", "5", 1800)]
    df = spark.createDataFrame(rows, "AGENCY_NAME string, AGENCY string, CONTRACTAMOUNT string, FISCALYEAR int")
    got = [len(r.validation_errors) for r in validate.validated(df, validate.rules_for("contracts")).collect()]
    assert got == [0, 1, 1, 1]


def test_hash_dedup_and_upsert(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, ""), (5, None)], "id int, h string")
    assert sorted(r.id for r in dedup.dedup_by_hash(df, "h", "id").collect()) == [1, 3, 4, 5]
    new = spark.createDataFrame([(2, "z"), (9, "y")], "id int, h string")
    assert {r.id: r.h for r in dedup.upsert(df, new, "id").collect()}[2] == "z"
    assert sorted(r.id for r in dedup.insert_absent(df, new, "id").collect()) == [9]


def test_null_rates_and_score(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    rates = quality.null_rates(df, "t")
    assert {r.column: r.rate for r in rates.collect()} == {"id": 0.0, "name": 0.5}
    assert quality.quality_score(rates).first().score == pytest.approx(1 - 0.5 * 0.25 - 0.3 * 0.5)


def test_stream_dedup(spark, tmp_path):
    rows = spark.read.parquet(f"{SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.unionByName(rows).write.parquet(f"{tmp_path}/in")
    s = stream.stream_of(spark, f"{tmp_path}/in", rows)
    stream.run_available(stream.dedup_stream(s, "ts", ["event_id"], "60 days"), f"{tmp_path}/out", f"{tmp_path}/cp")
    assert spark.read.parquet(f"{tmp_path}/out").count() == rows.select("event_id").distinct().count()


def test_sections(spark):
    body = "lost\nINTRODUCTION\n one \n\ntwo\nEMPTY PART\n1. Scope of Work\nthree\nSECTION 2: More\nfour\nNot A heading\n"
    rows = text.sections(spark.createDataFrame([(1, body), (2, None), (3, ""), (4, "no headings")], "doc_id int, text string")).orderBy("place").collect()
    assert [(r.heading, r.content) for r in rows] == [("INTRODUCTION", "one\ntwo"), ("1. Scope of Work", "three"), ("SECTION 2: More", "four\nNot A heading")]


def test_reach(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("c", "a"), ("x", "y")], "source string, target string")
    seeds = spark.createDataFrame([("a",), ("a",), (None,)], "url string")
    got = sorted((r.url, r.depth) for r in text.reach(links, seeds, 3).collect())
    assert got == [("a", 0), ("b", 1), ("c", 1), ("d", 2), ("e", 3)]


def test_locate_keeps_points_without_a_place(spark):
    rings = "array(array(struct(0D AS x, 0D AS y), struct(4D AS x, 0D AS y), struct(4D AS x, 4D AS y), struct(0D AS x, 4D AS y)), array(struct(1D AS x, 1D AS y), struct(2D AS x, 1D AS y), struct(2D AS x, 2D AS y)))"
    polygons = spark.sql(f"SELECT 'w' AS layer, n AS place, concat('p', n) AS name, {rings} AS rings FROM VALUES (2), (1) AS t(n)")
    points = spark.createDataFrame([(1, 3.0, 3.0), (2, 1.8, 1.5), (3, 9.0, 9.0), (4, None, 1.0)], "id int, x double, y double")
    got = {r.id: r.w for r in places.locate(points, polygons, ["w"], 1.5).collect()}
    assert got == {1: "p1", 2: None, 3: None, 4: None}


def test_warehouse_rows(spark):
    df = spark.sql("SELECT 1 AS a, array(1, 2) AS b, 'x' AS c")
    assert io.warehouse_rows(df, ["c", "b", "gone"]).first().asDict() == {"c": "x", "b": "[1,2]"}
