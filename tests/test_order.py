"""Ranks, percentiles and medians by group against plain versions, ties and hot groups included."""

import random
from collections import defaultdict
from statistics import median

import pytest
from pyspark.sql import functions as F

from civiclake.operators import order


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(2)
    out = [(k, "hot" if k % 3 else rnd.choice(["a", "b", None]), rnd.choice([None, 1.5, 2.0, 7.25, *map(float, range(40))]), rnd.randint(0, 9)) for k in range(3000)]
    out += [(5000 + k, "tied", 4.0, 1) for k in range(700)] + [(9000, "one", 3.0, 2), (9001, "none", None, 3)]
    return spark.createDataFrame(out, "id long, g string, v double, w int").repartition(5), out


def groups(out):
    by = defaultdict(list)
    for _, g, v, _ in out:
        if v is not None:
            by[g].append(v)
    return {g: sorted(x) for g, x in by.items()}


def test_percent_rank_by_group(rows):
    df, out = rows
    by = groups(out)
    got = {r.id: r.share for r in order.percent_rank(df, ["g"], "v", "share").collect()}
    assert len(got) == len(out)
    for id_, g, v, _ in out:
        want = None if v is None else (sum(x < v for x in by[g]) / (len(by[g]) - 1) if len(by[g]) > 1 else 0.0)
        assert got[id_] == pytest.approx(want), (id_, g, v)


def test_places_and_sums_in_one_pass(rows):
    df, out = rows
    by = groups(out)
    got = order.group_places(df, ["g"], "v", {"p25": 25, "p99": 99}, {"half": 0.5, "tenth": 0.1}, (F.sum("w").alias("w"),), (F.sum("_n").alias("n"), F.sum("w").alias("w"))).collect()
    assert {r.g for r in got} == set(by)
    for r in got:
        s = by[r.g]
        at = lambda p: s[min(len(s) * p // 100, len(s) - 1)]  # noqa: B023, E731
        spot = (len(s) - 1) * 0.1
        tenth = s[int(spot)] + (s[min(int(spot) + 1, len(s) - 1)] - s[int(spot)]) * (spot - int(spot))
        assert (r.p25, r.p99, r.n, r.w) == (at(25), at(99), len(s), sum(w for _, g, v, w in out if g == r.g and v is not None))
        assert r.half == median(s) and r.tenth == pytest.approx(tenth)
    assert order.group_places(df.where("id < 0"), ["g"], "v", {"p25": 25}).count() == 0
    assert [tuple(r) for r in order.group_places(df.where("id < 0"), [], "v", {"p25": 25}).collect()] == [(None,)]
    whole = order.group_places(df, [], "v", {"p50": 50}, {"half": 0.5}).collect()
    every = sorted(x for s in by.values() for x in s)
    assert [(r.p50, r.half) for r in whole] == [(every[len(every) // 2], median(every))]


def test_all_values_equal(spark):
    same = spark.range(500).select(F.lit("g").alias("g"), F.lit(2).alias("v"), "id")
    assert {r.s for r in order.percent_rank(same, ["g"], "v", "s").collect()} == {0.0}
    assert [tuple(r) for r in order.group_places(same, ["g"], "v", {"p9": 9}, {"half": 0.5}).collect()] == [("g", 2, 2.0)]
    places = sorted((r.place, r.id) for r in order.ranked(same, "v", "id").collect())
    assert places == [(k + 1, k) for k in range(500)]


def test_ranked_with_nulls_and_ties(rows, spark):
    df, out = rows
    got = sorted((r.place, r.id) for r in order.ranked(df, "v", "id").collect())
    want = sorted(out, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
    assert got == [(k + 1, r[0]) for k, r in enumerate(want)]
    assert order.ranked(df.where("id < 0"), "v", "id").count() == 0


def test_no_task_sorts_a_group(rows):
    """No exact percentile aggregate, and each window is cut by part or goes over the parts."""
    df, _ = rows
    plan = order.percent_rank(df, ["g"], "v", "s")._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan and all("_part" in x or "_p#" in x or "_rows" in x for x in plan.splitlines() if "Window [" in x)
