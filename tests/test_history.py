"""Dimension history and keyed tables: versions against a plain version, untouched files, repeated loads."""

import datetime as dt
import os
import random
from collections import defaultdict

from civiclake.operators import history
from civiclake.sources import keyed

D = dt.date
SCHEMA = "k string, region int, name string, score int, effective_date date"
KEYS, TRACKED = ["k", "region"], ["name", "score"]


def plain(loads):
    """Versions after each load in turn: those stored and the load's rows, which win on a day."""
    by = defaultdict(dict)
    for load in loads:
        for k, region, name, score, day in load:
            by[k, region][day] = (name, score)
        for days in by.values():
            last = None
            for day in sorted(days):
                if last is not None and days[day] == days[last]:
                    del days[day]
                else:
                    last = day
    out = set()
    for (k, region), days in by.items():
        order = sorted(days)
        for i, day in enumerate(order):
            end = order[i + 1] if i + 1 < len(order) else None
            out.add((k, region, *days[day], day, end, end is None))
    return out


def stored(spark, path):
    rows = history.read_history(spark, path).collect()
    assert len({(r.k, r.region, r.effective_date) for r in rows}) == len(rows)
    return {(r.k, r.region, r["name"], r.score, r.effective_date, r.expiration_date, r.is_current) for r in rows}


def load_of(rnd, first, n, late=0.2):
    seen, out = set(), []
    for _ in range(n):
        k, region = f"k{rnd.randint(0, 40)}", rnd.choice([1, 2, None])
        day = D(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, first) if rnd.random() < late else first + rnd.randint(0, 5))
        if (k, region, day) not in seen:
            seen.add((k, region, day))
            out.append((k, region, rnd.choice(["a", "b", "", None]), rnd.randint(0, 1), day))
    return out


def files(path):
    return {os.path.join(a, f): os.stat(os.path.join(a, f)).st_mtime_ns for a, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_loads_with_late_and_repeated_rows(spark, tmp_path):
    rnd, path = random.Random(11), str(tmp_path / "dim")
    loads = [load_of(rnd, 10 * i, 60) for i in range(4)]
    history.create_history(spark.createDataFrame(loads[0], SCHEMA), path, KEYS, TRACKED, buckets=4)
    assert stored(spark, path) == plain(loads[:1])
    for i in (1, 2, 3):
        df = spark.createDataFrame(loads[i], SCHEMA)
        counts = history.merge_history(spark, path, df, KEYS, TRACKED, str(i))
        assert stored(spark, path) == plain(loads[: i + 1])
        assert counts["changed"] and counts["late"]
        history.merge_history(spark, path, df, KEYS, TRACKED, str(i))
        assert stored(spark, path) == plain(loads[: i + 1])
    on = {(r.k, r.region): r["name"] for r in history.as_of(history.read_history(spark, path), D(2020, 1, 20)).collect()}
    want = {(k, g): n for k, g, n, _, a, b, _ in plain(loads) if a <= D(2020, 1, 20) and (b is None or b > D(2020, 1, 20))}
    assert on == want


def test_changes_leave_other_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "dim")
    first = [(f"k{i}", 1, "a", i, D(2020, 1, 1)) for i in range(200)]
    history.create_history(spark.createDataFrame(first, SCHEMA), path, KEYS, TRACKED, buckets=16)
    before = files(path)
    news = [("k3", 1, "b", 3, D(2020, 2, 1)), ("k4", 1, "a", 4, D(2020, 2, 1)), ("new", None, "n", None, D(2020, 2, 1))]
    assert history.merge_history(spark, path, spark.createDataFrame(news, SCHEMA), KEYS, TRACKED, "1") == {"opened": 1, "changed": 1, "late": 0}
    assert stored(spark, path) == plain([first, news])
    same = {f for f, t in files(path).items() if before.get(f) == t}
    assert len(before) - len(same) <= 2
    before = files(path)
    assert history.merge_history(spark, path, spark.createDataFrame([], SCHEMA), KEYS, TRACKED, "2") == {"opened": 0, "changed": 0, "late": 0}
    assert files(path) == before
    correction = [("k3", 1, "a", 3, D(2020, 2, 1))]
    assert history.merge_history(spark, path, spark.createDataFrame(correction, SCHEMA), KEYS, TRACKED, "3")["late"] == 1
    assert stored(spark, path) == plain([first, news, correction])


def test_history_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "dim")
    history.create_history(spark.createDataFrame([], SCHEMA), path, KEYS, TRACKED)
    assert stored(spark, path) == set()
    row = [("k", None, None, 1, D(2020, 1, 1))]
    history.merge_history(spark, path, spark.createDataFrame(row, SCHEMA), KEYS, TRACKED, "1")
    assert stored(spark, path) == plain([row])


def test_upsert_and_insert_touch_their_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.write_keyed(spark.createDataFrame([(f"k{i}", None if i % 5 else 1, i) for i in range(300)], "k string, g int, v long"), path, ["k", "g"], 16)
    before = files(path)
    new = spark.createDataFrame([("k1", None, -1, "x"), ("k1", None, -9, "w"), ("k7", None, -7, None), ("z", 2, 0, "z")], "k string, g int, v long, more string")
    hit = keyed.upsert_keyed(spark, path, new, ["k", "g"])
    got = {(r.k, r.g): (r.v, r.more) for r in keyed.read_keyed(spark, path).collect()}
    assert len(got) == 301 and got["k1", None] in ((-1, "x"), (-9, "w")) and got["k7", None] == (-7, None) and got["z", 2] == (0, "z") and got["k2", None] == (2, None)
    kept = {f for f, t in files(path).items() if before.get(f) == t}
    assert len(hit) <= 3 and kept == {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in hit}
    before = files(path)
    again = spark.createDataFrame([("k1", None, 5, "no"), ("k1", 1, 5, "yes"), (None, None, 6, "null")], new.schema)
    assert keyed.insert_keyed(spark, path, again, ["k", "g"]) == 2 and keyed.insert_keyed(spark, path, again, ["k", "g"]) == 0
    assert all(files(path)[f] == t for f, t in before.items())
    got = {(r.k, r.g): r.v for r in keyed.read_keyed(spark, path).collect()}
    assert len(got) == 303 and got["k1", 1] == 5 and got[None, None] == 6 and got["k1", None] != 5
    assert keyed.upsert_keyed(spark, path, again.where("false"), ["k", "g"]) == []


def test_only_touched_buckets_are_scanned(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.write_keyed(spark.range(100).selectExpr("CAST(id AS string) AS k", "id AS v"), path, ["k"], 8)
    scan = keyed.read_keyed(spark, path, [1, 2])
    assert "PartitionFilters: [bucket" in scan._jdf.queryExecution().executedPlan().toString() or "bucket#" in scan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert {r.b for r in scan.select(keyed.bucket_of(["k"], 8).alias("b")).distinct().collect()} == {1, 2}
